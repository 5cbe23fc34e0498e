"""Readers and writers: CSV (plain / gzip), drifted schemas, year-named entries, extracts,
partitioned writes with dynamic overwrite, catalog tables and dictionaries as JSON."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from ecoflux.operators import dictionary
from ecoflux.sources import readers, sinks


def test_read_csv_plain_and_gzip_infer_types(spark, tmp_root):
    df = spark.createDataFrame([(1, "São Paulo", 2.5), (2, "Belém", None)], "id int, nome string, v double")
    df.write.option("header", True).csv(f"{tmp_root}/plain")
    df.write.option("header", True).option("compression", "gzip").csv(f"{tmp_root}/gz")
    for sub in ("plain", "gz"):
        back = readers.read_csv(spark, f"{tmp_root}/{sub}")
        assert dict(back.dtypes) == {"id": "int", "nome": "string", "v": "double"}
        assert sorted(r.nome for r in back.collect()) == ["Belém", "São Paulo"]


def test_read_union_normalises_text_and_double(spark, tmp_root):
    spark.createDataFrame([("a", "1,5")], "k string, v string").write.parquet(f"{tmp_root}/a")
    spark.createDataFrame([("b", 2.5, 9)], "k string, v double, extra int").write.parquet(f"{tmp_root}/b")
    out = readers.read_union(spark, [f"{tmp_root}/a", f"{tmp_root}/b"], ["v"])
    assert sorted((r.k, r.v, r.extra) for r in out.collect()) == [("a", 1.5, None), ("b", 2.5, 9)]


def test_scan_years_names_and_range(spark, tmp_root):
    root = f"{tmp_root}/bronze"
    spark.createDataFrame([(1,)], "x int").write.parquet(f"{root}/DADOS_2015.parquet")
    spark.createDataFrame([(2,)], "x int").write.parquet(f"{root}/dados_2016_03.PARQUET")
    spark.createDataFrame([(3,)], "x int").write.parquet(f"{root}/cadastro.parquet")
    spark.createDataFrame([(4,)], "x int").write.parquet(f"{root}/dados_2025.parquet")
    with open(f"{root}/readme.txt", "w") as fh:
        fh.write("not data")
    all_rows = {r.x: r.file_year for r in readers.scan_years(spark, root).collect()}
    assert all_rows == {1: "2015", 2: "2016", 3: None, 4: "2025"}
    some = {r.x for r in readers.scan_years(spark, root, 2016, 2024).collect()}
    assert some == {2, 3}


def test_entry_names(spark):
    from ecoflux.functions import entry_name, year_in_name

    cases = {
        "file:///a/b/part-0001_2016.parquet": "part-0001_2016.parquet",  # a delivered file keeps its name
        "file:///a/b/dados_2017.PARQUET/part-00000-0199-c000.snappy.parquet": "dados_2017.PARQUET",
        "file:///a/b/2018/dados.parquet": "dados.parquet",
        "file:///a/b/entry=x_2019.parquet/part-1": "entry=x_2019.parquet",
        "file:///a/b/plain": "plain",
    }
    df = spark.createDataFrame([(k,) for k in cases], "p string").select("p", entry_name("p", "/a/b").alias("e"))
    assert {r.p: r.e for r in df.collect()} == cases
    inside = spark.createDataFrame([("s3a://k/lake_2001.parquet/in/x_2016.parquet",)], "p string")
    assert inside.select(year_in_name(entry_name("p", "s3a://k/lake_2001.parquet/in"))).first()[0] == "2016"


def test_schema_groups_do_not_follow_the_file_count(spark, tmp_root, monkeypatch):
    for i in range(12):
        kind = "string" if i < 5 else "double"
        spark.sql(f"SELECT cast({i} AS {kind}) AS v, {i} AS n" + (", 1 AS late" if i > 9 else "")).write.parquet(f"{tmp_root}/x_{i:02d}.parquet")
    paths = [r.path for r in readers.list_files(spark, tmp_root).collect()]
    groups = readers.schema_groups(spark, paths)
    assert sorted(len(p) for p, _ in groups) == [5, 7]
    out = readers.read_union(spark, paths, ["v"])
    assert sorted((r.n, r.v, r.late) for r in out.collect()) == [(i, float(i), 1 if i > 9 else None) for i in range(12)]


def test_shuffle_partitions_follow_the_input():
    from ecoflux.session import shuffle_partitions_for

    assert shuffle_partitions_for(1) == 200 and shuffle_partitions_for(100 << 40) == 819_200


def test_extract_year_and_extract_table(spark, tmp_root):
    df = spark.createDataFrame(
        [(1, dt.datetime(2016, 1, 1, 5, 6, 7), 2016), (2, dt.datetime(2017, 1, 1, 23, 0, 0), 2017)],
        "id int, hora timestamp_ntz, ano int",
    )
    dest = readers.extract_year(df, f"{tmp_root}/extract", years=[2016])
    back = spark.read.parquet(dest).collect()
    assert [(r.id, r.hora, r.ano) for r in back] == [(1, "05:06:07", 2016)]
    assert readers.extract_table(df.where("id > 5"), f"{tmp_root}/empty") is False
    assert not os.path.exists(f"{tmp_root}/empty")
    assert readers.extract_table(df, f"{tmp_root}/csv") is True


def test_write_partitioned_dynamic_overwrite(spark, tmp_root):
    dest = f"{tmp_root}/silver"
    a = spark.createDataFrame([(dt.date(2016, 1, 1), 1.0, 2016, 1), (dt.date(2016, 2, 1), 2.0, 2016, 2)],
                              "event_date date, v double, year int, month int")
    sinks.write_partitioned(a, dest)
    b = spark.createDataFrame([(dt.date(2016, 2, 9), 5.0, 2016, 2)], "event_date date, v double, year int, month int")
    sinks.write_partitioned(b, dest)  # replaces February only
    back = sorted((r.event_date, r.v) for r in spark.read.parquet(dest).collect())
    assert back == [(dt.date(2016, 1, 1), 1.0), (dt.date(2016, 2, 9), 5.0)]


def test_create_table_and_append_years(spark, tmp_root):
    df = spark.createDataFrame([("a", 1.0, "2016", "1"), ("b", 2.0, "2017", "3")], "k string, v double, year string, month string")
    name = "ecoflux_test_append"
    sinks.create_database(spark, "ecoflux_tests")
    sinks.create_table(spark, df.where(F.col("year") == "2016"), f"ecoflux_tests.{name}", path=f"{tmp_root}/t",
                       partition_by=["year", "month"])
    sinks.append_years(df, f"ecoflux_tests.{name}", years=[2017])
    rows = sorted(tuple(r) for r in spark.table(f"ecoflux_tests.{name}").collect())
    assert rows == [("a", 1.0, "2016", "1"), ("b", 2.0, "2017", "3")]
    # re-creating replaces the table
    sinks.create_table(spark, df, f"ecoflux_tests.{name}", path=f"{tmp_root}/t", partition_by=["year", "month"])
    assert spark.table(f"ecoflux_tests.{name}").count() == 2


def test_a_batch_can_be_repeated(spark, tmp_root):
    schema = "k string, v double, year string, month string"
    name, path = "ecoflux_tests.ecoflux_test_batches", f"{tmp_root}/batches"
    sinks.create_database(spark, "ecoflux_tests")
    first = spark.createDataFrame([("a", 1.0, "2016", "1"), ("b", 2.0, "2017", "3")], schema)
    sinks.create_table(spark, first.withColumn("batch", F.lit("one")), name, path=path, partition_by=["year", "month", "batch"])
    rows = lambda: sorted(tuple(r) for r in spark.table(name).drop("batch").collect())
    second = spark.createDataFrame([("c", 3.0, "2017", "3"), ("d", 4.0, "2017", "4")], schema)
    for _ in range(2):
        sinks.append_batch(second, name, path, "two")
        assert rows() == [("a", 1.0, "2016", "1"), ("b", 2.0, "2017", "3"), ("c", 3.0, "2017", "3"), ("d", 4.0, "2017", "4")]
    # a batch whose files were left in part, as by a lost driver, and one with fewer months
    spark.createDataFrame([("c", 3.0)], "k string, v double").write.mode("append").parquet(f"{path}/year=2017/month=3/batch=two")
    sinks.append_batch(second.where("month = '3'"), name, path, "two")
    assert rows() == [("a", 1.0, "2016", "1"), ("b", 2.0, "2017", "3"), ("c", 3.0, "2017", "3")]


def test_write_dictionary_document(spark, tmp_root):
    df = spark.createDataFrame([(1, "x")], "id_municipio int, nome string")
    dest = dictionary.write_document(df, f"{tmp_root}/dict", "Dicionario Municipios")
    part = [f for f in os.listdir(dest) if f.startswith("part-") and f.endswith(".json")]
    doc = json.loads(open(os.path.join(dest, part[0]), encoding="utf-8").read())
    assert doc["titulo"] == "Dicionario Municipios"
    assert doc["campos"] == [
        {"codigo": "id_municipio", "tipo": "INTEGER", "descricao": "Campo id_municipio"},
        {"codigo": "nome", "tipo": "STRING", "descricao": "Campo nome"},
    ]


class _StubContext:
    def __init__(self, master, configured=None):
        self.master, self._configured, self._dir = master, configured, None

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, d):
        self._dir = d

    def getConf(self):
        return {"spark.checkpoint.dir": self._configured} if self._configured else {}


class _StubSession:
    def __init__(self, sc):
        self.sparkContext = sc


def test_checkpoint_root_uses_the_configured_shared_folder():
    from ecoflux.session import checkpoint_root

    sc = _StubContext("spark://master:7077", configured="hdfs:///shared/ckpt")
    assert checkpoint_root(_StubSession(sc)) == "hdfs:///shared/ckpt"


def test_checkpoint_root_refuses_a_local_folder_on_a_cluster():
    import pytest

    from ecoflux.session import checkpoint_root

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_StubSession(_StubContext("yarn")))
    assert checkpoint_root(_StubSession(_StubContext("local[2]")))  # tests, laptops


def test_library_session_defaults(spark):
    """UTC session zone (source timestamps are UTC); no per-call Python call-site capture,
    which otherwise doubles driver-side plan construction; AQE on."""
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.python.sql.dataFrameDebugging.enabled") == "false"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_scratch_is_cleared(spark):
    from ecoflux import session

    before = list(session._scratch)
    session._scratch.clear()
    try:
        df = session.written(spark.range(5), "gone")
        assert df.count() == 5
        path = session._scratch[0].removeprefix("file:")
        assert os.path.isdir(path) and session.clear_scratch(spark) == 1 and not os.path.exists(path)
    finally:
        session._scratch.extend(before)


def test_partitioned_writes_hold_no_rows_for_a_sort(spark, tmp_root):
    rows = spark.range(200_000, numPartitions=1).selectExpr("id", "cast(id AS STRING) AS text", "2024 AS year", "cast(id % 3 + 1 AS INT) AS month")
    key, peaks = "spark.sql.maxConcurrentOutputFileWriters", {}
    before = spark.conf.get(key, None)
    sinks.stage_partitions(spark, rows, f"{tmp_root}/staged")
    sinks.write_partitioned(rows, f"{tmp_root}/written")
    assert spark.conf.get(key, None) == before
    with sinks.unsorted_writes(spark):
        assert int(spark.conf.get(key)) == sinks.OPEN_FILES
    for at in ("staged", "written"):
        back = spark.read.parquet(f"{tmp_root}/{at}")
        assert back.groupBy("month").count().count() == 3 and back.count() == 200_000
