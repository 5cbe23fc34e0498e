"""Plan shape: what a 100 TB run depends on, checked on the physical plans.

* partial (map-side) aggregation before every aggregate exchange of the daily rollups,
  and the exact distinct plant count planned two-level (first shuffle on group + plant);
* column pruning: scans read only the columns a result uses (``ReadSchema``);
* a year filter on a gold result reaches the silver scans as partition filters;
* the file-name year predicate of ``scan_years`` is evaluated per file, before reading;
* no Python evaluation, cartesian product or nested-loop join anywhere (checked on the
  final AQE plan of every registered query in ``test_oracle.py``).
"""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ecoflux.operators.shaping import only_years
from ecoflux.plans import gold, silver
from ecoflux.session import written
from ecoflux.sources import adapters as A
from ecoflux.sources import readers, sinks

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    """Physical plan text (the final AQE plan once ``df`` has run), untruncated."""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module", autouse=True)
def full_metadata(spark):
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    yield
    spark.conf.set("spark.sql.maxMetadataStringLength", old)


def read_schema(text: str, table: str) -> set[str]:
    """Column names of the ``ReadSchema`` of the scan of ``table``."""
    for line in text.splitlines():
        if "FileScan" in line and f"/{table}.parquet" in line:
            m = re.search(r"ReadSchema: struct<(.*)>", line)
            return {f.split(":")[0] for f in m.group(1).split(",")}
    raise AssertionError(f"no scan of {table}")


def test_weather_rollup_aggregates_map_side(spark):
    p = plan(E.queries()["weather_daily"](spark, SF))
    assert "partial_sum(precipitacao_total" in p and "partial_avg(radiacao_global" in p
    assert "partial_max(temperatura_bulbo_hora" in p and "partial_min(temperatura_bulbo_hora" in p


def test_distinct_plant_count_is_two_level(spark):
    """A hot (day, subsystem, state, type) group is first shuffled by plant as well."""
    df = E.queries()["generation_daily"](spark, SF)
    df.collect()
    p = plan(df)
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    assert any("nom_usina" in e for e in exchanges)
    assert "partial_count(distinct nom_usina" in p and "partial_sum(val_geracao" in p


def test_scans_read_only_used_columns(spark):
    p = plan(E.queries()["hydro_efficiency"](spark, SF))
    # lineitem: comment, ship instructions/mode and the other dates are never read
    assert not read_schema(p, "lineitem") & {"l_comment", "l_shipinstruct", "l_shipmode", "l_commitdate", "l_receiptdate"}
    assert not read_schema(p, "orders") & {"o_comment", "o_clerk", "o_shippriority"}
    p = plan(E.queries()["weather_daily"](spark, SF))
    assert read_schema(p, "events") <= {"event_id", "ts", "user_id", "event_type", "value"}


def test_year_filter_reaches_silver_partition_filters(spark, tmp_root):
    hyd, gen = f"{tmp_root}/hydrology", f"{tmp_root}/generation"
    sinks.write_partitioned(silver.hydrology(A.hydrology_raw(spark, SF)), hyd)
    sinks.write_partitioned(silver.generation_daily(A.generation_raw_orders(spark, SF)), gen)
    out = only_years(gold.hydro_efficiency(spark.read.parquet(gen), spark.read.parquet(hyd)), [1996])
    p = plan(out)
    scans = [line for line in p.splitlines() if "FileScan parquet" in line]
    assert any(f"{hyd}]" in s for s in scans) and any(f"{gen}]" in s for s in scans)
    for s in scans:  # every scan, those of the dynamic-pruning subqueries included
        filters = s.split("PartitionFilters: [", 1)[1].split("PushedFilters:", 1)[0]
        assert "1996" in filters, s
    assert "dynamicpruningexpression" in p  # the joined side is pruned at run time too
    rows = out.collect()
    assert rows and {r.year for r in rows} == {"1996"}


def test_file_year_predicate_prunes_files(spark, tmp_root):
    """The year-in-name predicate touches only ``_metadata``: the file index evaluates it
    per file while listing, so files of other years are never opened."""
    import glob

    root = f"{tmp_root}/bronze"
    o = A.table(spark, SF, "orders")
    entry = F.concat(F.lit("orders_"), F.year("o_orderdate").cast("string"), F.lit(".parquet"))
    o.select("o_orderkey", entry.alias("entry")).write.partitionBy("entry").parquet(root)
    df = readers.scan_years(spark, root, 1996, 1996)
    years = {r.file_year for r in df.collect()}
    assert years == {"1996"}
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    files_read = scan.metrics().apply("numFiles").value()
    all_files = glob.glob(f"{root}/*/part-*.parquet")
    files_1996 = glob.glob(f"{root}/entry=orders_1996.parquet/part-*.parquet")
    assert 0 < files_read == len(files_1996) < len(all_files)


@pytest.mark.parametrize("name", ["dim_time", "plant_class_pivot", "hydro_efficiency", "weather_generation_bridge"])
def test_unread_aggregates_are_pruned(spark, name):
    """Results that do not read the daily plant count do not compute it (nor shuffle for
    it): the silver rollups carry no filter over every column that would pin it."""
    p = plan(E.queries()[name](spark, SF))
    assert "count(distinct" not in p and "nom_usina" not in p


@pytest.mark.parametrize("name", ["weather_daily", "fact_weather", "weather_generation_bridge"])
def test_each_reading_is_parsed_once(spark, name):
    """Gold's null-date filters fold away on the (non-nullable) daily weather date rather
    than being pushed below the rollup, where they would parse every reading again."""
    optimized = E.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("convert_timezone(") == 1


def test_hot_state_is_spread_when_nothing_is_broadcast(spark):
    """A state holding a third of the station-days: the state-name map meets the stations,
    not the facts, so even without any broadcast no fact is dealt out by state name alone."""
    import datetime as dt

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    day0 = F.lit(dt.date(2024, 1, 1))
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        weather = spark.range(30000).select(
            F.concat(F.lit("E"), (F.col("id") % 300).cast("string")).alias("id_estacao"),
            F.date_add(day0, (F.col("id") / 300).cast("int")).alias("event_date"),
            *[F.lit(1.0).alias(c) for c in ("precipitacao_total", "radiacao_global", "temperatura_media",
                                             "temperatura_maxima", "temperatura_minima", "vento_velocidade_media")],
        ).withColumns({"year": F.year("event_date"), "month": F.month("event_date")})
        location = spark.range(300).select(
            F.concat(F.lit("E"), F.col("id").cast("string")).alias("id_estacao"),
            F.when(F.col("id") < 100, "HOT").otherwise(F.concat(F.lit("UF"), (F.col("id") % 40).cast("string"))).alias("nome_uf"),
            *[F.lit(x).alias(c) for c, x in (("sigla_uf", "X"), ("nome_regiao", "R"), ("nome_municipio", "M"),
                                             ("latitude", 0.0), ("longitude", 0.0))],
        )
        state = F.when(F.col("id") % 41 == 40, "HOT").otherwise(F.concat(F.lit("UF"), (F.col("id") % 41).cast("string")))
        generation = spark.range(4000).select(
            F.date_add(day0, (F.col("id") % 100).cast("int")).alias("event_date"),
            (F.col("id") % 2).cast("string").alias("id_subsistema"),
            F.concat(F.lit("SUB"), (F.col("id") % 2).cast("string")).alias("nom_subsistema"),
            (F.col("id") % 41).cast("string").alias("id_estado"),
            state.alias("nom_estado"),
            F.lit("Solar").alias("nom_tipousina"),
            F.lit(1.0).alias("val_geracao_total_mwmed"),
        ).withColumns({"year": F.year("event_date"), "month": F.month("event_date")})
        load = generation.select("event_date", "nom_subsistema", "year", "month", F.lit(5.0).alias("val_cargaenergiamwmed"))
        out = gold.bridge(weather, written(gold.places(location, gold.state_names(generation)), "places"), generation, load)
        out.collect()
        p = plan(out)
        dealt = re.findall(r"hashpartitioning\(([^)]*)\)", p)
        assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p
        assert dealt and all(re.search("event_date|id_estacao|place_id", by) for by in dealt)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hydrology_is_a_projection(spark):
    p = plan(E.queries()["hydrology_daily"](spark, SF))
    assert "Exchange" not in p and "Python" not in p


def test_bridge_does_not_shuffle_weather_for_places(spark):
    """600 stations and 5,570 municipalities: with the written places the first join is a
    broadcast, straight on the weather rows, although both registers' product is large."""
    stations = spark.range(600).selectExpr("concat('E', id) AS id_estacao", "cast(id * 9 AS int) AS id_municipio", "'s' AS estacao",
                                           "DATE'2006-01-01' AS data_fundacao", "1.0 AS latitude", "2.0 AS longitude", "3.0 AS altitude")
    towns = spark.range(5570).selectExpr("cast(id AS int) AS id_municipio", "concat('T', id) AS nome", "'U' AS sigla_uf",
                                         "concat('UF', id % 27) AS nome_uf", "'R' AS nome_regiao")
    generation = written(silver.generation_daily(A.generation_raw(spark, SF)), "generation")
    weather = written(silver.weather_daily(A.weather_raw(spark, SF)), "weather")
    location = written(gold.dim_location(stations, towns), "location")
    places = written(gold.places(location, gold.state_names(generation)), "places")
    out = gold.bridge(weather, places, generation, silver.load(A.load_raw_events(spark, SF)))
    out.collect()
    p = plan(out).split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
    lines = p.splitlines()
    scan = next(i for i, x in enumerate(lines) if "FileScan" in x and "vento_velocidade_media" in x)
    depth = lambda x: len(re.match(r"[\s:+\-|]*", x)[0])
    above, now = [], depth(lines[scan])
    for x in reversed(lines[:scan]):  # the operators over the weather scan, nearest first
        if depth(x) < now:
            above.append(x)
            now = depth(x)
    first_join = next(i for i, x in enumerate(above) if "Join" in x)
    assert "BroadcastHashJoin" in above[first_join] and not any("Exchange" in x or "ShuffleQueryStage" in x for x in above[:first_join])


def test_flagship_reads_events_three_times(spark):
    reads = {"n": 0}
    old = A.table

    def counted(s, d, name):
        reads["n"] += name == "events"
        return old(s, d, name)

    A.table = counted
    try:
        E.queries()["weather_generation_bridge"](spark, SF).collect()
    finally:
        A.table = old
    assert reads["n"] <= 3
