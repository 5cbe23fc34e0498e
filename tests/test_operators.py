"""DataFrame -> DataFrame operators, incremental helpers and the data dictionary."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ecoflux import schemas as SC
from ecoflux.operators import dictionary, incremental
from ecoflux.operators import shaping as S


def test_select_existing_keeps_list_order_and_skips_missing(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert S.select_existing(df, ["c", "zz", "a"]).columns == ["c", "a"]


def test_cast_decimal_comma_types(spark):
    schema = T.StructType(
        [T.StructField("t", T.StringType()), T.StructField("f", T.FloatType()), T.StructField("i", T.IntegerType())]
    )
    df = spark.createDataFrame([("3,5", 1.1, 7)], schema)
    out = S.cast_decimal_comma(df, ["t", "f", "i", "missing"])
    assert [f.dataType for f in out.schema.fields] == [T.DoubleType()] * 3
    assert tuple(out.first()) == (3.5, 1.1, 7.0)  # the float keeps its short decimal form


def test_to_event_date_from_timestamp_and_text(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 5, 23, 0), "2024-01-05 10:00:00"), (None, "bad")], "ts timestamp_ntz, s string"
    )
    a = S.to_event_date(df.select("ts"), "ts")
    b = S.to_event_date(df.select("s"), "s")
    assert a.columns == ["event_date"] and b.columns == ["event_date"]
    assert [r[0] for r in a.collect()] == [dt.date(2024, 1, 5), None]
    assert [r[0] for r in b.collect()] == [dt.date(2024, 1, 5), None]


def test_add_year_month_ints(spark):
    df = S.add_year_month(spark.createDataFrame([(dt.date(2016, 2, 29),)], "event_date date"))
    assert df.schema["year"].dataType == T.IntegerType()
    assert tuple(df.first()) == (dt.date(2016, 2, 29), 2016, 2)


def test_drop_all_null_counts_nan_as_null(spark):
    df = spark.createDataFrame([(None, None), (None, float("nan")), ("a", None), (None, 1.0)], "s string, x double")
    assert S.drop_all_null(df).count() == 2


def test_sanitize_types_turns_timestamps_to_text(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5, 6, 7), 1)], "ts timestamp_ntz, n int")
    out = S.sanitize_types(df)
    assert out.schema["ts"].dataType == T.StringType() and out.first()["ts"] == "2024-01-01 05:06:07"
    assert out.schema["n"].dataType == T.IntegerType()


def test_conform_orders_and_casts(spark):
    df = spark.createDataFrame(
        [("S1", "SUB", dt.date(2024, 1, 1), 1.5, 2024, 1)],
        "id_subsistema string, nom_subsistema string, event_date date, val_cargaenergiamwmed double, year int, month int",
    )
    out = S.conform(df.select("year", "month", "val_cargaenergiamwmed", "event_date", "nom_subsistema", "id_subsistema"), SC.GOLD_FACT_LOAD)
    assert out.columns == [f.name for f in SC.GOLD_FACT_LOAD.fields]
    assert out.first()["year"] == "2024" and out.first()["month"] == "1"


def test_conditional_sums_null_not_zero_overlap_and_total(spark):
    df = spark.createDataFrame(
        [("d1", "Eólica", 1.0), ("d1", "Solar Eolica", 2.0), ("d1", "Nuclear", 4.0), ("d2", "Nuclear", 8.0)],
        "k string, t string, v double",
    )
    classes = {"wind": ("t", ["%Eólica%", "%Eolica%"]), "solar": ("t", ["%Solar%"])}
    out = {r["k"]: r for r in S.conditional_sums(df, ["k"], "v", classes, total="tot").collect()}
    assert (out["d1"]["wind"], out["d1"]["solar"], out["d1"]["tot"]) == (3.0, 2.0, 7.0)
    assert (out["d2"]["wind"], out["d2"]["solar"], out["d2"]["tot"]) == (None, None, 8.0)


def test_only_years_string_and_int(spark):
    s = spark.createDataFrame([("2016",), ("2017",), ("2018",)], "year string")
    i = spark.createDataFrame([(2016,), (2017,), (2018,)], "year int")
    assert sorted(r[0] for r in S.only_years(s, [2016, 2018]).collect()) == ["2016", "2018"]
    assert sorted(r[0] for r in S.only_years(i, ["2017"]).collect()) == [2017]


def test_coalesce_pairs_left_wins(spark):
    df = spark.createDataFrame([(None, "r1"), ("l2", "r2")], "a_x string, b_x string")
    out = df.select(*S.coalesce_pairs({"x": F.col("a_x")}, {"x": F.col("b_x")}, ["x"]))
    assert [r[0] for r in out.collect()] == ["r1", "l2"]


def test_pending_months_anti_join(spark, tmp_root):
    loaded_df = spark.createDataFrame([(dt.date(2016, 1, 3), 1.0), (dt.date(2016, 2, 3), 1.0)], "event_date date, v double")
    dest = f"{tmp_root}/silver"
    S.add_year_month(loaded_df).write.partitionBy("year", "month").parquet(dest)
    src = spark.createDataFrame([(dt.date(2016, 1, 9),), (dt.date(2016, 3, 1),), (dt.date(2017, 1, 1),), (None,)], "event_date date")
    todo = incremental.pending(incremental.months_of(src), incremental.loaded(spark, dest))
    assert sorted(tuple(r) for r in todo.collect()) == [(2016, 3), (2017, 1)]
    months = spark.createDataFrame([(2016, 3)], "year int, month int")
    assert incremental.restrict_to_months(src, months).count() == 1


def test_dictionary_describe_and_document(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, None)], "id bigint, name string, x double")
    d = dictionary.describe(df, {"id": "identificador"})
    rows = sorted(tuple(r) for r in d.collect())
    assert rows == [
        (1, "id", "INTEGER", "identificador", 2, 2),
        (2, "name", "STRING", "Campo name", 2, 1),
        (3, "x", "FLOAT", "Campo x", 2, 0),
    ]
    doc = dictionary.as_document(d, "Dicionario teste").first()
    assert doc["titulo"] == "Dicionario teste"
    assert [c["codigo"] for c in doc["campos"]] == ["id", "name", "x"]


def test_declared_types(spark):
    from pyspark.sql import types as T

    from ecoflux.operators.contract import conform_declared, lost_values

    df = spark.createDataFrame([(7.0, "1", "x", 1), (7.5, "z", None, None), (None, None, "3", 2)], "k double, n string, other string, m int")
    declared = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("m", T.DoubleType()), T.StructField("absent", T.DateType())])
    out = conform_declared(df, declared)
    assert out.dtypes == [("k", "string"), ("n", "int"), ("other", "string"), ("m", "double")]
    assert [tuple(r) for r in out.collect()] == [("7", 1, "x", 1.0), ("7.5", None, None, None), (None, None, "3", 2.0)]
    assert lost_values(df, declared) == {"n": 1} and lost_values(out, declared) == {}
