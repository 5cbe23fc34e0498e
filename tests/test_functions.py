"""Column expressions: decimal commas, UTC hours, local dates, calendar, ratios, patterns."""

import datetime as dt
import math

from pyspark.sql import functions as F

from ecoflux import functions as X


def _one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("v")).collect()]


def test_decimal_comma_edge_cases(spark):
    data = [("1,5",), ("1.5",), ("",), ("1.234,56",), (None,), (" 2,25 ",), ("-0,5",), ("abc",), ("10",)]
    got = _one(spark, X.decimal_comma("s"), data, "s string")
    assert got == [1.5, 1.5, None, None, None, 2.25, -0.5, None, 10.0]


def test_decimal_comma_numeric_input_round_trips(spark):
    got = _one(spark, X.decimal_comma("x"), [(1.25,), (1e10,), (None,)], "x double")
    assert got == [1.25, 1e10, None]


def test_strip_utc_marker(spark):
    data = [("12:00:00 UTC",), ("12:00:00",), ("UTC 12:00:00  UTC",), ("12:00:00 utc",)]
    assert _one(spark, X.strip_utc_marker("h"), data, "h string") == ["12:00:00", "12:00:00", "12:00:00", "12:00:00 utc"]


def test_utc_reading_ts_shapes(spark):
    data = [
        ("2024-01-05", "12:00:00"),
        ("2024-01-05", "13:00:00 UTC"),
        ("2024-01-05", "1200"),
        ("2024-01-05", None),
        (None, "12:00:00"),
        ("2024-01-05", "25:00:00"),
        ("bad", "12:00:00"),
    ]
    got = _one(spark, X.utc_reading_ts("d", "h"), data, "d string, h string")
    assert got == [dt.datetime(2024, 1, 5, 12), dt.datetime(2024, 1, 5, 13), None, None, None, None, None]


def test_local_date_both_dst_regimes_and_year_crossing(spark):
    data = [
        ("2018-01-01", "01:30:00"),  # summer time, -02:00 -> 2017-12-31 23:30
        ("2020-01-01", "01:30:00"),  # no DST any more, -03:00 -> 2019-12-31 22:30
        ("2024-01-01", "02:59:59"),  # -03:00 -> 2023-12-31
        ("2024-01-01", "03:00:00"),  # -> 2024-01-01 00:00
        ("2018-07-01", "02:00:00 UTC"),  # winter -03:00 -> 2018-06-30
    ]
    got = _one(spark, X.local_date("d", "h"), data, "d string, h string")
    assert got == [dt.date(2017, 12, 31), dt.date(2019, 12, 31), dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2018, 6, 30)]
    hours = _one(spark, F.hour(X.utc_to_local(X.utc_reading_ts("d", "h"))), data[:2], "d string, h string")
    assert hours == [23, 22]


def test_iso_weekday_weekend_and_names(spark):
    # 2024-01-06 is a Saturday, 2024-01-07 a Sunday, 2024-01-08 a Monday
    data = [(dt.date(2024, 1, 6),), (dt.date(2024, 1, 7),), (dt.date(2024, 1, 8),)]
    df = spark.createDataFrame(data, "d date")
    rows = df.select(X.iso_weekday("d"), X.is_weekend("d"), X.weekday_name("d"), X.month_name("d")).collect()
    assert [tuple(r) for r in rows] == [
        (6, True, "Saturday", "January"),
        (7, True, "Sunday", "January"),
        (1, False, "Monday", "January"),
    ]


def test_safe_ratio(spark):
    data = [(10.0, 4.0), (10.0, 0.0), (10.0, -2.0), (10.0, None), (None, 2.0)]
    assert _one(spark, X.safe_ratio("n", "d"), data, "n double, d double") == [2.5, None, None, None, None]


def test_like_any_is_case_and_accent_sensitive(spark):
    data = [("Hidrelétrica",), ("HIDRELÉTRICA",), ("UHE Hidrel",), ("Eolica",), ("Eólica",), (None,)]
    assert _one(spark, X.like_any("t", X.PLANT_CLASS_PATTERNS["hidro"]), data, "t string") == [True, False, True, False, False, None]
    assert _one(spark, X.like_any("t", X.PLANT_CLASS_PATTERNS["eolica"]), data, "t string") == [False, False, False, True, True, None]


def test_year_in_name_and_entry_name(spark):
    data = [
        ("s3://b/x/DADOS_2016.parquet",),
        ("file:/r/geracao_2019_05.PARQUET",),
        ("file:/r/x_2020.parquet/part-00000-abc-c000.snappy.parquet",),
        ("file:/r/cadastro.parquet",),
    ]
    got = _one(spark, X.year_in_name(X.entry_name("p")), data, "p string")
    assert got == ["2016", "2019", "2020", None]


def test_decimal_comma_nan_text_is_double_nan(spark):
    got = _one(spark, X.decimal_comma("s"), [("NaN",)], "s string")
    assert math.isnan(got[0])
