"""AvailableNow file stream: new files trigger the ledger's load; year-end months stay whole."""

from pyspark.sql import functions as F

from ecoflux import streaming
from ecoflux.plans import pipeline as P
from ecoflux.sources import adapters as A
from tests.test_pipeline import SF, WEATHER_SCHEMA, _age, _dec_days, _december_2023


def test_stream_lands_new_and_late_files(spark, tmp_root):
    lake = P.local_lake(tmp_root)
    lake.database = "ecoflux_test_stream"
    _december_2023(spark).write.parquet(lake.src("weather") + "/inmet_microdados_raw_2023.parquet")
    streaming.land_series_now(spark, lake, "weather")
    assert _dec_days(spark, lake) == 31

    A.weather_raw(spark, SF).drop("event_id").write.parquet(lake.src("weather") + "/inmet_microdados_raw_2024.parquet")
    streaming.land_series_now(spark, lake, "weather")
    months = lambda: {(r.year, r.month) for r in spark.table(lake.silver_table("weather")).select("year", "month").distinct().collect()}
    assert _dec_days(spark, lake) == 31 and months() == {(2023, 12), (2024, 1)}

    # a file that is ten days older than the others is not skipped
    late = spark.createDataFrame([("E7", "2023-11-10", "12:00:00", "5,0", "1,0", "25,0", 3.0)], WEATHER_SCHEMA)
    late.write.parquet(lake.src("weather") + "/inmet_microdados_raw_2023_11.parquet")
    _age(lake.src("weather") + "/inmet_microdados_raw_2023_11.parquet", days=10)
    streaming.land_series_now(spark, lake, "weather")
    assert months() == {(2023, 11), (2023, 12), (2024, 1)}

    before = spark.table(lake.silver_table("weather")).count()
    streaming.land_series_now(spark, lake, "weather")  # nothing new
    assert spark.table(lake.silver_table("weather")).count() == before


def test_stream_year_range(spark, tmp_root):
    lake = P.local_lake(tmp_root)
    lake.database, lake.years = "ecoflux_test_stream_years", (2024, 2024)
    _december_2023(spark).write.parquet(lake.src("weather") + "/inmet_microdados_raw_2023.parquet")
    A.weather_raw(spark, SF).drop("event_id").write.parquet(lake.src("weather") + "/inmet_microdados_raw_2024.parquet")
    streaming.land_series_now(spark, lake, "weather")
    assert spark.table(lake.silver_table("weather")).where(F.col("year") != 2024).isEmpty()
