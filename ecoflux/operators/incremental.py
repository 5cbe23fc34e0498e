"""Incremental loading at (year, month) grain.

The source job marked a whole *year* as loaded as soon as any ``year=`` folder existed,
so later monthly files were never read and a spill-over day created a false year. Here
pending work is a set difference of (year, month) frames, computed by Spark, and the
months a batch touches are derived from the *output* dates (after the UTC -> local
shift), so every source row that lands in a month is re-read before that month is
overwritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

YM = ["year", "month"]


def months_of(df: DataFrame, date_col: str = "event_date") -> DataFrame:
    """Distinct (year, month) of a date column (partial distinct before the shuffle)."""
    d = F.col(date_col)
    return (
        df.where(d.isNotNull())
        .select(F.year(d).cast("int").alias("year"), F.month(d).cast("int").alias("month"))
        .distinct()
    )


def loaded(spark: SparkSession, dest: str) -> DataFrame:
    """(year, month) partitions already present in a ``year=/month=`` folder.

    Only the partition columns are selected, so no data column is read.
    """
    return (
        spark.read.parquet(dest)
        .select(F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"))
        .distinct()
    )


def pending(source_months: DataFrame, loaded_months: DataFrame) -> DataFrame:
    """Source months not yet loaded (anti join; both sides are tiny after ``distinct``)."""
    return source_months.join(loaded_months, on=YM, how="left_anti")


def restrict_to_months(df: DataFrame, months: DataFrame, date_col: str = "event_date") -> DataFrame:
    """Rows of ``df`` whose date falls in one of ``months`` (semi join)."""
    d = F.col(date_col)
    keyed = df.withColumns({"__y": F.year(d).cast("int"), "__m": F.month(d).cast("int")})
    m = months.select(F.col("year").alias("__y"), F.col("month").alias("__m"))
    return keyed.join(m, on=["__y", "__m"], how="left_semi").drop("__y", "__m")
