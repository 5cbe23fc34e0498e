"""Readers: Parquet and CSV scans, year-aware file scans, warehouse-style extracts.

File discovery is Spark's own (the file index lists directories on the driver, as any
scan does); selection by the year in a file name is a predicate on the hidden
``_metadata`` columns, which Spark evaluates per file before opening it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ecoflux.functions import entry_name, year_in_name
from ecoflux.operators.contract import conform_declared
from ecoflux.operators.shaping import cast_decimal_comma

# Case-insensitive ``*.parquet`` glob (globs are case-sensitive).
PARQUET_GLOB = "*.[pP][aA][rR][qQ][uU][eE][tT]"


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Plain Parquet scan of one or more files / folders (one schema)."""
    return spark.read.parquet(*paths)


def read_csv(spark: SparkSession, *paths: str, infer_schema: bool = True) -> DataFrame:
    """Headered UTF-8 CSV scan; ``.csv.gz`` is decompressed by the codec on read.

    ``inferSchema`` costs one extra distributed pass over the files; pass an explicit
    schema via ``spark.read`` instead when the layout is known.
    """
    return (
        spark.read.option("header", True)
        .option("inferSchema", infer_schema)
        .option("encoding", "UTF-8")
        .csv(list(paths))
    )


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, mtime in epoch microseconds) of every Parquet file below ``path``; the
    files are not opened."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", PARQUET_GLOB)
        .load(path)
        .select("path", "length", F.unix_micros("modificationTime").alias("mtime"))
    )


def schema_groups(spark: SparkSession, paths: list[str]) -> list[tuple[list[str], T.StructType]]:
    """Group files whose schemas can be merged (same type for the same column).

    Each footer pass is one distributed ``mergeSchema`` job over many files. Only when it
    meets two types for one column is the sorted list halved, so the number of passes
    follows the number of places where the layout changes, not the number of files.
    Groups that agree are put together again, so there is one scan for each layout.
    """
    found: list[tuple[list[str], T.StructType]] = []
    todo = [sorted(paths)] if paths else []
    while todo:
        some = todo.pop()
        try:
            found.append((some, spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(*some).schema))
        except (PySparkException, Py4JJavaError) as e:
            if len(some) == 1 or "CANNOT_MERGE_SCHEMAS" not in str(e):
                raise
            todo += [some[len(some) // 2 :], some[: len(some) // 2]]
    groups: list[tuple[list[str], dict[str, T.DataType]]] = []
    for some, schema in found:
        types = {f.name: f.dataType for f in schema.fields}
        for own, known in groups:
            if all(known.get(n, t) == t for n, t in types.items()):
                own += some
                known |= types
                break
        else:
            groups.append((some, types))
    return [(own, T.StructType([T.StructField(n, t) for n, t in types.items()])) for own, types in groups]


def _common(types: list[T.DataType]) -> T.DataType:
    """The type in which the values of drifted columns meet."""
    if all(t == types[0] for t in types):
        return types[0]
    if all(isinstance(t, T.IntegralType) for t in types):
        return T.LongType()
    return T.DoubleType() if all(isinstance(t, T.NumericType) for t in types) else T.StringType()


def read_union(
    spark: SparkSession,
    paths: list[str],
    numeric_text: list[str] = (),
    with_path: bool = False,
    declared: T.StructType | None = None,
    before: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Scan files whose schemas drifted: one scan for each layout, normalised, unioned by name.

    Columns of ``numeric_text`` become doubles whether a file holds decimal-comma text or
    numbers. Columns of ``declared`` are cast to their types in each layout. Other columns with
    several types meet in a common one (text, if they are not all numbers). Columns that a layout lacks are null. ``with_path`` adds the hidden file
    path as ``_path``. ``before`` sees each layout as it was delivered, and may add columns.
    """
    frames = []
    for own, schema in schema_groups(spark, paths):
        df = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*own)
        df = df.withColumn("_path", F.col("_metadata.file_path")) if with_path else df
        df = before(df) if before else df
        df = cast_decimal_comma(df, list(numeric_text))
        frames.append(conform_declared(df, declared) if declared else df)
    kinds: dict[str, list[T.DataType]] = {}
    for df in frames:
        for f in df.schema.fields:
            kinds.setdefault(f.name, []).append(f.dataType)
    meet = {n: _common(ts) for n, ts in kinds.items() if len(frames) > 1}
    frames = [df.withColumns({n: F.col(f"`{n}`").cast(t) for n, t in meet.items() if n in df.columns and df.schema[n].dataType != t}) for df in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def scan_years(
    spark: SparkSession,
    path: str,
    lo: int | None = None,
    hi: int | None = None,
    year_col: str = "file_year",
) -> DataFrame:
    """Scan every Parquet file below ``path`` and tag rows with the year in the name of
    the delivered entry they come from (first 4-digit run; null when the name has none).

    With ``lo``/``hi`` only entries of those years, plus entries without a year, are read:
    the predicate touches only ``_metadata`` so files of other years are never opened.
    """
    df = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", PARQUET_GLOB)
        .parquet(path)
    )
    fy = year_in_name(entry_name(F.col("_metadata.file_path"), path))
    if lo is not None or hi is not None:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (fy >= F.lit(f"{int(lo):04d}"))
        if hi is not None:
            cond = cond & (fy <= F.lit(f"{int(hi):04d}"))
        df = df.where(fy.isNull() | cond)
    return df.withColumn(year_col, fy)


def with_text_time(df: DataFrame, time_col: str = "hora") -> DataFrame:
    """Replace a time-of-day column by its text (``HH:mm:ss`` for timestamps)."""
    dtype = df.schema[time_col].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        text = F.date_format(time_col, "HH:mm:ss")
    else:
        text = F.col(time_col).cast("string")
    return df.withColumn(time_col, text)


def extract_year(
    df: DataFrame, dest: str, year_col: str = "ano", time_col: str = "hora", years: list[int] | None = None
) -> str:
    """Land a warehouse table as Parquet, one folder per year (``ano=YYYY``), with the
    time column stored as text. Every task writes its own files: nothing is buffered on
    the driver. Years already landed are replaced, others are left alone."""
    out = with_text_time(df, time_col)
    if years is not None:
        out = out.where(F.col(year_col).isin(list(years)))
    (
        out.hint("rebalance", year_col)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(year_col)
        .parquet(dest)
    )
    return dest


def extract_table(df: DataFrame, dest: str) -> bool:
    """Land a whole table as headered UTF-8 CSV; nothing is written when it is empty."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(dest)
    return True
