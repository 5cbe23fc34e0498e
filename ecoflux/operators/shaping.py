"""DataFrame -> DataFrame shaping transforms (usable with ``df.transform``).

These only build logical plans; Catalyst prunes the columns they drop all the way to
the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ecoflux.functions import decimal_comma, like_any, to_date_lenient


def select_existing(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Keep the listed columns that exist, in list order; missing ones are skipped."""
    present = set(df.columns)
    return df.select([c for c in cols if c in present])


def cast_decimal_comma(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Turn decimal-comma text columns into doubles (columns that are absent are skipped).

    Integral, decimal and double inputs are cast directly (same value, no text round
    trip); text and float inputs go through :func:`decimal_comma`, so a 32-bit float keeps
    its short decimal form (1.1 stays 1.1).
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    direct = (T.DoubleType, T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.DecimalType)
    out = {}
    for c in cols:
        if c not in fields:
            continue
        if isinstance(fields[c], direct):
            out[c] = F.col(c).cast("double")
        else:
            out[c] = decimal_comma(c)
    return df.withColumns(out) if out else df


def to_event_date(df: DataFrame, src: str = "din_instante", dest: str = "event_date") -> DataFrame:
    """Add the calendar date of ``src`` as ``dest`` and drop ``src``."""
    if src not in df.columns:
        return df.withColumn(dest, F.lit(None).cast("date"))
    dtype = df.schema[src].dataType.typeName()
    return df.withColumn(dest, to_date_lenient(F.col(src), dtype)).drop(src)


def add_year_month(df: DataFrame, date_col: str = "event_date") -> DataFrame:
    """Integer ``year`` and ``month`` partition columns from a date."""
    return df.withColumns(
        {
            "year": F.year(date_col).cast("int"),
            "month": F.month(date_col).cast("int"),
        }
    )


def drop_all_null(df: DataFrame) -> DataFrame:
    """Drop rows where every column is null (NaN counts as null, as in ``na.drop``)."""
    return df.na.drop(how="all")


def sanitize_types(df: DataFrame) -> DataFrame:
    """Store time-like columns (``timestamp``, ``timestamp_ntz``) as text before writing.

    The source's TIME columns cannot be written by every engine; timestamps are stored
    as text too, which is the layout the silver tables have.
    """
    timey = (T.TimestampType, T.TimestampNTZType)
    if not any(isinstance(f.dataType, timey) for f in df.schema.fields):
        return df
    return df.select(
        [
            F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, timey) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to ``schema``: its columns, in its order, with its types (strict casts)."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def coalesce_pairs(
    left_cols: Mapping[str, Column], right_cols: Mapping[str, Column], names: Iterable[str]
) -> list[Column]:
    """``coalesce(left.x, right.x) AS x`` for each name: the left value wins."""
    return [F.coalesce(left_cols[n], right_cols[n]).alias(n) for n in names]


def conditional_sums(
    df: DataFrame,
    keys: list[str],
    value: Column | str,
    classes: Mapping[str, tuple[str, list[str]]],
    total: str | None = None,
) -> DataFrame:
    """Group by ``keys`` and sum ``value`` per class of ``LIKE`` patterns.

    ``classes`` maps an output name to ``(column, patterns)``. A row counts in every class
    it matches; a class with no matching row in a group is null (no ELSE 0). ``total``
    names the plain sum over all rows of the group.
    """
    v = F.col(value) if isinstance(value, str) else value
    aggs = [F.sum(F.when(like_any(col, pats), v)).alias(name) for name, (col, pats) in classes.items()]
    if total:
        aggs.append(F.sum(v).alias(total))
    return df.groupBy(*keys).agg(*aggs)


def only_years(df: DataFrame, years: Iterable[int | str], col: str = "year") -> DataFrame:
    """Rows of the given years. Put on a result, it reaches the scans' partition filters
    when ``col`` is carried through the plan as a grouping / join key."""
    wanted = list(years)
    if isinstance(df.schema[col].dataType, T.StringType):
        return df.where(F.col(col).isin([str(y) for y in wanted]))
    return df.where(F.col(col).isin([int(y) for y in wanted]))


def only_months(df: DataFrame, months: Iterable[tuple[int, int]], year_col: str = "year", month_col: str = "month") -> DataFrame:
    """Rows of the given (year, month) pairs, as a literal predicate per year
    (``year = y AND month IN (...)``) so it reaches partition filters like ``only_years``."""
    by_year: dict[int, list[int]] = {}
    for y, m in months:
        by_year.setdefault(int(y), []).append(int(m))
    if not by_year:
        return df.where(F.lit(False))
    as_text = isinstance(df.schema[year_col].dataType, T.StringType)
    lit = (lambda v: str(v)) if as_text else (lambda v: v)
    cond = None
    for y, ms in sorted(by_year.items()):
        c = (F.col(year_col) == lit(y)) & F.col(month_col).isin([lit(m) for m in sorted(set(ms))])
        cond = c if cond is None else cond | c
    return df.where(cond)
