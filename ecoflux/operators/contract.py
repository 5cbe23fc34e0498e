"""Declared column types: deliveries are cast to them before anything is written.

A delivery may bring a column in another type than the one before (keys as numbers, numbers as
text). Each layout is cast to the declared type when it is read, so that values which mean the
same meet (group keys, joins), and a table keeps one type for all its partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_declared(col: Column, have: T.DataType, want: T.DataType) -> Column:
    """``col`` in the declared type. A whole number becomes text without a fraction (a key that
    a delivery has as ``7.0`` is the ``7`` of the others); what cannot be read becomes null."""
    if have == want:
        return col
    if isinstance(want, T.StringType) and isinstance(have, (T.DoubleType, T.FloatType, T.DecimalType)):
        whole = (col == F.floor(col)) & (F.abs(col) < F.lit(10**18))
        return F.when(whole, col.cast("decimal(20,0)").cast("string")).otherwise(col.cast("string"))
    return col.try_cast(want)


def may_lose(have: T.DataType, want: T.DataType) -> bool:
    """Whether a value can get lost on the way from one type to the other."""
    if have == want or isinstance(have, T.NullType) or isinstance(want, T.StringType):
        return False
    order = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]
    if type(have) in order and type(want) in order:
        return order.index(type(have)) > order.index(type(want))
    return not (isinstance(have, T.DecimalType) and isinstance(want, T.DoubleType))


def conform_declared(df: DataFrame, declared: T.StructType) -> DataFrame:
    """``df`` with its declared columns in their types. Other columns stay as they are, and
    declared ones that ``df`` lacks are not added."""
    types = {f.name: f.dataType for f in declared}
    odd = {f.name: as_declared(F.col(f"`{f.name}`"), f.dataType, types[f.name]) for f in df.schema if types.get(f.name, f.dataType) != f.dataType}
    return df.withColumns(odd) if odd else df


def lost_values(df: DataFrame, declared: T.StructType) -> dict[str, int]:
    """How many values of each column don't survive the cast to its declared type. One pass,
    and none where no column can lose any."""
    types = {f.name: f.dataType for f in declared}
    risky = [f for f in df.schema if f.name in types and may_lose(f.dataType, types[f.name])]
    if not risky:
        return {}
    gone = {f.name: as_declared(F.col(f"`{f.name}`"), f.dataType, types[f.name]).isNull() & F.col(f"`{f.name}`").isNotNull() for f in risky}
    row = df.agg(*[F.count_if(c).alias(n) for n, c in gone.items()]).first()
    return {n: row[n] for n in gone if row[n]}
