"""Readings that can't be read as delivered: which text, in which column, and why.

Lenient parsing turns a malformed number into null, and drops a reading whose time it can't
read. These expressions say so for each reading before it is parsed, with the same parsers,
so both sinks (``sinks.split_rows``) come from one pass.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ecoflux.functions import decimal_comma

PROBLEMS, READING = "_problems", "_reading"
_PROBLEM = "array<struct<column: string, text: string, reason: string>>"


def _problem(when: Column, column: str, text: Column, reason: str) -> Column:
    return F.when(when, F.struct(F.lit(column).alias("column"), text.cast("string").alias("text"), F.lit(reason).alias("reason")))


def number_problems(df: DataFrame, cols: Iterable[str]) -> list[Column]:
    """One problem for each text column that holds something that is no number. Blank and
    missing texts are no problem: nothing was measured."""
    kinds = {f.name: f.dataType for f in df.schema}
    texts = [c for c in cols if isinstance(kinds.get(c), T.StringType)]
    filled = lambda c: F.length(F.trim(F.col(f"`{c}`"))) > 0
    return [_problem(filled(c) & decimal_comma(f"`{c}`").isNull(), c, F.col(f"`{c}`"), "number") for c in texts]


def time_problem(cols: Iterable[str], date: Column) -> Column:
    """A problem where ``date`` (parsed from ``cols``) is null: the reading is dropped. ``time``
    if the texts can't be read, ``no_time`` if one is missing."""
    cols = list(cols)
    text = F.concat_ws(" ", *[F.col(f"`{c}`").cast("string") for c in cols])
    missing = F.lit(False)
    for c in cols:
        missing = missing | F.col(f"`{c}`").isNull()
    name = "+".join(cols)
    return F.coalesce(_problem(date.isNull() & missing, name, text, "no_time"), _problem(date.isNull(), name, text, "time"))


def with_problems(df: DataFrame, problems: Iterable[Column]) -> DataFrame:
    """``df`` with its problems (an empty list for a sound reading), and the reading as
    delivered, as JSON, where it has any."""
    found = F.filter(F.array(*problems), lambda p: p.isNotNull()) if (problems := list(problems)) else F.array()
    delivered = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    tagged = df.select("*", found.cast(_PROBLEM).alias(PROBLEMS))
    return tagged.withColumn(READING, F.when(F.size(PROBLEMS) > 0, delivered))


def lines(rejected: DataFrame, keep: Iterable[Column | str] = ()) -> DataFrame:
    """One line (column, text, reason, reading) for each problem, after the ``keep`` columns."""
    return rejected.select(*keep, F.inline(PROBLEMS), F.col(READING).alias("reading"))
