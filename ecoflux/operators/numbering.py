"""Whole numbers for the values of a growing set, kept for good."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecoflux.session import written


def number_new(values: DataFrame, col: str, known: DataFrame, id_col: str) -> DataFrame:
    """(col, id_col) for the distinct non-null ``values`` that ``known`` (of the same columns)
    does not hold, numbered on from its largest number without gaps.

    Numbers come from a range partitioning and the counts of its partitions, so no task sees
    more than its share. The values are written before they are numbered: a task that runs
    again gives the same numbers.
    """
    fresh = values.select(col).where(F.col(col).isNotNull()).distinct().join(known.select(col), col, "left_anti")
    # partition number in the upper bits, place within the partition in the lower 33
    placed = written(fresh.repartitionByRange(col).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumns({"_part": F.shiftright("_at", 33), "_row": F.col("_at").bitwiseAND((1 << 33) - 1)})
    start = known.agg(F.max(id_col)).first()[0]
    base, bases = 0 if start is None else start + 1, []
    for r in placed.groupBy("_part").count().orderBy("_part").collect():  # one row for each partition
        bases.append((r["_part"], base))
        base += r["count"]
    starts = values.sparkSession.createDataFrame(bases, "_part long, _base long")
    return placed.join(F.broadcast(starts), "_part").select(col, (F.col("_base") + F.col("_row")).alias(id_col))
