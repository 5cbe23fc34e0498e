"""Mixing sources to target weights by a time-varying curriculum.

Targets: the sources share the words of the whole table by weight; a target stops at
``max_repeat`` times the source's words, and what that frees is shared anew by weight among
the others until none is above. (Each target is min(rate * weight, max_repeat * words); the
rate is found from sums over the table of sources, a few rounds of one small job.)

Each source is a tape of its documents in hash order, repeated ``max_repeat`` times; the mix
takes the tape's first ``target`` words, so the last document may be taken in part. A source
has a weight schedule over training time [0, 1], a piecewise-linear curve given by its knots.
The integral of the curve, scaled to the target, is the source's cumulative token demand at a
time; the training position of a document copy is the time at which the demand reaches the
middle of its words on the tape. The result is range-sorted by position.

Word offsets on a tape are prefix sums in two steps: documents fall into hash buckets of
their source, bucket sums are prefix-summed per source, and a window adds up within a bucket.
The number of buckets follows the number of documents, so a source that holds a third of all
documents is spread over many tasks.

Defined cases: a null or empty text has 0 words, and a document without words takes part with
0 taken and no position. Null is a source of its own, sorted last. Repeated rows are taken one
by one. An empty table gives an empty result; with no words at all every target is 0. Other
columns, whatever their names, pass through ``mixed`` unless they have the name of one of its
results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ecoflux.llm.common import text_key, written

#: By the place of the source's weight in ``weights``: knots (time, weight) of the schedule.
SCHEDULES = (((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))
#: Documents that a hash bucket of the tape holds about (over all sources).
BUCKET_DOCS = 1 << 18
LEAST_BUCKETS = 1 << 10


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _ordered_source(source: Column) -> Column:
    """A non-null text in the order of the sources by code point, null last."""
    return F.when(source.isNull(), F.lit("z")).otherwise(F.concat(F.lit("a"), source.cast("string")))


def _ranked(sources: DataFrame) -> DataFrame:
    """Adds ``place`` (from 0) in the order of ``s`` without sorting in one task: the rows are
    range-sorted and written, and partition sizes give each partition its first place."""
    rows = written(sources.repartitionByRange("s").sortWithinPartitions("s").withColumn("at", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("at", 33)
    sizes = rows.groupBy(part.alias("part")).count().orderBy("part").collect()  # one row per partition
    first, n = [], 0
    for r in sizes:
        first += [F.lit(r["part"]), F.lit(n)]
        n += r["count"]
    if not first:
        return rows.withColumn("place", F.lit(0).cast("long"))
    return rows.withColumn("place", F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + F.element_at(F.create_map(*first), part))


def targets(sources: DataFrame, weights: Sequence[int], max_repeat: int) -> DataFrame:
    """(s, source_size, kind, target) from (s, source_size); kind is the index of the weight."""
    ranked = _ranked(sources).withColumn("kind", (F.col("place") % len(weights)).cast("int"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.col("kind") + 1)
    rows = written(ranked.select("s", "source_size", "kind", w.alias("w")), "source-weights")
    limit = F.col("source_size") * max_repeat
    rate, was = 0.0, -1
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    while total:
        full = limit <= F.lit(rate) * F.col("w")
        held, free, n = rows.agg(F.sum(F.when(full, limit).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("w"))), F.count_if(full)).first()
        if n == was or not free:
            break
        rate, was = (total - held) / free, n
    target = F.least(limit.cast("double"), F.lit(float(rate)) * F.col("w"))
    return rows.select("s", "source_size", "kind", target.alias("target"))


def time_of(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """The time at which the integral of the schedule reaches this share of its total."""
    area = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:])]
    whole, done, out = sum(area), 0.0, F.lit(float(knots[-1][0]))
    if whole <= 0:
        raise ValueError("a schedule needs a positive integral")
    found = None
    for (t0, w0), (t1, w1), a in zip(knots, knots[1:], area):
        slope = (w1 - w0) / (t1 - t0)
        rest = F.greatest(share * whole - done, F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * rest, F.lit(0.0)))
        t = F.least(F.lit(t0) + F.when(rest <= 0, 0.0).otherwise(2 * rest / (w0 + root)), F.lit(float(t1)))
        done += a
        inside = share * whole <= done
        found = F.when(inside, t) if found is None else found.when(inside, t)
    return found.otherwise(out)


def schedule(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (1, 2, 3),
    max_repeat: int = 3,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
) -> DataFrame:
    """(id, tk, size, source_size, target, taken, copies) per row, copies being (position,
    words) of each time that the mix reads the document."""
    tk = text_key(F.col(text_col))
    sized = docs.select(
        F.col(id_col).alias("id"), tk.alias("tk"), _ordered_source(F.col(source_col)).alias("s"), n_words(F.col(text_col)).alias("size"), F.xxhash64(F.lit("tape"), F.col(id_col), tk).alias("h")
    )
    sized = written(sized, "sizes")
    bits = max(LEAST_BUCKETS, sized.count() // BUCKET_DOCS).bit_length() - 1
    tape = sized.withColumn("bucket", F.shiftrightunsigned("h", 64 - bits))
    sums = written(tape.groupBy("s", "bucket").agg(F.sum("size").alias("words")), "bucket-words")
    goals = targets(sums.groupBy("s").agg(F.sum("words").alias("source_size")), weights, max_repeat)
    before = F.sum("words").over(Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    buckets = written(sums.withColumn("before", F.coalesce(before, F.lit(0))).join(goals, "s").drop("words"), "buckets")
    order = Window.partitionBy("s", "bucket").orderBy("h", "id", "tk").rowsBetween(Window.unboundedPreceding, -1)
    placed = tape.join(buckets, ["s", "bucket"]).withColumn("start", F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0)))
    goal = F.round("target").cast("long")

    def copy(n: int) -> Column:
        at = F.col("start") + n * F.col("source_size")
        words = F.greatest(F.lit(0), F.least(F.col("size"), goal - at)).cast("long")
        share = (at + words / 2) / goal
        t = time_of(share, schedules[0])
        for kind, knots in enumerate(schedules[1:], 1):
            t = F.when(F.col("kind") == kind, time_of(share, knots)).otherwise(t)
        return F.struct(F.when(words > 0, t).alias("position"), words.alias("words"))

    copies = F.filter(F.array(*[copy(n) for n in range(max_repeat)]), lambda c: c["words"] > 0)
    out = placed.select("id", "tk", "size", "source_size", "target", copies.alias("copies"))
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda n, c: n + c["words"])
    return out.select("id", "tk", "size", "source_size", "target", taken.alias("taken"), "copies")


def training_order(plan: DataFrame) -> DataFrame:
    """(id, tk, position, words) for every copy, range-sorted by position."""
    return plan.select("id", "tk", F.inline("copies")).orderBy("position", "id", "tk")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The documents range-sorted by the position of their first copy, with their columns and
    size, source_size, target, taken, position and copies. Those that the mix leaves out come
    last, with 0 taken."""
    plan = schedule(docs, id_col, text_col, **how)
    new = ["size", "source_size", "target", "taken", "position", "copies"]
    row_id = lambda i, tk: F.concat(F.coalesce(i.cast("string"), F.lit("-")), F.lit(":"), tk.cast("string"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    own = docs.select(row, row_id(F.col(id_col), text_key(F.col(text_col))).alias("row_id"))
    place = F.struct(F.get("copies", F.lit(0))["position"].alias("position"), "size", "source_size", "target", "taken", "copies")
    plan = plan.groupBy(row_id(F.col("id"), F.col("tk")).alias("row_id")).agg(F.array_sort(F.collect_list(place)).alias("places"))
    # rows that repeat both id and text take their places one by one (the join has them together)
    nth = F.row_number().over(Window.partitionBy("row_id").orderBy(F.xxhash64("row")))
    both = own.join(plan, "row_id").withColumn("place", F.get("places", nth - 1))
    keep = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c.lower() not in new]
    return both.select(*keep, *[F.col(f"place.{c}").alias(c) for c in new]).orderBy(F.col("position").asc_nulls_last(), id_col)
