"""Merkle dataset manifest: a content-addressed DAG of digests, and proofs by descent from its root.

A leaf is the digest of a row. The leaves of a group, in order, are hashed two by two (a last
one alone) level by level until one digest is left, the group's *subroot*; the subroots, in
order of their groups, are hashed the same way to the *root*.

The DAG is stored as *records*, digest -> children: under the digest of a node its descendants
of up to ``GENERATIONS`` generations, level by level, so that a descent takes one lookup for
each ``GENERATIONS`` levels and not for each level. Records are addressed by content: equal
subtrees are kept once on each *shelf*. A shelf serves ``SHELF`` neighbouring nodes, so that
a digest which a third of all nodes share is looked up by no more than so many in one place.

A *request* is a leaf's group and rank. Requests descend from the root by the binary digits of
the group's rank, then of their own; on the way the child that a digit does not select is the
sibling of the path and is collected. Requests with the same leading digits travel as one row
until they part; branches without a request are not followed. The path, found from the root
down, is reversed into the proof, from the leaf up.

Ranks come from a range partitioning and the counts of its partitions, never from one task
that orders a group. Leaves and records are written tables; all work is DataFrame functions.

Defined cases: nulls are values of their own (``-``); null ids sort first. Rows that repeat an
id are ordered by their digest; rows equal in all hashed columns are leaves of their own with
equal digests, in any order. An empty text is not a null one. A group of one leaf has the leaf
as its subroot, and one group's subroot is the root. An empty table gives an empty manifest.
Columns that are not named take no part, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ecoflux.llm.common import written

#: Levels of the tree in one record (2^6 descendants of the lowest generation).
GENERATIONS = 6
#: Neighbouring nodes (a power of two) whose lookups share one copy of a record.
SHELF = 4096


def digest_of(*parts: Column) -> Column:
    """SHA-256, as bytes, of texts put together."""
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def as_hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def encoded(value: Column) -> Column:
    """A value with its length, so that no two rows give the same text; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: list[Column]) -> Column:
    return digest_of(*[encoded(c) for c in columns])


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows``, with a column ``grp``, and ``rank``, the number of a row in its group by
    ``order``, and ``n``, the rows of its group.

    The partitions of a range order are numbered inside; where a group goes on in further
    partitions, the rows that it has in those before are added. ``_tie`` parts equal rows, so
    that no key is too large for one partition; it is written first, so that a task which runs
    again deals its rows out as before."""
    spread = written(rows.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id())), "merkle-rows")
    placed = spread.repartitionByRange("grp", *order, "_tie").sortWithinPartitions("grp", *order, "_tie").drop("_tie")
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = written(placed.select("*", F.spark_partition_id().alias("_part"), at.alias("_at")), "merkle-ranks")
    # a row for each partition and group in it
    runs = placed.groupBy("grp", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_size"))
    whole = Window.partitionBy("grp")
    before = F.coalesce(F.sum("_size").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = runs.select(F.col("grp").alias("_grp"), F.col("_part").alias("_own"), (before - F.col("_first")).alias("_shift"), F.sum("_size").over(whole).alias("n"))
    out = placed.join(shifts, F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("_own") == F.col("_part")))
    return out.select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("rank"), "n")


def _levels(n: Column) -> Column:
    """How many of the next ``GENERATIONS`` levels lie below the node that n nodes end in."""
    return reduce(lambda a, b: a + b, [(n > F.lit(1 << j)).cast("int") for j in range(GENERATIONS)])


def _pairs(nodes: Column) -> Column:
    """Digests of every 2 consecutive nodes."""
    pairs = F.sequence(F.lit(0), F.shiftright(F.size(nodes) - 1, 1))
    one = lambda i: F.coalesce(as_hex(F.get(nodes, i)), F.lit(""))
    return F.transform(pairs, lambda i: digest_of(one(i * 2), one(i * 2 + 1)))


@dataclass
class Forest:
    """Trees of all groups. ``roots``: (grp, n, digest). ``records[k]``: (digest, shelf,
    levels), the k-th from the leaves up; ``levels[0]`` are the lowest generation."""

    roots: DataFrame
    records: list[DataFrame]


def _shelf(grp: Column, page: Column) -> Column:
    return F.xxhash64(grp, F.shiftright(page, SHELF.bit_length() - 1))


def build(leaves: DataFrame) -> Forest:
    """The forest over ``leaves`` (grp, rank, n, digest)."""
    records, roots = [], []
    nodes = leaves.select("grp", "rank", "n", "digest")
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most:
        page = nodes.groupBy("grp", "n", F.shiftright("rank", GENERATIONS).alias("page")).agg(F.array_sort(F.collect_list(F.struct("rank", "digest"))).alias("own"))
        page = page.select("grp", "n", "page", F.col("own.digest").alias("l0"))
        for j in range(GENERATIONS):
            page = page.withColumn(f"l{j + 1}", F.when(_levels(F.col("n")) > j, _pairs(F.col(f"l{j}"))).otherwise(F.col(f"l{j}")))
        levels = F.slice(F.array(*[f"l{j}" for j in range(GENERATIONS)]), F.lit(1), _levels(F.col("n")))
        page = written(page.select("grp", "n", "page", F.get(f"l{GENERATIONS}", F.lit(0)).alias("digest"), levels.alias("levels")), "merkle-pages")
        # equal subtrees of a shelf are one record
        records.append(page.select("digest", _shelf(F.col("grp"), F.col("page")).alias("shelf"), "levels").dropDuplicates(["digest", "shelf"]))
        up = F.ceil(F.col("n") / (1 << GENERATIONS)).cast("long")
        roots.append(page.where(up == 1).select("grp", F.lit(len(records)).alias("height"), "digest"))
        nodes = page.where(up > 1).select("grp", F.col("page").alias("rank"), up.alias("n"), "digest")
        most = -(-most // (1 << GENERATIONS)) if most > 1 << GENERATIONS else 0
    if not roots:
        return Forest(leaves.select("grp", F.lit(0).alias("height"), "digest").limit(0), [])
    return Forest(written(reduce(DataFrame.unionAll, roots), "merkle-roots"), records)


def _sibling(levels: Column, at: Column, j: int) -> Column:
    """The child beside the one on the way to leaf ``at``, on level j, as (left, right); both
    are null beside a last one alone."""
    own = F.shiftright(at, j)
    other = F.get(F.get(levels, F.lit(j)), own.bitwiseXOR(F.lit(1)))
    is_right = own.bitwiseAND(F.lit(1)) == 1
    return F.struct(F.when(is_right, other).alias("left"), F.when(~is_right, other).alias("right"))


def _onward(path: Column, levels: Column, at: Column) -> Column:
    """``path``, root first, with the siblings on the way down a record to its leaf ``at``."""
    steps = [F.when(F.size(levels) > j, _sibling(levels, at, j)) for j in range(GENERATIONS - 1, -1, -1)]
    return F.concat(path, F.filter(F.array(*steps), lambda x: x.isNotNull()))


NO_PATH = "array<struct<left:binary,right:binary>>"


def descend(forest: Forest, requests: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """``requests`` (grp, rank, ...) with ``path``: the siblings from the root down to the leaf,
    after the path that ``start`` (grp, path) has for the group."""
    none = F.array().cast(NO_PATH)
    top = forest.roots.select("grp", "height", F.lit(0).cast("long").alias("page"), "digest", none.alias("path"))
    if start is not None:
        first = start.select(F.col("grp").alias("_grp"), F.col("path").alias("_path"))
        top = top.drop("path").join(first, F.col("grp").eqNullSafe(F.col("_grp"))).select("grp", "height", "page", "digest", F.col("_path").alias("path"))
    top = written(top, "merkle-top")
    here = None
    for k in range(len(forest.records) - 1, -1, -1):
        own = top.where(F.col("height") == k + 1).drop("height")
        here = own if here is None else here.unionAll(own)
        asked = here.withColumn("shelf", _shelf(F.col("grp"), F.col("page")))
        met = asked.join(forest.records[k], ["digest", "shelf"]).select("grp", "page", "path", "levels")
        want = requests.select(F.col("grp").alias("_grp"), F.shiftright("rank", GENERATIONS * max(k, 1)).alias("_page"), *([c for c in requests.columns if c != "grp"] if k == 0 else []))
        if k:
            # a node's children are the lowest generation of its record (at least two, or it would be on record k - 1)
            down = met.select("grp", "page", "path", "levels", F.posexplode(F.get("levels", F.lit(0))).alias("at", "digest"))
            here = down.select("grp", (F.col("page") * (1 << GENERATIONS) + F.col("at")).alias("page"), "digest", _onward(F.col("path"), F.col("levels"), F.col("at")).alias("path"))
            here = here.join(want.distinct(), F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("page") == F.col("_page")), "left_semi")
        else:
            out = met.join(want, F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("page") == F.col("_page")))
            at = F.col("rank").bitwiseAND(F.lit((1 << GENERATIONS) - 1)).cast("int")
            return out.select(*requests.columns, _onward(F.col("path"), F.col("levels"), at).alias("path"))
    return requests.withColumn("path", none).limit(0)


def proof_texts(path: Column) -> Column:
    """The siblings of a path, from the leaf up, as hex."""
    return F.transform(F.filter(F.reverse(path), lambda x: x["left"].isNotNull() | x["right"].isNotNull()), lambda x: as_hex(F.coalesce(x["left"], x["right"])))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    text = lambda c: F.coalesce(as_hex(c), F.lit(""))
    return F.aggregate(F.reverse(path), leaf, lambda a, x: digest_of(text(x["left"]), as_hex(a), text(x["right"])))


def manifest(
    docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), keep: dict[str, Column] | None = None
) -> DataFrame:
    """(id, *keep, leaf, subroot, root, path) for each row: its digest, its group's and the
    whole table's, and the proof's siblings from the root down. ``keep`` names further columns
    to compute from a row."""
    keep = keep or {}
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(group_col).cast("string").alias("grp"), leaf_digest([F.col(c) for c in columns]).alias("digest"), *[c.alias(n) for n, c in keep.items()]
    )
    leaves = written(_ranked(rows, ["id", "digest"]), "merkle-leaves")
    trees = build(leaves)
    groups = written(_ranked(trees.roots.select(F.lit(0).alias("grp"), F.col("grp").alias("name"), "digest"), ["name"]), "merkle-groups")
    top = build(groups)
    root = top.roots.select("digest").first()  # the one digest
    paths = written(descend(top, groups).select(F.col("name").alias("grp"), F.col("digest").alias("subroot"), "path"), "merkle-subroots")
    out = descend(trees, leaves, paths)
    own = paths.select(F.col("grp").alias("_grp"), "subroot", F.lit(bytes(root[0]) if root else None).cast("binary").alias("root"))
    out = out.join(own, F.col("grp").eqNullSafe(F.col("_grp")))
    return out.select("id", *keep, F.col("digest").alias("leaf"), "subroot", "root", "path")
