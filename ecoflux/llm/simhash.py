"""SimHash near-dedup with covering locality-sensitive hashing.

A fingerprint has bit i set if more than half of the document's shingle hashes have it set.
Two fingerprints link if they differ in at most ``radius`` bits. Candidate pairs come from a
covering family of bit masks: every bit position i gets a nonzero vector phi(i) of radius + 1
bits, and every nonzero vector v of radius + 1 bits makes one table whose mask holds the bits
with odd <phi(i), v>. For any ``radius`` differing bits some v is orthogonal to all their phi,
so that table's mask holds none of them and the pair meets in it. No link can be missed.

Equal fingerprints are one class from the start, so a group of copies is one row. A bucket
with more than ``bucket_rows`` classes is not compared as it is: its rows are dealt out anew
by a second covering family over the bits that are still free (then a third, and so on). Each
level fixes about half of the free bits, so bucket sizes have a bound that does not depend on
the data. A bucket yields a spanning forest of its links, never all pairs.

Links are closed into components by contraction rounds: each node hooks onto the neighbour
with the smallest hash of that round, edges are renamed and loops vanish, until none is left.

Defined cases: no words (or a null text): fingerprint 0, linked like any other. Fewer words
than a shingle: the whole sequence is the one shingle. Rows that repeat an id are told apart
by their text; the smallest non-null id names a component (null if it has none). Empty tables
give empty results. ``keep_one`` passes all columns through, whatever their names.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ecoflux.llm.common import text_bytes, text_key, word_pieces, written

SEED = 42  # Spark's xxhash64 has the same
BITS = 64
PIECE = 1 << 16


def _bit_counts(words: list[bytes], shingle: int) -> np.ndarray:
    """How many shingles of the words have each bit of their hash set."""
    whole, n = b" ".join(words), len(words) - shingle + 1
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    counts = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, PIECE):
        spans = zip(starts[at : min(at + PIECE, n)].tolist(), ends[at + shingle - 1 : at + shingle - 1 + PIECE].tolist())
        h = np.array([digest(whole[a:b], SEED) for a, b in spans], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return counts


def fingerprint(text: bytes, shingle: int) -> int:
    """Of UTF-8 bytes; ``bytes.lower`` and ``bytes.split`` know only ASCII letters and space."""
    counts, n, held = np.zeros(BITS, np.int64), 0, []
    for words in word_pieces(text.lower()):
        held += words
        if len(held) >= shingle:
            counts += _bit_counts(held, shingle)
            n += len(held) - shingle + 1
            held = held[len(held) - shingle + 1 :]
    if not n and held:  # fewer words than a shingle
        counts, n = _bit_counts(held, len(held)), 1
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, tk, fp) for each row; tk is the hash of its text."""
    rows = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("tk"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["id"], rows.schema["tk"], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [fingerprint(t, shingle) for t in text_bytes(b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp, pa.int64())], ["id", "tk", "fp"])

    return rows.mapInArrow(run, schema)


def covering_masks(radius: int, level: int) -> list[int]:
    """The masks of one covering family, as signed 64-bit numbers. Every nonzero phi serves
    about equally many bits; levels deal them differently."""
    n = (1 << radius + 1) - 1
    phi = [i % n + 1 for i in range(BITS)]
    random.Random(level).shuffle(phi)
    masks = [sum(1 << i for i in range(BITS) if (phi[i] & v).bit_count() & 1) for v in range(1, n + 1)]
    return [m - (1 << BITS) if m >> BITS - 1 else m for m in masks]


def _dealt(rows: DataFrame, radius: int, level: int) -> DataFrame:
    """Each row (fixed, fp) once per mask of the level: ``fixed`` grows by the mask, and
    ``key`` is the part of the fingerprint that a bucket has in common."""
    tables = F.array(*[F.lit(m).cast("long") for m in covering_masks(radius, level)])
    more = rows.select("fp", "fixed", F.explode(tables).alias("mask")).select("fp", F.col("fixed").bitwiseOR(F.col("mask")).alias("fixed"))
    return more.select("fixed", F.col("fp").bitwiseAND(F.col("fixed")).alias("key"), "fp")


def _far(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many bits signed 64-bit numbers differ (a signed count would take the absolute value)."""
    return np.bitwise_count((x ^ y).view(np.uint64))


def _forest(x: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(child, parent): edges that connect what the links within ``x`` connect."""
    left, a, b = x, [], []
    queue = x[:0]
    while len(left):
        if not len(queue):
            queue, left = left[:1], left[1:]
            continue
        root = queue[0]
        near = _far(left, root) <= radius
        a.append(left[near])
        b.append(np.full(int(near.sum()), root, x.dtype))
        queue, left = np.concatenate((queue[1:], left[near])), left[~near]
    none = x[:0]
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _links(radius: int):
    """Rows sorted by (fixed, key) in, forest edges (a, b) out; a bucket may span batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3
        for cols in _with_end(batches):
            if cols is not None:
                held = [np.concatenate((h, c)) for h, c in zip(held, cols)]
            fixed, key, fp = held
            if not len(fp):
                continue
            new = np.concatenate(([True], (fixed[1:] != fixed[:-1]) | (key[1:] != key[:-1])))
            start = np.flatnonzero(new)
            done = start[-1] if cols is not None else len(fp)  # the last bucket may go on
            size = np.diff(np.concatenate((start, [len(fp)])))
            a, b = [], []
            two = start[(size == 2) & (start + 2 <= done)]
            linked = two[_far(fp[two], fp[two + 1]) <= radius]
            a.append(fp[linked])
            b.append(fp[linked + 1])
            for s, n in zip(start[size > 2].tolist(), size[size > 2].tolist()):
                if s + n <= done:
                    for out, got in zip((a, b), _forest(fp[s : s + n], radius)):
                        out.append(got)
            held = [h[done:] for h in held]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    return run


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray] | None]:
    for b in batches:
        yield [c.to_numpy(zero_copy_only=False) for c in b.columns]
    yield None


def links(classes: DataFrame, radius: int = 3, bucket_rows: int = 2048) -> DataFrame:
    """(a, b): edges between distinct fingerprints (column fp) that connect exactly what the
    links of at most ``radius`` bits connect."""
    if bucket_rows < 1 << radius + 2:
        raise ValueError("so many fingerprints can differ in the same few bits")
    rows, found = classes.select(F.lit(0).cast("long").alias("fixed"), "fp"), []
    for level in range(8):
        dealt = _dealt(rows, radius, level)
        large = written(dealt.groupBy("fixed", "key").count().where(F.col("count") > bucket_rows).select("fixed", "key"), "large-buckets")
        more = not large.isEmpty()
        small = dealt.join(large, ["fixed", "key"], "left_anti") if more else dealt
        found.append(small.repartition("fixed", "key").sortWithinPartitions("fixed", "key").mapInArrow(_links(radius), "a long, b long"))
        if not more:
            break
        rows = written(dealt.join(large, ["fixed", "key"], "left_semi").select("fixed", "fp").distinct(), "large-rows")
    else:
        raise AssertionError("a bucket that eight families cannot split")
    edges = found[0]
    for f in found[1:]:
        edges = edges.unionAll(f)
    return edges.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); equal roots mean connected."""
    edges = written(edges, "edges")
    roots = None
    turn = 0
    while not edges.isEmpty():
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn), c), c.alias("to"))  # noqa: B023, E731
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = written(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least(rank(F.col("a")), rank(F.col("b"))))["to"].alias("to")), "hooks")
        moved = edges.join(hooks, edges["a"] == hooks["node"]).select(F.col("to").alias("a"), "b")
        moved = moved.join(hooks, moved["b"] == hooks["node"]).select("a", F.col("to").alias("b"))
        edges = written(moved.where(F.col("a") != F.col("b")).distinct(), "edges")
        if roots is None:
            roots = hooks.select("node", F.col("to").alias("root"))
        else:
            step = hooks.select(F.col("node").alias("root"), "to")
            roots = roots.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        turn += 1
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3, bucket_rows: int = 2048
) -> DataFrame:
    """(id, tk, fp, root, component_id) for each row: rows of one group share root and the
    smallest id of the group."""
    rows = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = written(rows.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    tree = components(links(classes, radius, bucket_rows))
    rooted = classes.join(tree, classes["fp"] == tree["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = written(rooted, "rooted")
    named = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    return rows.join(rooted.join(named, "root").select("fp", "root", "component_id"), "fp")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _row_id(id_: Column, tk: Column) -> Column:
    return F.concat(F.coalesce(id_.cast("string"), F.lit("-")), F.lit(":"), tk.cast("string"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One document of each group: that with the smallest id, with its columns."""
    groups = near_duplicates(docs, id_col, text_col, **how)
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), F.col("id").alias("id"), F.col("tk").alias("tk"))).alias("at"))
    stay = first.select(_row_id(F.col("at.id"), F.col("at.tk")).alias("row_id"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    own = docs.select(row.alias("row"), _row_id(F.col(id_col), text_key(F.col(text_col))).alias("row_id")).join(stay, "row_id", "left_semi")
    # rows that repeat both id and text: one of them (the join has them together already)
    nth = F.row_number().over(Window.partitionBy("row_id").orderBy(F.xxhash64("row")))
    return own.withColumn("nth", nth).where(F.col("nth") == 1).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
