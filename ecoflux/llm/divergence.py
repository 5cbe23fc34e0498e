"""Source divergence audit by in-mapper stripes.

A *stripe* belongs to a language and a term: in how many documents the term is, and how often
it occurs in each source. Tasks fold whole documents into a hash of stripes; when the hash
holds ``spill_entries`` counts (or ``spill_bytes`` of terms) it is emptied into the shuffle. So
a frequent term leaves a task once for each spill, not once for each document, and memory
doesn't grow with the input. Stripes of one key are merged as they stream by in the order of
their keys; only terms in at least ``min_docs`` documents of the language are kept.

The merged stripes give the divergences directly: from a stripe's counts and the totals of its
language come the smoothed shares of the term in every source, and with them the term's part
of the divergence of every pair of sources, and of each source from its language. A task sums
pairs over its stripes and holds the ``top`` terms of each source; what it sends does not grow
with its stripes.

Shares are whole numbers of billionths, p = 1 + floor(10^9 (count + 1) / (N + V)), with N
occurrences of V kept terms in all; a divergence is the sum of floor((p - q)^2 / q). All
arithmetic is on whole numbers (a long division, so no product passes 63 bits for N + V up to
9 * 10^17; sums hold for V up to 2 * 10^9).

Defined cases: null text, group (language) and source are ''. Every row is a document, also one
that repeats another. Terms are runs of ASCII letters and characters beyond ASCII, A-Z
lowered. A source without kept terms has all counts 0; a language without kept terms has
divergences 0 and no terms. A language with one source has no pairs. Ties rank by the bytes of
the item. An empty table gives an empty result. Other columns take no part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ecoflux.llm.common import text_bytes, word_pieces, written

_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
#: Entries that a task sorts into its stripes at once.
CHUNK = 1 << 20
#: Cells of a block of terms x sources.
CELLS = 1 << 20
#: Cells of pairs of sources that a task sums before it sends them; a language with more pairs
#: than that sends them for each block.
PAIR_CELLS = 1 << 22
#: Stripes for each part that they are dealt out by to meet the totals of their language.
PART = 1 << 14
#: Best terms that a task holds before it sends them.
HELD = 1 << 20
STRIPE = "grp string, term string, df long, sources array<string>, counts array<long>"


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, ascending, with the sum of its counts."""
    by = np.argsort(keys, kind="stable")
    keys, counts = keys[by], counts[by]
    start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[start], np.add.reduceat(counts, start)


def _lists(rows: int, of: np.ndarray, values: pa.Array) -> pa.ListArray:
    """``values``, in order of their rows ``of``, as one list for each row."""
    ends = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=rows)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), values)


class Stripes:
    """The stripes of a task. A term of a language has a number, a source too."""

    def __init__(self, spill_entries: int, spill_bytes: int):
        self.spill_entries, self.spill_bytes = spill_entries, spill_bytes
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, dict[bytes, int]] = {}
        self.names: list[tuple[str, bytes]] = []
        self.sources: dict[str, int] = {}
        self.bytes = self.waiting = 0
        self.some: list[tuple[np.ndarray, np.ndarray, int]] = []
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.df = np.zeros(0, np.int64)

    def fold(self, grp: str, source: str, text: bytes) -> None:
        seen: Counter[bytes] = Counter()
        for words in word_pieces(text.translate(_FOLD)):
            seen.update(words)
        if not seen:
            return
        number = self.number.setdefault(grp, {})
        ids = np.empty(len(seen), np.int64)
        for n, term in enumerate(seen):
            if (i := number.get(term)) is None:
                i = number[term] = len(self.names)
                self.names.append((grp, term))
                self.bytes += len(term) + 200
            ids[n] = i
        self.some.append((ids, np.fromiter(seen.values(), np.int64, len(seen)), self.sources.setdefault(source, len(self.sources))))
        self.waiting += len(seen)
        if self.waiting >= max(CHUNK, len(self.keys)):
            self.sort()

    def full(self) -> bool:
        return len(self.keys) + self.waiting >= self.spill_entries or self.bytes >= self.spill_bytes

    def sort(self) -> None:
        if not self.some:
            return
        ids = np.concatenate([s[0] for s in self.some])
        source = np.repeat(np.array([s[2] for s in self.some], np.int64), [len(s[0]) for s in self.some])
        counts = np.concatenate([s[1] for s in self.some])
        self.df = np.bincount(ids, minlength=len(self.names)) + np.pad(self.df, (0, len(self.names) - len(self.df)))
        self.keys, self.counts = _summed(np.concatenate((self.keys, ids << 32 | source)), np.concatenate((self.counts, counts)))
        self.some, self.waiting = [], 0

    def spill(self, rows: int = 1 << 15) -> Iterator[pa.RecordBatch]:
        """All stripes, some terms at a time; none are left."""
        self.sort()
        sources = pa.array(list(self.sources), pa.string())
        term = self.keys >> 32
        for at in range(0, len(self.names), rows):
            names = self.names[at : at + rows]
            a, b = np.searchsorted(term, [at, at + len(names)])
            of = term[a:b] - at
            own = sources.take(pa.array(self.keys[a:b] & 0xFFFFFFFF))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([g for g, _ in names], pa.string()),
                    pa.array([t for _, t in names], pa.binary()).cast(pa.string()),
                    pa.array(self.df[at : at + len(names)]),
                    _lists(len(names), of, own),
                    _lists(len(names), of, pa.array(self.counts[a:b])),
                ],
                ["grp", "term", "df", "sources", "counts"],
            )
        self.clear()


def _folded(spill_entries: int, spill_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripes = Stripes(spill_entries, spill_bytes)
        for b in batches:
            for grp, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), text_bytes(b.column(2))):
                stripes.fold(grp, source, text)
                if stripes.full():
                    stripes.sort()
                    if stripes.full():
                        yield from stripes.spill()
        yield from stripes.spill()

    return run


def _merge(t: pa.Table) -> pa.Table:
    """Neighbouring stripes of one key as one."""
    t = t.combine_chunks()
    grp, term, df, sources, counts = (c.chunk(0) for c in t.columns)
    n = t.num_rows
    same = pc.and_(pc.equal(grp.slice(1), grp.slice(0, n - 1)), pc.equal(term.slice(1), term.slice(0, n - 1)))
    new = np.concatenate(([True], ~same.to_numpy(zero_copy_only=False)))
    start, key = np.flatnonzero(new), np.cumsum(new) - 1
    coded = sources.flatten().dictionary_encode()
    wide = max(len(coded.dictionary), 1)
    of = np.repeat(key, np.diff(sources.offsets.to_numpy()))
    cell, total = _summed(of * wide + coded.indices.to_numpy(), counts.flatten().to_numpy())
    first = pa.array(start)
    columns = [grp.take(first), term.take(first), pa.array(np.add.reduceat(df.to_numpy(), start))]
    columns += [_lists(len(start), cell // wide, coded.dictionary.take(pa.array(cell % wide))), _lists(len(start), cell // wide, pa.array(total))]
    return pa.table(columns, t.column_names)


def _merged(min_docs: int):
    """Stripes in order of their keys in: one for each key that enough documents have out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: pa.Table | None = None  # the stripe whose key may go on in the next batch

        def kept(t: pa.Table) -> Iterator[pa.RecordBatch]:
            yield from t.filter(pc.greater_equal(t["df"], min_docs)).to_batches()

        for b in batches:
            if b.num_rows:
                t = pa.Table.from_batches([b])
                t = _merge(t if last is None else pa.concat_tables([last, t]))
                last = t.slice(t.num_rows - 1)
                yield from kept(t.slice(0, t.num_rows - 1))
        if last is not None:
            yield from kept(last)

    return run


def stripes(
    docs: DataFrame, group_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = 3, spill_entries: int = 1 << 21, spill_bytes: int = 1 << 27
) -> DataFrame:
    """(grp, term, df, sources, counts) of every kept term."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (group_col, source_col, text_col)])
    some = rows.mapInArrow(_folded(spill_entries, spill_bytes), STRIPE)
    return some.repartition("grp", "term").sortWithinPartitions("grp", "term").mapInArrow(_merged(min_docs), STRIPE)


def shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 counts / totals), digit by digit; counts are not above totals."""
    out, rest = np.zeros(np.broadcast(counts, totals).shape, np.int64), counts
    for _ in range(9):
        rest = rest * 10
        out = out * 10 + rest // totals
        rest = rest % totals
    return out + 1


class _Top:
    """The ``most`` (value, item) of greatest value, ties to the smaller item."""

    def __init__(self, most: int):
        self.most, self.least, self.own = most, -1, []

    def add(self, values: np.ndarray, items: list[bytes], rows: np.ndarray) -> None:
        may = np.flatnonzero(values >= self.least)
        if len(may) > 4 * self.most:  # those under the most-th greatest value can't rank
            may = may[values[may] >= np.partition(values[may], len(may) - self.most)[len(may) - self.most]]
        self.own += [(-v, items[r]) for v, r in zip(values[may].tolist(), rows[may].tolist())]
        if len(self.own) > self.most:
            self.own = sorted(self.own)[: self.most]
            self.least = -self.own[-1][0]


def _divergences(top: int):
    """Stripes with the totals of their language in; sums of pairs and the best terms out."""

    def rows(grp: str, source: str, part: str, items: list, values: list) -> pa.RecordBatch:
        n = len(items)
        return pa.RecordBatch.from_arrays(
            [pa.array([x] * n, pa.string()) for x in (grp, source, part)] + [pa.array(items, pa.binary()).cast(pa.string()), pa.array(values, pa.int64())],
            ["grp", "source", "part", "item", "value"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        best: dict[tuple[str, int], _Top] = {}
        names: dict[str, list[str]] = {}

        def sent() -> Iterator[pa.RecordBatch]:
            """All that the task holds."""
            for grp, m in sums.items():
                for g, source in enumerate(names[grp]):
                    yield rows(grp, source, "pair", *others(names[grp], g, m[g]))
            for (grp, g), t in best.items():
                own = sorted(t.own)[:top]
                yield rows(grp, names[grp][g], "term", [x for _, x in own], [-v for v, _ in own])
            for held in (sums, best, names):
                held.clear()

        def others(sources: list[str], g: int, values: np.ndarray) -> tuple[list, list]:
            return [x.encode() for x in sources[:g] + sources[g + 1 :]], np.delete(values, g).tolist()

        for b in batches:
            grps = np.array(b.column("grp").to_pylist(), object)
            terms = b.column("term").cast(pa.binary()).to_pylist()
            ends = b.column("sources").offsets.to_numpy()
            coded = b.column("sources").flatten().dictionary_encode()
            counts = b.column("counts").flatten().to_numpy()
            for grp in dict.fromkeys(grps.tolist()):
                mine = np.flatnonzero(grps == grp)
                if sum(m.size for m in sums.values()) + sum(len(t.own) for t in best.values()) > HELD + PAIR_CELLS:
                    yield from sent()
                if grp not in names:
                    names[grp] = b.column("all_sources")[int(mine[0])].as_py()
                totals = b.column("all_totals")[int(mine[0])].values.to_numpy()
                v, s = b.column("v")[int(mine[0])].as_py(), len(names[grp])
                place = {x: i for i, x in enumerate(names[grp])}
                code = np.array([place.get(x, -1) for x in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy()]
                if held := s * s <= PAIR_CELLS:
                    sums.setdefault(grp, np.zeros((s, s), np.int64))
                step = max(1, CELLS // s)
                for at in range(0, len(mine), step):
                    some = mine[at : at + step]
                    lens = ends[some + 1] - ends[some]
                    entry = np.repeat(ends[some] - np.cumsum(lens) + lens, lens) + np.arange(lens.sum()) - ends[0]
                    count = np.zeros((len(some), s), np.int64)
                    count[np.repeat(np.arange(len(some)), lens), code[entry]] = counts[entry]
                    p = shares(count + 1, totals + v)
                    q = shares(count.sum(1) + 1, np.int64(totals.sum() + v))
                    for g in range(s):
                        d = p[:, g, None] - p
                        d = (d * d // p).sum(0)
                        if held:
                            sums[grp][g] += d
                        else:
                            yield rows(grp, names[grp][g], "pair", *others(names[grp], g, d))
                        up = np.flatnonzero((count[:, g] > 0) & (p[:, g] > q))
                        if len(up):
                            d = p[up, g] - q[up]
                            best.setdefault((grp, g), _Top(top)).add(d * d // q[up], terms, some[up])
        yield from sent()

    return run


def audit(docs: DataFrame, group_col: str = "lang", source_col: str = "source", text_col: str = "text", top: int = 200, **how) -> DataFrame:
    """(grp, source, part, item, value, rank). Part ``pair``: the divergence of a source from
    each other source of its language. Part ``term``: the ``top`` terms that make a source
    differ from its language."""
    kept = written(stripes(docs, group_col, source_col, text_col, **how), "stripes")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    sources = docs.select(text(group_col).alias("grp"), text(source_col).alias("source")).distinct()
    totals = kept.select("grp", F.inline(F.arrays_zip(F.col("sources").alias("source"), F.col("counts").alias("n")))).groupBy("grp", "source").agg(F.sum("n").alias("total"))
    every = sources.join(totals, ["grp", "source"], "left").groupBy("grp")
    every = every.agg(F.sort_array(F.collect_list(F.struct("source", F.coalesce("total", F.lit(0)).alias("total")))).alias("own"))  # one row for each language, as wide as its sources
    every = written(every.select("grp", F.col("own.source").alias("all_sources"), F.col("own.total").alias("all_totals")), "sources")
    size = kept.groupBy("grp").agg(F.count("*").alias("v"))
    # a language's row goes to every part of its stripes, so that no task gets a whole language
    parts = 1 + kept.count() // PART
    whole = every.join(size, "grp").select("*", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    met = kept.withColumn("part", F.pmod(F.xxhash64("term"), F.lit(parts)).cast("int")).join(whole, ["grp", "part"])
    parts = written(met.mapInArrow(_divergences(top), "grp string, source string, part string, item string, value long"), "divergences")
    # pairs of languages without kept terms have no stripe: every pair starts at 0
    none = every.select("grp", F.explode("all_sources").alias("source"), "all_sources").select("grp", "source", F.explode("all_sources").alias("item"), F.lit(0).cast("long").alias("value"))
    pairs = parts.where("part = 'pair'").drop("part").unionByName(none.where("source <> item")).groupBy("grp", "source", "item").agg(F.sum("value").alias("value"))
    best = Window.partitionBy("grp", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("grp", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(best).alias("rank"))
    terms = parts.where("part = 'term'").select("grp", "source", "part", "item", "value", F.row_number().over(best).alias("rank")).where(F.col("rank") <= top)
    return pairs.unionAll(terms)
