"""Substring dedup: Rabin-Karp hashes of every window of ``width`` words, counted in Spark.

1. Documents are taken in chunks of about ``chunk_words`` words. Each word has a 64-bit hash;
   a window's hash is the polynomial sum of its words' hashes modulo 2^64 in an odd base,
   then mixed. Within a chunk equal windows are found by sorting: all but those of the
   smallest document id are repeats already, and only one copy of each window goes on. So a
   passage of a third of all documents leaves a chunk once.
2. The windows are dealt out by the top bits of their hash into buckets of about
   ``bucket_windows``; the bytes of a hash that the bucket implies are left out. In a bucket
   every window that also has a smaller document id is a repeat; its hash is sent back to its
   document.
3. Documents meet their repeats by id. Repeated windows merge into maximal intervals, and
   the words of the intervals go.

The number of buckets follows the text size, so the memory of a task doesn't grow with the
corpus. Windows are compared by two hashes: the one of step 1, and the first bytes of a second
one (another base, over words mixed anew). All steps compare both. The second one has at least
two bytes and as many as keep the expected number of false matches, n^2 / 2^(bits + 1) among n
windows, below 1 / 1000 at the size of the text (five at 1.7 * 10^13 windows).

Defined cases: a null or empty text has no words. Ids are integers; a null id counts as the
smallest: nothing is smaller, so such rows lose only what repeats within them, and they are cut
where they are read, however many they are. Rows that repeat an id are each compared with smaller ids and with themselves, not
with one another. An empty table gives an empty result. Other columns are not touched.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecoflux.llm.common import text_bytes, text_key, word_pieces

BASE = 0x9E3779B97F4A7C15
SECOND_BASE = 0xD1342543DE82EF95
LEAST_ID = -(1 << 63)
#: Distinct words whose hashes a task remembers.
WORD_CACHE = 1 << 18
#: Texts that a task holds before it passes them on.
OUTPUT_BYTES = 1 << 22


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word, 1)
        return h


def _hashed(text: bytes, cache: _WordHashes) -> np.ndarray:
    """The hash of every word."""
    some = [np.array(list(map(cache.__getitem__, words)), np.uint64) for words in word_pieces(text)]
    return np.concatenate(some) if some else np.zeros(0, np.uint64)


def window_hashes(words: np.ndarray, width: int, base: int = BASE) -> np.ndarray:
    """The hash of every window of ``width`` consecutive word hashes, by doubling."""
    if len(words) < width:
        return np.zeros(0, np.uint64)
    part, out, length, size = words, None, 0, 1
    while size <= width:
        if width & size:
            # windows of (length + size): ``out`` is the part so far, followed by a run of ``size``
            if out is None:
                out = part
            else:
                n = len(words) - length - size + 1
                out = out[:n] * np.uint64(pow(base, size, 1 << 64)) + part[length : length + n]
            length += size
        n = len(part) - size
        part = part[: max(n, 0)] * np.uint64(pow(base, size, 1 << 64)) + part[size:]
        size *= 2
    out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def window_tails(words: np.ndarray, width: int, extra: int) -> np.ndarray:
    """The first ``extra`` bytes of a second hash of every window."""
    mixed = (words ^ (words >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return window_hashes(mixed ^ (mixed >> np.uint64(30)), width, SECOND_BASE) >> np.uint64(64 - 8 * extra)


def extra_bytes(windows: int) -> int:
    """How many bytes of the second hash keep false matches among so many windows below 1 / 1000."""
    return min(8, max(2, -(-(2 * max(windows, 1).bit_length() + 9 - 64) // 8)))


def _order(h: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by both hashes, kept within equal ones, and where in it a new window begins."""
    by = np.lexsort((t, h))
    hs, ts = h[by], t[by]
    return by, np.concatenate(([True], (hs[1:] != hs[:-1]) | (ts[1:] != ts[:-1])))


def _among(h: np.ndarray, t: np.ndarray, some_h: np.ndarray, some_t: np.ndarray) -> np.ndarray:
    """Which windows (both hashes) are among some."""
    by, first = _order(some_h, some_t)
    some_h, some_t = some_h[by][first], some_t[by][first]
    at, found = np.searchsorted(some_h, h), np.zeros(len(h), bool)
    live = np.arange(len(h))
    while len(live):  # more than once only where the first hashes of different windows are equal
        live = live[at[live] < len(some_h)]
        live = live[some_h[at[live]] == h[live]]
        hit = some_t[at[live]] == t[live]
        found[live[hit]] = True
        live = live[~hit]
        at[live] += 1
    return found


def _slot(i: int, slots: int) -> int:
    """As pmod(xxhash64(id), slots) of Spark."""
    h = xxhash.xxh64_intdigest(struct.pack("<q", i), 42)
    return (h - (1 << 64) if h >> 63 else h) % slots


def _pack(*arrays: np.ndarray) -> bytes:
    return struct.pack("<I", len(arrays)) + b"".join(struct.pack("<cQ", a.dtype.char.encode(), a.nbytes) + a.tobytes() for a in arrays)


def _unpack(body: bytes) -> list[np.ndarray]:
    (n,), at, out = struct.unpack_from("<I", body), 4, []
    for _ in range(n):
        kind, size = struct.unpack_from("<cQ", body, at)
        out.append(np.frombuffer(body, kind.decode(), size // np.dtype(kind.decode()).itemsize, at + 9))
        at += 9 + size
    return out


def _short(h: np.ndarray, buckets: int) -> np.ndarray:
    """The hashes without the top bytes that their bucket implies."""
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : 8 - (buckets.bit_length() - 1) // 8].ravel()


def _whole(short: np.ndarray, bucket: int, buckets: int) -> np.ndarray:
    bits = buckets.bit_length() - 1
    kept = 8 - bits // 8
    out = np.zeros((len(short) // kept, 8), np.uint8)
    out[:, :kept] = short.reshape(-1, kept)
    top = bucket << (64 - bits) >> (8 * kept) << (8 * kept)
    return out.view("<u8").ravel() | np.uint64(top)


def _tail_bytes(t: np.ndarray, extra: int) -> np.ndarray:
    return t.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :extra].ravel()


def _tail_values(body: np.ndarray, extra: int) -> np.ndarray:
    out = np.zeros((len(body) // extra, 8), np.uint8)
    out[:, :extra] = body.reshape(-1, extra)
    return out.view("<u8").ravel()


def _narrow(a: np.ndarray) -> np.ndarray:
    """Non-negative numbers in the fewest bytes that hold them."""
    return a.astype(np.min_scalar_type(int(a.max()))) if len(a) else a.astype(np.uint8)


def _runs(flags: np.ndarray) -> np.ndarray:
    """(start, end) of each run of true flags."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edge.astype(np.int32)


def _chunk_rows(
    ids: list[int], keys: list[int], hashes: list[np.ndarray], tails: list[np.ndarray], buckets: int, slots: int, extra: int
) -> Iterator[tuple[int, int, bytes]]:
    """(kind, place, body): kind 0 are windows for a bucket, kind 1 repeats for a slot."""
    order = np.argsort(np.array(ids, np.int64), kind="stable")
    id_of = np.array(ids, np.int64)[order]
    sizes = np.array([len(hashes[r]) for r in order])
    h = np.concatenate([hashes[r] for r in order])
    t = np.concatenate([tails[r] for r in order])
    row = np.repeat(np.arange(len(order), dtype=np.int32), sizes)
    by, first = _order(h, t)  # keeps the order of ids and starts within a window
    rs = row[by]
    again = ~first & np.concatenate(([False], rs[1:] == rs[:-1]))
    lead = by[first]
    least = id_of[row[lead]][np.cumsum(first) - 1]
    gone = np.zeros(len(h), bool)
    gone[by] = again | (id_of[rs] > least)
    lead.sort()
    place = (h[lead] >> np.uint64(65 - buckets.bit_length())).astype(np.int64)
    turn = np.argsort(place, kind="stable")
    lead, place = lead[turn], place[turn]
    for b, part in zip(np.unique(place).tolist(), np.split(lead, np.flatnonzero(np.diff(place)) + 1)):
        rows, counts = np.unique(row[part], return_counts=True)
        yield 0, b, _pack(id_of[rows[:1]], _narrow(np.diff(id_of[rows].view(np.uint64))), _narrow(counts), _short(h[part], buckets), _tail_bytes(t[part], extra))
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    some = np.flatnonzero(np.add.reduceat(gone, bounds[:-1]) * (sizes > 0))
    out: dict[int, list] = {}
    for r in some[id_of[some] != LEAST_ID].tolist():
        out.setdefault(_slot(int(id_of[r]), slots), []).append((int(id_of[r]), keys[order[r]], _runs(gone[bounds[r] : bounds[r + 1]])))
    for s, got in out.items():
        yield 1, s, _pack(np.array([g[0] for g in got], np.int64), np.array([g[1] for g in got], np.int64), np.array([len(g[2]) for g in got], np.int32), np.concatenate([g[2] for g in got]))


def _local(width: int, buckets: int, slots: int, chunk_words: int, extra: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _WordHashes()
        ids, keys, hashes, tails, n = [], [], [], [], 0

        def flush():
            rows = list(_chunk_rows(ids, keys, hashes, tails, buckets, slots, extra)) if n else []
            return _batch(*(list(c) for c in zip(*rows))) if rows else _batch([], [], [])

        for b in batches:
            for i, tk, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), text_bytes(b.column(2))):
                words = _hashed(text, cache)
                own = window_hashes(words, width)
                if not len(own):
                    continue
                ids.append(LEAST_ID if i is None else i)
                keys.append(tk)
                hashes.append(own)
                tails.append(window_tails(words, width, extra))
                n += len(own)
                if n >= chunk_words:
                    yield flush()
                    ids, keys, hashes, tails, n = [], [], [], [], 0
        yield flush()

    return run


def _repeats(bodies: list[bytes], bucket: int, buckets: int, extra: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, both hashes) of the windows of one bucket that a smaller id has too, sorted by id."""
    ids, h, t = [], [], []
    for first, step, counts, hashes, tails in map(_unpack, bodies):
        ids.append(np.repeat(np.cumsum(np.concatenate((first.view(np.uint64), step)), dtype=np.uint64).view(np.int64), counts))
        h.append(_whole(hashes, bucket, buckets))
        t.append(_tail_values(tails, extra))
    ids, h, t = np.concatenate(ids), np.concatenate(h), np.concatenate(t)
    by, new = _order(h, t)
    start, s = np.flatnonzero(new), ids[by]
    least = np.repeat(np.minimum.reduceat(s, start), np.diff(np.concatenate((start, [len(by)]))))
    by = by[s > least]
    by = by[np.argsort(ids[by], kind="stable")]
    return ids[by], h[by], t[by]


def _batch(kind: list[int], place: list[int], body: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(place, pa.int32()), pa.array(body, pa.binary())], ["kind", "place", "body"])


def _count(buckets: int, slots: int, extra: int):
    """Rows (kind, place, body) sorted by kind and place in: of windows (kind 0) the repeats
    go out as kind 2; others go out as they are."""

    def answers(bodies: list[bytes], bucket: int) -> pa.RecordBatch:
        ids, h, t = _repeats(bodies, bucket, buckets, extra)
        own, at = np.unique(ids, return_index=True)
        place = np.array([_slot(i, slots) for i in own.tolist()], np.int64)
        ends = np.concatenate((at[1:], [len(ids)])).astype(np.int64)
        out = []
        for s in np.unique(place).tolist():
            mine = np.flatnonzero(place == s)
            part = np.concatenate([np.arange(at[m], ends[m]) for m in mine.tolist()])
            out.append((s, _pack(own[mine], (ends - at)[mine].astype(np.int32), h[part], _tail_bytes(t[part], extra))))
        return _batch([2] * len(out), [o[0] for o in out], [o[1] for o in out])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for b in batches:
            for kind, place, body in zip(*(b.column(i).to_pylist() for i in range(3))):
                if held and (kind, place) != (0, now):
                    yield answers(held, now)
                    held = []
                if kind == 0:
                    now = place
                    held.append(body)
                else:
                    yield _batch([kind], [place], [body])
        if held:
            yield answers(held, now)

    return run


def _covered(start: np.ndarray, width: int, n_words: int) -> np.ndarray:
    """The words that windows with these starts cover."""
    step = np.zeros(n_words + 1, np.int32)
    for a, b in _runs(start).reshape(-1, 2).tolist():
        step[a] += 1
        step[b - 1 + width] -= 1
    return np.cumsum(step[:-1]) > 0


def _without(text: bytes, gone: np.ndarray | None) -> tuple[int, int, bytes]:
    """(words, words removed, the others joined by a space)."""
    n, parts = 0, []
    for words in word_pieces(text):
        m = n + len(words)
        if gone is not None:
            words = [w for w, g in zip(words, gone[n:m].tolist()) if not g]
        n = m
        if words:
            parts.append(b" ".join(words))
    return n, 0 if gone is None else int(gone.sum()), b" ".join(parts)


def _result(out: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*out)) or [[]] * 4
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    ids, n_words, n_removed, kept = (pa.array(c, t) for c, t in zip(cols, types))
    return pa.RecordBatch.from_arrays([ids, n_words, n_removed, kept.cast(pa.string())], ["id", "n_words", "n_removed", "kept"])


def _alone(width: int, extra: int):
    """Rows (id, text) of the smallest id in: cut by what repeats within each of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _WordHashes()
        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), text_bytes(b.column(1))):
                words = _hashed(text, cache)
                gone = None
                if len(words) > width:
                    by, first = _order(window_hashes(words, width), window_tails(words, width, extra))
                    again = np.zeros(len(by), bool)
                    again[by] = ~first
                    gone = _covered(again, width, len(words))
                yield _result([(i, *_without(text, gone))])

    return run


def _cut(width: int, extra: int):
    """Rows (place, kind, id, tk, body, text) sorted by place and kind in: the repeats of a
    slot (kinds 1 and 2), then its documents (kind 3). Documents with what they keep out."""

    def removed(text: bytes, spans: list, hashes: list, cache: _WordHashes) -> np.ndarray:
        words = _hashed(text, cache)
        n = len(words) - width + 1
        start = np.zeros(max(n, 0), bool)
        for s in spans:
            for a, b in s.reshape(-1, 2).tolist():
                start[a:b] = True
        if hashes and n > 0:
            some_h, some_t = (np.concatenate(x) for x in zip(*hashes))
            start |= _among(window_hashes(words, width), window_tails(words, width, extra), some_h, some_t)
        return _covered(start, width, len(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _WordHashes()
        now, spans, hashes = None, {}, {}
        for b in batches:
            place, kind, ids, tks, bodies = (b.column(i).to_pylist() for i in range(5))
            out, size = [], 0
            for p, k, i, tk, body, text in zip(place, kind, ids, tks, bodies, text_bytes(b.column(5))):
                if p != now:
                    now, spans, hashes = p, {}, {}
                if k == 1:
                    own, keys, counts, ends = _unpack(body)
                    for o, key, part in zip(own.tolist(), keys.tolist(), np.split(ends, np.cumsum(counts)[:-1])):
                        spans.setdefault((o, key), []).append(part)
                elif k == 2:
                    own, counts, h, tails = _unpack(body)
                    ends = np.cumsum(counts)[:-1]
                    for o, *part in zip(own.tolist(), np.split(h, ends), np.split(_tail_values(tails, extra), ends)):
                        hashes.setdefault(o, []).append(part)
                else:
                    o = LEAST_ID if i is None else i
                    mine = spans.get((o, tk), []), hashes.get(o, [])
                    out.append((i, *_without(text, removed(text, *mine, cache) if any(mine) else None)))
                    size += len(out[-1][3])
                    if size >= OUTPUT_BYTES:
                        yield _result(out)
                        out, size = [], 0
            yield _result(out)

    return run


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 20, chunk_words: int = 1 << 19, bucket_windows: int = 1 << 21
) -> DataFrame:
    """(id, n_words, n_removed, kept) for each row: ``kept`` are the words that stay, joined
    by one space."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_key(F.col(text_col)).alias("tk"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    windows = size // 6  # about six bytes a word
    buckets, extra = max(256, 1 << (windows // bucket_windows).bit_length()), extra_bytes(windows)
    message = "kind int, place int, body binary"
    local = rows.mapInArrow(_local(width, buckets, buckets, chunk_words, extra), message)
    back = local.repartition("kind", "place").sortWithinPartitions("kind", "place").mapInArrow(_count(buckets, buckets, extra), message)
    nothing, least = F.lit(None), F.lit(LEAST_ID).cast("long")
    back = back.select("place", "kind", nothing.cast("long").alias("id"), nothing.cast("long").alias("tk"), "body", nothing.cast("string").alias("text"))
    slot = F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")
    own = rows.where(F.col("id") > least).select(slot.alias("place"), F.lit(3).alias("kind"), "id", "tk", nothing.cast("binary").alias("body"), "text")
    met = own.unionAll(back).repartition("place").sortWithinPartitions("place", "kind")
    result = "id long, n_words long, n_removed long, kept string"
    alone = rows.where(F.col("id").isNull() | (F.col("id") == least)).select("id", "text").mapInArrow(_alone(width, extra), result)
    return met.mapInArrow(_cut(width, extra), result).unionAll(alone)
