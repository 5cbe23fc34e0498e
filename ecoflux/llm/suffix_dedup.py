"""Suffix-array dedup on run-length indexes (run-compressed Burrows-Wheeler transforms).

Every byte goes that is covered by a string of ``length`` bytes which also starts in a document
with a smaller id. An index of the whole corpus would not be distributed, so strings that can
be equal are brought together in small indexes:

1. *Anchors.* The anchor of a string of ``length`` bytes is the k-gram in it with the least
   hash, so equal strings have equal anchors. Chunks of documents send the hashes of their
   anchors, each once, to buckets. An anchor that two documents share is *met*; only strings
   with a met anchor can be repeated. Neighbouring strings that share an anchor stay together
   as one *stretch* of bytes.
2. *Stretches* with a met anchor are dealt out by their anchor. Those equal to one of a smaller
   document in the same chunk are repeats as a whole; the others are sent. Stretches of an
   anchor that more than ``hot_docs`` documents share (a common phrase among ever new words)
   are cut into single strings, dealt out by their own hash, so that no bucket is hot.
3. *Index.* The suffixes of a bucket's different stretches are sorted and transformed. The
   index keeps the runs of the transform and, at the ends of runs, text positions with the
   length of the match to the suffix before. From these samples the matching statistics of
   every position are streamed in text order: inside a run a match is one byte shorter than at
   the position before. Matches of ``length`` bytes and more link the suffixes that begin with
   the same string; the smallest document id among them tells which documents hold a repeat.
4. Documents meet their marks, and merged marks go.

Hashes choose candidates and places only; every mark comes from a comparison of bytes.
The number of buckets follows the text size; a task holds a chunk or a bucket at a time, and
builds a bucket's indexes one after the other.
The frequent anchors (at most ``MOST_HOT``, 32 MB) are sent to every task. Chunks are told
apart by their place in the input's partitions, so ``docs`` must be a written table or another
frame that gives the same partitions when a lost task runs again.

Defined cases: a null text is empty. Ids are integers; a null id counts as the smallest. Rows
that repeat an id are compared with smaller ids only, not with one another; rows equal in id
and text travel once for each batch. An empty table gives an empty result. Other columns are
not touched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecoflux.llm.common import narrowed, packed, text_bytes, text_key, unpacked, utf8, written

LEAST_ID = -(1 << 63)
#: Bytes of an anchor.
ANCHOR = 16
#: Bits of an anchor's hash beyond those that tell its bucket.
KEY_BITS = 40
#: Bits of it that part a bucket: so many indexes are built for a bucket, one after the other.
PART_BITS = 4
#: Strings that a stretch holds at most.
MOST_STRINGS = 64
#: Bytes of text that are looked at for anchors at once.
BLOCK = 1 << 18
#: Documents of a chunk at most.
CHUNK_DOCS = 1 << 16
#: Frequent anchors that are told to every task at most.
MOST_HOT = 1 << 22
#: Bytes of kept text that a task holds before it passes them on.
OUTPUT_BYTES = 1 << 22

MESSAGE = "kind int, place long, id long, tk long, n long, body binary"
_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    """Messages (kind, place, body) or (kind, place, id, tk, n, body)."""
    whole = [r if len(r) == 6 else (*r[:2], 0, 0, 0, r[2]) for r in rows]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*whole) if whole else [[]] * 6, _TYPES)], ["kind", "place", "id", "tk", "n", "body"])


def _columns(b: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(b.column(n).to_pylist() for n in names))


# ------------------------------------------------------------------ anchors and stretches


def _hashes(seg: np.ndarray) -> np.ndarray:
    """A hash of the ``ANCHOR`` (16) bytes at each position that has them."""
    n = len(seg) - 7
    word = np.empty(n, np.uint64)
    for o in range(min(8, n)):
        m = (n - o + 7) // 8
        word[o::8] = np.frombuffer(seg[o : o + 8 * m].tobytes(), "<u8", m)
    h = word[:-8] * np.uint64(0x9E3779B97F4A7C15) + word[8:] * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def stretches(raw: np.ndarray, off: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(document number, first position, number of strings, anchor hash) of all stretches of
    neighbouring strings with one anchor, block by block of the texts."""
    wide = length - ANCHOR + 1
    for at in range(0, int(off[-1]) - length + 1, BLOCK):
        h = _hashes(raw[at : at + BLOCK + length - 1])
        size = 1
        while 2 * size <= wide:
            h, size = np.minimum(h[:-size], h[size:]), 2 * size
        if size < wide:
            h = np.minimum(h[: size - wide], h[wide - size :])
        start = np.arange(at, at + len(h))
        lo, hi = np.searchsorted(off, at, "right") - 1, np.searchsorted(off, at + len(h), "left")
        doc = np.repeat(np.arange(lo, hi), np.diff(np.clip(off[lo : hi + 1], at, at + len(h))))
        ok = off[doc + 1] - start >= length
        start, doc, h = start[ok], doc[ok], h[ok]
        if not len(start):
            continue
        first = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))))
        n = np.diff(np.concatenate((first, [len(start)])))
        if n.max() > MOST_STRINGS:  # the same bytes again and again
            parts = -(-n // MOST_STRINGS)
            step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            first, n = np.repeat(first, parts) + step * MOST_STRINGS, np.minimum(np.repeat(n, parts) - step * MOST_STRINGS, MOST_STRINGS)
        yield doc[first], start[first] - off[doc[first]], n, h[first]


def _key(h: np.ndarray, bits: int) -> np.ndarray:
    """The part of an anchor's hash that is kept: ``bits`` tell the bucket. Least hashes are
    small, so they are mixed once more."""
    return (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - bits - KEY_BITS)


def _among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which keys are in ``known`` (sorted)."""
    if not len(known):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


def _anchors(length: int, bits: int, chunk_bytes: int):
    """Rows (id, tk, place, text) in. Out: kind 0, the anchors of a chunk for a bucket; kind 1,
    for the chunk itself, the slots of its documents and the anchors that two of them share."""

    def chunk(number: int, docs: list[int], found: list[tuple]) -> Iterator[pa.RecordBatch]:
        doc, key = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
        by = np.argsort(key, kind="stable")  # documents ascend within a key
        doc, key = doc[by], key[by]
        new = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
        once = new | np.concatenate(([True], doc[1:] != doc[:-1]))[: len(doc)]
        doc, key, lead = doc[once], key[once], np.flatnonzero(new[once])
        n = np.diff(np.concatenate((lead, [len(key)]))).astype(np.int64)
        shared = np.repeat(n > 1, n)
        yield _batch([(1, number, packed(np.array(docs, np.int64), doc[shared].astype(np.int32), key[shared]))])
        key, doc, n = key[lead], doc[lead], np.minimum(n, 255).astype(np.uint8)
        ends = np.searchsorted(key >> np.uint64(KEY_BITS), np.arange((1 << bits) + 1, dtype=np.uint64))  # keys ascend
        rows = []
        for b in np.flatnonzero(np.diff(ends)).tolist():
            mine = np.arange(ends[b], ends[b + 1])
            mine = mine[np.argsort(doc[mine], kind="stable")]
            low = np.ascontiguousarray(key[mine]).view(np.uint8).reshape(-1, 8)[:, : KEY_BITS // 8].ravel()
            rows.append((0, b, packed(np.array([number]), narrowed(np.diff(doc[mine], prepend=0)), n[mine], low)))
        yield _batch(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        docs, seen, found, size = [], set(), [], 0
        for b in batches:
            raw, off = utf8(b.column(3))
            whole = list(_columns(b, "id", "tk", "place"))
            at = 0
            while at < len(whole):
                # some rows at a time, as many as the chunk has room for (at least one)
                to = max(at + 1, min(int(np.searchsorted(off, off[at] + chunk_bytes - size, "right")) - 1, at + CHUNK_DOCS - len(docs)))
                new = np.full(to - at, -1)
                for r in range(at, to):
                    i, tk, place = whole[r]
                    if off[r + 1] - off[r] >= length and (i, tk) not in seen:
                        seen.add((i, tk))
                        new[r - at] = len(docs)
                        docs.append(place)
                for doc, _, _, h in stretches(raw[off[at] : off[to]], off[at : to + 1] - off[at], length):
                    some = new[doc] >= 0
                    found.append((new[doc[some]], _key(h[some], bits)))
                size += int(off[to] - off[at])
                at = to
                if size >= chunk_bytes or len(docs) >= CHUNK_DOCS or at < len(whole):
                    yield from chunk(number, docs, found) if docs else ()
                    docs, seen, found, size, number = [], set(), [], 0, number + 1
        if docs:
            yield from chunk(number, docs, found)

    return run


def _met(hot_docs: int):
    """Messages sorted by kind and place in. Out: kind 1 as it is; kind 2, for a chunk, the
    anchors that another chunk has too; kind 4, the anchors of more than ``hot_docs`` documents."""

    def answers(bodies: list[bytes], bucket: int) -> pa.RecordBatch:
        number, doc, n, key = [], [], [], []
        for own, step, count, low in map(unpacked, bodies):
            number.append(np.repeat(own, len(step)))
            doc.append(np.cumsum(step, dtype=np.int64))
            n.append(count.astype(np.int64))
            whole = np.zeros((len(step), 8), np.uint8)
            whole[:, : KEY_BITS // 8] = low.reshape(len(step), -1)
            key.append(whole.view("<u8").ravel() | np.uint64(bucket << KEY_BITS))
        number, doc, n, key = (np.concatenate(x) for x in (number, doc, n, key))
        by = np.argsort(key, kind="stable")
        start = np.flatnonzero(np.concatenate(([True], key[by][1:] != key[by][:-1])))
        total = np.empty(len(key), np.int64)
        total[by] = np.repeat(np.add.reduceat(n[by], start), np.diff(np.concatenate((start, [len(key)]))))
        rows = []
        if len(hot := np.unique(key[total > hot_docs])):
            rows.append((4, 0, packed(hot)))
        met = np.flatnonzero((total > 1) & (n == 1))
        met = met[np.argsort(number[met], kind="stable")]
        for some in np.split(met, np.flatnonzero(np.diff(number[met])) + 1) if len(met) else []:
            rows.append((2, int(number[some[0]]), packed(narrowed(doc[some]), key[some])))
        return _batch(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for b in batches:
            for kind, place, body in _columns(b, "kind", "place", "body"):
                if held and (kind, place) != (0, now):
                    yield answers(held, now)
                    held = []
                if kind == 0:
                    now = place
                    held.append(body)
                else:
                    yield _batch([(kind, place, body)])
        if held:
            yield answers(held, now)

    return run


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kinds 1 and 2 sorted by chunk in. Out: kind 1, for a slot, the met anchors of its documents."""

    def answers(bodies: list[bytes]) -> pa.RecordBatch:
        places, doc, key = unpacked(bodies[0])
        more = [unpacked(b) for b in bodies[1:]]
        doc = np.concatenate([doc, *(m[0].astype(np.int64) for m in more)]).astype(np.int64)
        key = np.concatenate([key, *(m[1] for m in more)])
        place = places[doc]
        by = np.lexsort((key, place))
        place, key = place[by], key[by]
        once = np.concatenate(([True], (place[1:] != place[:-1]) | (key[1:] != key[:-1])))[: len(key)]
        place, key = place[once], key[once]
        rows = []
        for some in np.split(np.arange(len(key)), np.flatnonzero(np.diff(place)) + 1) if len(key) else []:
            rows.append((1, int(place[some[0]]), packed(key[some])))
        return _batch(rows)

    held, now = [], None
    for b in batches:
        for place, body in _columns(b, "place", "body"):
            if held and place != now:
                yield answers(held)
                held = []
            now = place
            held.append(body)
    if held:
        yield answers(held)


def _zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, tk, place, text) as messages of kind 3, those equal in id and text once."""
    zipper = zstandard.ZstdCompressor(level=1)
    for b in batches:
        rows: dict[tuple, list] = {}
        for (i, tk, place), text in zip(_columns(b, "id", "tk", "place"), text_bytes(b.column(3))):
            if own := rows.get((i, tk)):
                own[4] += 1
            else:
                rows[i, tk] = [3, place, i, tk, 1, zipper.compress(text)]
        yield _batch([tuple(r) for r in rows.values()])


def _by_slot(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[bytes], tuple]]:
    """(slot, rank, messages, row) of the documents (kind 3) of messages sorted by place, kind,
    id and tk: ``rank`` numbers the different documents of a slot, ``messages`` are those that
    precede its documents."""
    now, told, rank, last = None, [], -1, None
    for b in batches:
        for kind, place, i, tk, n, body in _columns(b, "kind", "place", "id", "tk", "n", "body"):
            if place != now:
                now, told, rank, last = place, [], -1, None
            if kind != 3:
                told.append((kind, body))
                continue
            if (i, tk) != last:
                rank, last = rank + 1, (i, tk)
            yield place, rank, told, (i, tk, n, body)


def _sent(length: int, bits: int, hot: np.ndarray, chunk_bytes: int):
    """Met anchors (kind 1) and documents (kind 3) of slots in. Out: kind 0, stretches for a
    bucket; kind 2, for a slot, what its documents know without an index: strings that a smaller
    document of the chunk holds too, and stretches that repeat one of their own."""

    def flush(seen: dict[bytes, list], ids: list[int], docs: list[tuple[int, int]], keys: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
        buckets: dict[int, list] = {}
        slots: dict[int, list] = {}
        for text, held in seen.items():
            least = min(ids[d] for d, _ in held)
            n = len(text) - length + 1
            k = keys[text]
            for d in {d for d, _ in held}:
                own = [at for x, at in held if x == d] if len(held) > 1 else [held[0][1]]
                place, rank = docs[d]
                if ids[d] > least:
                    slots.setdefault(place, []).extend((rank, at, at, n) for at in own)
                else:
                    buckets.setdefault(k >> PART_BITS, []).append((place, rank, own[0], k & (1 << PART_BITS) - 1, ids[d], text))
                    if len(own) > 1:  # marked with the first
                        slots.setdefault(place, []).extend((rank, at, own[0], n) for at in own[1:])
        zipper = zstandard.ZstdCompressor(level=1)
        rows = []
        for b, got in buckets.items():
            place, rank, at, part, own, texts = zip(*sorted(got))  # stretches that overlap come together
            own = np.array(own, np.int64)
            span = narrowed(own.view(np.uint64) - np.int64(own.min()).view(np.uint64))
            numbers = [narrowed(np.array(x, np.int64)) for x in (part, place, rank, at, [len(t) for t in texts])]
            rows.append((0, b, zipper.compress(packed(np.array([own.min()]), span, *numbers, np.frombuffer(b"".join(texts), np.uint8)))))
            if len(rows) == 64:
                yield _batch(rows)
                rows = []
        rows += [(2, s, packed(*(narrowed(np.array(x, np.int64)) for x in zip(*got)))) for s, got in slots.items()]
        yield _batch(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzipper = zstandard.ZstdDecompressor()
        now, last, met = None, None, np.zeros(0, np.uint64)
        seen: dict[bytes, list] = {}
        keys: dict[bytes, int] = {}
        ids: list[int] = []
        docs: list[tuple[int, int]] = []
        some: list[bytes] = []
        size = waiting = 0

        def look() -> None:
            """Take the stretches of the texts of ``some``, the last documents of ``docs``."""
            raw = np.frombuffer(b"".join(some), np.uint8)
            off = np.concatenate(([0], np.cumsum([len(t) for t in some])))
            base = len(docs) - len(some)
            for doc, start, n, h in stretches(raw, off, length):
                key = _key(h, bits)
                own = np.flatnonzero(_among(key, met))
                key, frequent = key[own], _among(key[own], hot)
                for d, at, m, k, cut in zip(doc[own].tolist(), start[own].tolist(), n[own].tolist(), (key >> np.uint64(KEY_BITS - PART_BITS)).tolist(), frequent.tolist()):
                    text = some[d]
                    for a, c in ((a, 1) for a in range(at, at + m)) if cut else ((at, m),):
                        s = text[a : a + c + length - 1]
                        if held := seen.get(s):
                            held.append((base + d, a))
                        else:
                            seen[s] = [(base + d, a)]
                            keys[s] = xxhash.xxh64_intdigest(s) >> (64 - bits - PART_BITS) if cut else k
            some.clear()

        for place, rank, told, (i, tk, _, body) in _by_slot(batches):
            if place != now:
                look()
                # an anchor that one document of the slot shares with others is met for all of them
                now, waiting = place, 0
                met = np.unique(np.concatenate([np.zeros(0, np.uint64), *(unpacked(m)[0] for _, m in told)]))
            if (place, rank) == last:
                continue
            last = place, rank
            some.append(unzipper.decompress(body))
            ids.append(i)
            docs.append((place, rank))
            size, waiting = size + len(some[-1]), waiting + len(some[-1])
            if size >= chunk_bytes or waiting >= BLOCK:
                look()
                waiting = 0
            if size >= chunk_bytes:
                yield from flush(seen, ids, docs, keys)
                seen, keys, ids, docs, size = {}, {}, [], [], 0
        look()
        yield from flush(seen, ids, docs, keys)

    return run


# ------------------------------------------------------------------ the run-length index


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of texts, over suffixes of ``length`` bytes and
    more (others can't begin a match), sorted by their first ``length`` bytes.

    ``order`` are the rows' text positions. ``symbols`` are the runs' preceding bytes (0: none,
    the start of a text; else a code), ``starts`` their first rows. A run also ends where the
    suffixes that are a byte longer are no neighbours. ``sample``, ``before`` and ``match`` are,
    for the first row of each run, its position, that of the row above, and the length of their
    match."""

    def __init__(self, texts: list[bytes], length: int):
        self.length = length
        sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(sizes)
        self.size = int(sizes.sum())
        raw = np.frombuffer(b"".join(texts), np.uint8)
        self.room = np.repeat(self.ends, sizes) - np.arange(self.size)  # bytes to the end of the text
        # bytes by their rank among those that occur, as many in a word as it holds
        used = np.bincount(raw, minlength=256) > 0
        codes = np.cumsum(used)[raw].astype(np.int64)
        self.base = int(used.sum()) + 1
        self.wide = int(63 / math.log2(self.base) - 1e-9)
        self.words = np.zeros(self.size, np.int64)
        for j in range(self.wide):
            self.words *= self.base
            here = max(self.size - j, 0)
            self.words[:here] += codes[j:]
        self.order = self._sorted(np.flatnonzero(self.room >= length))
        above = np.concatenate(([-1], self.order[:-1]))[: len(self.order)]
        over = np.full(self.size + 1, -2)
        over[self.order] = above
        previous = np.concatenate(([0], codes[:-1]))[: self.size]
        previous[self.ends[:-1][self.ends[:-1] < self.size]] = 0
        bwt = previous[self.order]
        ends_run = (bwt == 0) | (above < 0) | (bwt != previous[above]) | (over[self.order - 1] + 1 != above)
        self.starts = np.flatnonzero(ends_run)
        self.symbols = bwt[self.starts]
        self.sample, self.before = self.order[self.starts], above[self.starts]
        self.match = self._matches(self.sample, self.before)

    def _sorted(self, rows: np.ndarray) -> np.ndarray:
        """Positions in order of the ``length`` bytes there: by a word, then what is tied by
        further bytes, at last by position."""
        by = rows[np.argsort(self.words[rows])] if len(rows) else rows
        known, place, key = self.wide, np.arange(len(by)), self.words[by]
        while len(place):
            new = np.concatenate(([True], key[1:] != key[:-1]))
            tied = ~new | ~np.concatenate((new[1:], [True]))
            place, group = place[tied], np.cumsum(new[tied])
            if not len(place) or known >= self.length:
                by[place] = by[place][np.argsort(group * self.size + by[place])]
                break
            more = min(self.wide, int((62 - math.log2(int(group[-1]) + 1)) / math.log2(self.base)))
            key = group * self.base**more + self.words[by[place] + known] // self.base ** (self.wide - more)
            turn = np.argsort(key)
            by[place], key = by[place[turn]], key[turn]
            known += more
        return by

    def _matches(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The length of the longest common prefix of the suffixes at a and b (0 if b < 0)."""
        out = np.zeros(len(a), np.int64)
        live = np.flatnonzero(b >= 0)
        most = np.minimum(self.room[a[live]], self.room[b[live]])
        at = 0
        while len(live):
            x, y = self.words[a[live] + at], self.words[b[live] + at]
            same = np.where(x == y, self.wide, 0)
            odd = np.flatnonzero(x != y)
            x, y = x[odd], y[odd]
            for _ in range(self.wide - 1):
                x, y = x // self.base, y // self.base
                same[odd] += x == y
            out[live] = np.minimum(at + same, most)
            on = (same == self.wide) & (at + self.wide < most)
            live, most, at = live[on], most[on], at + self.wide
        return out

    def statistics(self) -> np.ndarray:
        """For each row's text position, the length of its match with the row above, streamed
        from the samples: between two of them it falls by one at each byte."""
        sampled = np.zeros(self.size, np.int64)
        sampled[self.sample] = self.sample
        last = np.maximum.accumulate(sampled)
        first = np.zeros(self.size, np.int64)
        first[self.sample] = self.match
        return first[last] - (np.arange(self.size) - last)

    def least(self, owner: np.ndarray) -> np.ndarray:
        """For each row's position, the least owner of a text that holds the ``length`` bytes
        there (``owner`` has one number for each text)."""
        out = np.zeros(self.size, np.int64)
        head = np.flatnonzero(self.statistics()[self.order] < self.length)
        if len(head):
            own = np.repeat(owner, np.diff(np.concatenate(([0], self.ends))))[self.order]
            out[self.order] = np.repeat(np.minimum.reduceat(own, head), np.diff(np.concatenate((head, [len(self.order)]))))
        return out


def _indexed(length: int):
    """Messages sorted by kind and place in. Out: kind 2 as it is; kind 1, for a slot, the
    strings of its documents that a smaller document holds too."""

    def strings(some: list[tuple]) -> tuple[np.ndarray, ...]:
        """Of stretches (ids, places, ranks, positions, sizes, texts), runs of strings that a
        smaller document holds too: (place, rank, position of the stretch, first, how many)."""
        number: dict[bytes, int] = {}
        which = np.array([number.setdefault(t, len(number)) for x in some for t in x[5]], np.int64)
        ids, place, rank, at, size = (np.concatenate([x[c] for x in some]).astype(np.int64) for c in range(5))
        owner = np.full(len(number), np.iinfo(np.int64).max)
        np.minimum.at(owner, which, ids)
        index = RunIndex(list(number), length)
        least = index.least(owner)
        # the strings of each stretch: those of its text in the index
        n = size - length + 1
        first = np.concatenate(([0], index.ends))[which]
        each = np.repeat(np.arange(len(which)), n)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        hit = least[first[each] + step] < ids[each]
        last = np.concatenate((step[1:] == 0, [True]))
        begin = np.flatnonzero(hit & ((step == 0) | ~np.concatenate(([False], hit[:-1]))))
        stop = np.flatnonzero(hit & (last | ~np.concatenate((hit[1:], [False]))))
        e = each[begin]
        return place[e], rank[e], at[e], step[begin], stop - begin + 1

    def answers(bodies: list[bytes]) -> pa.RecordBatch:
        unzipper = zstandard.ZstdDecompressor()
        parts: dict[int, list] = {}
        for body in bodies:
            base, span, part, place, rank, at, size, raw = unpacked(unzipper.decompress(body))
            ids = (base.view(np.uint64) + span.astype(np.uint64)).view(np.int64)
            raw, ends = raw.tobytes(), np.concatenate(([0], np.cumsum(size, dtype=np.int64)))
            for p in np.unique(part).tolist():
                mine = np.flatnonzero(part == p)
                texts = [raw[x:y] for x, y in zip(ends[mine].tolist(), ends[mine + 1].tolist())]
                parts.setdefault(p, []).append((*(x[mine] for x in (ids, place, rank, at, size)), texts))
        place, *marks = (np.concatenate(x) for x in zip(*(strings(some) for some in parts.values())))
        by = np.argsort(place, kind="stable")
        rows = []
        for some in np.split(by, np.flatnonzero(np.diff(place[by])) + 1) if len(by) else []:
            rows.append((1, int(place[some[0]]), packed(*(narrowed(x[some]) for x in marks))))
        return _batch(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for b in batches:
            for kind, place, body in _columns(b, "kind", "place", "body"):
                if held and (kind, place) != (0, now):
                    yield answers(held)
                    held = []
                if kind == 0:
                    now = place
                    held.append(body)
                else:
                    yield _batch([(kind, place, body)])
        if held:
            yield answers(held)

    return run


def _cut(length: int):
    """Marks (kinds 1 and 2) and documents (kind 3) of slots in; what documents keep out."""
    schema = pa.schema(
        [("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())]
    )

    def known(told: list[tuple[int, bytes]]) -> tuple[dict, dict]:
        """By rank: strings (first position of the stretch, first string, how many) and twins
        (position, that of the stretch which it repeats)."""
        strings: dict[int, list] = {}
        twins: dict[int, list] = {}
        for kind, body in told:
            for rank, at, x, n in zip(*(a.tolist() for a in unpacked(body))):
                if kind == 1:
                    strings.setdefault(rank, []).append((at, x, n))
                elif at == x:
                    strings.setdefault(rank, []).append((at, 0, n))
                else:
                    twins.setdefault(rank, []).append((at, x))
        return strings, twins

    def spans(size: int, strings: list, twins: list) -> np.ndarray:
        """(start, end) of the maximal runs that marked strings cover."""
        if twins:
            of: dict[int, list] = {}
            for at, first, n in strings:
                of.setdefault(at, []).append((first, n))
            strings = strings + [(at, first, n) for at, x in twins for first, n in of.get(x, ())]
        if not strings:
            return np.zeros((0, 2), np.int64)
        at, first, n = (np.array(x, np.int64) for x in zip(*strings))
        a, b = at + first, at + first + n - 1 + length
        by = np.argsort(a, kind="stable")
        a, b = a[by], np.maximum.accumulate(b[by])
        new = np.concatenate(([True], a[1:] > b[:-1]))
        return np.stack((a[new], b[np.concatenate((new[1:], [True]))]), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzipper = zstandard.ZstdDecompressor()
        now, out, size = None, [], 0
        for place, rank, told, (i, _, n, body) in _by_slot(batches):
            if place != now:
                now, (strings, twins) = place, known(told)
            text = unzipper.decompress(body)
            gone = spans(len(text), strings.get(rank, []), twins.get(rank, []))
            a, b = gone[:, 0].tolist(), gone[:, 1].tolist()
            kept = b"".join(text[x:y] for x, y in zip([0, *b], [*a, len(text)]))
            for _ in range(n):
                out.append((None if i == LEAST_ID else i, len(text), len(text) - len(kept), [{"start": x, "end": y} for x, y in zip(a, b)], kept))
                size += len(kept) + 64
                if size >= OUTPUT_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def without_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 50,
    hot_docs: int = 10_000,
    bucket_bytes: int = 1 << 24,
    chunk_bytes: int = 1 << 23,
) -> DataFrame:
    """(id, n_bytes, n_removed, spans, kept) for each row: ``spans`` are the maximal runs of
    bytes that go (start, end), ``kept`` the other bytes, put together."""
    if length < ANCHOR + 8:
        raise ValueError(f"length must be {ANCHOR + 8} at least")
    own = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST_ID)).alias("id"), text_key(F.col(text_col)).alias("tk"), F.col(text_col).alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(64 - KEY_BITS, max(5, (size // bucket_bytes).bit_length()))
    rows = own.select("id", "tk", F.pmod(F.xxhash64("id", "tk"), F.lit(1 << bits)).alias("place"), "text")
    anchors = rows.mapInArrow(_anchors(length, bits, chunk_bytes), MESSAGE)
    hot_docs = max(hot_docs, size // 8 // MOST_HOT)  # anchors are no denser than one in eight bytes
    met = written(anchors.repartition("kind", "place").sortWithinPartitions("kind", "place").mapInArrow(_met(hot_docs), MESSAGE), "anchors")
    hot = [unpacked(bytes(r["body"]))[0] for r in met.where("kind = 4").select("body").collect()]  # MOST_HOT numbers at most
    hot = np.sort(np.concatenate([np.zeros(0, np.uint64), *hot]))
    told = met.where("kind IN (1, 2)").repartition("place").sortWithinPartitions("place", "kind").mapInArrow(_told, MESSAGE)
    texts = rows.mapInArrow(_zipped, MESSAGE)
    dealt = lambda df: df.repartition("place").sortWithinPartitions("place", "kind", "id", "tk")
    sent = dealt(told.unionAll(texts)).mapInArrow(_sent(length, bits, hot, chunk_bytes), MESSAGE)
    marks = sent.repartition("kind", "place").sortWithinPartitions("kind", "place").mapInArrow(_indexed(length), MESSAGE)
    out = "id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"
    return dealt(marks.unionAll(texts)).mapInArrow(_cut(length), out)
