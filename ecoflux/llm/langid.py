"""Language identification: averaged hashed subword embeddings with a linear softmax.

Subwords are the byte n-grams (``GRAMS``) of the text, letters lowered and every other ASCII
byte a blank; they are hashed into ``BUCKETS`` rows of an embedding table. A document is the
mean of its subwords' embeddings, and a softmax over a linear map of it gives the languages.

Training takes every labelled document twice, and no sample of them (languages are the
``max_langs`` most frequent). First, tasks add up how often each language has each bucket, each
text counting alike; the table and the map start as the main axes of the log ratios of these
shares to those of all languages (what more than ``DIM`` languages have beside them is added to
the scores and not trained). Then stochastic gradient descent in numpy: each task goes once
through all of its documents, and the model is the mean of what the tasks have made of the start,
weighed by their documents. Tasks send whole numbers, so that sums do not depend on their order.

Calibration takes every labelled document too. Documents are dealt to two folds, each of which has
counts, a start and a model of its own beside those of all documents, and the model of one fold
scores the other's, so none is scored by what it was learned into. The softmax temperature is the
one of least log loss. A histogram of the scores of those predicted rightly, for each class of
variety (how many different subwords a text has: a sure model is surer of a text that has many, so
a text in an unknown language shows), gives the rejection: a class's threshold is the highest at
which, with 95 % confidence, no more than ``cost`` of its rightly predicted documents score lower.
Where the documents are too few to tell (under 3 / cost in a class), only texts without letters
are rejected.

Since all is linear up to the softmax, table and map are multiplied into one row of scores per
bucket, and every whole text of any length is scored in blocks of bytes in Spark tasks.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and rejected, and
is not learned from; so are rows without a label or id. With nothing to learn from every text
is ``und``. Ties go to the language that sorts first. Columns of other names pass through
``predicted`` unchanged; columns with the names of its results are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ecoflux.llm.common import utf8, written

BUCKETS = 1 << 15
GRAMS = (2, 3, 4)
DIM = 16
#: Bytes of text that are split into subwords at once.
BLOCK = 1 << 16
#: Texts that are counted at once: a text's number and a bucket share 32 bits.
ROWS = 1 << 16
#: Texts of a batch that a training task takes out of its order at once.
TAKEN = 256
UNKNOWN = "und"
#: Bins of scores from 0 to 1, for the threshold of rejection.
SCORE_BINS = 4096
#: Different subwords are counted among one bucket in so many, and these counts part the classes of variety.
VARIETY_SHARE = 16
VARIETY = (4, 16, 64)
#: The softmax temperatures to choose from.
TEMPERATURES = np.geomspace(0.1, 10, 41)
#: Documents are dealt to so many folds; each is scored by a model that has not learned from it.
FOLDS = 2
#: Tasks send what they have learned in pieces of so many numbers, in whole units of 1 / ``UNITS``.
PIECE = 1 << 13
UNITS = 1 << 22
#: What a text is shared out in when subwords are counted (sums of 2 ** 31 texts fit 64 bits).
TEXT_UNITS = 1 << 32
#: So many languages of a fold are counted at once, and a task holds twice as many at most.
COUNTED = 32
#: The length of the map's rows and the scale of the logits in the start.
START_OUT, START_LOGITS = 8.0, 4.0

_FOLD = bytes(c if c >= 0x80 or 0x61 <= c < 0x7B else c + 0x20 if 0x41 <= c < 0x5B else 0x20 for c in range(256))
_SHIFT = BUCKETS.bit_length() - 1


def subwords(raw: np.ndarray, off: np.ndarray) -> Iterator[np.ndarray]:
    """document number * ``BUCKETS`` + bucket of the subwords of at most ``ROWS`` texts, block by
    block of bytes."""
    for at in range(0, int(off[-1]), BLOCK):
        end = min(at + BLOCK, int(off[-1]))
        seg = np.frombuffer(raw[at : end + max(GRAMS) - 1].tobytes().translate(_FOLD), np.uint8)
        n = end - at
        lo, hi = np.searchsorted(off, at, "right") - 1, np.searchsorted(off, end, "left")
        size = np.diff(np.clip(off[lo : hi + 1], at, end))
        doc = np.repeat(np.arange(lo, hi, dtype=np.uint32) << np.uint32(_SHIFT), size)
        room = np.repeat(np.minimum(off[lo + 1 : hi + 1] - at, n + max(GRAMS)).astype(np.int32), size) - np.arange(n, dtype=np.int32)
        code, seen = seg[:n].astype(np.uint32), seg[:n] != 0x20
        for k in range(1, max(GRAMS)):
            m = min(n, max(len(seg) - k, 0))
            code[:m] |= seg[k : k + m].astype(np.uint32) << np.uint32(8 * k)
            seen[:m] |= seg[k : k + m] != 0x20
            if k + 1 in GRAMS:
                key = code * np.uint32(2654435761)
                key += np.uint32(k * 0x3C6EF372)
                key >>= np.uint32(32 - _SHIFT)
                key |= doc
                yield key[seen & (room > k)]


def tallies(raw: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document number, bucket, subwords in it) of each bucket that a text has, in order; no
    text is parted, and a long one comes alone."""
    lo = 0
    while lo < len(off) - 1:
        hi = max(lo + 1, min(lo + ROWS, int(np.searchsorted(off, off[lo] + BLOCK, "right")) - 1))
        own = raw[off[lo] : off[hi]]
        if len(own) > BLOCK:
            bucket, count = _counts(own)
            yield np.full(len(bucket), lo), bucket, count
        elif len(own):
            key = np.sort(np.concatenate([*subwords(own, off[lo : hi + 1] - off[lo])]))
            first = np.flatnonzero(np.concatenate((key[:1] == key[:1], key[1:] != key[:-1])))
            count, key = np.diff(first, append=len(key)), key[first].astype(np.int64)
            yield lo + (key >> _SHIFT), key & (BUCKETS - 1), count
        lo = hi


@dataclass
class Model:
    langs: list[str]
    scores: np.ndarray = field(repr=False)  # BUCKETS x languages
    bias: np.ndarray = field(repr=False)
    temperature: float = 1.0
    thresholds: list[float] = field(default_factory=lambda: [0.0] * (len(VARIETY) + 1))

    def read(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The logits and the class of variety of each text."""
        total = np.zeros((len(off) - 1, len(self.langs)))
        columns = np.ascontiguousarray(self.scores.T, np.float64)
        count, different = np.zeros(len(off) - 1), np.zeros(len(off) - 1, np.int64)
        for doc, bucket, times in tallies(raw, off):
            if len(doc):
                start = np.flatnonzero(np.diff(doc, prepend=-1))
                own = doc[start]
                for i, column in enumerate(columns):  # the buckets of some texts times one language
                    total[own, i] = np.add.reduceat(column.take(bucket) * times, start)
                count[own] = np.add.reduceat(times, start)
                different[own] = np.add.reduceat((bucket & (VARIETY_SHARE - 1) == 0).astype(np.int64), start)
        return total / np.maximum(count, 1)[:, None] + self.bias, np.searchsorted(VARIETY, different, "right")

    def logits(self, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        return self.read(raw, off)[0]

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        return _rows_softmax(logits / self.temperature)


def _rows_softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _labelled(docs: DataFrame, id_col: str, text_col: str, lang_col: str, max_langs: int) -> tuple[DataFrame, list[str]]:
    """(lang, text, fold) of the rows to learn from, and the languages."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & has_letter(F.col(text_col)))
    lang = F.col(lang_col).cast("string")
    # one count for each language of the model; texts are not dealt out by language
    sizes = rows.groupBy(lang.alias("lang")).count().orderBy(F.desc("count"), "lang").limit(max_langs).collect()
    langs = sorted(r["lang"] for r in sizes)
    fold = F.pmod(F.xxhash64(F.lit("fold"), F.col(id_col)), F.lit(FOLDS)).cast("int")
    return rows.select(lang.alias("lang"), F.col(text_col).alias("text"), fold.alias("fold")).where(F.col("lang").isin(langs)), langs


def _counts(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text's subwords and how many subwords each has."""
    count = np.zeros(BUCKETS, np.int64)
    for bucket in subwords(raw, np.array([0, len(raw)])):
        count += np.bincount(bucket, minlength=BUCKETS)
    bucket = np.flatnonzero(count)
    return bucket, count[bucket]


_PIECES = "part int, at int, n long, numbers binary"


def _pieces(part: int, n: int, numbers: np.ndarray) -> pa.RecordBatch:
    pieces = [numbers[at : at + PIECE].tobytes() for at in range(0, len(numbers), PIECE)]
    k = len(pieces)
    return pa.RecordBatch.from_arrays([pa.array([part] * k, pa.int32()), pa.array(range(k), pa.int32()), pa.array([n] * k, pa.int64()), pa.array(pieces, pa.binary())], ["part", "at", "n", "numbers"])


def _added(pieces: DataFrame, kind: type) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(part, first number, n, numbers) of each piece: the sum of its rows, times their n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], tuple[int, np.ndarray]] = {}
        for b in batches:
            for i, (part, at, n) in enumerate(zip(*(c.to_pylist() for c in b.columns[:3]))):
                was = total.get((part, at), (0, 0))
                total[part, at] = was[0] + n, was[1] + np.frombuffer(b.column(3)[i].as_buffer(), kind).astype(np.int64) * n
        for (part, at), (n, numbers) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([at], pa.int32()), pa.array([n], pa.int64()), pa.array([numbers.tobytes()], pa.binary())], ["part", "at", "n", "numbers"])

    for r in pieces.repartition("part", "at").mapInArrow(run, _PIECES).toLocalIterator():
        yield r["part"], r["at"] * PIECE, r["n"], np.frombuffer(r["numbers"], np.int64)


def _shares(rows: DataFrame, number: dict[str, int]) -> np.ndarray:
    """What each bucket has of the texts of each language, for each fold, over all rows: a text
    counts 1 at most (the less the more blanks it has), however long it is."""
    n_langs = len(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            part = np.array([number[x] for x in b.column(0).to_pylist()], np.int64) + n_langs * b.column(2).to_numpy()
            parts, nth = np.unique(part, return_inverse=True)
            for first in range(0, len(parts), COUNTED):
                some = np.flatnonzero((nth >= first) & (nth < first + COUNTED))
                raw, off = utf8(b.column(1).take(pa.array(some)))
                unit = np.maximum(TEXT_UNITS // (len(GRAMS) * np.maximum(np.diff(off), 1)), 1)
                total = np.zeros((min(COUNTED, len(parts) - first), BUCKETS), np.int64)
                cell = (nth[some] - first) * BUCKETS
                for doc, bucket, times in tallies(raw, off):
                    np.add.at(total.reshape(-1), cell[doc] + bucket, unit[doc] * times)
                for p, own in zip(parts[first : first + COUNTED].tolist(), total):
                    held[p] = held[p] + own if p in held else own
                if len(held) > COUNTED:
                    yield from (_pieces(p, 1, own) for p, own in held.items())
                    held = {}
        yield from (_pieces(p, 1, own) for p, own in held.items())

    out = np.zeros((FOLDS * n_langs, BUCKETS), np.float32)
    for part, at, _, numbers in _added(rows.select("lang", "text", "fold").mapInArrow(run, _PIECES), np.int64):  # the size of the model, for each fold
        out[part, at : at + len(numbers)] = numbers / TEXT_UNITS
    return out.reshape(FOLDS, n_langs, BUCKETS)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max())
    return z / z.sum()


@dataclass
class Weights:
    """The embedding table, the map and the bias, and a step of their training."""

    table: np.ndarray = field(repr=False)  # BUCKETS x axes (``DIM`` at most)
    out: np.ndarray = field(repr=False)  # axes x languages
    bias: np.ndarray = field(repr=False)
    rest: np.ndarray | None = field(repr=False, default=None)  # BUCKETS x languages: added to the scores

    def step(self, bucket: np.ndarray, share: np.ndarray, right: int, rate: float) -> None:
        own = self.table.take(bucket, axis=0)
        mean = share @ own
        logits = mean @ self.out + self.bias
        wrong = _softmax(logits if self.rest is None else logits + share.astype(np.float32) @ self.rest[bucket])
        wrong[right] -= 1
        back = self.out @ wrong
        self.out -= rate * np.outer(mean, wrong)
        self.bias -= 0.01 * rate * wrong
        own -= (rate * share)[:, None] @ back[None]  # by BLAS: far faster than a product with so short rows
        row = np.dtype((np.void, own.itemsize * own.shape[1]))
        self.table.view(row)[bucket] = own.view(row)  # rows are copied whole

    def flat(self) -> np.ndarray:
        return np.concatenate((self.table.ravel(), self.out.ravel(), self.bias))

    def shaped(self, flat: np.ndarray) -> Weights:
        table, out, bias = np.split(flat, np.cumsum((self.table.size, self.out.size)))
        return Weights(table.reshape(self.table.shape), out.reshape(self.out.shape), bias, self.rest)

    def model(self, langs: list[str]) -> Model:
        scores = (self.table @ self.out).astype(np.float32)
        return Model(langs, scores if self.rest is None else scores + self.rest, self.bias)


def _start(shares: np.ndarray) -> Weights:
    """The main axes of the languages' log ratios (with one more text that is as all languages
    are). ``DIM`` axes at most, and no more than languages: further ones could not change a score."""
    dim = min(DIM, len(shares))
    w = Weights(np.zeros((BUCKETS, dim)), np.zeros((dim, len(shares))), np.zeros(len(shares)))
    every = shares.sum(0)
    seen = every > 0
    if seen.any():
        every = every[seen] / every.sum()
        ratio = np.log((shares[:, seen] + every) / (shares.sum(1)[:, None] + 1) / every)
        ratio -= ratio.mean(0)
        axes = np.linalg.eigh((ratio * every) @ ratio.T)[1][:, ::-1][:, :dim]
        w.table[seen] = ratio.T @ axes * (START_LOGITS / START_OUT)
        w.out[:] = axes.T * START_OUT
        if dim < len(shares):
            w.rest = np.zeros((BUCKETS, len(shares)), np.float32)
            w.rest[seen] = START_LOGITS * (ratio.T - ratio.T @ axes @ axes.T)
    return w


def _learned(rows: DataFrame, starts: list[Weights], number: dict[str, int], rate: float, slow: int, seed: int) -> list[Weights]:
    """The weights that each fold's rows, and last all rows, make of their start. A task goes
    through all of its rows once; its change counts by the number of its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(seed)
        own, seen = [w.shaped(w.flat()) for w in starts], [0] * len(starts)
        for b in batches:
            lang, fold = b.column(0).to_pylist(), b.column(2).to_pylist()
            order = rng.permutation(b.num_rows)  # tables are often sorted
            for at in range(0, len(order), TAKEN):
                some = order[at : at + TAKEN]
                for doc, bucket, times in tallies(*utf8(b.column(1).take(pa.array(some)))):
                    start = np.flatnonzero(np.diff(doc, prepend=-1))
                    for i, of, to in zip(some[doc[start]].tolist(), start.tolist(), [*start[1:].tolist(), len(doc)]):
                        share = times[of:to] / times[of:to].sum()
                        for part in (fold[i], FOLDS):
                            own[part].step(bucket[of:to], share, number[lang[i]], rate / (1 + seen[part] / slow))
                            seen[part] += 1
        for part, start in enumerate(starts):
            if seen[part]:
                yield _pieces(part, seen[part], np.rint((own[part].flat() - start.flat()) * UNITS).astype(np.int32))

    flat = [w.flat() for w in starts]
    for part, at, n, numbers in _added(rows.select("lang", "text", "fold").mapInArrow(run, _PIECES), np.int32):  # the size of the weights, for each of them
        flat[part][at : at + len(numbers)] += numbers / n / UNITS
    return [w.shaped(f) for w, f in zip(starts, flat)]


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows_per_lang: int = 400,
    rate: float = 0.5,
    seed: int = 8,
    max_langs: int = 512,
    cost: float = 0.001,
) -> Model:
    """Train and calibrate on all labelled documents. A task's steps are half as long after
    ``rows_per_lang`` documents for each language."""
    rows, langs = _labelled(docs, id_col, text_col, lang_col, max_langs)
    number = {x: i for i, x in enumerate(langs)}
    if not langs:
        return _start(np.zeros((0, BUCKETS))).model(langs)
    shares = _shares(rows, number)
    starts = [_start(s) for s in (*shares, shares.sum(0))]
    # small steps: each task sees few rows, and the mean must stay near what all of them want
    *folds, whole = _learned(rows, starts, number, rate, rows_per_lang * len(langs), seed)
    model = whole.model(langs)
    others = [w.model(langs) for w in reversed(folds)]  # by fold, the model of the other one
    model.temperature, histograms = _histograms(rows, others)
    model.thresholds = [_threshold(h, cost) for h in histograms]
    return model


def _histograms(rows: DataFrame, models: list[Model]) -> tuple[float, np.ndarray]:
    """The temperature of least log loss over all rows of (lang, text, fold, ...), each scored by
    its fold's entry in ``models``, and how many rightly predicted ones then score in each of
    ``SCORE_BINS`` bins, for each class of variety."""
    cells = (len(VARIETY) + 1) * SCORE_BINS
    number = {x: i for i, x in enumerate(models[0].langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, loss = np.zeros((len(TEMPERATURES), cells), np.int64), np.zeros(len(TEMPERATURES), np.int64)
        for b in batches:
            folds = b.column(2).to_numpy()
            for f, model in enumerate(models):
                if not len(own := np.flatnonzero(folds == f)):
                    continue
                right = np.array([number.get(x, -1) for x in b.column(0).take(pa.array(own)).to_pylist()])
                logits, variety = model.read(*utf8(b.column(1).take(pa.array(own))))
                logits, variety, right = logits[right >= 0], variety[right >= 0], right[right >= 0]
                good = logits.argmax(1) == right
                for t, temperature in enumerate(TEMPERATURES):
                    p = _rows_softmax(logits / temperature)
                    score = np.minimum((p.max(1)[good] * SCORE_BINS).astype(np.int64), SCORE_BINS - 1)
                    counts[t] += np.bincount(variety[good] * SCORE_BINS + score, minlength=cells)
                    # in whole numbers, so that the sum does not depend on the order of the rows
                    loss[t] += np.rint(-np.log(np.maximum(p[np.arange(len(p)), right], 1e-12)) * (1 << 20)).astype(np.int64).sum()
        t, cell = np.nonzero(counts)
        every = np.arange(len(TEMPERATURES))
        columns = [np.concatenate((every, t)), np.concatenate((every * 0 - 1, cell)), np.concatenate((loss, counts[t, cell]))]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.int64()))], ["t", "cell", "n"])

    found = rows.select("lang", "text", "fold").mapInArrow(run, "t int, cell int, n long").groupBy("t", "cell").agg(F.sum("n").alias("n"))
    found = written(found, "langid-scores")
    losses = {r["t"]: r["n"] for r in found.where("cell < 0").collect()}  # one for each temperature
    best = min(losses, key=lambda t: (losses[t], t)) if any(losses.values()) else int(np.abs(np.log(TEMPERATURES)).argmin())
    out = np.zeros(cells, np.int64)
    for r in found.where((F.col("cell") >= 0) & (F.col("t") == best)).collect():  # ``cells`` rows at most
        out[r["cell"]] = r["n"]
    return float(TEMPERATURES[best]), out.reshape(-1, SCORE_BINS)


def _threshold(histogram: np.ndarray, cost: float, doubt: float = 0.05) -> float:
    """The highest bin edge under which so few rows lie that, at this confidence, no more than
    a share ``cost`` of all rows score lower; 0 if the rows are too few to tell."""
    n = int(histogram.sum())
    few, chance, term = -1, 0.0, n * math.log1p(-cost)
    while (chance := chance + math.exp(term)) <= doubt and few + 1 < n:  # chance of at most few + 1 of n
        few += 1
        term += math.log((n - few) / (few + 1)) + math.log(cost / (1 - cost))
    below = np.cumsum(histogram)
    return float(np.searchsorted(below, few, "right")) / len(histogram) if few >= 0 else 0.0


def predicted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents with lang_pred, score and rejected."""
    new = ["lang_pred", "score", "rejected"]
    rows = docs.drop(*new).withColumn("rejected", has_letter(F.col(text_col)))
    at = [c.lower() for c in rows.columns].index(text_col.lower())
    schema = T.StructType(rows.schema.fields[:-1] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            letter = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool)
            lang, score, least = np.full(b.num_rows, UNKNOWN, object), np.zeros(b.num_rows), 0.0
            if model.langs and b.num_rows:
                logits, variety = model.read(*utf8(b.column(at)))
                p = model.probabilities(logits)
                best = p.argmax(1)
                lang = np.where(letter, np.array(model.langs, object)[best], UNKNOWN)
                score = np.where(letter, p.max(1), 0.0)
                least = np.array(model.thresholds)[variety]
            rejected = ~letter | (score < least) | (not model.langs)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)], schema.names)

    return rows.mapInArrow(run, schema)


def identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents that the model does not reject, with their columns."""
    aside = {c: f"own column {n}" for n, c in enumerate(docs.columns) if c.lower() in ("lang_pred", "score", "rejected")}
    kept = predicted(docs.withColumnsRenamed(aside), model, text_col).where(~F.col("rejected"))
    return kept.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])
