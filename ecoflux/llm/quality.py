"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

1. Each whole text becomes a vector of document statistics (``STATISTICS``).
2. Statistics are standardised and mapped to ``n_features`` random Fourier features,
   sqrt(2 / D) cos(Wx + b), whose inner products approximate a Gaussian kernel.
3. Every partition sums its rows into normal equations, one set for each of ``FOLDS`` folds
   (a hash of the id); the sums are added up in two steps and only a fixed number of
   matrices reaches the driver. Subtracting a fold's sums gives the model that has not seen
   it, so the ridge strength is chosen by exact cross-validation without another pass.
4. The out-of-fold scores of the training rows, counted in narrow bins by Spark, are made
   monotone by pooling adjacent violators; the final score interpolates that curve.

All labelled rows are used; nothing is sampled.

Defined cases: a null text is an empty one; an empty text has a score like any other. Rows
without an id are scored but not learned from. A document with several labels counts with
their mean. Without labels every score is 0.5. Other columns are not touched.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecoflux.llm.common import text_bytes, written

FOLDS = 3
RIDGES = (1e-5, 1e-4, 1e-3, 1e-2, 1e-1)
BINS = 2000
SUM_TASKS = 8

STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "word_bytes_spread", "upper", "digits", "symbols", "bars", "marks", "odd_marks",
    "beyond_ascii", "byte_entropy", "vocabulary", "top_word", "same_word_again", "bigram_variety", "log_line_bytes", "line_repeats", "lines_with_stop", "stops_per_word", "short_words",
)

_KIND = np.zeros((256, 6))
_KIND[0x41:0x5B, 0] = 1  # upper
_KIND[0x30:0x3A, 1] = 1  # digits
for _c in b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~":
    _KIND[_c, 2] = 1  # symbols
_KIND[ord("|"), 3] = 1
_KIND[ord("!"), 4] = 1
for _c in b"#$%&*=<>":
    _KIND[_c, 5] = 1
KINDS = _KIND


def statistics(text: bytes) -> np.ndarray:
    """The ``STATISTICS`` of one text. Shares are of bytes, words or lines; all are finite."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n = max(len(text), 1)
    words = text.split()
    m = max(len(words), 1)
    size = np.fromiter(map(len, words), np.int32, len(words)) if words else np.zeros(1)
    often = Counter(words)
    pairs = max(len(words) - 1, 1)
    lines = [x for x in text.split(b"\n") if x.strip()]
    k = max(len(lines), 1)
    p = counts[counts > 0] / n
    upper, digits, symbols, bars, marks, odd = counts @ KINDS / n
    return np.array([
        np.log1p(len(text)), np.log1p(len(words)), min(size.mean(), 100.0), min(size.std(), 100.0), upper, digits, symbols, bars, marks, odd,
        counts[0x80:].sum() / n, -(p * np.log2(p)).sum(), np.log1p(len(often)) / np.log1p(m), max(often.values(), default=0) / m,
        sum(map(bytes.__eq__, words, words[1:])) / pairs, len(set(zip(words, words[1:]))) / pairs,
        np.log1p(n / k), 1 - len(set(lines)) / k, sum(x.rstrip().endswith(b".") for x in lines) / k,
        text.count(b".") / m, float((size <= 3).mean()),
    ])


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x) for each row: the statistics of its whole text."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [statistics(t).astype(np.float32) for t in text_bytes(b.column(1))]
            flat = pa.array(np.concatenate(x) if x else np.zeros(0, np.float32))
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(STATISTICS))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(ends, flat)], ["id", "x"])

    return rows.mapInArrow(run, "id long, x array<float>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


@dataclass
class Kernel:
    """Standardisation and the random features."""

    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    b: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        f = np.sqrt(2 / len(self.b)) * np.cos(z @ self.w + self.b)
        return np.hstack([f, np.ones((len(x), 1))])


@dataclass
class Model:
    kernel: Kernel
    weights: np.ndarray
    at: np.ndarray  # raw scores, rising
    value: np.ndarray  # calibrated scores at them

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.kernel.features(x) @ self.weights, self.at, self.value)


def _normal_equations(train: DataFrame, kernel: Kernel) -> list[tuple[np.ndarray, np.ndarray, float, float]]:
    """(Z'Z, Z'y, y'y, n) for each fold, from the rows (x, y, fold)."""
    d = len(kernel.b) + 1

    def packed(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
        folds = sorted(sums)
        return pa.RecordBatch.from_arrays([pa.array(folds, pa.int32()), pa.array([sums[f].tobytes() for f in folds], pa.binary())], ["fold", "body"])

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            z, y, fold = kernel.features(_matrix(b.column(0))), b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)
            for f in np.unique(fold).tolist():
                a = np.column_stack([z[fold == f], y[fold == f]])  # with y as a last column one product has all sums
                got = np.zeros((d + 1, d + 2))
                got[:, :-1], got[0, -1] = a.T @ a, len(a)
                sums[f] = sums[f] + got if f in sums else got
        yield packed(sums)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for f, body in zip(b.column(0).to_pylist(), b.column(1)):
                got = np.frombuffer(body.as_py())
                sums[f] = sums[f] + got if f in sums else got
        yield packed(sums)

    schema = "fold int, body binary"
    some = train.select("x", "y", "fold").mapInArrow(partition, schema).repartition(SUM_TASKS).mapInArrow(added, schema).collect()
    out = []
    for f in range(FOLDS):
        got = sum((np.frombuffer(r["body"]).reshape(d + 1, d + 2) for r in some if r["fold"] == f), np.zeros((d + 1, d + 2)))
        out.append((got[:d, :d], got[:d, d], float(got[d, d]), float(got[0, -1])))
    return out


def _ridge(a: np.ndarray, b: np.ndarray, n: float, strength: float) -> np.ndarray:
    penalty = np.full(len(b), strength * max(n, 1))
    penalty[-1] = 1e-9 * max(n, 1)  # the constant is free
    return np.linalg.solve(a + np.diag(penalty), b)


def pooled(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic fit by pooling adjacent violators: (mean x, level) of each block."""
    blocks: list[list[float]] = []
    for xi, yi, ni in zip(x.tolist(), y.tolist(), n.tolist()):
        blocks.append([xi * ni, yi * ni, ni])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def fit(rows: DataFrame, labels: DataFrame, n_features: int = 192, width: float = 4.0, seed: int = 2) -> Model | None:
    """Learn from (id, x) and labels (id, y); None if no row has a label."""
    means = labels.where(F.col("y").isNotNull() & F.col("id").isNotNull()).groupBy("id").agg(F.avg(F.col("y").cast("double")).alias("y"))
    fold = F.pmod(F.xxhash64(F.lit("fold"), F.col("id")), F.lit(FOLDS)).cast("int")
    train = written(rows.join(means, "id").select("x", "y", fold.alias("fold")), "labelled")
    cells = train.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("spread")).orderBy("at").collect()
    if not cells:
        return None
    rng = np.random.default_rng(seed)
    k = len(cells)
    scale = np.array([c["spread"] if c["spread"] > 1e-9 else 1.0 for c in cells])
    kernel = Kernel(np.array([c["mean"] for c in cells]), scale, rng.normal(0, 1 / width, (k, n_features)), rng.uniform(0, 2 * np.pi, n_features))
    folds = _normal_equations(train, kernel)
    whole = [sum(f[i] for f in folds) for i in range(4)]
    loss = []
    for strength in RIDGES:
        err = 0.0
        for a, b, yy, n in folds:
            w = _ridge(whole[0] - a, whole[1] - b, whole[3] - n, strength)
            err += yy - 2 * w @ b + w @ a @ w
        loss.append(err)
    strength = RIDGES[int(np.argmin(loss))]
    apart = np.array([_ridge(whole[0] - a, whole[1] - b, whole[3] - n, strength) for a, b, _, n in folds])

    def unseen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fold = b.column(2).to_numpy(zero_copy_only=False)
            raw = (kernel.features(_matrix(b.column(0))) * apart[fold]).sum(1) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([pa.array(raw), b.column(1)], ["raw", "y"])

    raw = train.select("x", "y", "fold").mapInArrow(unseen, "raw double, y double")
    binned = raw.groupBy(F.floor(F.least(F.greatest("raw", F.lit(-0.5)), F.lit(1.5)) * (BINS / 2)).alias("bin"))
    curve = binned.agg(F.avg("raw").alias("raw"), F.avg("y").alias("y"), F.count("*").alias("n")).orderBy("bin").collect()  # at most BINS + 1 rows
    at, value = pooled(*(np.array([float(c[name]) for c in curve]) for name in ("raw", "y", "n")))
    return Model(kernel, _ridge(whole[0], whole[1], whole[3], strength), at, value)


def scored(rows: DataFrame, model: Model | None) -> DataFrame:
    """(id, score) from (id, x)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = model.score(_matrix(b.column(1))) if model and b.num_rows else np.full(b.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.clip(score, 0, 1))], ["id", "score"])

    return rows.select("id", "x").mapInArrow(run, "id long, score double")


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(id, score) of every document, learned from ``labels`` (id, y)."""
    rows = written(with_statistics(docs, id_col, text_col), "statistics")
    return scored(rows, fit(rows, labels, **how))
