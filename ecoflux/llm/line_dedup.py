"""Line dedup with levelled sorted runs of line hashes. DataFrame functions only.

A *run* is a written table (h1, h2, n, last), sorted by hash, one row per line key: in how
many documents the key was seen and the largest id among them. Batches of documents arrive
from the largest ids down. Each new batch is aggregated, anti-joined with the keys that the
runs have already *sealed* (seen in ``min_docs`` documents; their keeper cannot change any
more, as later batches hold smaller ids), and the rest is added as a new run of level 0.
When a level holds ``fanout`` runs they are merged into one run of the next level. The runs
stay exact: n and last of a key are the sum and the maximum over its rows.

Defined cases: a null or empty text is one empty line. A key is hashed to 128 bits (two
64-bit hashes with different seeds). Rows that repeat an id count as one document; rows
without an id count as none and never hold the kept copy. An empty table gives an empty
result. Other columns, whatever their names, pass through ``drop_repeated_lines`` unchanged.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecoflux.llm.common import ASCII_SPACE, ascii_lower, text_key, written

KEYS = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The compared form of a line: ASCII white space stripped at both ends, A-Z lowered."""
    return ascii_lower(F.trim(line, F.lit(ASCII_SPACE)))


def hashed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, tk, pos, h1, h2): one row per line whose key has ``min_chars`` code points."""
    lines = docs.select(
        F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("tk"), F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("pos", "line")
    )
    keyed = lines.select("id", "tk", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    return keyed.select("id", "tk", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"))


class LineRuns:
    """The levelled runs. Feed batches from the largest document ids to the smallest."""

    def __init__(self, min_docs: int = 3, fanout: int = 2):
        self.min_docs, self.fanout = min_docs, fanout
        self.levels: list[list[DataFrame]] = [[]]

    def _all(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    @staticmethod
    def _merge(runs: list[DataFrame]) -> DataFrame:
        if len(runs) == 1:
            return runs[0]
        return reduce(DataFrame.unionAll, runs).groupBy(*KEYS).agg(F.sum("n").alias("n"), F.max("last").alias("last"))

    @staticmethod
    def _write(run: DataFrame) -> DataFrame:
        return written(run.sortWithinPartitions(*KEYS), "line-run")

    def add(self, lines: DataFrame) -> None:
        """Add one batch of ``hashed_lines``."""
        # the distinct count is two-level (key + document first), so a hot line is spread over tasks
        batch = lines.groupBy(*KEYS).agg(F.count_distinct("id").alias("n"), F.max("id").alias("last"))
        if known := self._all():
            sealed = reduce(DataFrame.unionAll, [r.where(F.col("n") >= self.min_docs).select(*KEYS) for r in known])
            batch = batch.join(sealed, KEYS, "left_anti")
        self.levels[0].append(self._write(batch))
        for depth in range(len(self.levels)):
            if len(self.levels[depth]) >= self.fanout:
                merged = self._write(self._merge(self.levels[depth]))
                self.levels[depth] = []
                if depth + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[depth + 1].append(merged)

    def repeated(self) -> DataFrame:
        """(h1, h2, last) of every key seen in at least ``min_docs`` documents."""
        runs = self._all()
        if len(runs) > 1:
            self.levels = [[], [self._write(self._merge(runs))]]
        return self._all()[0].where(F.col("n") >= self.min_docs).select(*KEYS, "last")


def batch_bounds(docs: DataFrame, id_col: str, n_batches: int) -> list[int]:
    """Ids that part the table into about equal batches (a few numbers, from a sketch)."""
    at = [i / n_batches for i in range(1, n_batches)]
    got = docs.select(F.percentile_approx(id_col, at, 1000)).first()[0] if at else None
    return sorted(set(got or []))


def repeated_positions(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3, n_batches: int = 4, fanout: int = 2
) -> DataFrame:
    """(id, tk, drop): the line numbers to drop, for each document that loses a line."""
    bounds = batch_bounds(docs, id_col, n_batches)
    batch = reduce(lambda c, b: c + F.when(F.col("id") > F.lit(b), 1).otherwise(0), bounds, F.lit(0))
    table = hashed_lines(docs, id_col, text_col, min_chars).withColumn("batch", batch)
    lines = written(table, "lines")
    runs = LineRuns(min_docs, fanout)
    for b in range(len(bounds), -1, -1):
        runs.add(lines.where(F.col("batch") == b).drop("batch"))
    hits = lines.join(runs.repeated(), KEYS).where(~F.col("id").eqNullSafe(F.col("last")))
    return hits.groupBy("id", "tk").agg(F.collect_set("pos").alias("drop"))


def _kept(docs: DataFrame, id_col: str, text_col: str, **how) -> DataFrame:
    """(row, n_lines, n_dropped, kept): ``row`` is the untouched input row."""
    drops = repeated_positions(docs, id_col, text_col, **how).withColumnsRenamed({"id": "drop_id", "tk": "drop_tk"})
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("tk")
    )
    joined = base.join(drops, base["id"].eqNullSafe(drops["drop_id"]) & (base["tk"] == drops["drop_tk"]), "left")
    lines = F.split(F.coalesce(F.col(f"row.`{text_col}`"), F.lit("")), "\n", -1)
    parts = joined.select("row", lines.alias("lines"), "drop")
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drop"))
    return parts.select(
        "row",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("drop").isNull(), F.array_join("lines", "\n"))
        .otherwise(F.array_join(F.transform(left, lambda i: F.get(F.col("lines"), i)), "\n"))
        .alias("kept"),
    )


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(id, n_lines, n_dropped, kept): each document with the text that stays."""
    return _kept(docs, id_col, text_col, **how).select(F.col(f"row.`{id_col}`").alias(id_col), "n_lines", "n_dropped", "kept")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_col: str = "n_chars", **how) -> DataFrame:
    """The documents with repeated lines taken out of their texts; the columns stay as they
    were (``count_col``, if there, is set to the new length; a null text stays null)."""
    kept = _kept(docs, id_col, text_col, **how)
    text = F.when(F.col(f"row.`{text_col}`").isNotNull(), F.col("kept"))
    new = {text_col: text}
    if count_col in docs.columns:
        old = F.col(f"row.`{count_col}`")
        new[count_col] = F.when(F.col("n_dropped") == 0, old).otherwise(F.char_length("kept").cast(docs.schema[count_col].dataType))
    return kept.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
