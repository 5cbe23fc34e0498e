"""Benchmark decontamination by winnowing. DataFrame functions only.

Words are runs of a-z, 0-9 and characters beyond ASCII, after A-Z are lowered. Every k-gram
of words is hashed, and in each run of w = span - k + 1 consecutive k-grams the smallest
hash is kept with its position (winnowing). Two texts that share ``span`` words in a row
share the whole run, so they keep a common k-gram: no shared span can be missed. Kept
k-grams of documents and of benchmark items are joined on their hash; at each match the
words themselves are compared and the match is extended to both sides, at most span - k
words, and counts where ``span`` words agree. (Hash collisions thus cannot make a hit.)

On the benchmark side all positions that tie for the minimum are kept, so whichever of equal
k-grams a document keeps, it finds its aligned partner.

Items of fewer than ``span`` words are one window of their own length; for each such length
that occurs in the benchmark, the document n-grams of that length are joined in full.

Defined cases: a null text has no words. Items without words match nothing; items without an
id mark words as hit but are not listed. Repeated item ids are listed once. Rows that repeat
a document id are told apart by their text. Empty tables are fine on both sides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecoflux.llm.common import ASCII_UPPER, text_key, written

#: ASCII characters that no word has (after A-Z are lowered).
NOT_WORD = "".join(c for c in map(chr, range(0x80)) if not c.isalnum())
#: A benchmark with at most so many kept k-grams is broadcast (about 200 bytes each).
BROADCAST_SEEDS = 100_000


def words(text: Column) -> Column:
    """One pass over the characters folds letters and blanks out the rest; splitting at a
    blank is then much cheaper than at a class of characters."""
    clean = F.translate(F.coalesce(text, F.lit("")), ASCII_UPPER + NOT_WORD, ASCII_UPPER.lower() + " " * len(NOT_WORD))
    return F.array_remove(F.split(clean, " ", -1), "")


def _upto(last: Column) -> Column:
    """0..last, or nothing if last < 0."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _gram(w: Column, at: Column, k: int) -> Column:
    return F.xxhash64(*[F.get(w, at + j) for j in range(k)])


def _grams(w: Column, k: int) -> Column:
    return F.transform(_upto(F.size(w) - k), lambda i: _gram(w, i, k))


def _hash(v: Column) -> Column:
    """The hash part of a kept k-gram; its low 3 bits hold the position modulo 8."""
    return v.bitwiseAND(F.lit(~7))


def winnowed(df: DataFrame, keep: list[str], k: int, w: int) -> DataFrame:
    """(keep..., w, p, h): the kept k-grams of the words in column ``w``, p being positions."""
    if not 1 < w <= 8:
        raise ValueError("span - k + 1 must be 2 to 8")
    tagged = F.transform(F.col("g"), lambda h, i: _hash(h).bitwiseOR((i % 8).cast("long")))
    low = F.transform(_upto(F.size("g") - w), lambda i: F.least(*[F.get(F.col("g"), i + j) for j in range(w)]))
    # consecutive windows that keep the same k-gram give it once (w <= 8 positions tell modulo 8)
    new = F.filter(_upto(F.size("m") - 1), lambda i: (i == 0) | (F.get(F.col("m"), i) != F.get(F.col("m"), i - 1)))
    out = df.select(*keep, "w", _grams(F.col("w"), k).alias("g")).select(*keep, "w", tagged.alias("g")).select(*keep, "w", low.alias("m"))
    out = out.select(*keep, "w", "m", F.explode(new).alias("i")).select(*keep, "w", "i", F.get("m", F.col("i")).alias("v"))
    return out.select(*keep, "w", (F.col("i") + F.pmod(F.col("v").bitwiseAND(F.lit(7)) - F.col("i"), F.lit(8)).cast("int")).alias("p"), _hash(F.col("v")).alias("h"))


def all_grams(df: DataFrame, keep: list[str], k: int) -> DataFrame:
    """(keep..., w, p, h): every k-gram."""
    return df.select(*keep, "w", F.posexplode(_grams(F.col("w"), k)).alias("p", "v")).select(*keep, "w", "p", _hash(F.col("v")).alias("h"))


def _around(w: Column, p: Column, k: int, reach: int) -> list[Column]:
    """The words before p (nearest first), the k words at p, the words after them."""
    before = F.transform(F.sequence(F.lit(1), F.lit(reach)), lambda j: F.get(w, p - j)) if reach else F.array().cast("array<string>")
    after = F.transform(F.sequence(F.lit(0), F.lit(reach - 1)), lambda j: F.get(w, p + k + j)) if reach else F.array().cast("array<string>")
    return [before.alias("before"), F.slice(w, p + 1, k).alias("mid"), after.alias("after")]


def _agree(a: Column, b: Column, reach: int) -> Column:
    """How many leading words of two lists agree (missing words agree with nothing)."""
    same = F.transform(F.sequence(F.lit(0), F.lit(reach)), lambda j: F.coalesce(F.get(a, j) == F.get(b, j), F.lit(False)))
    return F.array_position(same, False) - 1


def _seeds(items: DataFrame, k: int, span: int) -> DataFrame:
    """(item, h, item_before, item_mid, item_after) of the items with ``span`` words and more."""
    w = span - k + 1
    grams = items.where(F.size("w") >= span).select("item", "w", _grams(F.col("w"), k).alias("g"))
    run = grams.select("item", "w", "g", F.explode(_upto(F.size("g") - w)).alias("i"))
    run = run.select("item", "w", "g", "i", F.least(*[_hash(F.get("g", F.col("i") + j)) for j in range(w)]).alias("h"))
    tied = run.select("item", "w", "g", "i", "h", F.explode(F.sequence(F.lit(0), F.lit(w - 1))).alias("j"))
    at = tied.where(_hash(F.get("g", F.col("i") + F.col("j"))) == F.col("h")).select("item", "w", (F.col("i") + F.col("j")).alias("p"), "h")
    return _as_seeds(at, k, span - k)


def _as_seeds(at: DataFrame, k: int, reach: int) -> DataFrame:
    return at.select("item", "h", *_around(F.col("w"), F.col("p"), k, reach)).distinct().withColumnsRenamed(
        {"before": "item_before", "mid": "item_mid", "after": "item_after"}
    )


def _extended(docs: DataFrame, grams: DataFrame, seeds: DataFrame, k: int, reach: int, need: int, broadcast_seeds: int) -> DataFrame:
    """(id, tk, lo, hi, item): stretches of words [lo, hi) that a benchmark window covers."""
    key = ["id", "tk"]
    if seeds.limit(broadcast_seeds + 1).count() <= broadcast_seeds:
        met = grams.join(F.broadcast(seeds), "h").select(*key, "p", "item", "item_before", "item_mid", "item_after", *_around(F.col("w"), F.col("p"), k, reach))
    else:
        # too large to broadcast: join hashes and positions only, then fetch the words of the documents met
        at = grams.select(*key, "p", "h").join(seeds, "h").drop("h")
        own = docs.withColumnsRenamed({"id": "own_id", "tk": "own_tk"}).dropDuplicates(["own_id", "own_tk"])
        met = at.join(own, at["id"].eqNullSafe(own["own_id"]) & (at["tk"] == own["own_tk"])).select(
            *key, "p", "item", "item_before", "item_mid", "item_after", *_around(F.col("w"), F.col("p"), k, reach)
        )
    sized = met.where(F.col("mid") == F.col("item_mid")).select(
        *key, "p", "item", _agree(F.col("before"), F.col("item_before"), reach).alias("l"), _agree(F.col("after"), F.col("item_after"), reach).alias("r")
    )
    return sized.where(F.col("l") + F.col("r") + k >= need).select(
        *key, (F.col("p") - F.col("l")).alias("lo"), (F.col("p") + k + F.col("r")).alias("hi"), "item"
    )


def hits(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    span: int = 10,
    k: int = 5,
    broadcast_seeds: int = BROADCAST_SEEDS,
) -> DataFrame:
    """(id, tk, n_hit, items): the documents with a benchmark window, how many of their words
    lie in one, and the ids of those items as sorted strings."""
    items = written(benchmark.select(F.col(item_col).cast("string").alias("item"), words(F.col(item_text_col)).alias("w")).where(F.size("w") > 0), "items")
    own = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("tk"), words(F.col(text_col)).alias("w"))
    long = _seeds(items, k, span)
    found = [_extended(own, winnowed(own, ["id", "tk"], k, span - k + 1), written(long, "seeds"), k, span - k, span, broadcast_seeds)]
    for (m,) in items.select(F.size("w")).where(F.size("w") < span).distinct().collect():  # at most span - 1 lengths
        short = all_grams(items.where(F.size("w") == m).select("item", "w"), ["item"], m)
        found.append(_extended(own, all_grams(own, ["id", "tk"], m), _as_seeds(short, m, 0), m, 0, m, broadcast_seeds))
    stretches = reduce(DataFrame.unionAll, found).groupBy("id", "tk").agg(
        F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias("spans"), F.array_sort(F.collect_set("item")).alias("items")
    )
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    covered = F.aggregate(
        "spans",
        start,
        lambda a, x: F.struct(
            (a["n"] + F.greatest(F.lit(0), x["hi"] - F.greatest(x["lo"], a["end"]))).cast("long").alias("n"),
            F.greatest(a["end"], x["hi"]).cast("long").alias("end"),
        ),
        lambda a: a["n"],
    )
    return stretches.select("id", "tk", covered.alias("n_hit"), "items")


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(id, n_words, n_hit, items) for every document."""
    found = hits(docs, benchmark, id_col, text_col, **how).withColumnsRenamed({"id": "hit_id", "tk": "hit_tk"})
    own = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("tk"), F.size(words(F.col(text_col))).cast("long").alias("n_words"))
    joined = own.join(found, own["id"].eqNullSafe(found["hit_id"]) & (own["tk"] == found["hit_tk"]), "left")
    none = F.array().cast("array<string>")
    return joined.select(F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The documents without any hit, with their columns."""
    found = hits(docs, benchmark, id_col, text_col, **how).select(F.struct("id", "tk").alias("hit"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    base = docs.select(row, F.struct(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("tk")).alias("own"))
    return base.join(found, F.col("own").eqNullSafe(F.col("hit")), "left_anti").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
