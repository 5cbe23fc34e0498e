"""The registered queries of this package and their DuckDB SQL.

Each ``opN_`` query is thin: it applies its operator to the whole table and derives the
digest columns of the result from the operator's real output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ecoflux.llm import chat_format, decontaminate, divergence, langid, license_scan, line_dedup, merkle, mixing, quality, simhash, substring_dedup, suffix_dedup, topk
from ecoflux.llm.common import table


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that quotes the template's marks, formatted and read back."""
    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    out = chat_format.read_back(chat_format.format_turns(rows.unionByName(extra)))
    return out.withColumnRenamed("conv", "conv_id")


def held_out(remainder: int, parts: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder (false for a null id)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == remainder, F.lit(False))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text, learned from three quarters of the labels."""
    labels = table(spark, sf_dir, "labels").where(~held_out(2, 4)).select(F.col("doc_id").alias("id"), F.col("quality").alias("y"))
    out = quality.quality(table(spark, sf_dir, "documents"), labels)
    out = out.select(F.col("id").alias("doc_id"), "score")
    return out.select("doc_id", held_out(2, 4).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every whole text, with their exact differences from the template."""
    return license_scan.scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best inner products of every 50th vector among all others."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to weights 1, 2, 3 by source, range-sorted by first position."""
    plan = mixing.schedule(table(spark, sf_dir, "documents"))
    first = F.get("copies", F.lit(0))["position"].alias("position")
    return plan.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", first).orderBy("position", "doc_id")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of 3-word shingles, linked at 3 bits or fewer, closed into components."""
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 20 words that also start earlier are cut out of every text."""
    out = substring_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text, learned from two thirds of the documents."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out(1, 3))
    model = langid.fit(docs.where(~F.col("held_out")).select("doc_id", "text", "lang"))
    return langid.predicted(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 20 characters and more that at least 3 documents hold stay in one of them."""
    out = line_dedup.line_report(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents that lie in a 10-word window of a benchmark item."""
    out = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that a smaller document holds too are cut out of every text."""
    out = suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each source's words differ from those of every other source of its language, and
    the terms by which it differs most from its language."""
    return divergence.audit(table(spark, sf_dir, "documents")).withColumnRenamed("grp", "lang")


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a leaf of the manifest, its proof, and the root that a leaf folds to,
    with one document in seven tampered with."""
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = F.when(tampered, merkle.leaf_digest([more if c == "n_chars" else F.col(c) for c in columns]))
    out = merkle.manifest(table(spark, sf_dir, "documents"), columns=columns, keep={"changed": changed})
    out = out.withColumn("folded", merkle.folded(F.coalesce("changed", "leaf"), F.col("path")))
    proof = F.sha2(F.array_join(merkle.proof_texts(F.col("path")), "").cast("binary"), 256)
    digests = [merkle.as_hex(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")]
    return out.select(
        F.col("id").alias("doc_id"), *digests, proof.alias("proof_sha256"), merkle.as_hex(F.col("folded")).alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_quality": op2_quality,
    "op3_license_scan": op3_license_scan,
    "op4_topk": op4_topk,
    "op5_mix": op5_mix,
    "op6_simhash": op6_simhash,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_language_id": op8_language_id,
    "op9_line_dedup": op9_line_dedup,
    "op10_decontaminate": op10_decontaminate,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_divergence": op12_divergence,
    "op13_merkle": op13_merkle,
}
