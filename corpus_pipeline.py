"""The corpus pipeline: ``documents`` through the training-data operators, stage by stage.

1. language_id: documents whose language the classifier rejects go (no text, no letter, or a
   calibrated score under its threshold).
2. line_dedup: lines that at least 3 documents hold stay in one document only.
3. near_dedup: of each group of SimHash near-duplicates the smallest id stays.
4. decontamination: documents with a benchmark window go.
5. mixing: the documents in training order, each with the words and the positions that the
   mix takes of it (``copies``; those that it leaves out come last, with 0 taken).

Every stage takes all rows that the one before kept and returns the columns of its input; the
last one adds the columns of the mix.

Defined cases are those of the operators. A null text goes in stage 1. A text that line dedup
empties stays as an empty document until the mix, which takes no word of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ecoflux.llm import decontaminate, langid, line_dedup, mixing, simhash
from ecoflux.llm.common import table, written


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.identified(docs, langid.fit(docs))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontaminate_stage),
    ("mixing", mixing_stage),
]

#: The language model, the fingerprints and the order of the mix are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
