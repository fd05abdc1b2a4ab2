"""The corpus pipeline: documents are judged, told apart by language, deduplicated, cleaned of
benchmark passages and encoded, each stage on what the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwell.llm import bpe, decontaminate, language_id, quality, simhash
from rankwell.llm.common import stored
from rankwell.sources.tables import table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects.

    Null and empty texts have no words and go, as too short. Repeated rows are judged alike. Rules that
    would reject the same document in another order reject it in this one too, so ties do not matter.
    """
    return quality.keep(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text fits a language, and fits it no worse than its label's.

    The classifier learns from the documents' own labels; null labels teach nothing and are not
    contradicted. Where no document has a label there is nothing to tell languages by. Documents
    without a letter, or without text, go in any case.
    """
    return language_id.fitting(docs, language_id.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates.

    Of rows with the same smallest id, repeated rows among them, one stays; a null id comes last. Texts
    without words, null ones among them, are one group.
    """
    return simhash.deduplicate(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage.

    Null and empty texts have none and stay, as do repeated rows of a clean text. Items without words or
    without id remove as their words do; an empty benchmark removes nothing.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, their number, and whether they decode to its text.

    Null and empty texts have no ids and are exact. Repeated rows keep a row each.
    """
    out = bpe.decode(bpe.encode(docs, RANKS), RANKS)
    return out.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("exact"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("byte-level BPE", tokens),
]

# The languages are told by a trained classifier and the texts are encoded, which SQL cannot do.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs)
    return docs
