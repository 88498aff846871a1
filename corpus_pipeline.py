"""From raw documents to token ids: every stage is written as Parquet and read again as the next one's input.

All stages but the last return the columns of ``documents``. A row stands for itself: rows that repeat a
key are judged one by one, null texts count as empty texts. A stage takes the identity of its rows once, so its
documents need not be stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medalstar.llm import bpe, exact_dedup, mixing, near_dedup, quality
from medalstar.llm.common import HIDING, ROW, broadcast_if_few, staged, with_rows
from medalstar.llm.queries import vocabulary_path
from medalstar.sources.samples import inputs

_ROW_BYTES = 64


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold."""
    model = quality.fit(docs, inputs(spark, sf_dir, "labels")["labels"])
    return quality.score(docs, model).filter(F.col("score") >= quality.KEEP).select(docs.columns)


def _identified(docs: DataFrame) -> tuple[DataFrame, list]:
    """(``docs`` with the identity of their rows, the columns of ``docs`` in it).

    Columns of the table that bear the identity's names have other names meanwhile.
    """
    names = {c: f"_own{i}" if c in HIDING else c for i, c in enumerate(docs.columns)}
    return with_rows(docs.withColumnsRenamed({c: n for c, n in names.items() if c != n})), [
        F.col(n).alias(c) for c, n in names.items()]


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs``, which have ``_row``, less the rows named by ``dropped``."""
    dropped = broadcast_if_few(staged(dropped.select(ROW), "dropped"), _ROW_BYTES)
    return docs.join(dropped, ROW, "left_anti")


def exact_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts."""
    rows, columns = _identified(docs)
    return _without(rows, exact_dedup.deduplicate(rows).filter(~F.col("kept"))).select(columns)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of near copies: five words a shingle, similarity of 0.8 or more."""
    rows, columns = _identified(docs)
    return _without(rows, near_dedup.deduplicate(rows).filter(~F.col("kept"))).select(columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix enters it: not at all, once, or up to three times."""
    rows, columns = _identified(docs)
    parts, _, _ = mixing.mix(rows)
    times = parts.groupBy(ROW).agg(F.countDistinct("epoch").alias("_times"))
    times = broadcast_if_few(staged(times, "times"), _ROW_BYTES)
    return rows.join(times, ROW).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times")))).select(columns)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digest of their decoded text."""
    encoded = bpe.encode_decode(docs, vocabulary_path())
    return encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
                          F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_deduplication),
    ("minhash_near_dedup", near_deduplication),
    ("mixing", source_mixing),
    ("bpe", bpe_encoding),
]

# SQL can't express the classifier; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs(spark, sf_dir, "documents")["documents"]
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
