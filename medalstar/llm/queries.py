"""One query per operator, over its whole table and with production settings."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medalstar.llm import (
    ann, bpe, chat, exact_dedup, langid, lexical, mixing, near_dedup, quality, substrings,
    token_counts, trie, warc,
)
from medalstar.llm.common import ROW, held_out, staged, with_rows
from medalstar.sources.samples import inputs

VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path() -> str:
    return public_tokenizers.path(VOCABULARY)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return inputs(spark, sf_dir, name)[name]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= quality.KEEP, 1).otherwise(0).alias("predicted"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_rows(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = token_counts.apply_edits(docs, token_counts.sample_edits(docs, by=ROW), vocabulary_path(), by=ROW)
    return counts.select("doc_id", "tokens_before", "tokens_after", "edits", "chars_again", "chars_after",
                         F.size("leaf_chars").alias("leaves"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode_decode(_table(spark, sf_dir, "documents"), vocabulary_path()))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id bigint, turn bigint, role string, text string")
    rows = _table(spark, sf_dir, "conversations").unionByName(extra)
    return chat.read_back(*chat.format_tree(rows, vocabulary_path()))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.predict(docs.drop("lang"), langid.fit(docs)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(_table(spark, sf_dir, "documents")).drop("_row")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(_table(spark, sf_dir, "documents")).drop("_row")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_index(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.deduplicate(_table(spark, sf_dir, "documents"), width=2)
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = staged(trie.numbered_turns(_table(spark, sf_dir, "conversations")), "numbered")
    nodes, ends = trie.prefix_trie(*trie.rebuilt(turns, trie.lengths_of(turns)))
    return trie.ends_digest(nodes, ends).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256")


def op12_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removed(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_table(spark, sf_dir, "benchmark"), _table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality, op2_token_counts, op3_bpe, op4_chat, op5_langid, op6_mixing, op7_exact_dedup, op8_warc, op9_ann,
        op10_near_dedup, op11_trie, op12_substrings, op13_lexical)
}
