"""Columns of a caller's table that bear the names the row identity needs."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from medalstar.llm import common, exact_dedup, mixing, near_dedup, token_counts, warc
from medalstar.llm.queries import vocabulary_path

SMALL = "/root/testdata/sf0.001"
TEXT = "one two three four five six seven eight nine ten"


@pytest.fixture(params=[True, False])
def docs(spark, request):
    """Documents with clashing columns, stored or not."""
    rows = [(1, TEXT, "en", "a", 1, "mine", "yours"), (2, TEXT, "en", "a", 1, None, None), (3, None, None, None, 1, "x", "y"), (4, "other words", "en", "b", 2, "", "")]
    made = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, _row string, _metadata string")
    return common.staged(made, "clashing") if request.param else made


def test_operators_take_clashing_columns(docs):
    exact = {r["doc_id"]: r["kept"] for r in exact_dedup.deduplicate(docs).collect()}
    near = {r["doc_id"]: r["kept"] for r in near_dedup.deduplicate(docs).collect()}
    assert exact == near == {1: True, 2: False, 3: True, 4: True}
    assert mixing.taken(docs).count() == 4
    edits = docs.sparkSession.createDataFrame([], token_counts.sample_edits(docs.select("doc_id", "text")).schema)
    assert token_counts.apply_edits(docs, edits, vocabulary_path()).count() == 4
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("http://a.b/c").alias("url"), F.col("text").alias("html"), "_row", "_metadata")
    assert warc.archive_and_index(pages).count() == 4


def test_pipeline_keeps_clashing_columns(spark, docs):
    for stage, kept in ((corpus_pipeline.exact_deduplication, [1, 3, 4]), (corpus_pipeline.near_deduplication, [1, 3, 4]),
                        (corpus_pipeline.source_mixing, None)):
        got = stage(spark, docs, SMALL)
        assert got.columns == docs.columns
        rows = {r["doc_id"]: (r["_row"], r["_metadata"]) for r in got.collect()}
        assert kept is None or sorted(rows) == kept
        assert all(rows[k] == v for k, v in {1: ("mine", "yours"), 4: ("", "")}.items() if k in rows)
