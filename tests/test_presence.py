"""Presence of JSON fields and unknown keys, against what the documents say."""

from pyspark.sql import types as T

from medalstar import schemas
from medalstar.sources.presence import field_presence, unknown_keys

PART = T.StructType().add("x", "integer")
KNOWN = T.StructType().add("id", "long").add("info", T.StructType().add("a", "string").add("parts", T.ArrayType(PART))).add(
    "list", T.ArrayType(T.ArrayType(T.IntegerType())))
TEXTS = [
    '{"id": 1, "info": {"a": null, "parts": [{"x": 1}, {"x": null}, {}, {"y": 2}]}, "list": [[1]]}',
    '{"id": null, "info": null, "extra": 5}',
    '{"info": {"parts": 7, "b": 1}, "extra": null, "more": {"z": 1}}',
    '{"info": [1], "list": null}',
    '{"id": 2', "", None, "[]", "null", "3",
]


def documents(spark, texts=TEXTS):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_absent_is_told_from_null(spark):
    got = {r["path"]: (r["objects"], r["absent"], r["nulls"]) for r in field_presence(documents(spark), "value", KNOWN).collect()}
    assert got == {
        "$.id": (4, 2, 1), "$.info": (4, 0, 1), "$.list": (4, 2, 1),
        "$.info.a": (2, 1, 1), "$.info.parts": (2, 0, 0), "$.info.parts[*].x": (4, 2, 1),
    }


def test_unknown_keys_are_counted_by_document(spark):
    got = sorted(map(tuple, unknown_keys(documents(spark), "value", KNOWN).collect()))
    assert got == [("$", "extra", 2), ("$", "more", 1), ("$.info", "b", 1), ("$.info.parts[*]", "y", 1)]


def test_no_documents(spark):
    assert field_presence(documents(spark, []), "value", KNOWN).count() == 0
    assert unknown_keys(documents(spark, []), "value", KNOWN).count() == 0


def test_names_with_quotes_and_dots(spark):
    known = T.StructType([T.StructField("it's a.b", T.IntegerType())])
    docs = documents(spark, ['{"it\'s a.b": 1}', '{"it\'s a": {"b": 1}}'])
    assert [tuple(r) for r in field_presence(docs, "value", known).collect()] == [("$.it's a.b", 2, 1, 0)]
    assert [tuple(r) for r in unknown_keys(docs, "value", known).collect()] == [("$", "it's a", 1)]


def test_match_schema(spark):
    docs = documents(spark, ['{"metadata": {"matchId": "M1"}, "info": {"participants": [{"novel": 1}]}}'])
    got = {r["path"]: r["absent"] for r in field_presence(docs, "value", schemas.MATCH_DOCUMENT).collect()}
    assert got["$.metadata.matchId"] == 0 and got["$.info.teams"] == 1
    assert [tuple(r) for r in unknown_keys(docs, "value", schemas.MATCH_DOCUMENT).collect()] == [("$.info.participants[*]", "novel", 1)]
