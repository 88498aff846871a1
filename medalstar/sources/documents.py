"""JSON documents: parsing, rejection of malformed ones, and lookup lists."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalstar import schemas

_CORRUPT = "_corrupt"


def read_text_documents(spark: SparkSession, path: str, one_per_file: bool = False) -> DataFrame:
    """Landed JSON as column ``value``: one document per line, or one per file."""
    return spark.read.text(path, wholetext=one_per_file)


def parse_documents(df: DataFrame, text: str, schema: T.StructType) -> DataFrame:
    """Parse a JSON text column to the fields of ``schema``; unreadable text is kept in ``_corrupt``.

    The parsed struct passes through a generator, which later filters cannot be pushed below; as a
    plain projection it would be parsed again for every reference in such a filter.
    """
    return df.select("*", F.inline(F.array(_parsed(text, schema))))


def _parsed(text: str, schema: T.StructType) -> Column:
    with_corrupt = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    return F.from_json(text, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})


def may_hold(text: Column | str, value: str) -> Column:
    """Whether a JSON text can hold ``value`` as a parsed string: false only where it surely does not.

    A string stands in the text as it is, or with escapes. A number or an object may be read as a string of another
    spelling, so a value that could come from one is looked for nowhere.
    """
    if not value or value[0] in "{[+-.0123456789" or value in ("NaN", "INF", "Infinity"):
        return F.lit(True)
    column = F.col(text) if isinstance(text, str) else text
    return column.contains(value) | column.contains("\\")


def _present(fields: Iterable[str], within: Column) -> Column:
    return reduce(Column.__and__, [within[f].isNotNull() for f in fields])


def _every(elements: Column, fields: Iterable[str]) -> Column:
    return F.coalesce(F.forall(elements, lambda e: _present(fields, e)), F.lit(False))


def _match_reason(corrupt: Column, metadata: Column, info: Column) -> Column:
    return (
        F.when(corrupt.isNotNull(), "unreadable")
        .when(metadata["matchId"].isNull(), "match id missing")
        .when(~_present(schemas.MATCH_REQUIRED, info), "match field missing")
        .when(~_every(info["participants"], schemas.PARTICIPANT_REQUIRED), "participant field missing")
        .when(~_every(info["teams"], ["teamId", "win"]), "team field missing")
    )


def match_rejection(df: DataFrame) -> DataFrame:
    """Add ``reason``: why a parsed match document is unusable, NULL when it is fine.

    A required key that is missing or null rejects the whole document, for both bronze tables.
    Extra document columns, such as a file name, pass through.
    """
    return df.withColumn("reason", _match_reason(F.col(_CORRUPT), F.col("metadata"), F.col("info")))


def _document_reason(document: Column) -> Column:
    return _match_reason(document[_CORRUPT], document["metadata"], document["info"])


def _one_match(text: str) -> Column:
    """A list of the one parsed match, judged and cut inside a generator: what no question reads is never copied."""
    return F.array(_parsed(text, schemas.MATCH_DOCUMENT))


def match_reasons(df: DataFrame, text: str) -> DataFrame:
    """``reason`` of ``match_rejection`` for a text column, without the parsed parts."""
    return df.select("*", F.explode(F.transform(_one_match(text), _document_reason)).alias("reason"))


def _accepted_match(text: str) -> Column:
    return F.filter(_one_match(text), lambda d: _document_reason(d).isNull())


def matches_of(df: DataFrame, text: str) -> DataFrame:
    """(metadata, info) of the match documents in a text column that ``match_rejection`` finds fine."""
    return df.select(F.inline(_accepted_match(text))).select("metadata", "info")


def match_rows(df: DataFrame, text: str, rows: Callable[[Column], Column]) -> DataFrame:
    """The rows of those documents: ``rows`` makes an array of structs of one."""
    return df.select(F.inline(F.flatten(F.transform(_accepted_match(text), rows))))


def accepted_matches(df: DataFrame) -> DataFrame:
    return match_rejection(df).filter(F.col("reason").isNull()).drop("reason", _CORRUPT)


def quarantined_matches(df: DataFrame) -> DataFrame:
    """Rejected documents with their reason; the parsed parts are dropped, other columns stay."""
    return match_rejection(df).filter(F.col("reason").isNotNull()).drop("metadata", "info", _CORRUPT)


def lookup_entries(df: DataFrame, text: str, shape: str) -> DataFrame:
    """Distinct (id, name) rows of lookup documents.

    ``list``: ``[{id, name}]``; ``dict``: ``{id: {name}}``; ``styles``: ``{styles: [{id, name}]}``.
    Entries without an id or a name are left out.
    """
    entry = "struct<id: string, name: string>"
    if shape == "dict":
        entries = df.select(F.explode(F.from_json(text, "map<string, struct<name: string>>")).alias("id", "entry"))
        pairs = entries.select("id", "entry.name")
    else:
        schema = f"array<{entry}>" if shape == "list" else f"struct<styles: array<{entry}>>"
        parsed = F.from_json(text, schema)
        pairs = df.select(F.inline(parsed if shape == "list" else parsed["styles"]))
    return pairs.dropna().select(F.col("id").cast("bigint").alias("id"), "name").distinct()
