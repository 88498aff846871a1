"""What landed JSON really holds, against a declared schema: absent and null fields, and unknown keys.

A document is parsed once, to a VARIANT, which keeps an absent key apart from an explicit null; ``from_json`` gives
NULL for both. All objects at a path are looked at, those in arrays too. Reports are grouped counts, combined in the
tasks before the one shuffle, which moves a row per path and task.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROOT = "$"


def _steps(objects: Column, known: T.StructType, path: str = ROOT) -> Iterator[tuple[str, Column, T.StructType]]:
    """(path, array of the values there, declared fields) of every object of the schema; ``[*]`` marks arrays."""
    yield path, objects, known
    for field in known.fields:
        kind, inner = field.dataType, f"{path}.{field.name}"
        values = F.transform(objects, lambda o: _member(o, field.name))
        while isinstance(kind, T.ArrayType):
            # A null or other value than an array has no elements.
            values = F.flatten(F.transform(values, lambda v: F.coalesce(
                v.try_cast("array<variant>"), F.array().cast("array<variant>"))))
            kind, inner = kind.elementType, f"{inner}[*]"
        if isinstance(kind, T.StructType):
            yield from _steps(values, kind, inner)


def _keys(value: Column) -> Column:
    """Keys of an object; none of anything else."""
    return F.coalesce(F.map_keys(value.try_cast("map<string, variant>")), F.array().cast("array<string>"))


def _member(value: Column, name: str) -> Column:
    """The value under a key: NULL if absent, a VARIANT null if null."""
    quote = '"' if "'" in name else "'"  # paths know no escapes
    return F.try_variant_get(value, f"$[{quote}{name}{quote}]", "variant")


def _parsed(df: DataFrame, text: str) -> DataFrame:
    """Column ``objects``: the document as an array of one VARIANT, empty where the text is unreadable or null."""
    value = F.try_parse_json(F.col(text))
    return df.select(F.filter(F.array(value), lambda v: v.isNotNull()).alias("objects"))


def field_presence(df: DataFrame, text: str, known: T.StructType) -> DataFrame:
    """(path, objects, absent, nulls): per declared field, the objects that should have it, lack it, or hold null."""
    counts = []
    for path, objects, fields in _steps(F.col("objects"), known):
        objects = F.filter(objects, lambda o: o.try_cast("map<string, variant>").isNotNull())
        for field in fields.fields:
            own = F.transform(objects, lambda o: _member(o, field.name))
            size = lambda a: F.size(a).cast("bigint")
            counts.append(F.struct(
                F.lit(f"{path}.{field.name}").alias("path"), size(own).alias("objects"),
                size(F.filter(own, lambda v: v.isNull())).alias("absent"),
                size(F.filter(own, lambda v: F.coalesce(F.is_variant_null(v), F.lit(False)))).alias("nulls")))
    rows = _parsed(df, text).select(F.inline(F.array(*counts)))
    return rows.groupBy("path").agg(*[F.sum(c).alias(c) for c in ("objects", "absent", "nulls")])


def unknown_keys(df: DataFrame, text: str, known: T.StructType) -> DataFrame:
    """(path, key, documents): keys that the schema does not declare, and in how many documents they occur."""
    found = []
    for path, objects, fields in _steps(F.col("objects"), known):
        names = [f.name for f in fields.fields]
        keys = F.array_distinct(F.flatten(F.transform(objects, _keys)))
        found.append(F.transform(F.filter(keys, lambda k: ~k.isin(names)), lambda k: F.struct(
            F.lit(path).alias("path"), k.alias("key"))))
    rows = _parsed(df, text).select(F.inline(F.concat(*found)))
    return rows.groupBy("path", "key").agg(F.count("*").alias("documents"))
