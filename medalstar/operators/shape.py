"""Unpivot, union and projection helpers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_distinct(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Distinct non-NULL values over several columns, in one scan.

    The same as a UNION of one leg per column, which would scan the table once per leg. The
    partial aggregate collapses the values before the shuffle.
    """
    values = df.select(F.explode(F.array_distinct(F.array(*columns))).alias(name))
    return values.filter(F.col(name).isNotNull()).distinct()


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, matched by column name; missing columns become NULL."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def select_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[c for c in columns if c in df.columns])
