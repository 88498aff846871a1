"""Rows of a month clustered on several columns at once, so that scans skip files and row groups by any of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BITS = 6  # of a column's place among its quantiles
_ACCURACY = 2000


def _computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns that are computed once per row: a generator keeps later references from repeating them."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _placed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds ``_place0``, ...: the number of the quantile that each column's value falls into, 0 for NULL."""
    told = _computed(df, {f"_number{i}": _number(df, c) for i, c in enumerate(columns)})
    names = [f"_number{i}" for i in range(len(columns))]
    cuts = [i / (1 << _BITS) for i in range(1, 1 << _BITS)]
    row = told.agg(*[F.percentile_approx(n, cuts, _ACCURACY).alias(n) for n in names]).first()
    return _computed(told, {f"_place{i}": _place(F.col(n), sorted(set(row[n] or []))) for i, n in enumerate(names)}).drop(*names)


def _place(number: Column, bounds: list[float]) -> Column:
    place = F.when(number.isNull(), 0)
    for i, bound in enumerate(bounds, 1):
        place = place.when(number < bound, i)
    return place.otherwise(len(bounds) + 1)


def _number(df: DataFrame, column: str) -> Column:
    """A number that orders the values of a column, roughly for text."""
    if df.schema[column].dataType.simpleString() == "string":
        return F.conv(F.substring(F.rpad(F.hex(F.col(column)), 12, "0"), 1, 12), 16, 10).cast("double")
    if df.schema[column].dataType.simpleString() in ("date", "timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    return F.col(column).cast("double")


def interleaved(places: Sequence[Column]) -> Column:
    """One number from the bits of all places in turn, highest first."""
    total = F.lit(0).cast("bigint")
    for bit in range(_BITS + 1):
        for i, place in enumerate(places):
            value = F.shiftright(place, bit).bitwiseAND(F.lit(1)).cast("bigint")
            total = total.bitwiseOR(F.shiftleft(value, bit * len(places) + i))
    return total


def cluster_rows(df: DataFrame, columns: Sequence[str], files: int) -> DataFrame:
    """``df`` in ``files`` ranges along a curve that keeps rows together that are close in all ``columns``.

    Values become places among approximate quantiles of a first pass, so skewed columns use all of the curve; a hot
    value is cut by the other columns. Ranges are sorted within, so row groups are narrow too. ``df`` is read three
    times, for quantiles, ranges and rows: pass a stored table.
    """
    if not 1 <= len(columns) <= 6:
        raise ValueError("one to six columns")
    curve = interleaved([F.col(f"_place{i}") for i in range(len(columns))]).alias("_curve")
    rest = F.xxhash64(*df.columns).alias("_rest")  # cuts ranges of rows that agree in all columns
    return _placed(df, columns).select(*df.columns, curve, rest).repartitionByRange(
        files, "_curve", "_rest").sortWithinPartitions("_curve").drop("_curve", "_rest")
