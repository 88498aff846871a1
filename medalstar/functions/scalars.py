"""Scalar expressions of the silver and gold layers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strips every whitespace character at both ends; Spark's trim() would leave tabs and newlines.
EDGE_SPACE = r"^\s+|\s+$"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """numerator / denominator as double; 0.0 when the denominator is zero, negative or NULL."""
    num, den = _col(numerator).cast("double"), _col(denominator)
    return F.when(den > 0, num / den.cast("double")).otherwise(F.lit(0.0))


def per_minute(amount: Column | str, seconds: Column | str) -> Column:
    """amount per minute of a duration in seconds; 0.0 without a positive duration."""
    duration = _col(seconds)
    minutes = duration.cast("double") / F.lit(60)
    return F.when(duration > 0, _col(amount).cast("double") / minutes).otherwise(F.lit(0.0))


def kda(kills: Column | str, deaths: Column | str, assists: Column | str) -> Column:
    """(kills + assists) / deaths; just kills + assists without a death; NULL for NULL deaths."""
    takedowns = (_col(kills) + _col(assists)).cast("double")
    return F.when(_col(deaths) == 0, takedowns).otherwise(takedowns / _col(deaths).cast("double"))


def blank_to_null(text: Column | str) -> Column:
    """The text without surrounding whitespace, NULL when nothing is left."""
    return F.nullif(F.regexp_replace(_col(text), EDGE_SPACE, ""), F.lit(""))


def blank_fallback(text: Column | str, fallback: Column | str) -> Column:
    return F.coalesce(blank_to_null(text), _col(fallback))


def version_part(version: Column | str, position: int) -> Column:
    """1-based part of a dotted version; NULL when there is no such part."""
    return F.get(F.split(_col(version), "[.]"), position - 1)


def patch_major(version: Column | str) -> Column:
    """First two parts, as in ``14.24``; NULL unless both exist."""
    return F.concat(version_part(version, 1), F.lit("."), version_part(version, 2))


def iso_timestamp(text: Column | str) -> Column:
    """ISO-8601 text to timestamp in the session zone (UTC); bad text fails the job."""
    return _col(text).cast("timestamp")


def epoch_ms(millis: Column | str, tenths: bool = False) -> Column:
    """Epoch milliseconds to timestamp, exact. ``tenths`` rounds to a tenth of a second first."""
    value = _col(millis)
    if tenths:
        value = (F.round(value / F.lit(100.0)) * 100).cast("bigint")
    return F.timestamp_millis(value)


def date_key(date: Column | str) -> Column:
    """Integer ``yyyymmdd``."""
    return F.date_format(_col(date), "yyyyMMdd").cast("int")


def month_key(timestamp: Column | str) -> Column:
    """``yyyy-MM``, the partition value of the fact."""
    return F.date_format(_col(timestamp), "yyyy-MM")


def code_lookup(code: Column | str, table: Mapping, default: str | None = None) -> Column:
    """Value of a small fixed table; ``default`` (or NULL) for unknown and NULL codes.

    The map folds to one literal, so there is no join and no shuffle.
    """
    pairs = [F.lit(part) for item in table.items() for part in item]
    found = F.try_element_at(F.create_map(*pairs), _col(code))
    return found if default is None else F.coalesce(found, F.lit(default))


def flag(predicate: Column) -> Column:
    """The predicate as a boolean without NULL."""
    return F.coalesce(predicate, F.lit(False))
