"""Ranked cuts over the ladder."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medalstar.operators.keys import ascending, dedupe_first


def top_k(df: DataFrame, metric: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the highest metric; every task keeps its own best ``k`` only."""
    return df.orderBy(F.col(metric).desc_nulls_last(), *ascending(ties)).limit(k)


def first_n(df: DataFrame, key: str, arrival: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` distinct keys in order of arrival, NULLs last."""
    seen = dedupe_first(df.select(key, *[c for c in arrival if c != key]), [key], arrival)
    return seen.orderBy(*ascending([*arrival, key])).limit(n).select(key)


def ladder_waterfall(
    df: DataFrame, tiers: Sequence[str], tier: str, points: str, k: int, ties: Sequence[str]
) -> DataFrame:
    """Top ``k`` by points over the tiers, admitting a tier only while higher ones hold fewer than ``k``.

    The admitted tiers come from one aggregate row, read as a scalar subquery of the same plan.
    """
    sizes = [F.count_if(F.col(tier) == t) for t in tiers]
    higher = [sum(sizes[:i], F.lit(0)) for i in range(len(tiers))]
    admitted = df.agg(
        F.array_compact(F.array(*[F.when(n < k, F.lit(t)) for n, t in zip(higher, tiers)])).alias("admitted")
    ).scalar()
    return top_k(df.filter(F.array_contains(admitted, F.col(tier))), points, k, ties)


def tier_major_rank(
    df: DataFrame, opens_above: Mapping[str, int], tier: str, points: str, k: int, ties: Sequence[str]
) -> DataFrame:
    """Rank 1..k with tiers kept apart: all of the first tier, then the next, each by points.

    ``opens_above`` lists the tiers from the top with the ``k`` above which each takes part.
    The numbering window sees the ``k`` rows of the cut only.
    """
    open_tiers = [t for t, limit in opens_above.items() if k > limit]
    place = F.array_position(F.lit(open_tiers), F.col(tier))
    order = ["_place", F.col(points).desc_nulls_last(), *ascending(ties)]
    cut = df.filter(F.col(tier).isin(open_tiers)).withColumn("_place", place).orderBy(*order).limit(k)
    return cut.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint")).drop("_place")
