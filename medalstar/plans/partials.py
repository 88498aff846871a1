"""The business questions from monthly partial results, so that neither a new nor a corrected month needs a full scan.

A partial holds, per month and group, numbers that add up: rows, wins, decided games, exact decimal sums and their
counts. Ratios and averages are taken when partials are combined. A match belongs to the month of its start, so the
team-grain questions count each team once within its month.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medalstar.operators.joins import broadcast_if_small
from medalstar.plans import marts
from medalstar.session import new_shared_folder, remove_folder
from medalstar.sources.tables import MONTH, write_months


@dataclass(frozen=True)
class Mart:
    """How a question is reduced to a month's partial: rows to group, group columns, averaged columns."""

    rows: Callable[[DataFrame], DataFrame]
    groups: Sequence[str]
    averages: Sequence[str] = field(default_factory=tuple)


PERFORMANCE = ("kda", "gold_per_minute", "cs_per_minute")
MARTS = {
    "champion_winrate_by_patch": Mart(lambda fact: fact, ("champion_key", "champion_name", "queue_patch_key")),
    "player_performance": Mart(
        lambda fact: fact.filter(F.col("player_key").isNotNull()), ("player_key", "puuid"), PERFORMANCE),
    "side_winrate": Mart(lambda fact: marts.team_results(fact, MONTH), ("side",)),
    "objective_impact": Mart(lambda fact: marts.team_objectives(fact, MONTH), ("objective", "bucket")),
    "role_analysis": Mart(
        lambda fact: fact, ("team_position",), (*PERFORMANCE, "vision_score", "damage_to_champions")),
}


def partial(name: str, fact: DataFrame) -> DataFrame:
    """The partial of every month of ``fact``."""
    mart = MARTS[name]
    exact = [x for c in mart.averages for x in (
        F.sum(F.col(c).cast("decimal(18,6)")).alias(f"sum_{c}"), F.count(c).alias(f"n_{c}"))]
    return mart.rows(fact).groupBy(MONTH, *mart.groups).agg(
        F.count("*").alias("games"), F.count_if(F.col("win")).alias("wins"), F.count("win").alias("decided"), *exact)


def refresh(
    fact: DataFrame, root: str, months: Sequence[str | None] | None = None, names: Sequence[str] = tuple(MARTS),
) -> None:
    """Store the partials of ``months`` of the fact, in place of what is stored for them; of all months if None.

    ``names`` are the questions whose partials are stored, all of them unless given.

    Only those months of ``fact``, which is partitioned by month, are read. A month that has no rows any more loses
    its partials.
    """
    spark = fact.sparkSession
    if months is not None:
        named = F.col(MONTH).isin([m for m in months if m is not None])
        fact = fact.filter(named | F.col(MONTH).isNull() if None in months else named)
    for name in names:
        stored = new_shared_folder(spark, name)
        part = partial(name, fact)
        part.write.parquet(stored)  # computed once; a month that fails to compute replaces nothing
        rows = spark.read.schema(part.schema).parquet(stored)
        found = {r[0] for r in rows.select(MONTH).distinct().collect()}
        path = f"{root}/partials/{name}"
        write_months(rows.hint("rebalance", MONTH).sortWithinPartitions(MONTH), path, keep_other_months=months is not None)
        for month in set(months or ()) - found:
            remove_folder(spark, f"{path}/{MONTH}={'__HIVE_DEFAULT_PARTITION__' if month is None else month}")
        remove_folder(spark, stored)


def stored(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/partials/{name}")


def combine(name: str, partials: DataFrame, dim_queue_patch: DataFrame | None = None) -> DataFrame:
    """The answer from partials, of all months or of those that are passed.

    Patches are joined here: a corrected dimension needs no new partials.
    """
    mart, groups = MARTS[name], list(MARTS[name].groups)
    if "queue_patch_key" in groups:
        patches = broadcast_if_small(dim_queue_patch.select("queue_patch_key", "patch_major"))
        partials = partials.join(patches, "queue_patch_key")
        groups[groups.index("queue_patch_key")] = "patch_major"
    added = ["games", "wins", "decided", *[f"{kind}_{c}" for c in mart.averages for kind in ("sum", "n")]]
    sums = partials.groupBy(*groups).agg(*[F.sum(c).alias(c) for c in added])
    return sums.select(
        *groups, "games", "wins", F.try_divide("wins", "decided").alias("win_rate"),
        *[F.try_divide(F.col(f"sum_{c}").cast("double"), F.col(f"n_{c}")).alias(f"avg_{c}") for c in mart.averages])
