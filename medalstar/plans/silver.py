"""Typed, cleaned and enriched tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalstar import schemas
from medalstar.functions.scalars import iso_timestamp, kda, per_minute, safe_ratio
from medalstar.operators.keys import ascending, latest_per_key, top_n_per_key
from medalstar.operators.packing import Packing

LADDER_COLUMNS = [
    "puuid", "platform", "tier", "league_points", "wins", "losses", "total_games", "winrate", "ingest_ts",
]
# Where the derived participant columns stand among the bronze ones.
_DERIVED_AFTER = {
    "assists": ["kda"],
    "total_enemy_jungle_minions_killed": ["total_cs"],
    "perk_shard_offense": ["gold_per_minute", "cs_per_minute"],
}
PARTICIPANT_COLUMNS = [
    column for name in schemas.PARTICIPANTS.names for column in [name, *_DERIVED_AFTER.get(name, [])]
]


def stg_ladder(ladder: DataFrame) -> DataFrame:
    """Latest ladder row per player, with games and win rate."""
    games = F.col("wins") + F.col("losses")
    typed = ladder.filter(F.col("puuid").isNotNull()).select(
        "puuid",
        F.upper("platform").alias("platform"),
        "tier", "league_points", "wins", "losses",
        games.alias("total_games"),
        safe_ratio("wins", games).alias("winrate"),
        iso_timestamp("ingest_ts").alias("ingest_ts"),
    )
    return latest_per_key(typed, ["puuid"], "ingest_ts", ["platform", "tier", "league_points", "wins", "losses"])


def _dedupe(bronze: DataFrame, keys: Sequence[str] | None) -> DataFrame:
    """The newest bronze row of every key; columns derived from a row decide nothing and need not be shuffled.

    Rows are sorted and shuffled packed, at half the bytes.
    """
    if not keys:
        return bronze
    packing = Packing(bronze.schema, keys)
    rows = packing.pack(bronze)
    return packing.unpack(top_n_per_key(rows, keys, [iso_timestamp("ingest_ts").desc_nulls_last(), *ascending(rows.columns)]))


def with_rates(participants: DataFrame) -> DataFrame:
    """Bronze participants with the derived columns and a typed ingest time; other columns stay."""
    minions = F.col("total_minions_killed") + F.col("neutral_minions_killed")
    return participants.withColumns({
        "kda": kda("kills", "deaths", "assists"),
        "total_cs": minions,
        "gold_per_minute": per_minute("gold_earned", "game_duration"),
        "cs_per_minute": per_minute(minions, "game_duration"),
        "ingest_ts": iso_timestamp("ingest_ts"),
    })


def stg_matches_participants(participants: DataFrame, dedupe_keys: Sequence[str] | None = None) -> DataFrame:
    """Participants with derived rates.

    Repeated ingests stay as they are unless ``dedupe_keys`` names the grain to keep the newest of.
    """
    return with_rates(_dedupe(participants.select(*schemas.PARTICIPANTS.names), dedupe_keys)).select(*PARTICIPANT_COLUMNS)


def stg_matches_teams(teams: DataFrame, dedupe_keys: Sequence[str] | None = None) -> DataFrame:
    """Team rows with a typed ingest time; ``dedupe_keys`` as for participants."""
    return _dedupe(teams.select(*schemas.TEAMS.names), dedupe_keys).withColumn("ingest_ts", iso_timestamp("ingest_ts"))
