"""Business questions over the stored fact and dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalstar.operators.joins import broadcast_if_small


def _wins() -> list[Column]:
    won = F.count_if(F.col("win"))
    return [F.count("*").alias("games"), won.alias("wins"), F.try_divide(won, F.count("win")).alias("win_rate")]


def _mean(column: str) -> Column:
    """Average of the values to six decimals. Decimals add up exactly, in whatever order they come."""
    total = F.sum(F.col(column).cast("decimal(18,6)")).cast("double")
    return F.try_divide(total, F.count(column)).alias(f"avg_{column}")


def champion_winrate_by_patch(fact: DataFrame, dim_queue_patch: DataFrame) -> DataFrame:
    """Games, wins and win rate per champion and patch.

    The fact is grouped by queue-patch key before the join, so the join sees one row per
    (champion, key) instead of one per participant.
    """
    grouped = fact.groupBy("champion_key", "champion_name", "queue_patch_key").agg(
        F.count("*").alias("games"), F.count("win").alias("decided"), F.count_if(F.col("win")).alias("wins")
    )
    patches = broadcast_if_small(dim_queue_patch.select("queue_patch_key", "patch_major"))
    return (
        grouped.join(patches, "queue_patch_key")
        .groupBy("champion_key", "champion_name", "patch_major")
        .agg(F.sum("games").alias("games"), F.sum("wins").alias("wins"), F.sum("decided").alias("decided"))
        .withColumn("win_rate", F.try_divide("wins", "decided"))
        .drop("decided")
    )


def player_performance(fact: DataFrame) -> DataFrame:
    """Games, win rate and average rates per player."""
    return fact.filter(F.col("player_key").isNotNull()).groupBy("player_key", "puuid").agg(
        *_wins(), _mean("kda"), _mean("gold_per_minute"), _mean("cs_per_minute")
    )


def team_results(fact: DataFrame, *columns: str) -> DataFrame:
    """The fact reduced to one row per team of a match; a value that some of its rows lack comes from the others."""
    return fact.groupBy("match_id", "team_id").agg(*[F.max(c).alias(c) for c in ("side", "win", *columns)])


def side_winrate(fact: DataFrame) -> DataFrame:
    """Win rate per map side, counting each team of a match once."""
    return team_results(fact).groupBy("side").agg(*_wins())


def _kill_bucket(kills: Column) -> Column:
    return F.when(kills == 0, "0").when(kills <= 2, "1-2").when(kills > 2, "3+")


def team_objectives(fact: DataFrame, *columns: str) -> DataFrame:
    """(objective, bucket, win) of every team of a match, and ``columns``."""
    firsts = ["team_first_blood", "team_first_dragon", "team_first_baron"]
    kills = ["team_dragon_kills", "team_baron_kills"]
    bucket = {
        **{name: F.col(name).cast("string") for name in firsts},
        **{name: _kill_bucket(F.col(name)) for name in kills},
    }
    pairs = F.array(*[F.struct(F.lit(n).alias("objective"), b.alias("bucket")) for n, b in bucket.items()])
    teams = team_results(fact, *firsts, *kills, *columns)
    return teams.select("win", *columns, F.inline(pairs)).filter(F.col("bucket").isNotNull())


def objective_impact(fact: DataFrame) -> DataFrame:
    """Win rate by who took the first objective and by objective count, at team grain, in one pass."""
    return team_objectives(fact).groupBy("objective", "bucket").agg(*_wins())


def role_analysis(fact: DataFrame) -> DataFrame:
    """Results and averages per position."""
    return fact.groupBy("team_position").agg(
        *_wins(), _mean("kda"), _mean("gold_per_minute"), _mean("cs_per_minute"),
        _mean("vision_score"), _mean("damage_to_champions"),
    )


def participants_per_match(fact: DataFrame) -> DataFrame:
    return fact.groupBy("match_id").agg(F.count("*").alias("participants"))


def star_join(fact: DataFrame, dim_player: DataFrame, dim_champion: DataFrame) -> DataFrame:
    """Fact rows labelled from the player and champion dimensions."""
    players = broadcast_if_small(dim_player.select("player_key", "summoner_name"))
    champions = broadcast_if_small(dim_champion.select("champion_key", "champion_name"))
    return (
        fact.select("match_id", "participant_id", "player_key", "champion_key", "kills", "deaths", "assists")
        .join(champions, "champion_key").join(players, "player_key")
        .select("match_id", "participant_id", "summoner_name", "champion_name", "kills", "deaths", "assists")
    )
