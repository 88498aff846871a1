"""Star schema: six dimensions and the participant fact."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalstar.functions import lookups
from medalstar.functions.assets import Assets
from medalstar.functions.scalars import (
    blank_fallback, blank_to_null, code_lookup, date_key, epoch_ms, flag, patch_major, version_part,
)
from medalstar.operators.asof import join_as_of
from medalstar.operators.joins import broadcast_if_small, join_lookup, join_snapshot
from medalstar.operators.keys import dense_key, preferred_latest
from medalstar.operators.shape import unpivot_distinct
from medalstar.sources.tables import MONTH, gather_months

ITEM_SLOTS = [f"item{i}" for i in range(7)]


def dim_champion(participants: DataFrame, assets: Assets = Assets()) -> DataFrame:
    """One row per (champion id, name): a renamed champion keeps both names under one key."""
    used = participants.filter(F.col("champion_id").isNotNull()).select("champion_id", "champion_name").distinct()
    name = F.col("champion_name")
    return used.select(
        F.col("champion_id").alias("champion_key"),
        "champion_id",
        "champion_name",
        assets.champion_icon(name).alias("champion_image_url"),
        assets.champion_splash(name).alias("champion_splash_url"),
        assets.champion_loading(name).alias("champion_loading_url"),
    )


def dim_date(participants: DataFrame) -> DataFrame:
    """One row per day on which a match started (UTC). Weeks are ISO weeks, Monday is day 1."""
    started = participants.filter(F.col("game_start_timestamp").isNotNull())
    days = started.select(F.to_date(epoch_ms("game_start_timestamp")).alias("calendar_date")).distinct()
    day = F.col("calendar_date")

    def part(field: str) -> Column:
        return F.extract(F.lit(field), day).cast("bigint")

    return days.select(
        date_key(day).alias("date_key"),
        "calendar_date",
        part("YEAR").alias("year"),
        part("QUARTER").alias("quarter"),
        part("MONTH").alias("month"),
        F.date_format(day, "MMM").alias("month_name"),
        part("WEEK").alias("week_of_year"),
        part("DAY").alias("day"),
        part("DOW_ISO").alias("day_of_week"),
        F.date_format(day, "E").alias("day_name"),
        part("DOW_ISO").isin(6, 7).alias("is_weekend"),
    )


def dim_item(participants: DataFrame, assets: Assets = Assets()) -> DataFrame:
    """One row per item seen in any of the seven slots."""
    items = unpivot_distinct(participants, ITEM_SLOTS, "item_id").filter(F.col("item_id") > 0)
    return items.select(
        F.col("item_id").alias("item_key"), "item_id", assets.item(F.col("item_id")).alias("item_image_url")
    )


def dim_spell(participants: DataFrame, assets: Assets = Assets()) -> DataFrame:
    """One row per spell seen in either slot; spells outside the fixed table get a name from their id."""
    used = unpivot_distinct(participants, ["summoner1_id", "summoner2_id"], "spell_id").filter(F.col("spell_id") > 0)
    known = join_lookup(used, lookups.SPELLS, "spell_id bigint, known_key string, known_name string", "spell_id")
    code = F.col("spell_id").cast("string")
    key_name = F.coalesce("known_key", F.concat(F.lit("Summoner"), code))
    return known.select(
        F.col("spell_id").alias("spell_key"),
        "spell_id",
        F.coalesce("known_name", F.concat(F.lit("Spell "), code)).alias("spell_name"),
        key_name.alias("spell_key_name"),
        assets.spell(key_name).alias("spell_image_url"),
    )


def dim_queue_patch(participants: DataFrame, number: Callable = dense_key) -> DataFrame:
    """One row per (queue, mode, version), keyed in the order of queue and version."""
    combos = participants.filter(F.col("queue_id").isNotNull()).select("queue_id", "game_mode", "game_version").distinct()
    keyed = number(combos, "queue_patch_key", ["queue_id", "game_version", "game_mode"])
    return keyed.select(
        "queue_patch_key",
        "queue_id",
        "game_mode",
        flag(F.col("queue_id").isin(lookups.RANKED_QUEUES)).alias("is_ranked"),
        code_lookup("queue_id", lookups.QUEUES, lookups.OTHER_QUEUE).alias("queue_name"),
        "game_version",
        patch_major("game_version").alias("patch_major"),
        version_part("game_version", 1).alias("patch_season"),
    )


def current_players(participants: DataFrame) -> DataFrame:
    """Latest identity per player, preferring rows that carry a summoner name."""
    named = participants.filter(F.col("puuid").isNotNull()).select(
        "puuid", "platform",
        blank_to_null("summoner_name").isNotNull().alias("_named"),
        blank_fallback("summoner_name", "riot_id_name").alias("summoner_name"),
        "riot_id_name", "riot_id_tagline", "ingest_ts",
    )
    # Rows that tie on all of these are equal in every column that is kept.
    ties = ["platform", "summoner_name", "riot_id_name", "riot_id_tagline"]
    return preferred_latest(named, ["puuid"], F.col("_named"), "ingest_ts", ties).drop("_named", "ingest_ts")


def dim_player(
    participants: DataFrame, stg_ladder: DataFrame, assets: Assets = Assets(), number: Callable = dense_key,
) -> DataFrame:
    """One row per player with identity and, where ladder and identity agree on the platform, rank.

    ``number`` gives the surrogate keys, anew or from a registry.
    """
    ranked = join_snapshot(current_players(participants), stg_ladder, "puuid", "platform", {
        "tier": "current_tier",
        "league_points": "current_lp",
        "wins": "current_wins",
        "losses": "current_losses",
        "winrate": "current_winrate",
    })
    return number(ranked, "player_key", ["puuid"]).withColumn(
        "rank_emblem_url", assets.rank_emblem(F.col("current_tier"))
    )


PLAYER_KEY = ("puuid", "player_key")


def player_keys(participants: DataFrame, number: Callable = dense_key) -> DataFrame:
    """``PLAYER_KEY`` of ``dim_player``, whose keys follow from the players alone, without a look at their identities."""
    players = participants.select("puuid").filter(F.col("puuid").isNotNull()).distinct()
    return number(players, "player_key", ["puuid"]).select(*PLAYER_KEY)


TEAM_STATS = {
    "baron_kills": "team_baron_kills",
    "dragon_kills": "team_dragon_kills",
    "rift_herald_kills": "team_rift_herald_kills",
    "tower_kills": "team_tower_kills",
    "champion_kills": "team_total_kills",
    "first_blood": "team_first_blood",
    "first_dragon": "team_first_dragon",
    "first_baron": "team_first_baron",
}

# Fact name -> silver participant name, where the two differ.
FACT_RENAMES = {
    "game_duration_seconds": "game_duration",
    "champion_key": "champion_id",
    "damage_to_champions": "total_damage_dealt_to_champions",
    "damage_taken": "total_damage_taken",
    "time_spent_dead": "total_time_spent_dead",
    "spell1_id": "summoner1_id",
    "spell2_id": "summoner2_id",
    "keystone_rune_id": "perk_keystone",
    "primary_rune_tree": "perk_primary_style",
    "secondary_rune_tree": "perk_secondary_style",
}

# The published columns of the fact, in order.
FACT_COLUMNS = [
    # keys
    "match_id", "puuid", "participant_id", "team_id", "date_key", "player_key", "champion_key", "queue_patch_key",
    # context
    "platform", "side", "team_position", "game_start_datetime", "game_duration_seconds",
    # champion
    "champion_id", "champion_name", "champion_image_url", "champion_splash_url",
    # outcome and combat
    "win", "kills", "deaths", "assists", "kda", "largest_killing_spree", "damage_to_champions", "damage_taken",
    # economy, vision, survival
    "gold_earned", "total_cs", "gold_per_minute", "cs_per_minute",
    "vision_score", "wards_placed", "wards_killed", "time_spent_dead",
    # loadout
    "spell1_id", "spell2_id", "spell1_image_url", "spell2_image_url",
    "keystone_rune_id", "primary_rune_tree", "secondary_rune_tree",
    "keystone_rune_image_url", "primary_rune_tree_image_url", "secondary_rune_tree_image_url",
    *ITEM_SLOTS, *[f"{slot}_image_url" for slot in ITEM_SLOTS],
    "role_icon",
    # team and rank
    *TEAM_STATS.values(), "rank_tier_at_match", "rank_lp_at_match",
    "ingest_ts",
]


def rank_at_match(participants: DataFrame, rank_history: DataFrame) -> DataFrame:
    """Participants with the rank that their player held on their platform when the match started.

    ``rank_history`` has puuid, platform, tier, league_points and since (a timestamp). ``rank_tier_at_match`` of the fact
    is the latest rank known, whenever that was; this is the one at the time.
    """
    timed = participants.withColumn("_started", epoch_ms("game_start_timestamp"))
    ranked = join_as_of(timed, rank_history, ["puuid", "platform"], "_started", "since", {
        "tier": "rank_tier_then", "league_points": "rank_lp_then", "since": "rank_since"}, ["tier", "league_points"])
    return ranked.drop("_started")


# What the fact takes from the tables that hold one row per player.
_BY_PLAYER = {"dim_player": ("player_key",), "stg_ladder": ("rank_tier_at_match", "rank_lp_at_match")}


def unread(columns: Collection[str]) -> list[str]:
    """Tables of the fact that give none of ``columns`` and, with one row per player, no further rows either.

    The team rows and the queue dimension are always read: a repeated team row or a second mode multiplies fact rows.
    """
    return [name for name, given in _BY_PLAYER.items() if not set(given) & set(columns)]


def _player_lookup(dim_player: DataFrame | None, stg_ladder: DataFrame | None) -> DataFrame | None:
    """Surrogate key and ladder row per player, for one join instead of two on the same key."""
    lookups_by_player = []
    if dim_player is not None:
        lookups_by_player.append(dim_player.select(*PLAYER_KEY))
    if stg_ladder is not None:
        lookups_by_player.append(stg_ladder.select(
            "puuid", F.col("platform").alias("_platform"), F.col("tier").alias("_tier"), F.col("league_points").alias("_lp")
        ))
    if len(lookups_by_player) == 2:
        return lookups_by_player[0].join(lookups_by_player[1], "puuid", "full")
    return lookups_by_player[0] if lookups_by_player else None


# What the joins below read of the participants; all other columns may be derived behind them.
JOINED_BY = ("match_id", "team_id", "puuid", "platform", "queue_id", "game_version")


def fact_joins(
    participants: DataFrame, teams: DataFrame, stg_ladder: DataFrame | None, dim_player: DataFrame | None,
    dim_queue_patch: DataFrame,
) -> DataFrame:
    """Participants with team statistics, ladder rank and dimension keys.

    The narrow queue dimension goes first: once its key is attached, queue and version need not
    travel through the two large shuffles. ``stg_ladder`` and ``dim_player`` hold one row per
    player, so they merge into one lookup and the participants are shuffled by player once.
    A second mode for one (queue, version), or a repeated team row, multiplies fact rows.
    Where neither ranks nor keys of players are asked for, see ``unread``, ``stg_ladder`` or ``dim_player`` are None and
    their columns are left out; without both there is no shuffle by player.
    """
    patch = broadcast_if_small(dim_queue_patch.select("queue_id", "game_version", "queue_patch_key"))
    stats = teams.select("match_id", "team_id", *[F.col(old).alias(new) for old, new in TEAM_STATS.items()])
    same_platform = F.col("platform") == F.col("_platform")
    joined = (
        participants.join(patch, ["queue_id", "game_version"], "left").drop("queue_id", "game_version")
        .join(stats, ["match_id", "team_id"], "left")
    )
    by_player = _player_lookup(dim_player, stg_ladder)
    if by_player is not None:
        joined = joined.join(by_player, "puuid", "left")
    if stg_ladder is None:
        return joined
    return joined.withColumns({
        "rank_tier_at_match": F.when(same_platform, F.col("_tier")),
        "rank_lp_at_match": F.when(same_platform, F.col("_lp")),
    })


def fact_columns(
    joined: DataFrame, assets: Assets = Assets(), names: Collection[str] = tuple(FACT_COLUMNS),
) -> DataFrame:
    """The fact's columns, or those of ``names``, from ``fact_joins`` rows; a month column added to those rows stays.

    The image addresses make a row several times wider, so this comes after the last shuffle.
    """
    started = epoch_ms("game_start_timestamp")
    derived = {
        "game_start_datetime": started,
        "date_key": date_key(F.to_date(started)),
        "champion_image_url": assets.champion_icon(F.col("champion_name")),
        "champion_splash_url": assets.champion_splash(F.col("champion_name")),
        "spell1_image_url": assets.known_spell(F.col("summoner1_id")),
        "spell2_image_url": assets.known_spell(F.col("summoner2_id")),
        "keystone_rune_image_url": assets.keystone(F.col("perk_keystone")),
        "primary_rune_tree_image_url": assets.rune_tree(F.col("perk_primary_style")),
        "secondary_rune_tree_image_url": assets.rune_tree(F.col("perk_secondary_style")),
        **{f"{slot}_image_url": assets.item_slot(F.col(slot)) for slot in ITEM_SLOTS},
        "role_icon": code_lookup("team_position", lookups.ROLE_ICONS, lookups.UNKNOWN_ROLE_ICON),
    }
    absent = {n for given in _BY_PLAYER.values() for n in given} - set(joined.columns)
    names = [n for n in FACT_COLUMNS if n in names and n not in absent] + [MONTH] * (MONTH in joined.columns)
    return joined.select(*[derived.get(n, F.col(FACT_RENAMES.get(n, n))).alias(n) for n in names])


def fct_participant_match(
    participants: DataFrame,
    teams: DataFrame,
    stg_ladder: DataFrame | None,
    dim_player: DataFrame | None,
    dim_queue_patch: DataFrame,
    assets: Assets = Assets(),
) -> DataFrame:
    """One row per participant row, with everything a report needs; tables may be None as for ``fact_joins``."""
    return fact_columns(fact_joins(participants, teams, stg_ladder, dim_player, dim_queue_patch), assets)


def fct_participant_match_by_month(*tables: DataFrame | None) -> DataFrame:
    """The fact with its month, gathered by month for writing. Takes the tables of the fact."""
    return fact_columns(gather_months(fact_joins(*tables), epoch_ms("game_start_timestamp")))
