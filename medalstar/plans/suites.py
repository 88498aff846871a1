"""The declared data checks of the silver and gold tables (47 in all)."""

from __future__ import annotations

from medalstar.functions.lookups import LADDER_TIERS
from medalstar.operators.quality import Checks

SUITES = {
    "stg_ladder": Checks(
        not_null=["puuid", "platform", "tier", "league_points", "ingest_ts"],
        unique=["puuid"],
        accepted={"tier": LADDER_TIERS},
    ),
    "stg_matches_participants": Checks(
        not_null=["match_id", "participant_id", "puuid", "champion_id", "win", "ingest_ts"],
    ),
    "stg_matches_teams": Checks(not_null=["match_id", "team_id", "win"]),
    "dim_date": Checks(not_null=["date_key", "calendar_date"], unique=["date_key"]),
    "dim_player": Checks(not_null=["player_key", "puuid", "platform"], unique=["player_key", "puuid"]),
    "dim_champion": Checks(not_null=["champion_key", "champion_id", "champion_name"], unique=["champion_key"]),
    "dim_spell": Checks(not_null=["spell_key", "spell_id"], unique=["spell_key"]),
    "dim_item": Checks(not_null=["item_key", "item_id"], unique=["item_key"]),
    "dim_queue_patch": Checks(
        not_null=["queue_patch_key", "queue_id", "game_version"], unique=["queue_patch_key"],
    ),
    "fct_participant_match": Checks(
        not_null=["match_id", "puuid", "date_key", "champion_key", "win"],
        relationships={
            "date_key": ("dim_date", "date_key"),
            "player_key": ("dim_player", "player_key"),
            "champion_key": ("dim_champion", "champion_key"),
            "queue_patch_key": ("dim_queue_patch", "queue_patch_key"),
        },
    ),
}
