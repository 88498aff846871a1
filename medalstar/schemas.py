"""Schemas of the raw JSON documents and of the bronze tables. Nothing is inferred."""

from __future__ import annotations

import re

from pyspark.sql import types as T

LONG, TEXT, FLAG = T.LongType(), T.StringType(), T.BooleanType()

# ---- Fixed values: JSON field names of one participant, grouped as the bronze table is. ----
IDENTITY_REQUIRED = {"puuid": TEXT, "participantId": LONG, "teamId": LONG}
IDENTITY_OPTIONAL = {"summonerName": TEXT, "riotIdGameName": TEXT, "riotIdTagline": TEXT}
CHAMPION = {"championId": LONG, "championName": TEXT, "teamPosition": TEXT, "lane": TEXT, "win": FLAG}
SCORE = {"kills": LONG, "deaths": LONG, "assists": LONG}
ECONOMY_REQUIRED = {"goldEarned": LONG, "totalMinionsKilled": LONG}
ECONOMY_OPTIONAL = {
    "neutralMinionsKilled": LONG,
    "totalAllyJungleMinionsKilled": LONG,
    "totalEnemyJungleMinionsKilled": LONG,
}
DAMAGE = {
    "totalDamageDealtToChampions": LONG,
    "totalDamageTaken": LONG,
    "damageSelfMitigated": LONG,
    "totalDamageShieldedOnTeammates": LONG,
    "totalHealsOnTeammates": LONG,
    "damageDealtToBuildings": LONG,
    "damageDealtToObjectives": LONG,
}
OBJECTIVES = {"dragonKills": LONG, "turretKills": LONG, "turretsLost": LONG, "objectivesStolen": LONG}
VISION = {"visionScore": LONG, "wardsPlaced": LONG, "wardsKilled": LONG, "detectorWardsPlaced": LONG}
FLOW = {
    "firstBloodKill": FLAG,
    "firstBloodAssist": FLAG,
    "firstTowerKill": FLAG,
    "firstTowerAssist": FLAG,
    "gameEndedInEarlySurrender": FLAG,
    "gameEndedInSurrender": FLAG,
}
SURVIVAL = {
    "longestTimeSpentLiving": LONG,
    "largestKillingSpree": LONG,
    "totalTimeCCDealt": LONG,
    "totalTimeSpentDead": LONG,
}
LOADOUT = {"summoner1Id": LONG, "summoner2Id": LONG, **{f"item{i}": LONG for i in range(7)}}

# Bronze names that do not follow from the JSON name by the snake-case rule.
RENAMED = {"riotIdGameName": "riot_id_name", "detectorWardsPlaced": "control_wards_placed"}

MATCH_REQUIRED = {
    "platformId": TEXT,
    "queueId": LONG,
    "gameMode": TEXT,
    "gameVersion": TEXT,
    "gameCreation": LONG,
    "gameStartTimestamp": LONG,
    "gameEndTimestamp": LONG,
}
OBJECTIVE_NAMES = ["baron", "dragon", "riftHerald", "tower", "inhibitor", "champion"]
# ---- End of fixed values ----

PARTICIPANT_REQUIRED = {
    **IDENTITY_REQUIRED, **CHAMPION, **SCORE, **ECONOMY_REQUIRED, **DAMAGE, **OBJECTIVES,
    **VISION, **FLOW, **SURVIVAL, **LOADOUT,
}
PARTICIPANT_OPTIONAL = {**IDENTITY_OPTIONAL, **ECONOMY_OPTIONAL}


def snake(name: str) -> str:
    """camelCase to snake_case, keeping runs of capitals together (``CCDealt`` -> ``cc_dealt``)."""
    if name in RENAMED:
        return RENAMED[name]
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name).lower()


def _struct(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


PERKS = _struct({
    "styles": T.ArrayType(_struct({"style": LONG, "selections": T.ArrayType(_struct({"perk": LONG}))})),
    "statPerks": _struct({"defense": LONG, "flex": LONG, "offense": LONG}),
})
PARTICIPANT = _struct({**PARTICIPANT_REQUIRED, **PARTICIPANT_OPTIONAL, "perks": PERKS})
TEAM = _struct({
    "teamId": LONG,
    "win": FLAG,
    "objectives": _struct({name: _struct({"kills": LONG, "first": FLAG}) for name in OBJECTIVE_NAMES}),
    "bans": T.ArrayType(_struct({"championId": LONG})),
})
MATCH_DOCUMENT = _struct({
    "metadata": _struct({"matchId": TEXT}),
    "info": _struct({
        **MATCH_REQUIRED,
        "gameDuration": LONG,
        "participants": T.ArrayType(PARTICIPANT),
        "teams": T.ArrayType(TEAM),
    }),
})
LADDER_DOCUMENT = _struct({
    "entries": T.ArrayType(_struct({
        "puuid": TEXT, "rank": TEXT, "leaguePoints": LONG, "wins": LONG, "losses": LONG,
    })),
})

MATCH_LIST = _struct({"puuid": TEXT, "ids": T.ArrayType(TEXT)})

LADDER = _struct({
    "platform": TEXT, "puuid": TEXT, "tier": TEXT, "rank": TEXT,
    "league_points": LONG, "wins": LONG, "losses": LONG, "ingest_ts": TEXT,
})
RANK_HISTORY = _struct({"puuid": TEXT, "platform": TEXT, "tier": TEXT, "league_points": LONG, "recorded_ms": LONG})
MATCH_IDS = _struct({
    "match_id": TEXT, "puuid": TEXT, "platform": TEXT, "region": TEXT, "queue_id": LONG, "ingest_ts": TEXT,
})


def _bronze_names(fields: dict[str, T.DataType]) -> dict[str, T.DataType]:
    return {snake(name): dtype for name, dtype in fields.items()}


RUNE_COLUMNS = [
    "perk_keystone", "perk_primary_row_1", "perk_primary_row_2", "perk_primary_row_3",
    "perk_secondary_row_1", "perk_secondary_row_2", "perk_primary_style", "perk_secondary_style",
    "perk_shard_defense", "perk_shard_flex", "perk_shard_offense",
]
PARTICIPANTS = _struct({
    "match_id": TEXT, "platform": TEXT, "queue_id": LONG, "game_mode": TEXT, "game_version": TEXT,
    "game_duration": LONG, "game_creation": LONG, "game_start_timestamp": LONG, "game_end_timestamp": LONG,
    "puuid": TEXT, **_bronze_names(IDENTITY_OPTIONAL), "participant_id": LONG, "team_id": LONG, "side": TEXT,
    **_bronze_names(CHAMPION), **_bronze_names(SCORE),
    **_bronze_names(ECONOMY_REQUIRED), **_bronze_names(ECONOMY_OPTIONAL),
    **_bronze_names(DAMAGE), **_bronze_names(OBJECTIVES), **_bronze_names(VISION),
    **_bronze_names(FLOW), **_bronze_names(SURVIVAL), **_bronze_names(LOADOUT),
    **{name: LONG for name in RUNE_COLUMNS},
    "ingest_ts": TEXT,
})
TEAMS = _struct({
    "match_id": TEXT, "team_id": LONG, "side": TEXT, "win": FLAG,
    **{f"{snake(name)}_kills": LONG for name in OBJECTIVE_NAMES},
    **{f"first_{snake(name)}": FLAG for name in OBJECTIVE_NAMES[:-1]}, "first_blood": FLAG,
    **{f"ban_{i}": LONG for i in range(1, 6)},
    "game_version": TEXT, "queue_id": LONG, "ingest_ts": TEXT,
})

BRONZE = {
    "ladder": LADDER,
    "match_ids": MATCH_IDS,
    "matches_participants": PARTICIPANTS,
    "matches_teams": TEAMS,
}
