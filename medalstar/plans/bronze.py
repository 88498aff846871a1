"""Raw JSON to the four bronze tables. ``ingest_ts`` is passed in, so a rerun gives equal rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalstar import schemas
from medalstar.functions import lookups
from medalstar.functions.scalars import code_lookup
from medalstar.operators.keys import dedupe_first
from medalstar.operators.topk import ladder_waterfall


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0).cast("bigint"))


def side_of(team_id: Column) -> Column:
    return code_lookup(team_id, lookups.SIDES, lookups.UNKNOWN_SIDE)


def element_or_zero(array: Column, position: int, field: str) -> Column:
    """Field of the array element at a 0-based position; 0 when the array is short or the field missing."""
    return or_zero(F.get(array, position)[field])


def rune_columns(perks: Column) -> dict[str, Column]:
    """The 11 rune columns: four primary and two secondary picks, two trees, three shards."""
    styles, shards = perks["styles"], perks["statPerks"]
    primary, secondary = (F.get(styles, i)["selections"] for i in (0, 1))
    values = [
        *(element_or_zero(primary, i, "perk") for i in range(4)),
        *(element_or_zero(secondary, i, "perk") for i in range(2)),
        *(element_or_zero(styles, i, "style") for i in (0, 1)),
        *(or_zero(shards[name]) for name in ("defense", "flex", "offense")),
    ]
    return dict(zip(schemas.RUNE_COLUMNS, values))


def optional_columns(participant: Column) -> dict[str, Column]:
    """The keys that a participant may lack: empty text and zero in their place."""
    return {
        **{schemas.snake(name): F.coalesce(participant[name], F.lit("")) for name in schemas.IDENTITY_OPTIONAL},
        **{schemas.snake(name): or_zero(participant[name]) for name in schemas.ECONOMY_OPTIONAL},
    }


def objective_columns(objectives: Column) -> dict[str, Column]:
    """Kills and first-taken flag per objective; champion takedowns count as first blood."""
    kills = {f"{schemas.snake(n)}_kills": or_zero(objectives[n]["kills"]) for n in schemas.OBJECTIVE_NAMES}
    firsts = {
        "first_blood" if n == "champion" else f"first_{schemas.snake(n)}":
            F.coalesce(objectives[n]["first"], F.lit(False))
        for n in schemas.OBJECTIVE_NAMES
    }
    return {**kills, **firsts}


def _ordered(columns: dict[str, Column], names: Sequence[str]) -> list[Column]:
    return [columns[name].alias(name) for name in names]


def _match_level(*names: str) -> list[Column]:
    """The match id and fields of ``info``, under their bronze names."""
    return [F.col("metadata.matchId").alias("match_id"), *[F.col(f"info.{n}").alias(schemas.snake(n)) for n in names]]


def flatten_participants(documents: DataFrame, ingest_ts: str) -> DataFrame:
    """One row per participant of accepted match documents."""
    p = F.col("p")
    rows = documents.select(
        *_match_level(*schemas.MATCH_REQUIRED, "gameDuration"), F.explode("info.participants").alias("p")
    )
    columns = {
        **{name: F.col(name) for name in rows.columns},
        "platform": F.col("platform_id"),
        "game_duration": or_zero(F.col("game_duration")),
        **{schemas.snake(name): p[name] for name in schemas.PARTICIPANT_REQUIRED},
        **optional_columns(p),
        "side": side_of(p["teamId"]),
        **rune_columns(p["perks"]),
        "ingest_ts": F.lit(ingest_ts),
    }
    return rows.select(*_ordered(columns, schemas.PARTICIPANTS.names))


def flatten_teams(documents: DataFrame, ingest_ts: str) -> DataFrame:
    """One row per team of accepted match documents."""
    team = F.col("t")
    rows = documents.select(*_match_level("gameVersion", "queueId"), F.explode("info.teams").alias("t"))
    columns = {
        **{name: F.col(name) for name in rows.columns},
        "team_id": team["teamId"],
        "side": side_of(team["teamId"]),
        "win": team["win"],
        **objective_columns(team["objectives"]),
        **{f"ban_{i + 1}": element_or_zero(team["bans"], i, "championId") for i in range(5)},
        "ingest_ts": F.lit(ingest_ts),
    }
    return rows.select(*_ordered(columns, schemas.TEAMS.names))


def player_matches(documents: DataFrame, puuid: str) -> DataFrame:
    """One player's line of every match they took part in.

    The player is picked inside the document's own array, so other participants never become rows.
    """
    mine = F.get(F.filter("info.participants", lambda p: p["puuid"] == puuid), 0)
    rows = documents.select(F.col("metadata.matchId").alias("match_id"), "info", mine.alias("me"))
    return rows.filter(F.col("me").isNotNull()).select(
        "match_id",
        F.col("info.gameDuration").alias("game_duration"),
        F.col("info.gameMode").alias("game_mode"),
        F.col("me.championName").alias("champion"),
        "me.kills", "me.deaths", "me.assists", "me.win",
        (F.col("me.totalMinionsKilled") + or_zero(F.col("me.neutralMinionsKilled"))).alias("cs"),
    )


def usable_entry(entry: Column) -> Column:
    """A ladder entry needs a player and points."""
    return entry["puuid"].isNotNull() & entry["leaguePoints"].isNotNull()


def rejected_entries(documents: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep``, reason and value of parsed ladder documents that are unreadable and of entries that lack a key."""
    entry = documents.select(*keep, F.explode("entries").alias("entry"))
    lacking = entry.filter(~usable_entry(F.col("entry"))).select(
        *keep, F.lit("entry without player or points").alias("reason"), F.to_json("entry").alias("value"))
    unreadable = documents.filter(F.col("entries").isNull())
    return unreadable.select(*keep, F.lit("unreadable").alias("reason"), "value").unionByName(lacking)


def flatten_ladder(
    documents: DataFrame, platform: str, ingest_ts: str, k: int | None, tiers: Sequence[str] = lookups.LADDER_TIERS
) -> DataFrame:
    """Top ``k`` players (all of them if None) from parsed ladder documents (columns ``tier``, ``entries``).

    ``tiers`` names the tiers from the top; a document of another tier is an error, not a loss.
    """
    listed = F.col("tier").isin(list(tiers))
    known = documents.withColumn("tier", F.when(listed, F.col("tier")).otherwise(
        F.raise_error(F.concat(F.lit("ladder tier not listed: "), F.coalesce("tier", F.lit("none"))))))
    entries = known.select("tier", F.inline(F.filter("entries", usable_entry)))
    rows = entries.select(
        F.lit(platform.upper()).alias("platform"), "puuid", "tier", "rank",
        F.col("leaguePoints").alias("league_points"), "wins", "losses", F.lit(ingest_ts).alias("ingest_ts"),
    )
    return rows if k is None else ladder_waterfall(rows, tiers, "tier", "league_points", k, ["tier", "puuid"])


def match_ids(
    lists: DataFrame, arrival: str, platform: str, region: str, queue_id: int, ingest_ts: str, per_player: int | None
) -> DataFrame:
    """First appearance of every match over the players' match lists (columns ``puuid``, ``ids``, ``arrival``).

    Only the first ``per_player`` ids of a list count, all of them if None. A match stays with the earliest player.
    """
    counted = F.col("ids") if per_player is None else F.slice("ids", 1, per_player)
    ids = lists.select(arrival, "puuid", F.posexplode(counted).alias("_place", "match_id"))
    return dedupe_first(ids, ["match_id"], [arrival, "puuid", "_place"]).select(
        "match_id", "puuid",
        F.lit(platform).alias("platform"), F.lit(region).alias("region"),
        F.lit(queue_id).cast("bigint").alias("queue_id"), F.lit(ingest_ts).alias("ingest_ts"),
    )
