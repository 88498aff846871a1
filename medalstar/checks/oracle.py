"""The expected result of every query, as one SQL text over the same Parquet tables.

Written against the rules of the models, not against the Spark plans: the fact, for example, is a
chain of plain left joins here. Only the fixed lookup values and the derivation of the bronze
tables are shared with the Spark side.
"""

from __future__ import annotations

import re

from medalstar import schemas
from medalstar.functions import lookups
from medalstar.plans.suites import SUITES
from medalstar.sources import samples

DIALECT = {
    "@order_ms@": "epoch_ms(o_orderdate)",
    "@ship_iso@": "strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S')",
    "@team_ids@": "unnest([100, 200])",
    "@snapshots@": "unnest([1, 2])",
    "@tab@": "chr(9)",
    "@shuffled@": "",
}
INGEST = "2025-01-06T00:00:00"
CDN = lookups.ASSET_CDN
IMG = f"{CDN}/{lookups.ASSET_VERSION}/img"
RUNES = f"{CDN}/img/perk-images/Styles"
TRIMMED = r"nullif(regexp_replace(summoner_name, '^\s+|\s+$', '', 'g'), '')"


def quoted(value) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def case_of(column: str, table: dict, default: str = "NULL") -> str:
    arms = " ".join(f"WHEN {quoted(code)} THEN {quoted(value)}" for code, value in table.items())
    return f"CASE {column} {arms} ELSE {default} END"


def in_list(values) -> str:
    return "(" + ", ".join(quoted(v) for v in values) + ")"


SPELL_URLS = {code: f"{IMG}/spell/{key}.png" for code, key, _ in lookups.SPELLS}
KEYSTONE_URLS = {code: f"{RUNES}/{path}" for code, path in lookups.KEYSTONES.items()}
TREE_URLS = {code: f"{RUNES}/{path}" for code, path in lookups.RUNE_TREES.items()}
EMBLEM_URLS = {t: f"{lookups.EMBLEM_BASE}/emblem-{t.lower()}.png" for t in lookups.EMBLEM_TIERS}
ROLE_ICON = case_of("team_position", lookups.ROLE_ICONS, quoted(lookups.UNKNOWN_ROLE_ICON))
QUEUE_NAME = case_of("queue_id", lookups.QUEUES, quoted(lookups.OTHER_QUEUE))
SPELL_ROWS = ", ".join(f"({code}, '{key}', '{name}')" for code, key, name in lookups.SPELLS)


def item_url(slot: str) -> str:
    return f"CASE WHEN {slot} > 0 THEN '{IMG}/item/' || CAST({slot} AS VARCHAR) || '.png' END"


ITEM_URLS = ", ".join(f"{item_url(f'item{i}')} AS item{i}_image_url" for i in range(7))
ITEM_SLOTS = ", ".join(f"item{i}" for i in range(7))
ALL_ITEMS = " UNION ".join(f"SELECT item{i} AS item_id FROM stg_matches_participants" for i in range(7))
BOTH_SPELLS = (
    "SELECT summoner1_id AS spell_id FROM stg_matches_participants "
    "UNION SELECT summoner2_id FROM stg_matches_participants"
)


def bronze_sql(name: str) -> str:
    return samples.in_dialect(samples.SQL[name], DIALECT).format(
        customer="customer", orders="orders", lineitem="lineitem"
    )


# ---- expected values of the JSON documents, by order k and participant i ----


def _number(a: int, b: int, modulus: int) -> str:
    return f"((k * {a} + i * {b}) % {modulus})"


def _pick_sql(style: int, position: int) -> str:
    shown = f"(k + i) % 3 >= {style + 1} AND (k + i * {style + 1}) % 5 >= {position + 1}"
    return f"CASE WHEN {shown} THEN {8000 + 10 * position + style} + k % 7 ELSE 0 END"


def _runes() -> dict[str, str]:
    shard = "CASE WHEN k % 4 <> 0 THEN (k + i * {}) % {} ELSE 0 END"
    values = [
        *[_pick_sql(0, p) for p in range(4)],
        *[_pick_sql(1, p) for p in range(2)],
        *[f"CASE WHEN (k + i) % 3 >= {s + 1} THEN {8000 + 100 * s} + i ELSE 0 END" for s in (0, 1)],
        shard.format(1, 3), shard.format(2, 4), shard.format(3, 5),
    ]
    return dict(zip(schemas.RUNE_COLUMNS, values))


def _json_participant_columns() -> dict[str, str]:
    columns = {
        "match_id": "'J_' || k",
        "platform": "'VN2'",
        "queue_id": "400 + k % 60",
        "game_mode": "CASE WHEN k % 6 = 2 THEN 'ARAM' ELSE 'CLASSIC' END",
        "game_version": "'14.' || (k % 24) || '.1'",
        "game_duration": "CASE WHEN k % 8 <> 0 THEN 60 * (k % 40) ELSE 0 END",
        "game_creation": "epoch_ms(o_orderdate) - 5000",
        "game_start_timestamp": "epoch_ms(o_orderdate)",
        "game_end_timestamp": "epoch_ms(o_orderdate) + 60000 * (k % 40)",
        "ingest_ts": f"'{INGEST}'",
    }
    for place, (name, dtype) in enumerate(schemas.PARTICIPANT_REQUIRED.items(), start=1):
        if dtype == schemas.FLAG:
            value = f"{_number(place, 3, 2)} = 0"
        elif dtype == schemas.TEXT:
            value = f"'{name}_' || {_number(place, 1, 20)}"
        else:
            value = _number(place, 5, 500 + place)
        columns[schemas.snake(name)] = value
    for place, (name, dtype) in enumerate(schemas.PARTICIPANT_OPTIONAL.items(), start=2):
        text = dtype == schemas.TEXT
        value = f"'n' || {_number(place, 1, 90)}" if text else _number(place, 1, 90)
        absent = "''" if text else "0"
        columns[schemas.snake(name)] = f"CASE WHEN {_number(1, place, 4)} <> 0 THEN {value} ELSE {absent} END"
    team = "CASE WHEN i <= 5 THEN 100 WHEN k % 9 = 0 THEN 300 ELSE 200 END"
    columns.update({
        "puuid": f"'P_' || {_number(1, 7, 100)}",
        "participant_id": "i",
        "team_id": team,
        "side": f"CASE {team} WHEN 100 THEN 'blue' WHEN 200 THEN 'red' ELSE 'unknown' END",
        **_runes(),
    })
    return columns


def _json_team_columns() -> dict[str, str]:
    team = "CASE WHEN t = 1 THEN 100 WHEN k % 9 = 0 THEN 300 ELSE 200 END"
    columns = {
        "match_id": "'J_' || k",
        "team_id": team,
        "side": f"CASE {team} WHEN 100 THEN 'blue' WHEN 200 THEN 'red' ELSE 'unknown' END",
        "win": "(k + t) % 2 = 0",
        "game_version": "'14.' || (k % 24) || '.1'",
        "queue_id": "400 + k % 60",
        "ingest_ts": f"'{INGEST}'",
    }
    for p, name in enumerate(schemas.OBJECTIVE_NAMES):
        there, short = f"(k + {p}) % 6 <> 0", schemas.snake(name)
        first = "first_blood" if name == "champion" else f"first_{short}"
        columns[f"{short}_kills"] = f"CASE WHEN {there} AND (k + {p}) % 5 <> 0 THEN (k + t + {p}) % 12 ELSE 0 END"
        columns[first] = f"CASE WHEN {there} AND (k + {p}) % 7 <> 0 THEN (k + t + {p}) % 2 = 0 ELSE FALSE END"
    for b in range(1, 6):
        listed = f"(k + t) % 7 >= {b} AND (k + {b}) % 8 <> 0"
        columns[f"ban_{b}"] = f"CASE WHEN {listed} THEN (k * {b} + t) % 160 ELSE 0 END"
    return columns


def _select_list(columns: dict[str, str], schema) -> str:
    kinds = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN"}
    return ", ".join(
        f"CAST({columns[f.name]} AS {kinds[f.dataType.simpleString()]}) AS {f.name}" for f in schema.fields
    )


# ---- named subqueries; each text lists only what the ones before it define ----

CTES = {
    "matches_participants": bronze_sql("matches_participants"),
    "matches_teams": bronze_sql("matches_teams"),
    "ladder": bronze_sql("ladder"),
    "match_ids": bronze_sql("match_ids"),
    "rank_history": bronze_sql("rank_history"),
    # One rank per player and moment.
    "rank_held": """
        SELECT puuid, platform, tier, league_points, recorded_ms FROM rank_history
        WHERE puuid IS NOT NULL AND recorded_ms IS NOT NULL
        QUALIFY row_number() OVER (
            PARTITION BY puuid, platform, recorded_ms ORDER BY tier NULLS LAST, league_points NULLS LAST) = 1""",
    "json_participants":
        f"SELECT {_select_list(_json_participant_columns(), schemas.PARTICIPANTS)} "
        "FROM (SELECT o_orderkey AS k, o_orderdate, unnest(range(1, o_orderkey % 10 + 2)) AS i FROM orders)",
    "json_teams":
        f"SELECT {_select_list(_json_team_columns(), schemas.TEAMS)} "
        "FROM (SELECT o_orderkey AS k, unnest([1, 2]) AS t FROM orders)",
    "stg_ladder": """
        SELECT puuid, upper(platform) AS platform, tier, league_points, wins, losses, wins + losses AS total_games,
               CASE WHEN wins + losses > 0 THEN wins / (wins + losses) ELSE 0 END AS winrate,
               CAST(ingest_ts AS TIMESTAMP) AS ingest_ts
        FROM ladder WHERE puuid IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY puuid ORDER BY ingest_ts DESC, platform, tier, league_points) = 1""",
    "stg_matches_teams": "SELECT * REPLACE (CAST(ingest_ts AS TIMESTAMP) AS ingest_ts) FROM matches_teams",
    "stg_matches_participants": """
        SELECT * REPLACE (CAST(ingest_ts AS TIMESTAMP) AS ingest_ts),
               (kills + assists) / CASE deaths WHEN 0 THEN 1 ELSE deaths END AS kda,
               total_minions_killed + neutral_minions_killed AS total_cs,
               CASE WHEN game_duration > 0 THEN gold_earned / (game_duration / 60) ELSE 0 END AS gold_per_minute,
               CASE WHEN game_duration > 0 THEN total_cs / (game_duration / 60) ELSE 0 END AS cs_per_minute
        FROM matches_participants""",
    "dim_champion": f"""
        SELECT DISTINCT champion_id AS champion_key, champion_id, champion_name,
               '{IMG}/champion/' || champion_name || '.png' AS champion_image_url,
               '{CDN}/img/champion/splash/' || champion_name || '_0.jpg' AS champion_splash_url,
               '{CDN}/img/champion/loading/' || champion_name || '_0.jpg' AS champion_loading_url
        FROM stg_matches_participants WHERE champion_id IS NOT NULL""",
    "dim_date": """
        SELECT CAST(strftime(calendar_date, '%Y%m%d') AS INTEGER) AS date_key, calendar_date,
               extract(year FROM calendar_date) AS year, extract(quarter FROM calendar_date) AS quarter,
               extract(month FROM calendar_date) AS month, strftime(calendar_date, '%b') AS month_name,
               extract(week FROM calendar_date) AS week_of_year, extract(day FROM calendar_date) AS day,
               extract(isodow FROM calendar_date) AS day_of_week, strftime(calendar_date, '%a') AS day_name,
               extract(isodow FROM calendar_date) IN (6, 7) AS is_weekend
        FROM (SELECT DISTINCT CAST(make_timestamp(game_start_timestamp * 1000) AS DATE) AS calendar_date
              FROM stg_matches_participants WHERE game_start_timestamp IS NOT NULL)""",
    "dim_item": f"""
        SELECT item_id AS item_key, item_id, '{IMG}/item/' || CAST(item_id AS VARCHAR) || '.png' AS item_image_url
        FROM ({ALL_ITEMS}) WHERE item_id > 0""",
    "spell_reference": f"SELECT * FROM (VALUES {SPELL_ROWS}) AS t(spell_id, spell_key, spell_name)",
    "dim_spell": f"""
        SELECT u.spell_id AS spell_key, u.spell_id,
               coalesce(r.spell_name, 'Spell ' || CAST(u.spell_id AS VARCHAR)) AS spell_name,
               coalesce(r.spell_key, 'Summoner' || CAST(u.spell_id AS VARCHAR)) AS spell_key_name,
               '{IMG}/spell/' || coalesce(r.spell_key, 'Summoner' || CAST(u.spell_id AS VARCHAR)) || '.png'
                   AS spell_image_url
        FROM ({BOTH_SPELLS}) u LEFT JOIN spell_reference r ON u.spell_id = r.spell_id
        WHERE u.spell_id > 0""",
    "dim_queue_patch": f"""
        SELECT row_number() OVER (ORDER BY queue_id, game_version NULLS LAST, game_mode NULLS LAST) AS queue_patch_key,
               queue_id, game_mode, queue_id IN {in_list(lookups.RANKED_QUEUES)} AS is_ranked,
               {QUEUE_NAME} AS queue_name, game_version,
               string_split(game_version, '.')[1] || '.' || string_split(game_version, '.')[2] AS patch_major,
               string_split(game_version, '.')[1] AS patch_season
        FROM (SELECT DISTINCT queue_id, game_mode, game_version FROM stg_matches_participants
              WHERE queue_id IS NOT NULL)""",
    "current_players": f"""
        SELECT puuid, platform, coalesce({TRIMMED}, riot_id_name) AS summoner_name, riot_id_name, riot_id_tagline
        FROM stg_matches_participants WHERE puuid IS NOT NULL
        QUALIFY row_number() OVER (
            PARTITION BY puuid
            ORDER BY {TRIMMED} IS NULL, ingest_ts DESC, platform,
                     coalesce({TRIMMED}, riot_id_name), riot_id_name, riot_id_tagline) = 1""",
    "dim_player": f"""
        SELECT row_number() OVER (ORDER BY p.puuid) AS player_key, p.*,
               l.tier AS current_tier, l.league_points AS current_lp, l.wins AS current_wins,
               l.losses AS current_losses, l.winrate AS current_winrate,
               {case_of("l.tier", EMBLEM_URLS)} AS rank_emblem_url
        FROM current_players p LEFT JOIN stg_ladder l ON p.puuid = l.puuid AND p.platform = l.platform""",
    "fct_participant_match": f"""
        SELECT p.match_id, p.puuid, p.participant_id, p.team_id,
               CAST(strftime(make_timestamp(p.game_start_timestamp * 1000), '%Y%m%d') AS INTEGER) AS date_key,
               d.player_key, p.champion_id AS champion_key, q.queue_patch_key,
               p.platform, p.side, p.team_position,
               make_timestamp(p.game_start_timestamp * 1000) AS game_start_datetime,
               p.game_duration AS game_duration_seconds,
               p.champion_id, p.champion_name,
               '{IMG}/champion/' || p.champion_name || '.png' AS champion_image_url,
               '{CDN}/img/champion/splash/' || p.champion_name || '_0.jpg' AS champion_splash_url,
               p.win, p.kills, p.deaths, p.assists, p.kda, p.largest_killing_spree,
               p.total_damage_dealt_to_champions AS damage_to_champions, p.total_damage_taken AS damage_taken,
               p.gold_earned, p.total_cs, p.gold_per_minute, p.cs_per_minute,
               p.vision_score, p.wards_placed, p.wards_killed, p.total_time_spent_dead AS time_spent_dead,
               p.summoner1_id AS spell1_id, p.summoner2_id AS spell2_id,
               {case_of("p.summoner1_id", SPELL_URLS)} AS spell1_image_url,
               {case_of("p.summoner2_id", SPELL_URLS)} AS spell2_image_url,
               p.perk_keystone AS keystone_rune_id, p.perk_primary_style AS primary_rune_tree,
               p.perk_secondary_style AS secondary_rune_tree,
               {case_of("p.perk_keystone", KEYSTONE_URLS)} AS keystone_rune_image_url,
               {case_of("p.perk_primary_style", TREE_URLS)} AS primary_rune_tree_image_url,
               {case_of("p.perk_secondary_style", TREE_URLS)} AS secondary_rune_tree_image_url,
               {ITEM_SLOTS}, {ITEM_URLS}, {ROLE_ICON} AS role_icon,
               t.baron_kills AS team_baron_kills, t.dragon_kills AS team_dragon_kills,
               t.rift_herald_kills AS team_rift_herald_kills, t.tower_kills AS team_tower_kills,
               t.champion_kills AS team_total_kills, t.first_blood AS team_first_blood,
               t.first_dragon AS team_first_dragon, t.first_baron AS team_first_baron,
               l.tier AS rank_tier_at_match, l.league_points AS rank_lp_at_match, p.ingest_ts
        FROM stg_matches_participants p
        LEFT JOIN stg_matches_teams t ON p.match_id = t.match_id AND p.team_id = t.team_id
        LEFT JOIN stg_ladder l ON p.puuid = l.puuid AND p.platform = l.platform
        LEFT JOIN dim_player d ON p.puuid = d.puuid
        LEFT JOIN dim_queue_patch q ON p.queue_id = q.queue_id AND p.game_version = q.game_version""",
}
# Steps whose rank filter or size makes it worth computing them once per statement.
COMPUTED_ONCE = {"stg_ladder", "stg_matches_participants", "fct_participant_match", "dim_player"}
INPUT_NAMES = set(samples.INPUT_SCHEMAS)


def complete(sql: str) -> str:
    """The statement with the named subqueries it needs, in order of definition."""
    needed: set[str] = set()

    def collect(text: str, own: str = "") -> None:
        for name in CTES:
            if name != own and name not in needed and re.search(rf"\b(FROM|JOIN) {name}\b", text):
                needed.add(name)
                collect(CTES[name], name)

    collect(sql)
    parts = [
        f"{name} AS {'MATERIALIZED ' if name in COMPUTED_ONCE else ''}({CTES[name]})" for name in CTES if name in needed
    ]
    return f"WITH {', '.join(parts)} {sql}" if parts else sql


P = "FROM stg_matches_participants"
ARRIVAL = ", ".join(samples.ARRIVAL)
MATCH_ID_COLUMNS = ", ".join(schemas.MATCH_IDS.names)
WINS = ("count(*) AS games, count(*) FILTER (WHERE win) AS wins, "
        "count(*) FILTER (WHERE win) / count(win) AS win_rate")
JSON_SIDES = "SELECT match_id, team_id, side FROM json_teams"


def means(*columns: str) -> str:
    exact = "CAST(sum(CAST({0} AS DECIMAL(18, 6))) AS DOUBLE) / count({0}) AS avg_{0}"
    return ", ".join(exact.format(c) for c in columns)


def report_sql() -> str:
    legs = []

    def leg(table: str, column: str, test: str, failures: str) -> None:
        legs.append(
            f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{test}' AS test_name, "
            f"failures, failures = 0 AS passed FROM (SELECT {failures} AS failures)"
        )

    for table, suite in SUITES.items():
        for c in suite.not_null:
            leg(table, c, "not_null", f"(SELECT count(*) FROM {table} WHERE {c} IS NULL)")
        for c in suite.unique:
            leg(table, c, "unique", f"(SELECT count(*) FROM (SELECT {c} FROM {table} WHERE {c} IS NOT NULL "
                                    f"GROUP BY {c} HAVING count(*) > 1))")
        for c, values in (suite.accepted or {}).items():
            leg(table, c, "accepted_values",
                f"(SELECT count(DISTINCT {c}) FROM {table} WHERE {c} NOT IN {in_list(values)})")
        for c, (parent, key) in (suite.relationships or {}).items():
            leg(table, c, "relationships",
                f"(SELECT count(*) FROM {table} WHERE {c} IS NOT NULL "
                f"AND {c} NOT IN (SELECT {key} FROM {parent}))")
    return " UNION ALL ".join(legs)


LADDER_LIST = in_list(lookups.LADDER_TIERS)
TIER_PLACE = "CASE tier WHEN 'CHALLENGER' THEN 1 WHEN 'GRANDMASTER' THEN 2 ELSE 3 END"


def waterfall_sql(source: str, k: int, ties: str, columns: str) -> str:
    return f"""
        SELECT {columns} FROM {source}
        WHERE tier = 'CHALLENGER'
           OR tier = 'GRANDMASTER' AND (SELECT count(*) FROM {source} WHERE tier = 'CHALLENGER') < {k}
           OR tier = 'MASTER' AND (SELECT count(*) FROM {source} WHERE tier IN ('CHALLENGER', 'GRANDMASTER')) < {k}
        ORDER BY league_points DESC, {ties} LIMIT {k}"""


LADDER_ENTRIES = f"""
    SELECT 'VN2' AS platform, 'P_' || c_custkey || '_' || n AS puuid,
           CASE WHEN floor(c_acctbal) >= 9000 THEN 'CHALLENGER' WHEN floor(c_acctbal) >= 7000 THEN 'GRANDMASTER'
                ELSE 'MASTER' END AS tier,
           'I' AS rank, CAST(floor(c_acctbal) AS BIGINT) + n AS league_points, c_custkey % 200 AS wins,
           c_custkey % 70 + n AS losses, '{INGEST}' AS ingest_ts
    FROM (SELECT *, unnest([1, 2]) AS n FROM customer)"""
CTES["ladder_entries"] = LADDER_ENTRIES

TEAM_RESULTS = "SELECT DISTINCT match_id, team_id, side, win{} FROM fct_participant_match"


def bucket_sql(column: str) -> str:
    return f"CASE WHEN {column} = 0 THEN '0' WHEN {column} <= 2 THEN '1-2' WHEN {column} > 2 THEN '3+' END"


def objective_sql() -> str:
    firsts = ["team_first_blood", "team_first_dragon", "team_first_baron"]
    kills = ["team_dragon_kills", "team_baron_kills"]
    source = TEAM_RESULTS.format(", " + ", ".join(firsts + kills))
    legs = [f"SELECT '{c}' AS objective, CAST({c} AS VARCHAR) AS bucket, win FROM ({source})" for c in firsts]
    legs += [f"SELECT '{c}' AS objective, {bucket_sql(c)} AS bucket, win FROM ({source})" for c in kills]
    return (
        f"SELECT objective, bucket, {WINS} FROM ({' UNION ALL '.join(legs)}) "
        "WHERE bucket IS NOT NULL GROUP BY objective, bucket"
    )


VERSION = """concat_ws('.', '14', CASE WHEN o_orderkey % 4 <> 0 THEN CAST(month(o_orderdate) AS VARCHAR) END,
                   CASE WHEN o_orderkey % 4 > 1 THEN '1' END)"""

STATEMENTS = {
    # scans and sinks
    "scan_parquet": "SELECT * FROM orders",
    "load_row_counts": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in samples.INPUT_SCHEMAS
    ),
    "fact_partitions": "SELECT strftime(game_start_datetime, '%Y-%m') AS game_month, count(*) AS rows "
                       "FROM fct_participant_match GROUP BY 1",
    "partition_profile": "SELECT strftime(game_start_datetime, '%Y-%m') AS game_month, count(*) AS rows, "
                         "min(game_start_datetime) AS min_value, max(game_start_datetime) AS max_value "
                         "FROM fct_participant_match GROUP BY 1",
    "pruned_scan": "SELECT match_id, participant_id, date_key, strftime(game_start_datetime, '%Y-%m') AS game_month, "
                   "kills FROM fct_participant_match WHERE game_start_datetime >= TIMESTAMP '1996-03-10 00:00:00' "
                   "AND game_start_datetime < TIMESTAMP '1997-02-05 12:00:00'",
    "footer_profile": "SELECT strftime(game_start_datetime, '%Y-%m') AS game_month, count(*) AS rows, "
                      "count(*) - count(date_key) AS nulls, min(date_key) AS min_value, max(date_key) AS max_value, "
                      "TRUE AS known FROM fct_participant_match GROUP BY 1",
    "pruned_by_dimension": """
        SELECT match_id, participant_id, date_key, strftime(game_start_datetime, '%Y-%m') AS game_month, kills
        FROM fct_participant_match WHERE date_key IN (
            SELECT date_key FROM dim_date WHERE year = 1996 AND quarter = 2 AND is_weekend)""",
    "clustered_scan": f"""
        SELECT match_id, participant_id, puuid, champion_id, game_start_timestamp, kills {P}
        WHERE puuid = 'P_42' OR champion_id = 17""",
    "lookup_values": "SELECT CAST(r.spell_id AS BIGINT) AS spell_id, r.spell_key, r.spell_name, count(*) AS uses FROM stg_matches_participants p "
                     "JOIN spell_reference r ON p.summoner1_id = r.spell_id GROUP BY ALL",
    "json_scan": "SELECT event_id, CAST(regexp_extract(props, '\"k\": *(-?[0-9]+)', 1) AS BIGINT) AS k FROM events",
    "insert_from_files": "SELECT * FROM orders",
    "append_rows": "SELECT * FROM orders",
    "replace_table": "SELECT * FROM customer",
    "load_status": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count, FALSE AS failed FROM {n}"
        for n in ("orders", "customer", "lineitem")
    ) + " UNION ALL SELECT 'absent', NULL, TRUE",
    "upsert_months": """
        SELECT *, strftime(o_orderdate, '%Y-%m') AS game_month FROM (
            SELECT o_orderkey, o_custkey,
                   CASE WHEN o_orderkey % 50 = 7 THEN o_orderdate + INTERVAL 40 DAYS ELSE o_orderdate END AS o_orderdate,
                   CASE WHEN o_orderkey % 50 <> 7 AND o_orderkey % 3 <> 1 AND o_orderkey % 2 = 0 THEN o_totalprice + 1
                        ELSE o_totalprice END AS o_totalprice, o_orderstatus
            FROM orders)""",
    "replace_versioned": """
        SELECT moment, count(*) AS rows, sum(o_orderkey)::BIGINT AS key_sum
        FROM orders, (SELECT unnest(['after a failure', 'reader from before', 'after']) AS moment)
        WHERE moment = 'after' OR o_orderkey % 2 = 0 GROUP BY moment""",
    "select_present": "SELECT c_name, c_custkey FROM customer",
    # JSON documents
    "flatten_participants": "SELECT * FROM json_participants",
    "flatten_teams": "SELECT * FROM json_teams",
    "array_get_default": f"SELECT match_id, participant_id, {', '.join(schemas.RUNE_COLUMNS)} FROM json_participants",
    "struct_get_default": "SELECT * EXCLUDE (side, win, ban_1, ban_2, ban_3, ban_4, ban_5, game_version, queue_id, "
                          "ingest_ts) FROM json_teams",
    "optional_default": "SELECT match_id, participant_id, game_duration, summoner_name, riot_id_name, riot_id_tagline, "
                        "neutral_minions_killed, total_ally_jungle_minions_killed, total_enemy_jungle_minions_killed "
                        "FROM json_participants",
    "code_label": JSON_SIDES,
    "reject_malformed": """
        SELECT o_orderkey AS doc_id,
               CASE o_orderkey % 10 WHEN 0 THEN 'unreadable' WHEN 1 THEN 'match id missing'
                    WHEN 2 THEN 'match field missing' WHEN 3 THEN 'participant field missing'
                    ELSE 'team field missing' END AS reason
        FROM orders WHERE o_orderkey % 10 < 5""",
    "player_matches": """
        SELECT match_id, CASE WHEN k % 8 <> 0 THEN game_duration END AS game_duration, game_mode,
               champion_name AS champion, kills, deaths, assists, win,
               total_minions_killed + neutral_minions_killed AS cs
        FROM (SELECT *, CAST(substr(match_id, 3) AS BIGINT) AS k FROM json_participants WHERE puuid = 'P_42')
        QUALIFY row_number() OVER (PARTITION BY match_id ORDER BY participant_id) = 1""",
    "json_lookup": """
        SELECT p_partkey AS id, p_name AS name FROM part
        UNION SELECT p_partkey + 1000000, upper(p_name) FROM part WHERE p_partkey % 3 <> 1 AND p_partkey % 5 <> 0""",
    "flatten_ladder": waterfall_sql("ladder_entries", 500, "tier, puuid", "*"),
    # One entry of a document lacks its points where k % 10 is 2.
    "reject_ladder": """
        SELECT c_custkey AS doc_id,
               CASE WHEN floor(c_acctbal) >= 9000 THEN 'CHALLENGER' WHEN floor(c_acctbal) >= 7000 THEN 'GRANDMASTER'
                    ELSE 'MASTER' END AS tier,
               CASE c_custkey % 10 WHEN 0 THEN 'unreadable' ELSE 'entry without player or points' END AS reason
        FROM (SELECT *, unnest(CASE c_custkey % 10 WHEN 1 THEN [1, 2] ELSE [1] END) AS n FROM customer)
        WHERE c_custkey % 10 < 3""",
    "match_ids": f"""
        SELECT match_id, puuid, 'vn2' AS platform, 'sea' AS region, CAST(420 AS BIGINT) AS queue_id,
               '{INGEST}' AS ingest_ts
        FROM (SELECT 'M_' || (c_custkey * 3 + j) AS match_id, 'P_' || c_custkey AS puuid, c_custkey, j
              FROM (SELECT c_custkey, unnest(range(0, 20)) AS j FROM customer))
        QUALIFY row_number() OVER (PARTITION BY match_id ORDER BY c_custkey, j) = 1""",
    # projections and filters
    "project_rename": "SELECT match_id, team_id, baron_kills AS team_baron_kills, dragon_kills AS team_dragon_kills, "
                      "rift_herald_kills AS team_rift_herald_kills, tower_kills AS team_tower_kills, "
                      "champion_kills AS team_total_kills, first_blood AS team_first_blood, "
                      "first_dragon AS team_first_dragon, first_baron AS team_first_baron FROM stg_matches_teams",
    "filter_not_null": f"SELECT match_id, participant_id, puuid {P} WHERE puuid IS NOT NULL",
    "filter_positive": f"SELECT match_id, participant_id, summoner1_id {P} WHERE summoner1_id > 0",
    "in_list_flag": f"SELECT match_id, participant_id, queue_id, queue_id IN (420, 440) AS is_ranked {P}",
    # joins
    "join_rank_as_of": """
        SELECT p.match_id, p.participant_id, p.puuid, p.platform, p.game_start_timestamp,
               h.tier AS rank_tier_then, h.league_points AS rank_lp_then,
               make_timestamp(h.recorded_ms * 1000) AS rank_since
        FROM stg_matches_participants p ASOF LEFT JOIN rank_held h
            ON p.puuid = h.puuid AND p.platform = h.platform AND p.game_start_timestamp >= h.recorded_ms""",
    "join_hot_keys": """
        SELECT l.*, o.o_orderkey, o.o_custkey FROM (
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   CASE WHEN l_suppkey % 3 = 0 THEN 7 WHEN l_partkey % 90 <> 1 THEN l_orderkey END AS key FROM lineitem) l
        LEFT JOIN (
            SELECT CASE WHEN o_orderkey <= 12 THEN 7 ELSE o_orderkey END AS key, o_orderkey, o_custkey
            FROM orders WHERE o_orderkey % 10 <> 5) o ON l.key = o.key""",
    "join_team_stats": """
        SELECT p.match_id, p.team_id, p.participant_id, t.dragon_kills, t.tower_kills, t.first_blood
        FROM stg_matches_participants p
        LEFT JOIN stg_matches_teams t ON p.match_id = t.match_id AND p.team_id = t.team_id""",
    "join_rank_snapshot": """
        SELECT p.match_id, p.participant_id, p.puuid, p.platform, l.tier, l.league_points AS lp
        FROM stg_matches_participants p LEFT JOIN stg_ladder l ON p.puuid = l.puuid AND p.platform = l.platform""",
    "join_player_key": """
        SELECT p.match_id, p.participant_id, p.puuid, d.player_key
        FROM stg_matches_participants p LEFT JOIN dim_player d ON p.puuid = d.puuid""",
    "join_queue_patch": """
        SELECT p.match_id, p.participant_id, p.queue_id, p.game_version, q.queue_patch_key
        FROM stg_matches_participants p
        LEFT JOIN dim_queue_patch q ON p.queue_id = q.queue_id AND p.game_version = q.game_version""",
    "join_lookup_fallback": """
        SELECT p.match_id, p.participant_id, p.summoner1_id AS spell_id,
               coalesce(r.spell_name, 'Spell ' || CAST(p.summoner1_id AS VARCHAR)) AS spell_name
        FROM stg_matches_participants p LEFT JOIN spell_reference r ON p.summoner1_id = r.spell_id""",
    "star_join": """
        SELECT f.match_id, f.participant_id, p.summoner_name, c.champion_name, f.kills, f.deaths, f.assists
        FROM fct_participant_match f
        JOIN dim_player p ON f.player_key = p.player_key
        JOIN dim_champion c ON f.champion_key = c.champion_key""",
    "fk_orphans": """
        SELECT child_key AS l_orderkey, count(*) AS child_rows FROM (
            SELECT CASE WHEN l_partkey % 50 = 0 THEN l_orderkey + 1000000000000 ELSE l_orderkey END AS child_key FROM lineitem)
        WHERE child_key NOT IN (SELECT o_orderkey FROM orders) GROUP BY child_key""",
    # aggregation and set operations
    "distinct_dates": f"SELECT DISTINCT CAST(make_timestamp(game_start_timestamp * 1000) AS DATE) AS day {P}",
    "distinct_combo": f"SELECT DISTINCT queue_id, game_mode, game_version {P}",
    "dedupe_first": f"""
        SELECT {MATCH_ID_COLUMNS} FROM match_ids
        QUALIFY row_number() OVER (PARTITION BY match_id ORDER BY {ARRIVAL}) = 1""",
    "dedupe_participants": f"""
        SELECT * {P} QUALIFY row_number() OVER (
            PARTITION BY match_id, participant_id ORDER BY ingest_ts DESC, {', '.join(schemas.PARTICIPANTS.names)}) = 1""",
    "participants_per_match": f"SELECT match_id, count(*) AS participants {P} GROUP BY match_id",
    "union_distinct": f"SELECT spell_id FROM ({BOTH_SPELLS}) WHERE spell_id IS NOT NULL",
    "unpivot_distinct": f"SELECT item_id FROM ({ALL_ITEMS}) WHERE item_id IS NOT NULL",
    "distinct_bitmap": f"SELECT item_id FROM ({ALL_ITEMS}) WHERE item_id IS NOT NULL",
    "distinct_bitmap_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS of, strftime(game_start_datetime, '{period}') AS period, count(DISTINCT id) AS ids "
        f"FROM (SELECT game_start_datetime, unnest([{slots}]) AS id FROM fct_participant_match) GROUP BY 2"
        for name, slots in (("champion", "champion_id"), ("spell", "spell1_id, spell2_id")) for period in ("%Y-%m", "%Y")),
    "union_all": """
        SELECT puuid, tier, league_points, CAST(NULL AS VARCHAR) AS match_id FROM ladder
        UNION ALL SELECT puuid, NULL, NULL, match_id FROM match_ids""",
    # windows
    "latest_per_key": """
        SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""",
    "preferred_latest": "SELECT * FROM current_players",
    "latest_as_of": """
        SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders
        WHERE o_orderdate <= TIMESTAMP '1997-06-30 00:00:00'
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""",
    "surrogate_key": f"""
        SELECT row_number() OVER (ORDER BY puuid) AS player_key, puuid
        FROM (SELECT DISTINCT puuid {P} WHERE puuid IS NOT NULL)""",
    "surrogate_key_incremental": """
        WITH members AS (
            SELECT p_brand AS brand, CASE WHEN p_size % 7 <> 0 THEN p_name END AS name,
                   min(CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 2 END) AS ingest
            FROM part WHERE p_partkey % 3 = 0 OR p_partkey % 5 <> 0 GROUP BY ALL)
        SELECT row_number() OVER (ORDER BY ingest, brand NULLS LAST, name NULLS LAST) AS part_key, brand, name FROM members""",
    "latest_incremental": """
        SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""",
    "surrogate_key_composite": """
        SELECT row_number() OVER (ORDER BY brand NULLS LAST, name NULLS LAST) AS part_key, brand, name
        FROM (SELECT DISTINCT p_brand AS brand, CASE WHEN p_size % 7 <> 0 THEN p_name END AS name FROM part)""",
    # top-k
    "top_k": "SELECT puuid, tier, league_points, ingest_ts FROM ladder "
             "ORDER BY league_points DESC, puuid, ingest_ts, tier LIMIT 100",
    "limit_n": f"SELECT match_id, count(*) AS participants {P} GROUP BY match_id "
               "ORDER BY participants DESC, match_id LIMIT 5",
    "ladder_waterfall": waterfall_sql("stg_ladder", 250, "puuid", "puuid, tier, league_points"),
    "tier_major_rank": f"""
        SELECT puuid, tier, league_points,
               row_number() OVER (ORDER BY {TIER_PLACE}, league_points DESC, puuid) AS rank
        FROM stg_ladder WHERE tier IN ('CHALLENGER', 'GRANDMASTER')
        QUALIFY rank <= 500""",
    "first_n_ids": f"""
        SELECT match_id FROM (
            SELECT match_id, {ARRIVAL} FROM match_ids
            QUALIFY row_number() OVER (PARTITION BY match_id ORDER BY {ARRIVAL}) = 1)
        ORDER BY {ARRIVAL}, match_id LIMIT 200""",
    "top_n_per_key": f"""
        SELECT {MATCH_ID_COLUMNS} FROM match_ids
        QUALIFY row_number() OVER (PARTITION BY puuid ORDER BY {ARRIVAL}) <= 20""",
    # scalar expressions
    "str_upper": "SELECT puuid, ingest_ts, upper(platform) AS platform FROM ladder",
    "blank_fallback": f"SELECT match_id, participant_id, coalesce({TRIMMED}, riot_id_name) AS name {P}",
    "url_template": f"""
        SELECT match_id, participant_id, '{IMG}/champion/' || champion_name || '.png' AS icon,
               '{CDN}/img/champion/splash/' || champion_name || '_0.jpg' AS splash,
               '{CDN}/img/champion/loading/' || champion_name || '_0.jpg' AS loading,
               '{IMG}/item/' || CAST(item0 AS VARCHAR) || '.png' AS item {P}""",
    "version_parts": f"""
        SELECT o_orderkey, version,
               string_split(version, '.')[1] || '.' || string_split(version, '.')[2] AS patch_major,
               string_split(version, '.')[1] AS patch_season
        FROM (SELECT o_orderkey, {VERSION} AS version FROM orders)""",
    "code_lookup_url": f"""
        SELECT match_id, participant_id, {case_of("summoner1_id", SPELL_URLS)} AS spell_url,
               {case_of("perk_keystone", KEYSTONE_URLS)} AS keystone_url,
               {case_of("perk_primary_style", TREE_URLS)} AS tree_url, {ROLE_ICON} AS role_icon {P}""",
    "case_label": f"SELECT match_id, participant_id, queue_id, {QUEUE_NAME} AS queue_name {P}",
    "cond_url": f"SELECT match_id, participant_id, {ITEM_URLS} {P}",
    "safe_ratio": """
        SELECT puuid, ingest_ts, CASE WHEN wins + losses > 0 THEN wins / (wins + losses) ELSE 0 END AS winrate
        FROM ladder""",
    "per_minute": f"SELECT match_id, participant_id, gold_per_minute {P}",
    "kda": f"SELECT match_id, participant_id, kda {P}",
    "derived_sum": "SELECT puuid, ingest_ts, wins + losses AS total_games FROM ladder",
    "iso_timestamp": "SELECT puuid, CAST(ingest_ts AS TIMESTAMP) AS ingest_ts FROM ladder",
    "epoch_ms": """
        SELECT match_id, participant_id, make_timestamp(ms * 1000) AS exact,
               make_timestamp(CAST(round(ms / 100.0) AS BIGINT) * 100000) AS tenths,
               CAST(strftime(make_timestamp(ms * 1000), '%Y%m%d') AS INTEGER) AS date_key
        FROM (SELECT match_id, participant_id, game_start_timestamp + kills * 53 AS ms FROM matches_participants)""",
    "date_dim": "",
    # models
    "stg_ladder": "SELECT * FROM stg_ladder",
    "stg_matches_teams": "SELECT * FROM stg_matches_teams",
    "stg_matches_participants": "SELECT * FROM stg_matches_participants",
    "dim_champion": "SELECT * FROM dim_champion",
    "dim_date": "SELECT * FROM dim_date",
    "dim_item": "SELECT * FROM dim_item",
    "dim_spell": "SELECT * FROM dim_spell",
    "dim_queue_patch": "SELECT * FROM dim_queue_patch",
    "dim_player": "SELECT * FROM dim_player",
    "fct_participant_match": "SELECT * FROM fct_participant_match",
    # business questions
    "champion_winrate_by_patch": f"""
        SELECT f.champion_key, f.champion_name, q.patch_major, {WINS}
        FROM fct_participant_match f JOIN dim_queue_patch q ON f.queue_patch_key = q.queue_patch_key
        GROUP BY ALL""",
    "player_performance": f"""
        SELECT player_key, puuid, {WINS}, {means("kda", "gold_per_minute", "cs_per_minute")}
        FROM fct_participant_match WHERE player_key IS NOT NULL GROUP BY player_key, puuid""",
    "side_winrate": f"SELECT side, {WINS} FROM ({TEAM_RESULTS.format('')}) GROUP BY side",
    "objective_impact": objective_sql(),
    "role_analysis": f"""
        SELECT team_position, {WINS},
               {means("kda", "gold_per_minute", "cs_per_minute", "vision_score", "damage_to_champions")}
        FROM fct_participant_match GROUP BY team_position""",
    # data checks
    "dq_not_null": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS failures {P} WHERE {c} IS NULL"
        for c in ("match_id", "puuid", "deaths", "win")
    ),
    "dq_unique": f"SELECT match_id, puuid, count(*) AS rows {P} WHERE match_id IS NOT NULL AND puuid IS NOT NULL "
                 "GROUP BY match_id, puuid HAVING count(*) > 1",
    "dq_accepted_values": f"SELECT tier, count(*) AS rows FROM stg_ladder WHERE tier NOT IN {LADDER_LIST} GROUP BY tier",
    "dq_report": report_sql(),
    "json_presence": """
        SELECT path, objects, absent, nulls FROM (
            SELECT '$.event_id' AS path, count(*) AS objects, 0::BIGINT AS absent, 0::BIGINT AS nulls FROM events
            UNION ALL SELECT '$.event_type', count(*), count(*) FILTER (event_id % 7 = 0),
                count(*) FILTER (event_id % 7 = 1) FROM events
            UNION ALL SELECT '$.parts', count(*), 0, 0 FROM events
            UNION ALL SELECT '$.parts[*].k', count(*) + count(*) FILTER (event_id % 3 = 0),
                count(*) FILTER (props IS NULL), count(*) FILTER (event_id % 3 = 0) FROM events)""",
    "json_unknown_keys": """
        SELECT '$' AS path, 'debug' AS key, count(*) AS documents FROM events WHERE user_id % 5 = 0
        UNION ALL SELECT '$.parts[*]', 'old', count(*) FROM events WHERE event_id % 3 = 0""",
}
STATEMENTS["date_dim"] = CTES["dim_date"].replace(
    "make_timestamp(game_start_timestamp * 1000)", "l_shipdate"
).replace("FROM stg_matches_participants WHERE game_start_timestamp IS NOT NULL", "FROM lineitem")
for _name in ("champion_winrate_by_patch", "player_performance", "side_winrate", "objective_impact", "role_analysis"):
    STATEMENTS[f"{_name}_partials"] = STATEMENTS[_name]

ORACLE = {name: " ".join(complete(sql).split()) for name, sql in STATEMENTS.items()}
