"""Bronze-shaped tables and JSON documents derived from the order tables in ``TESTDATA.md``.

The derivations are plain SQL shared with the checks; ``@name@`` marks the few spots where two SQL
dialects differ. Values repeat, are blank, zero or NULL on purpose, so that every rule of the
pipeline has rows to act on.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from medalstar import schemas
from medalstar.functions.lookups import KEYSTONES
from medalstar.session import bytes_of
from medalstar.sources import match_texts
from medalstar.sources.tables import scan

INPUT_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

SPARK_DIALECT = {
    "@order_ms@": "unix_millis(CAST(o_orderdate AS TIMESTAMP))",
    "@ship_iso@": "date_format(l_shipdate, \"yyyy-MM-dd'T'HH:mm:ss\")",
    "@team_ids@": "explode(array(100L, 200L))",
    "@snapshots@": "explode(array(1, 2))",
    "@tab@": r"'\t'",
    # Both inputs are large at scale; shuffling them also spreads a single small file over tasks.
    "@shuffled@": "/*+ MERGE(o) */",
}


def _pick(index: str, values: list[str]) -> str:
    """CASE over 0-based positions."""
    arms = " ".join(f"WHEN {i} THEN {value}" for i, value in enumerate(values))
    return f"CASE {index} {arms} END"


def _counter(a: int, b: int, modulus: int) -> str:
    return f"(l_partkey * {a} + l_suppkey * {b}) % {modulus}"


def _chance(modulus: int) -> str:
    return f"(l_partkey + l_suppkey) % {modulus} = 0"


_KEYSTONE_CODES = [str(code) for code in sorted(KEYSTONES)] + ["1"]
_TEAM = "CASE WHEN l_linenumber % 2 = 0 THEN 100 ELSE 200 END"
_START = "@order_ms@ + (o_orderkey % 86400) * 1000"
_DURATION = "CASE WHEN l_quantity = 1 THEN 0 ELSE l_quantity * 60 END"

# Bigint columns are cast where the table is assembled, so only the values are stated here.
PARTICIPANT_VALUES = {
    "match_id": "concat('M_', CAST(o_orderkey AS STRING))",
    "platform": "CASE WHEN o_orderkey % 13 = 0 THEN 'OC1' ELSE 'VN2' END",
    "queue_id": _pick("o_orderkey % 6", ["420", "440", "450", "400", "430", "490"]),
    # One (queue, version) pair gets a second mode.
    "game_mode": "CASE WHEN o_orderkey % 6 = 2 THEN 'ARAM' WHEN o_orderkey % 36 = 3 AND month(o_orderdate) = 3 "
                 "THEN 'EVENT' ELSE 'CLASSIC' END",
    "game_version": "concat('14.', CAST(month(o_orderdate) AS STRING), '.', CAST(o_orderkey % 3 AS STRING))",
    "game_duration": _DURATION,
    "game_creation": f"{_START} - 60000",
    "game_start_timestamp": _START,
    "game_end_timestamp": f"{_START} + CAST(l_quantity AS BIGINT) * 60000",
    "puuid": "CASE WHEN l_partkey % 211 = 0 THEN NULL ELSE concat('P_', CAST("
             "(o_custkey * 7 + l_linenumber * 13) % (SELECT count(*) FROM {customer}) AS STRING)) END",
    "summoner_name": "CASE l_suppkey % 4 WHEN 0 THEN '' WHEN 1 THEN concat(' ', @tab@) "
                     "ELSE concat(' S', CAST(l_suppkey AS STRING), @tab@) END",
    "riot_id_name": "concat('R', CAST(o_custkey AS STRING))",
    "riot_id_tagline": "concat('T', CAST(l_suppkey % 5 AS STRING))",
    "participant_id": "l_linenumber",
    "team_id": _TEAM,
    "side": "CASE WHEN l_linenumber % 2 = 0 THEN 'blue' ELSE 'red' END",
    "champion_id": "l_partkey % 160",
    # Champion 7 has been renamed.
    "champion_name": "CASE WHEN l_partkey % 160 = 7 AND l_suppkey % 2 = 0 THEN 'Seven' "
                     "ELSE concat('C', CAST(l_partkey % 160 AS STRING)) END",
    "team_position": _pick("l_linenumber % 6", ["'TOP'", "'JUNGLE'", "'MIDDLE'", "'BOTTOM'", "'UTILITY'", "''"]),
    "lane": _pick("l_linenumber % 3", ["'TOP'", "'MIDDLE'", "'NONE'"]),
    "win": "(l_linenumber + o_orderkey) % 2 = 0",
    "kills": "CAST(l_quantity AS BIGINT) % 20",
    "deaths": "CASE WHEN l_partkey % 223 = 0 THEN NULL ELSE l_linenumber % 5 END",
    "assists": "l_suppkey % 15",
    "gold_earned": f"5000 + {_counter(7, 3, 9000)}",
    "total_minions_killed": _counter(3, 1, 250),
    "neutral_minions_killed": _counter(1, 5, 90),
    "total_ally_jungle_minions_killed": _counter(1, 2, 60),
    "total_enemy_jungle_minions_killed": _counter(2, 1, 30),
    "total_damage_dealt_to_champions": f"3000 + {_counter(11, 7, 40000)}",
    "total_damage_taken": f"2000 + {_counter(13, 5, 45000)}",
    "damage_self_mitigated": _counter(5, 11, 50000),
    "total_damage_shielded_on_teammates": _counter(3, 7, 8000),
    "total_heals_on_teammates": _counter(2, 9, 7000),
    "damage_dealt_to_buildings": _counter(4, 3, 12000),
    "damage_dealt_to_objectives": _counter(6, 5, 30000),
    "dragon_kills": _counter(1, 1, 4),
    "turret_kills": _counter(1, 3, 6),
    "turrets_lost": _counter(3, 1, 9),
    "objectives_stolen": _counter(1, 7, 2),
    "vision_score": _counter(2, 3, 90),
    "wards_placed": _counter(1, 4, 40),
    "wards_killed": _counter(4, 1, 15),
    "control_wards_placed": _counter(2, 5, 8),
    "first_blood_kill": _chance(10),
    "first_blood_assist": _chance(9),
    "first_tower_kill": _chance(8),
    "first_tower_assist": _chance(7),
    "game_ended_in_early_surrender": "o_orderkey % 40 = 0",
    "game_ended_in_surrender": "o_orderkey % 5 = 0",
    "longest_time_spent_living": _counter(9, 2, 1200),
    "largest_killing_spree": _counter(1, 6, 12),
    "total_time_cc_dealt": _counter(5, 4, 400),
    "total_time_spent_dead": _counter(7, 8, 300),
    "summoner1_id": "l_suppkey % 35",
    "summoner2_id": "l_linenumber + 3",
    **{f"item{i}": f"(l_partkey * {i + 1}) % 50" for i in range(7)},
    "perk_keystone": _pick("l_partkey % 18", _KEYSTONE_CODES),
    **{f"perk_primary_row_{i}": f"9000 + {_counter(1, i, 60)}" for i in (1, 2, 3)},
    **{f"perk_secondary_row_{i}": f"8300 + {_counter(2, i, 60)}" for i in (1, 2)},
    "perk_primary_style": "8000 + (l_partkey % 6) * 100",
    "perk_secondary_style": "8000 + (l_suppkey % 6) * 100",
    "perk_shard_defense": "5001 + l_partkey % 3",
    "perk_shard_flex": "5002 + l_suppkey % 3",
    "perk_shard_offense": "5005 + l_partkey % 2",
    "ingest_ts": "@ship_iso@",
}

TEAM_VALUES = {
    # Some teams belong to no match of the participants.
    "match_id": "concat('M_', CAST(o_orderkey AS STRING), CASE WHEN o_orderkey % 17 = 0 AND team = 200 THEN 'x' "
                "ELSE '' END)",
    "team_id": "team",
    "side": "CASE WHEN team = 100 THEN 'blue' ELSE 'red' END",
    "win": "(team / 100 + o_orderkey) % 2 = 1",
    "baron_kills": "(o_orderkey + team) % 3",
    "dragon_kills": "(o_orderkey + team) % 5",
    "rift_herald_kills": "(o_orderkey + team) % 2",
    "tower_kills": "(o_orderkey * 3 + team) % 12",
    "inhibitor_kills": "(o_orderkey * 5 + team) % 4",
    "champion_kills": "(o_orderkey * 7 + team) % 60",
    "first_baron": "(o_orderkey + team) % 7 = 0",
    "first_dragon": "(o_orderkey + team / 100) % 2 = 0",
    "first_rift_herald": "(o_orderkey + team) % 4 = 0",
    "first_tower": "(o_orderkey * 3 + team) % 7 < 3",
    "first_inhibitor": "(o_orderkey + team) % 11 < 4",
    "first_blood": "(o_orderkey * 5 + team) % 9 < 4",
    **{f"ban_{i}": f"(o_orderkey * {i} + team) % 160" for i in range(1, 6)},
    "game_version": PARTICIPANT_VALUES["game_version"],
    "queue_id": PARTICIPANT_VALUES["queue_id"],
    "ingest_ts": "'2025-01-02T10:00:00.123456'",
}

LADDER_VALUES = {
    "platform": "CASE WHEN c_custkey % 2 = 0 THEN 'vn2' ELSE 'VN2' END",
    # Some ladder players appear in no match.
    "puuid": "CASE WHEN c_custkey % 101 = 100 THEN NULL WHEN c_custkey % 7 = 0 THEN "
             "concat('Q_', CAST(c_custkey AS STRING)) ELSE concat('P_', CAST(c_custkey AS STRING)) END",
    "tier": "CASE WHEN c_acctbal >= 8000 THEN 'CHALLENGER' WHEN c_acctbal >= 5000 THEN 'GRANDMASTER' "
            "WHEN c_acctbal >= 0 THEN 'MASTER' ELSE 'DIAMOND' END",
    "rank": "'I'",
    "league_points": "floor(c_acctbal) + snap",
    "wins": "CASE WHEN c_custkey % 10 = 0 THEN 0 WHEN c_custkey % 31 = 0 THEN NULL ELSE c_custkey % 200 END",
    "losses": "CASE WHEN c_custkey % 10 = 0 THEN 0 ELSE c_nationkey END",
    # The second snapshot is the older one for some, and as old as the first for others.
    "ingest_ts": "concat('2025-01-0', CAST(CASE WHEN c_custkey % 3 = 0 THEN 3 - snap WHEN c_custkey % 11 = 0 THEN 1 "
                 "ELSE snap END AS STRING), 'T10:00:00.123456')",
}

MATCH_ID_VALUES = {
    "match_id": "concat('M_', CAST(l_orderkey AS STRING))",
    "puuid": "concat('P_', CAST(l_suppkey AS STRING))",
    "platform": "'vn2'",
    "region": "'sea'",
    "queue_id": "420",
    "ingest_ts": "@ship_iso@",
}


# Past ranks: one per order, some of one player at one moment, some of nobody.
RANK_HISTORY_VALUES = {
    "puuid": "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE concat('P_', CAST("
             "(o_custkey * 7 + (o_orderkey % 5) * 13) % (SELECT count(*) FROM {customer}) AS STRING)) END",
    "platform": "CASE WHEN o_orderkey % 13 = 0 THEN 'OC1' ELSE 'VN2' END",
    "tier": "CASE WHEN o_totalprice >= 300000 THEN 'CHALLENGER' WHEN o_totalprice >= 150000 THEN 'GRANDMASTER' "
            "WHEN o_orderkey % 31 = 0 THEN NULL ELSE 'MASTER' END",
    "league_points": "CAST(floor(o_totalprice) AS BIGINT) % 1000",
    "recorded_ms": "CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE @order_ms@ + (o_orderkey % 3) * 43200000 END",
}


def _typed(values: dict[str, str], schema, names: Collection[str] | None = None) -> list[str]:
    """The columns, or those of ``names``, each cast to its bronze type."""
    wanted = [f for f in schema.fields if names is None or f.name in names]
    return [f"CAST({values[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in wanted]


def _select(values: dict[str, str], schema) -> str:
    return ", ".join(_typed(values, schema))


# One SQL text per bronze table; inputs are written {name}.
SQL = {
    "matches_participants":
        f"SELECT @shuffled@ {_select(PARTICIPANT_VALUES, schemas.PARTICIPANTS)} "
        "FROM {lineitem} JOIN {orders} o ON l_orderkey = o_orderkey",
    "matches_teams":
        f"SELECT {_select(TEAM_VALUES, schemas.TEAMS)} "
        "FROM (SELECT o_orderkey, o_orderdate, @team_ids@ AS team FROM {orders})",
    "ladder":
        f"SELECT {_select(LADDER_VALUES, schemas.LADDER)} "
        "FROM (SELECT c_custkey, c_acctbal, c_nationkey, @snapshots@ AS snap FROM {customer})",
    "match_ids":
        f"SELECT {_select(MATCH_ID_VALUES, schemas.MATCH_IDS)}, "
        "l_orderkey, l_linenumber, l_partkey, l_suppkey FROM {lineitem}",
    "rank_history": f"SELECT {_select(RANK_HISTORY_VALUES, schemas.RANK_HISTORY)} FROM {{orders}}",
}
# Columns that order the match_ids rows by arrival; rows equal in all of them are equal throughout.
ARRIVAL = ["ingest_ts", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def in_dialect(sql: str, dialect: dict[str, str]) -> str:
    for mark, text in dialect.items():
        sql = sql.replace(mark, text)
    return sql


def inputs(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: scan(spark, f"{sf_dir}/{n}.parquet", StructType.fromDDL(INPUT_SCHEMAS[n])) for n in names}


def bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One bronze-shaped table."""
    tables = inputs(spark, sf_dir, "customer", "orders", "lineitem")
    text = in_dialect(SQL[name], SPARK_DIALECT)
    return spark.sql(text, **{n: df for n, df in tables.items() if f"{{{n}}}" in text})


def participant_sources(spark: SparkSession, sf_dir: str, early: Collection[str]) -> DataFrame:
    """The lines with their orders and ``early`` columns of the participants, for ``derive_participants`` to add the others."""
    tables = inputs(spark, sf_dir, "customer", "orders", "lineitem")
    columns = ", ".join(_typed(PARTICIPANT_VALUES, schemas.PARTICIPANTS, early))
    text = in_dialect(f"SELECT @shuffled@ *, {columns} FROM {{lineitem}} JOIN {{orders}} o ON l_orderkey = o_orderkey", SPARK_DIALECT)
    return spark.sql(text, **{n: df for n, df in tables.items() if f"{{{n}}}" in text})


def derive_participants(sources: DataFrame) -> DataFrame:
    """The participant columns of ``participant_sources`` rows, whatever was joined to them.

    Early ones are made again, so that a join need not carry them on; only ``puuid``, which counts customers, is kept.
    """
    late = [n for n in schemas.PARTICIPANTS.names if n != "puuid"]
    derived = [F.expr(in_dialect(column, SPARK_DIALECT)) for column in _typed(PARTICIPANT_VALUES, schemas.PARTICIPANTS, late)]
    return sources.select(*[c for c in sources.columns if c not in late], *derived)


def bronze_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: bronze(spark, sf_dir, name) for name in SQL}


# ---- JSON documents, one match per order ----

# Bytes of JSON text per stored byte of the orders, as measured, and what one task writes or parses of them.
_TEXT_PER_BYTE = 400
_TEXT_PER_TASK = 128 * 1024 * 1024


@lru_cache(maxsize=4)
def match_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, value): the JSON text of one match per order, with 1 to 10 participants."""
    k = F.col("o_orderkey")
    # A narrow row grows into a large document, so the rows are spread before that, over more tasks the more there are.
    text_bytes = _TEXT_PER_BYTE * bytes_of(spark, f"{sf_dir}/orders.parquet")
    tasks = max(spark.sparkContext.defaultParallelism, -(-text_bytes // _TEXT_PER_TASK))
    start = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    orders = inputs(spark, sf_dir, "orders")["orders"].select(k, start.alias("start")).repartition(tasks, k)
    return orders.mapInArrow(match_texts.writer(), match_texts.SCHEMA)


def damaged_match_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The match documents with some cut short and some missing a required key."""
    text, k = F.col("value"), F.col("doc_id")
    damaged = (
        F.when(k % 10 == 0, F.substring(text, 1, 40))
        .when(k % 10 == 1, F.replace(text, F.lit('"matchId"'), F.lit('"id"')))
        .when(k % 10 == 2, F.replace(text, F.lit('"gameVersion"'), F.lit('"version"')))
        .when(k % 10 == 3, F.regexp_replace(text, r'"championName":"[^"]*",', ""))
        .when(k % 10 == 4, F.replace(text, F.lit('"teamId":100,"win"'), F.lit('"teamId":100,"won"')))
        .otherwise(text)
    )
    return match_documents(spark, sf_dir).withColumn("value", damaged)


def ladder_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, tier, value): ladder documents of two entries each, one per customer."""
    customer = inputs(spark, sf_dir, "customer")["customer"]
    k, points = F.col("c_custkey"), F.floor("c_acctbal")
    entry = [
        F.struct(
            F.concat(F.lit("P_"), k.cast("string"), F.lit(f"_{n}")).alias("puuid"), F.lit("I").alias("rank"),
            (points + n).alias("leaguePoints"), (k % 200).alias("wins"), (k % 70 + n).alias("losses"),
        )
        for n in (1, 2)
    ]
    tier = F.when(points >= 9000, "CHALLENGER").when(points >= 7000, "GRANDMASTER").otherwise("MASTER")
    text = F.to_json(F.struct(F.array(*entry).alias("entries")))
    return customer.select(k.alias("doc_id"), tier.alias("tier"), text.alias("value"))


def damaged_ladder_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ladder documents with some cut short and some entries without player or points."""
    text, k = F.col("value"), F.col("doc_id")
    damaged = (
        F.when(k % 10 == 0, F.substring(text, 1, 40))
        .when(k % 10 == 1, F.replace(text, F.lit('"puuid"'), F.lit('"id"')))
        .when(k % 10 == 2, F.regexp_replace(text, r'^(.*)"leaguePoints"', '$1"points"'))
        .otherwise(text)
    )
    return ladder_documents(spark, sf_dir).withColumn("value", damaged)


def lookup_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(shape, value): small lookup documents of the three published shapes, one per part."""
    part = inputs(spark, sf_dir, "part")["part"]
    k, name = F.col("p_partkey"), F.col("p_name")
    entries = F.array(
        F.struct(k.alias("id"), name.alias("name")),
        F.struct((k + 1000000).alias("id"), F.when(k % 5 != 0, F.upper(name)).alias("name")),
    )
    shape = F.when(k % 3 == 0, "list").when(k % 3 == 1, "dict").otherwise("styles")
    text = (
        F.when(k % 3 == 0, F.to_json(entries))
        .when(k % 3 == 1, F.to_json(F.create_map(k.cast("string"), F.struct(name.alias("name")))))
        .otherwise(F.to_json(F.struct(entries.alias("styles"))))
    )
    return part.select(shape.alias("shape"), text.alias("value"))
