import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from medalstar import schemas
from medalstar.jobs import run
from medalstar.plans import marts
from medalstar.plans.bronze import flatten_ladder
from medalstar.plans.ingest import ingest_ladder, ingest_matches, rejected_ladder, rejected_lists
from medalstar.plans.warehouse import FACT, Warehouse
from medalstar.sources.tables import replace_files
from medalstar.sources.versions import current_version, read_current
from tests.support import rows_of
from tests.test_documents import match, participant

STAMP = "2025-01-06T00:00:00"


def land(folder, name, *texts):
    with open(f"{folder}/{name}", "w", encoding="utf-8") as out:
        out.write("\n".join(t if isinstance(t, str) else json.dumps(t) for t in texts))


@pytest.fixture
def landed(folder):
    """Two good and two bad match documents, and two ladder tiers."""
    for sub in ("matches", "CHALLENGER", "MASTER"):
        os.mkdir(f"{folder}/{sub}")
    teams = [{"teamId": 100, "win": True, "bans": [{"championId": 3}]}, {"teamId": 200, "win": False}]
    people = [participant(f"p{i}", participantId=i, teamId=100 if i <= 5 else 200, championName="Ahri", championId=103)
              for i in range(1, 11)]
    context = {"platformId": "VN2", "gameVersion": "14.24.1", "gameStartTimestamp": 1735984800000}
    land(f"{folder}/matches", "a.json", match("m1", people, teams, **context), match("m2", people[:2], teams, **context),
         match("bad", [participant(puuid="ABSENT")]))
    land(f"{folder}/matches", "b.json", "{broken")
    entry = {"rank": "I", "wins": 3, "losses": 1}
    land(f"{folder}/CHALLENGER", "c.json", {"entries": [{"puuid": "p1", "leaguePoints": 900, **entry}]})
    land(f"{folder}/MASTER", "m.json", {"entries": [{"puuid": "p9", "leaguePoints": 100, **entry}]})
    return folder


def test_json_to_checked_star_schema(spark, landed):
    folder = landed
    bronze = ingest_matches(spark, f"{folder}/matches", folder, STAMP)
    tiers = {t: f"{folder}/{t}" for t in ("CHALLENGER", "MASTER")}
    bronze["ladder"] = ingest_ladder(spark, tiers, folder, "vn2", STAMP, 500)
    assert rows_of(bronze["rejected_matches"], "reason") == [("participant field missing",), ("unreadable",)]
    assert bronze["rejected_matches"].filter("value is null or file_path is null").count() == 0
    assert rows_of(bronze["matches_teams"], "match_id", "team_id", "ban_1") == [
        ("m1", 100, 3), ("m1", 200, 0), ("m2", 100, 3), ("m2", 200, 0)
    ]

    store = Warehouse(spark, bronze, f"{folder}/lake")
    built = store.build()
    assert {n: df.count() for n, df in built.items()} == {
        "stg_ladder": 2, "stg_matches_participants": 12, "stg_matches_teams": 4, "dim_champion": 1, "dim_date": 1,
        "dim_item": 1, "dim_spell": 1, "dim_queue_patch": 1, "dim_player": 10, FACT: 12,
    }
    assert rows_of(built[FACT].filter("rank_tier_at_match is not null"), "match_id", "puuid", "rank_tier_at_match") == [
        ("m1", "p1", "CHALLENGER"), ("m1", "p9", "MASTER"), ("m2", "p1", "CHALLENGER")
    ]
    checks = store.check()
    assert checks.count() == 47
    assert rows_of(checks.filter("not passed")) == []


def test_stored_tables_answer_sql(spark, landed):
    bronze = ingest_matches(spark, f"{landed}/matches", landed, STAMP)
    bronze["ladder"] = ingest_ladder(spark, {"MASTER": f"{landed}/MASTER"}, landed, "vn2", STAMP, None)
    Warehouse(spark, bronze, f"{landed}/lake").publish("test_silver", "test_gold")
    counts = spark.sql("SELECT match_id, count(*) AS n FROM test_gold.fct_participant_match GROUP BY match_id")
    assert rows_of(counts) == [("m1", 10), ("m2", 2)]
    labelled = spark.sql("""
        SELECT p.puuid, c.champion_name, f.kills
        FROM test_gold.fct_participant_match f
        JOIN test_gold.dim_player p USING (player_key) JOIN test_gold.dim_champion c USING (champion_key)
        WHERE f.game_month >= '2025-01' ORDER BY p.puuid LIMIT 3""")
    assert rows_of(labelled) == [("p1", "Ahri", 7), ("p1", "Ahri", 7), ("p10", "Ahri", 7)]
    assert spark.table("test_silver.stg_ladder").count() == 1


def test_command_line(spark, landed):
    ingest = ["ingest", "--matches", f"{landed}/matches", "--ladder", f"CHALLENGER={landed}/CHALLENGER",
              "--ladder", f"MASTER={landed}/MASTER", "--platform", "vn2", "--stamp", STAMP, "--root", f"{landed}/out", "--top", "all"]
    assert run(spark, ingest) == 2  # two match documents are bad
    assert run(spark, ["build", "--root", f"{landed}/out"]) == 0
    assert spark.read.parquet(f"{landed}/out/checks").count() == 47
    assert spark.read.parquet(current_version(spark, f"{landed}/out/gold/{FACT}")).count() == 12


def test_tiers_come_from_the_caller_and_nothing_vanishes(spark, folder):
    entry = {"rank": "I", "wins": 3, "losses": 1}
    for tier, texts in {
        "MASTER": [{"entries": [{"puuid": "a", "leaguePoints": 1, **entry}]}, '{"entries": [{"puu'],
        "GOLD": [{"entries": [{"puuid": "b", "leaguePoints": 9, **entry}, {"leaguePoints": 5, **entry},
                              {"puuid": "c", **entry}]}],
    }.items():
        os.mkdir(f"{folder}/{tier}")
        for i, text in enumerate(texts):
            land(f"{folder}/{tier}", f"{i}.json", text)
    paths = {"MASTER": f"{folder}/MASTER", "GOLD": f"{folder}/GOLD"}
    assert rows_of(ingest_ladder(spark, paths, folder, "vn2", STAMP, None), "puuid", "tier") == [("a", "MASTER"), ("b", "GOLD")]
    assert rows_of(rejected_ladder(spark, folder), "tier", "reason") == [
        ("GOLD", "entry without player or points"), ("GOLD", "entry without player or points"), ("MASTER", "unreadable")]
    assert rows_of(ingest_ladder(spark, paths, folder, "vn2", STAMP, 1), "puuid") == [("a",)]


def test_an_unlisted_tier_is_an_error(spark):
    docs = spark.createDataFrame(
        [("GOLD", [])], "tier string, entries array<struct<puuid string, rank string, leaguePoints bigint, wins bigint, losses bigint>>")
    with pytest.raises(Exception, match="ladder tier not listed: GOLD"):
        flatten_ladder(docs, "vn2", STAMP, None, ["MASTER"]).select("tier").collect()


def test_a_match_landed_twice_counts_once(spark, folder):
    os.mkdir(f"{folder}/matches")
    teams = [{"teamId": 100, "win": True}, {"teamId": 200, "win": False}]
    people = [participant("p1", participantId=1, teamId=100)]
    for name in ("a.json", "b.json"):
        land(f"{folder}/matches", name, match("m1", people, teams, platformId="VN2"))
    bronze = ingest_matches(spark, f"{folder}/matches", folder, STAMP)
    assert rows_of(bronze["rejected_matches"], "reason") == [("repeated",)]
    assert (bronze["matches_participants"].count(), bronze["matches_teams"].count()) == (1, 2)


def test_a_failed_rebuild_leaves_the_old_table(spark, folder):
    path = f"{folder}/table"
    replace_files(spark.range(5), path)
    with pytest.raises(Exception, match="stop here"):
        replace_files(spark.range(9, numPartitions=3).select(
            F.when(F.col("id") == 8, F.raise_error(F.lit("stop here")).cast("bigint")).otherwise(F.col("id")).alias("id")), path)
    assert spark.read.parquet(current_version(spark, path)).count() == 5
    assert rows_of(replace_files(spark.range(2), path)) == [(0,), (1,)]
    assert len(os.listdir(path)) == 2  # the current rows, and those that earlier readers may still read


def test_dedupe_keys_reach_the_silver_tables(spark, landed):
    bronze = ingest_matches(spark, f"{landed}/matches", landed, STAMP)
    bronze["ladder"] = ingest_ladder(spark, {"MASTER": f"{landed}/MASTER"}, landed, "vn2", STAMP, None)
    twice = bronze["matches_teams"].unionByName(bronze["matches_teams"])
    store = Warehouse(spark, {**bronze, "matches_teams": twice}, f"{landed}/lake", {"stg_matches_teams": ["match_id", "team_id"]})
    assert store.table("stg_matches_teams").count() == bronze["matches_teams"].count()


def test_match_lists_reach_bronze(spark, landed, capsys):
    os.mkdir(f"{landed}/lists")
    land(f"{landed}/lists", "a.json", {"puuid": "p1", "ids": ["m1", "m2", "m3"]}, {"puuid": "p2", "ids": ["m2", "m4"]}, "{broken", {"ids": ["m9"]})
    land(f"{landed}/lists", "b.json", {"puuid": "p0", "ids": ["m4", "m1", "m5"]}, {"puuid": "p3", "ids": []}, {"puuid": "p4", "ids": None})
    ingest = ["ingest", "--matches", f"{landed}/matches", "--ladder", f"MASTER={landed}/MASTER", "--platform", "vn2", "--stamp", STAMP,
              "--root", f"{landed}/out", "--top", "all", "--match-lists", f"{landed}/lists", "--region", "sea", "--per-player", "2"]
    assert run(spark, ingest) == 2
    stored = read_current(spark, f"{landed}/out/bronze/match_ids", schemas.MATCH_IDS)
    assert rows_of(stored, "match_id", "puuid") == [("m1", "p1"), ("m2", "p1"), ("m4", "p2")]
    assert rows_of(stored, "platform", "region", "queue_id", "ingest_ts")[0] == ("vn2", "sea", 420, STAMP)
    assert rows_of(rejected_lists(spark, f"{landed}/out"), "reason") == [("player or list missing",)] * 2 + [("unreadable",)]
    assert "rejected from match lists: 1 unreadable" in capsys.readouterr().out


def test_build_loads_bronze_and_tells_what_failed(spark, landed, capsys):
    ingest = ["ingest", "--matches", f"{landed}/matches", "--ladder", f"CHALLENGER={landed}/CHALLENGER", "--ladder", f"MASTER={landed}/MASTER",
              "--platform", "vn2", "--stamp", STAMP, "--root", f"{landed}/out", "--top", "all"]
    run(spark, ingest)
    build = ["build", "--root", f"{landed}/out", "--load", "test_bronze", "--keep-keys"]
    assert run(spark, build) == 0
    assert spark.table("test_bronze.matches_participants").count() == 12
    assert "loaded ladder: 2" in capsys.readouterr().out
    shutil.rmtree(f"{landed}/out/bronze/ladder")
    assert run(spark, build) == 3
    assert "loaded ladder: AnalysisException" in capsys.readouterr().out
    assert spark.table("test_bronze.ladder").count() == 2  # the table of the load before
    spark.sql("DROP DATABASE test_bronze CASCADE")


def test_marts_of_a_warehouse_come_from_partials(spark, landed):
    bronze = ingest_matches(spark, f"{landed}/matches", landed, STAMP)
    bronze["ladder"] = ingest_ladder(spark, {"MASTER": f"{landed}/MASTER"}, landed, "vn2", STAMP, None)
    store = Warehouse(spark, bronze, f"{landed}/lake")
    store.refresh_marts()
    assert rows_of(store.mart("side_winrate")) == rows_of(marts.side_winrate(store.table(FACT)))
    assert rows_of(store.mart("champion_winrate_by_patch")) == rows_of(
        marts.champion_winrate_by_patch(store.table(FACT), store.table("dim_queue_patch")))
