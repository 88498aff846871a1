import json

import pytest
from pyspark.sql import functions as F

from medalstar import schemas
from medalstar.plans import bronze
from medalstar.sources import documents
from tests.support import rows_of

STAMP = "2025-01-06T00:00:00"


def participant(puuid="p1", **changes):
    values = {"bigint": 7, "string": "text", "boolean": True}
    record = {n: values[d.simpleString()] for n, d in schemas.PARTICIPANT_REQUIRED.items()}
    record.update({"puuid": puuid, "participantId": 1, "teamId": 100})
    record.update(changes)
    return {k: v for k, v in record.items() if v != "ABSENT"}


def match(match_id="m1", participants=None, teams=None, **info):
    values = {"bigint": 5, "string": "text"}
    body = {n: values[d.simpleString()] for n, d in schemas.MATCH_REQUIRED.items()}
    body["participants"] = [participant()] if participants is None else participants
    body["teams"] = [{"teamId": 100, "win": True}] if teams is None else teams
    body.update(info)
    return {"metadata": {"matchId": match_id}, "info": {k: v for k, v in body.items() if v != "ABSENT"}}


def parsed(spark, *texts):
    rows = [(i, t if isinstance(t, str) else json.dumps(t)) for i, t in enumerate(texts)]
    return documents.parse_documents(spark.createDataFrame(rows, "doc int, value string"), "value", schemas.MATCH_DOCUMENT)


def accepted(spark, *texts):
    return documents.accepted_matches(parsed(spark, *texts))


def test_malformed_documents_are_set_aside_with_a_reason(spark):
    docs = [
        match(),
        '{"metadata": {"mat',
        {"info": match()["info"]},
        match(gameVersion="ABSENT"),
        match(participants=[participant(), participant(lane="ABSENT")]),
        match(teams=[{"teamId": 100}]),
        match(participants="ABSENT"),
        match(participants=[]),
        {"metadata": {"matchId": "m"}},
    ]
    reasons = {r["doc"]: r["reason"] for r in documents.quarantined_matches(parsed(spark, *docs)).collect()}
    assert reasons == {
        1: "unreadable", 2: "match id missing", 3: "match field missing", 4: "participant field missing",
        5: "team field missing", 6: "participant field missing", 8: "match field missing",
    }
    assert sorted(r["doc"] for r in accepted(spark, *docs).collect()) == [0, 7]


def test_a_document_bad_in_one_part_is_in_neither_table(spark):
    docs = accepted(spark, match("good"), match("bad", teams=[{"win": True}]))
    assert rows_of(bronze.flatten_participants(docs, STAMP), "match_id") == [("good",)]
    assert rows_of(bronze.flatten_teams(docs, STAMP), "match_id") == [("good",)]


def test_participant_row(spark):
    runes = {
        "styles": [
            {"style": 8000, "selections": [{"perk": 1}, {"perk": 2}, {}, {"perk": 4}]},
            {"style": 8100, "selections": [{"perk": 5}]},
        ],
        "statPerks": {"defense": 11, "offense": 13},
    }
    people = [participant("a", perks=runes, riotIdGameName="Ann", neutralMinionsKilled=3), participant("b", teamId=300)]
    rows = {r["puuid"]: r for r in bronze.flatten_participants(accepted(spark, match(participants=people)), STAMP).collect()}
    a, b = rows["a"], rows["b"]
    assert [a[c] for c in schemas.RUNE_COLUMNS] == [1, 2, 0, 4, 5, 0, 8000, 8100, 11, 0, 13]
    assert [b[c] for c in schemas.RUNE_COLUMNS] == [0] * 11
    assert (a["riot_id_name"], a["summoner_name"], a["neutral_minions_killed"]) == ("Ann", "", 3)
    assert (a["game_duration"], a["side"], b["side"], a["ingest_ts"]) == (0, "blue", "unknown", STAMP)
    assert (a["control_wards_placed"], a["total_time_cc_dealt"], a["first_blood_kill"]) == (7, 7, True)


@pytest.mark.parametrize("count", [0, 1, 2])
def test_styles_may_be_short(spark, count):
    styles = [{"style": 1, "selections": [{"perk": 10}]}, {"style": 2}][:count]
    docs = accepted(spark, match(participants=[participant(perks={"styles": styles})]))
    row = bronze.flatten_participants(docs, STAMP).first()
    assert (row["perk_keystone"], row["perk_primary_style"], row["perk_secondary_style"]) == (
        (0, 0, 0), (10, 1, 0), (10, 1, 2)
    )[count]


def test_explicit_null_counts_as_absent(spark):
    docs = accepted(spark, match(gameDuration=None, participants=[participant(summonerName=None)]))
    row = bronze.flatten_participants(docs, STAMP).first()
    assert (row["game_duration"], row["summoner_name"]) == (0, "")


def test_team_row(spark):
    team = {
        "teamId": 200, "win": False,
        "objectives": {"baron": {"kills": 2, "first": True}, "dragon": {"kills": 1}, "champion": {"first": True}},
        "bans": [{"championId": 9}, {}, {"championId": 8}],
    }
    row = bronze.flatten_teams(accepted(spark, match(teams=[team])), STAMP).first()
    assert (row["side"], row["win"]) == ("red", False)
    assert (row["baron_kills"], row["first_baron"], row["dragon_kills"], row["first_dragon"]) == (2, True, 1, False)
    assert (row["rift_herald_kills"], row["first_rift_herald"], row["first_blood"]) == (0, False, True)
    assert [row[f"ban_{i}"] for i in range(1, 6)] == [9, 0, 8, 0, 0]


def test_json_is_parsed_once_per_document(spark):
    flat = bronze.flatten_participants(accepted(spark, match()), STAMP)
    plan = flat._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_player_matches(spark):
    docs = accepted(
        spark,
        match("m1", [participant("x"), participant("me", championName="Ahri", kills=3, neutralMinionsKilled=2)], gameDuration=60),
        match("m2", [participant("x")]),
        match("m3", [participant("me", kills=1), participant("me", kills=99)]),
    )
    found = bronze.player_matches(docs, "me")
    assert rows_of(found, "match_id", "game_duration", "kills", "cs") == [("m1", 60, 3, 9), ("m3", None, 1, 7)]


def test_lookup_shapes(spark):
    def entries(value, shape):
        docs = spark.createDataFrame([(json.dumps(value),)], "value string")
        return rows_of(documents.lookup_entries(docs, "value", shape))

    assert entries([{"id": 1, "name": "A"}, {"id": 2}, {"name": "C"}, {"id": 1, "name": "A"}], "list") == [(1, "A")]
    assert entries({"10": {"name": "X", "price": 3}, "11": {}}, "dict") == [(10, "X")]
    assert entries({"styles": [{"id": 8000, "name": "P"}]}, "styles") == [(8000, "P")]


def test_match_ids_keep_the_first_player_and_cut_lists(spark):
    rows = [(2, "late", ["m1", "m3"]), (1, "early", ["m2", "m1", "m9"])]
    lists = spark.createDataFrame(rows, "arrival int, puuid string, ids array<string>")
    found = bronze.match_ids(lists, "arrival", "vn2", "sea", 420, STAMP, per_player=2)
    assert rows_of(found, "match_id", "puuid") == [("m1", "early"), ("m2", "early"), ("m3", "late")]
    assert found.columns == schemas.MATCH_IDS.names


def test_ladder_rows(spark):
    value = {"entries": [{"puuid": "p", "rank": "I", "leaguePoints": 5, "wins": 1, "losses": 2}]}
    docs = spark.createDataFrame([("MASTER", json.dumps(value))], "tier string, value string")
    parsed_docs = documents.parse_documents(docs, "value", schemas.LADDER_DOCUMENT)
    found = bronze.flatten_ladder(parsed_docs, "vn2", STAMP, k=500)
    assert rows_of(found) == [("VN2", "p", "MASTER", "I", 5, 1, 2, STAMP)]
    assert found.columns == schemas.LADDER.names


def test_documents_from_files(spark, folder):
    with open(f"{folder}/a.json", "w", encoding="utf-8") as out:
        out.write(json.dumps(match("m1")) + "\n" + json.dumps(match("m2")) + "\n")
    lines = documents.read_text_documents(spark, folder)
    docs = documents.accepted_matches(documents.parse_documents(lines, "value", schemas.MATCH_DOCUMENT))
    assert rows_of(docs.select(F.col("metadata.matchId"))) == [("m1",), ("m2",)]
