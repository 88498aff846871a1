import datetime as dt

import pytest

from medalstar.plans import gold, marts, silver
from tests.support import bronze_rows, rows_of


def test_stg_ladder(spark):
    bronze = bronze_rows(spark, "ladder", [
        {"puuid": "a", "platform": "vn2", "tier": "MASTER", "wins": 1, "losses": 3, "ingest_ts": "2025-01-01T10:00:00"},
        {"puuid": "a", "platform": "vn2", "tier": "GRANDMASTER", "wins": 3, "losses": 1, "ingest_ts": "2025-01-02T10:00:00"},
        {"puuid": "moved", "platform": "vn2", "ingest_ts": "2025-01-01T00:00:00"},
        {"puuid": "moved", "platform": "oc1", "ingest_ts": "2025-01-02T00:00:00"},
        {"puuid": None, "platform": "vn2"},
        {"puuid": "idle", "platform": "VN2", "wins": 0, "losses": 0},
        {"puuid": "hidden", "platform": "VN2", "wins": None, "losses": 2},
        {"puuid": "tied", "platform": "vn2", "tier": "MASTER"},
        {"puuid": "tied", "platform": "vn2", "tier": "CHALLENGER"},
    ])
    found = silver.stg_ladder(bronze)
    assert found.columns == silver.LADDER_COLUMNS
    assert rows_of(found, "puuid", "platform", "tier", "total_games", "winrate") == sorted([
        ("a", "VN2", "GRANDMASTER", 4, 0.75), ("moved", "OC1", "", 0, 0.0), ("idle", "VN2", "", 0, 0.0),
        ("hidden", "VN2", "", None, 0.0), ("tied", "VN2", "CHALLENGER", 0, 0.0),
    ], key=repr)


def test_stg_participants(spark):
    bronze = bronze_rows(spark, "matches_participants", [
        {"match_id": "m", "kills": 4, "deaths": 2, "assists": 2, "game_duration": 120, "gold_earned": 600,
         "total_minions_killed": 10, "neutral_minions_killed": 4},
        {"match_id": "n", "kills": 1, "deaths": 0, "assists": 2, "game_duration": 0, "gold_earned": 600},
    ])
    found = silver.stg_matches_participants(bronze)
    assert found.columns == silver.PARTICIPANT_COLUMNS
    assert dict(found.dtypes)["ingest_ts"] == "timestamp"
    assert rows_of(found, "match_id", "kda", "total_cs", "gold_per_minute", "cs_per_minute") == [
        ("m", 3.0, 14, 300.0, 7.0), ("n", 3.0, 0, 0.0, 0.0)
    ]


def test_repeated_ingest_stays_unless_asked(spark):
    rows = [{"match_id": "m", "puuid": "p", "kills": k, "ingest_ts": f"2025-01-0{k}T00:00:00"} for k in (1, 2)]
    bronze = bronze_rows(spark, "matches_participants", rows)
    assert silver.stg_matches_participants(bronze).count() == 2
    assert rows_of(silver.stg_matches_participants(bronze, ["match_id", "puuid"]), "kills") == [(2,)]
    teams = bronze_rows(spark, "matches_teams", [{"match_id": "m", "team_id": 100, "baron_kills": b} for b in (1, 1)])
    assert silver.stg_matches_teams(teams).count() == 2
    assert silver.stg_matches_teams(teams, ["match_id", "team_id"]).count() == 1


def participants(spark, rows):
    return silver.stg_matches_participants(bronze_rows(spark, "matches_participants", rows))


def test_dim_champion_keeps_both_names_of_a_renamed_champion(spark):
    found = gold.dim_champion(participants(spark, [
        {"champion_id": 1, "champion_name": "Old"}, {"champion_id": 1, "champion_name": "New"},
        {"champion_id": 1, "champion_name": "New"}, {"champion_id": None, "champion_name": "None"},
    ]))
    assert rows_of(found, "champion_key", "champion_name") == [(1, "New"), (1, "Old")]
    assert found.filter("champion_name = 'New'").first()["champion_loading_url"].endswith("/loading/New_0.jpg")


@pytest.mark.parametrize("day, expected", [
    (dt.date(2025, 1, 4), (20250104, 2025, 1, 1, "Jan", 1, 4, 6, "Sat", True)),
    (dt.date(2025, 1, 5), (20250105, 2025, 1, 1, "Jan", 1, 5, 7, "Sun", True)),
    (dt.date(2024, 12, 30), (20241230, 2024, 4, 12, "Dec", 1, 30, 1, "Mon", False)),
])
def test_dim_date(spark, day, expected):
    start = int(dt.datetime(day.year, day.month, day.day, 23, 59, 59, tzinfo=dt.timezone.utc).timestamp() * 1000) + 960
    found = gold.dim_date(participants(spark, [{"game_start_timestamp": start}, {"game_start_timestamp": None}]))
    assert rows_of(found.drop("calendar_date")) == [expected]
    assert rows_of(found, "calendar_date") == [(day,)]


def test_dim_item_and_dim_spell(spark):
    rows = [{"item0": 5, "item1": None, "item6": 5, "summoner1_id": 4, "summoner2_id": 99}, {"item3": -1, "summoner1_id": 0}]
    silver_rows = participants(spark, rows)
    assert rows_of(gold.dim_item(silver_rows), "item_key", "item_id") == [(5, 5)]
    spells = gold.dim_spell(silver_rows)
    assert rows_of(spells, "spell_key", "spell_name", "spell_key_name") == [
        (4, "Flash", "SummonerFlash"), (99, "Spell 99", "Summoner99")
    ]
    assert spells.filter("spell_id = 99").first()["spell_image_url"].endswith("/img/spell/Summoner99.png")


def test_dim_queue_patch(spark):
    found = gold.dim_queue_patch(participants(spark, [
        {"queue_id": 450, "game_mode": "ARAM", "game_version": "14.24.1"},
        {"queue_id": 420, "game_mode": "CLASSIC", "game_version": None},
        {"queue_id": 420, "game_mode": "CLASSIC", "game_version": "14.24.1"},
        {"queue_id": 420, "game_mode": "CLASSIC", "game_version": "14.24.1"},
        {"queue_id": 420, "game_mode": "ARENA", "game_version": "14.24.1"},
        {"queue_id": 1, "game_mode": "X", "game_version": "14"},
        {"queue_id": None, "game_mode": "X", "game_version": "14"},
    ]))
    assert [tuple(r) for r in found.orderBy("queue_patch_key").collect()] == [
        (1, 1, "X", False, "Other", "14", None, "14"),
        (2, 420, "ARENA", True, "Ranked Solo/Duo", "14.24.1", "14.24", "14"),
        (3, 420, "CLASSIC", True, "Ranked Solo/Duo", "14.24.1", "14.24", "14"),
        (4, 420, "CLASSIC", True, "Ranked Solo/Duo", None, None, None),
        (5, 450, "ARAM", False, "ARAM", "14.24.1", "14.24", "14"),
    ]


def player_rows():
    return [
        {"puuid": "b", "platform": "VN2", "summoner_name": "Old name", "riot_id_name": "B1", "ingest_ts": "2025-01-01T00:00:00"},
        {"puuid": "b", "platform": "VN2", "summoner_name": "\t", "riot_id_name": "B2", "ingest_ts": "2025-01-09T00:00:00"},
        {"puuid": "a", "platform": "OC1", "summoner_name": " ", "riot_id_name": "A", "ingest_ts": "2025-01-01T00:00:00"},
        {"puuid": None, "platform": "VN2", "summoner_name": "nobody"},
    ]


def stg_ladder(spark):
    return silver.stg_ladder(bronze_rows(spark, "ladder", [
        {"puuid": "b", "platform": "vn2", "tier": "CHALLENGER", "league_points": 900, "wins": 3, "losses": 1},
        {"puuid": "a", "platform": "vn2", "tier": "MASTER", "league_points": 10, "wins": 3, "losses": 1},
    ]))


def test_dim_player(spark):
    found = gold.dim_player(participants(spark, player_rows()), stg_ladder(spark))
    assert [tuple(r)[:4] + tuple(r)[6:11] for r in found.orderBy("player_key").collect()] == [
        (1, "a", "OC1", "A", None, None, None, None, None),
        (2, "b", "VN2", "Old name", "CHALLENGER", 900, 3, 1, 0.75),
    ]
    assert found.filter("puuid = 'b'").first()["rank_emblem_url"].endswith("/emblem-challenger.png")


def fact(spark, rows, teams, ladder=None):
    silver_rows = participants(spark, rows)
    stg_teams = silver.stg_matches_teams(bronze_rows(spark, "matches_teams", teams))
    ranks = stg_ladder(spark) if ladder is None else ladder
    dim_player = gold.dim_player(silver_rows, ranks)
    patches = gold.dim_queue_patch(silver_rows)
    return gold.fct_participant_match(silver_rows, stg_teams, ranks, dim_player, patches)


def test_fact_row(spark):
    rows = [{
        "match_id": "m", "team_id": 100, "participant_id": 1, "queue_id": 420, "game_version": "14.1.1",
        "game_start_timestamp": 1735948799960, "champion_id": 7, "champion_name": "Ahri", "item0": 3, "item1": 0,
        "item2": None, "summoner1_id": 4, "summoner2_id": 99, "perk_keystone": 8005, "perk_primary_style": 8000,
        "perk_secondary_style": 8500, "team_position": "JUNGLE", **player_rows()[0],
    }]
    teams = [{"match_id": "m", "team_id": 100, "dragon_kills": 3, "champion_kills": 20, "first_blood": True}]
    row = fact(spark, rows, teams).first().asDict()
    assert list(row) == gold.FACT_COLUMNS
    assert (row["date_key"], row["player_key"], row["champion_key"], row["queue_patch_key"]) == (20250103, 1, 7, 1)
    assert (row["team_dragon_kills"], row["team_total_kills"], row["team_first_blood"]) == (3, 20, True)
    assert (row["rank_tier_at_match"], row["rank_lp_at_match"]) == ("CHALLENGER", 900)
    assert row["spell1_image_url"].endswith("SummonerFlash.png") and row["spell2_image_url"] is None
    assert row["keystone_rune_image_url"].endswith("PressTheAttack.png")
    assert row["primary_rune_tree_image_url"].endswith("7201_Precision.png")
    assert row["secondary_rune_tree_image_url"] is None
    assert row["item0_image_url"].endswith("/item/3.png")
    assert (row["item1_image_url"], row["item2_image_url"], row["role_icon"]) == (None, None, "🌲")


def test_fact_keeps_unmatched_and_null_keys(spark):
    rows = [
        {"match_id": "m", "puuid": None, "team_id": 100, "game_version": None, "queue_id": 420},
        {"match_id": "m", "puuid": "stranger", "team_id": 300, "game_version": "14.1", "queue_id": None},
    ]
    found = fact(spark, rows, [{"match_id": "m", "team_id": 100}])
    assert rows_of(found, "puuid", "player_key", "queue_patch_key", "team_baron_kills", "rank_tier_at_match") == sorted([
        (None, None, None, 0, None), ("stranger", 1, None, None, None)
    ], key=repr)


def test_fact_rank_needs_the_platform_of_the_ladder(spark):
    rows = [
        {"match_id": "1", "puuid": "a", "platform": "VN2"}, {"match_id": "2", "puuid": "a", "platform": "OC1"},
    ]
    assert rows_of(fact(spark, rows, []), "match_id", "rank_tier_at_match") == [("1", "MASTER"), ("2", None)]


def test_fact_rank_does_not_need_the_player_dimension(spark):
    silver_rows = participants(spark, [{"match_id": "1", "puuid": "b", "platform": "VN2"}])
    teams = silver.stg_matches_teams(bronze_rows(spark, "matches_teams", []))
    nobody = spark.createDataFrame([], "puuid string, player_key bigint")
    patches = gold.dim_queue_patch(silver_rows)
    row = gold.fct_participant_match(silver_rows, teams, stg_ladder(spark), nobody, patches).first()
    assert (row["player_key"], row["rank_tier_at_match"]) == (None, "CHALLENGER")


def test_fact_multiplies_on_repeated_teams_and_second_modes(spark):
    rows = [{"match_id": "m", "team_id": 100, "puuid": "a", "queue_id": 420, "game_version": "1.1", "game_mode": g}
            for g in ("X", "Y")]
    one_team = [{"match_id": "m", "team_id": 100}]
    assert fact(spark, rows, one_team).count() == 4
    assert fact(spark, rows[:1], one_team * 2).count() == 2
    assert fact(spark, rows[:1], one_team).count() == 1


def test_marts(spark):
    rows = [
        {"match_id": m, "team_id": t, "side": s, "win": w, "puuid": f"p{t}{i}", "participant_id": i, "champion_id": 1,
         "champion_name": "C", "queue_id": 420, "game_version": "14.2.1", "kills": 4, "deaths": 2, "assists": 2,
         "team_position": "TOP"}
        for m, winner in (("m1", 100), ("m2", 100), ("m3", 200))
        for t, s in ((100, "blue"), (200, "red"))
        for w in [t == winner]
        for i in (1, 2)
    ]
    teams = [{"match_id": m, "team_id": t, "first_dragon": t == 100, "dragon_kills": 4 if t == 100 else 1}
             for m in ("m1", "m2", "m3") for t in (100, 200)]
    table = fact(spark, rows, teams)
    third = 1 / 3
    assert rows_of(marts.side_winrate(table)) == [("blue", 3, 2, 2 / 3), ("red", 3, 1, third)]
    impact = {(r["objective"], r["bucket"]): (r["games"], r["wins"]) for r in marts.objective_impact(table).collect()}
    assert impact[("team_first_dragon", "true")] == (3, 2)
    assert impact[("team_first_dragon", "false")] == (3, 1)
    assert impact[("team_dragon_kills", "3+")] == (3, 2)
    assert impact[("team_dragon_kills", "1-2")] == (3, 1)
    assert impact[("team_baron_kills", "0")] == (6, 3)
    patches = gold.dim_queue_patch(participants(spark, rows))
    assert rows_of(marts.champion_winrate_by_patch(table, patches)) == [(1, "C", "14.2", 12, 6, 0.5)]
    assert rows_of(marts.role_analysis(table), "team_position", "games", "avg_kda") == [("TOP", 12, 3.0)]
    players = marts.player_performance(table)
    assert rows_of(players, "puuid", "games", "wins") == [("p1001", 3, 2), ("p1002", 3, 2), ("p2001", 3, 1), ("p2002", 3, 1)]
    assert rows_of(marts.participants_per_match(table)) == [("m1", 4), ("m2", 4), ("m3", 4)]
