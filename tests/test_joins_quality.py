import pytest
from pyspark.sql import functions as F

from medalstar.operators import joins, quality
from medalstar.plans.suites import SUITES
from tests.support import physical_plan, rows_of


def test_snapshot_join_needs_both_columns_to_agree(spark):
    left = spark.createDataFrame([("a", "X"), ("a", "Y"), ("b", "X"), (None, "X"), ("a", None)], "k string, p string")
    snapshot = spark.createDataFrame([("a", "X", 5), ("c", "X", 6)], "k string, p string, lp int")
    found = joins.join_snapshot(left, snapshot, "k", "p", {"lp": "points"})
    plain = left.join(snapshot.withColumnRenamed("lp", "points"), ["k", "p"], "left").select("k", "p", "points")
    assert rows_of(found) == rows_of(plain)


def test_snapshot_join_reuses_the_partitioning_of_a_latest_per_key(spark):
    from medalstar.operators.keys import latest_per_key

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frames = [
            latest_per_key(spark.range(50).selectExpr("id % 9 as k", "'x' as p", "id as ts"), ["k"], "ts", [])
            for _ in range(2)
        ]
        plan = physical_plan(joins.join_snapshot(frames[0], frames[1], "k", "p", {"ts": "t"}))
        assert plan.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_broadcast_only_below_the_limit(spark):
    small = spark.createDataFrame([(1, "ab"), (2, None)], "k int, s string")
    assert joins.measured_bytes(small) == 2 * 32 + 2
    assert joins.measured_bytes(small.filter("k > 5")) == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(10).withColumnRenamed("id", "k")
        assert "BroadcastHashJoin" in physical_plan(left.join(joins.broadcast_if_small(small), "k"))
        assert "BroadcastHashJoin" not in physical_plan(left.join(joins.broadcast_if_small(small, 50), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_join_keeps_unknown_rows(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert rows_of(joins.join_lookup(left, [(1, "one")], "k int, name string", "k")) == sorted(
        [(1, "one"), (2, None), (None, None)], key=repr
    )


def test_orphans_ignore_null_and_count_rows(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (3,)], "pk int")
    assert rows_of(joins.orphans(child, "fk", parent, "pk")) == [(2, 2)]


@pytest.fixture(scope="module")
def tables(spark):
    child = [("a", 1, "ok", 1), ("a", None, "odd", 9), (None, 3, None, None), ("b", 4, "odd", 9)]
    return {
        "child": spark.createDataFrame(child, "k string, n int, tier string, fk int"),
        "parent": spark.createDataFrame([(1,)], "pk int"),
    }


def test_single_checks(spark, tables):
    child = tables["child"]
    assert rows_of(quality.null_counts(child, ["k", "n", "fk"])) == [("fk", 1), ("k", 1), ("n", 1)]
    assert rows_of(quality.duplicated(child, ["k"])) == [("a", 2)]
    assert rows_of(quality.duplicated(child, ["k", "n"])) == []
    assert rows_of(quality.unaccepted(child, "tier", ["ok"])) == [("odd", 2)]


def test_report(spark, tables):
    suites = {
        "child": quality.Checks(
            not_null=["k", "tier"], unique=["k", "n"], accepted={"tier": ["ok"]}, relationships={"fk": ("parent", "pk")}
        ),
        "parent": quality.Checks(not_null=["pk"]),
    }
    found = quality.report(tables, suites)
    assert rows_of(found) == sorted([
        ("child", "k", "not_null", 1, False), ("child", "tier", "not_null", 1, False),
        ("child", "k", "unique", 1, False), ("child", "n", "unique", 0, True),
        ("child", "tier", "accepted_values", 1, False), ("child", "fk", "relationships", 2, False),
        ("parent", "pk", "not_null", 0, True),
    ], key=repr)


def test_the_report_scans_every_table_once(spark, folder, tables):
    stored = {}
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}")
        stored[name] = spark.read.parquet(f"{folder}/{name}")
    suites = {
        "child": quality.Checks(not_null=["k"], unique=["k"], accepted={"tier": ["ok"]}, relationships={"fk": ("parent", "pk")}),
        "parent": quality.Checks(not_null=["pk"], unique=["pk"]),
    }
    found = quality.report(stored, suites)
    assert physical_plan(found).count("FileScan") == 2
    assert {(r["column_name"], r["test_name"]): r["failures"] for r in found.collect()}[("fk", "relationships")] == 2


def test_the_declared_checks():
    """The declared checks, by hand."""
    not_null = {
        "stg_ladder": "puuid platform tier league_points ingest_ts",
        "stg_matches_participants": "match_id participant_id puuid champion_id win ingest_ts",
        "stg_matches_teams": "match_id team_id win",
        "dim_date": "date_key calendar_date",
        "dim_player": "player_key puuid platform",
        "dim_champion": "champion_key champion_id champion_name",
        "dim_spell": "spell_key spell_id",
        "dim_item": "item_key item_id",
        "dim_queue_patch": "queue_patch_key queue_id game_version",
        "fct_participant_match": "match_id puuid date_key champion_key win",
    }
    unique = {
        "stg_ladder": "puuid", "dim_date": "date_key", "dim_player": "player_key puuid", "dim_champion": "champion_key",
        "dim_spell": "spell_key", "dim_item": "item_key", "dim_queue_patch": "queue_patch_key",
    }
    references = {"date_key": "dim_date", "player_key": "dim_player", "champion_key": "dim_champion",
                  "queue_patch_key": "dim_queue_patch"}
    assert {t: " ".join(s.not_null) for t, s in SUITES.items()} == not_null
    assert {t: " ".join(s.unique) for t, s in SUITES.items() if s.unique} == unique
    assert {t: s.accepted for t, s in SUITES.items() if s.accepted} == {
        "stg_ladder": {"tier": ["CHALLENGER", "GRANDMASTER", "MASTER"]}}
    assert {t: s.relationships for t, s in SUITES.items() if s.relationships} == {
        "fct_participant_match": {key: (parent, key) for key, parent in references.items()}}
    assert sum(s.count() for s in SUITES.values()) == 47


def test_null_checks_of_a_table_are_one_scan(spark, folder):
    spark.range(5).selectExpr("id as a", "id as b", "id as c").write.parquet(f"{folder}/t")
    plan = physical_plan(quality.null_counts(spark.read.parquet(f"{folder}/t"), ["a", "b", "c"]))
    assert plan.count("FileScan") == 1


def test_orphans_group_before_a_shuffled_join(spark):
    # With a broadcast parent Spark moves the join below the grouping, which shuffles as little.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        child = spark.range(100).select((F.col("id") % 2).alias("fk"))
        plan = physical_plan(joins.orphans(child, "fk", spark.range(1).withColumnRenamed("id", "pk"), "pk"))
        assert "HashAggregate" in plan[plan.index("LeftAnti"):]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
