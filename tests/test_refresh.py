"""Versions, month upserts, stable keys and folded state: each against a plain model of what it has to hold."""

import os
import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from medalstar.operators import keys, state
from medalstar.plans.warehouse import Warehouse
from medalstar.sources import samples, tables, versions
from tests.support import bronze_rows, physical_plan, rows_of

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def database(spark, request):
    name = f"db_{abs(hash(request.node.name))}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def broken(spark):
    return spark.range(9, numPartitions=3).select(
        F.when(F.col("id") == 8, F.raise_error(F.lit("stop here")).cast("bigint")).otherwise(F.col("id")).alias("id"))


# --- versions


def test_readers_keep_the_version_they_began_with(spark, folder):
    path = f"{folder}/t"
    early = tables.replace_files(spark.range(5), path)
    again = tables.replace_files(early.union(spark.range(100, 102)), path)  # reads what it replaces
    assert (early.count(), again.count()) == (5, 7)
    assert versions.read_current(spark, path, early.schema).count() == 7
    tables.replace_files(spark.range(1), path)  # the first version is released by now
    assert len(versions.versions(spark, path)) == 2 and again.count() == 7


def test_failed_and_unfinished_versions_do_not_count(spark, folder):
    path = f"{folder}/t"
    with pytest.raises(FileNotFoundError):
        versions.current_version(spark, path)
    tables.replace_files(spark.range(5), path)
    with pytest.raises(Exception, match="stop here"):
        tables.replace_files(broken(spark), path)
    os.mkdir(f"{path}/version-000000007-{'0' * 32}")  # begun by somebody else
    assert versions.read_current(spark, path, spark.range(1).schema).count() == 5
    fresh = versions.write_version(spark.range(3), path)
    assert fresh.rsplit("/", 1)[-1].startswith("version-000000008") and versions.current_version(spark, path) == fresh
    assert len(versions.release_versions(spark, path)) == 2 and os.listdir(path) == [fresh.rsplit("/", 1)[-1]]
    with pytest.raises(ValueError):
        versions.release_versions(spark, path, 0)


def test_a_table_is_switched_in_one_step(spark, database):
    name = f"{database}.t"
    tables.replace_table(spark.range(5), name)
    early = spark.table(name)
    with pytest.raises(Exception, match="stop here"):
        tables.replace_table(broken(spark), name)
    assert spark.table(name).count() == 5
    tables.replace_table(spark.table(name).union(spark.range(10, 13)), name)
    assert (early.count(), spark.table(name).count()) == (5, 8)
    tables.replace_table(spark.range(2).withColumn("more", F.lit("x")), name)  # other columns
    assert rows_of(spark.table(name)) == [(0, "x"), (1, "x")]
    tables.append_rows(spark.range(3, 4).withColumn("more", F.lit("y")), name)
    assert spark.table(name).count() == 3
    left = [r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect()]
    assert left == ["t"]


# --- upserts


KIND = "k bigint, at timestamp, v string, n int"


def at(month, day=1):
    return month and datetime(2025, month, day)


def files_of(path):
    return {d: sorted((f, os.stat(f"{path}/{d}/{f}").st_mtime_ns) for f in os.listdir(f"{path}/{d}")) for d in os.listdir(path) if "=" in d}


def stored(spark, path):
    return rows_of(spark.read.schema(KIND + ", game_month string").parquet(path), "k", "at", "v", "n")


def test_only_months_with_changes_are_rewritten(spark, folder):
    path = f"{folder}/t"

    def ingest(rows, **options):
        return tables.upsert_months(spark.createDataFrame(rows, KIND), path, ["k"], "at", [F.col("n").desc_nulls_last(), F.col("v")], **options)

    first = [(1, at(1), "a", 1), (2, at(2), "b", 1), (3, at(3), None, 1), (None, at(3), "null key", 1), (4, None, "no time", 1)]
    assert ingest(first) == ["2025-01", "2025-02", "2025-03", None]
    before = files_of(path)
    assert ingest(first) == [] and files_of(path) == before  # twice
    second = [(2, at(2), "b2", 2), (2, at(2), "older", 1), (5, at(2), "new", 1), (3, at(3), None, 1), (None, at(3), "null key", 1)]
    assert ingest(second) == ["2025-02"]
    after = files_of(path)
    assert all(after[m] == before[m] for m in before if m != "game_month=2025-02")
    expected = {1: (1, at(1), "a", 1), 2: (2, at(2), "b2", 2), 3: first[2], None: first[3], 4: first[4], 5: second[2]}
    assert stored(spark, path) == sorted(expected.values(), key=repr)
    assert ingest([(3, at(3), "", 1)]) == ["2025-03"]  # NULL and empty differ
    assert ingest([(1, at(4), "moved", 1), (5, at(1), "moved", 1)], moves=True) == ["2025-01", "2025-02", "2025-04"]
    assert ingest([(1, at(4), "moved", 1)], moves=True) == []
    assert ingest([(5, at(2), "back", 1)], moves=True) == ["2025-01", "2025-02"]  # January is empty now
    assert "game_month=2025-01" not in os.listdir(path)
    assert [r[0] for r in stored(spark, path)] == sorted([1, 2, 3, 4, 5, None], key=lambda k: repr((k,)))
    assert ingest([]) == []


def test_ingests_in_any_number_agree_with_a_dictionary(spark, folder):
    rng, model, path = random.Random(3), {}, f"{folder}/t"
    for _ in range(4):
        rows = [(rng.randrange(40), at(rng.randrange(1, 5)), rng.choice("abc"), rng.randrange(3)) for _ in range(30)]
        news = {}
        for row in sorted(rows, key=lambda r: (-r[3], r[2], r[1])):
            news.setdefault(row[0], row)
        touched = {m for k, row in news.items() if model.get(k) != row for m in (row[1].month, *([model[k][1].month] if k in model else []))}
        got = tables.upsert_months(spark.createDataFrame(rows, KIND), path, ["k"], "at", [F.col("n").desc(), F.col("v"), F.col("at")], moves=True)
        assert got == [f"2025-{m:02d}" for m in sorted(touched)]
        model.update(news)
        assert stored(spark, path) == sorted(model.values(), key=repr)


# --- keys


def test_known_members_keep_their_keys(spark, folder):
    kind = "key bigint, a string, b int"
    registry = spark.createDataFrame([], kind)
    seen = {}
    for rows in ([("x", 1), ("m", None), ("m", None), (None, None)], [("a", 5), ("x", 1), ("m", 2)], [], [(None, None), ("b", 0)]):
        members = spark.createDataFrame(rows, "a string, b int")
        registry = tables.replace_files(keys.grow_registry(registry, members, "key", ["a", "b"]), f"{folder}/registry")
        now = {(a, b): k for k, a, b in rows_of(registry)}
        assert seen.items() <= now.items() and sorted(now.values()) == list(range(1, len(now) + 1))
        new = sorted(set(now) - set(seen), key=lambda m: (m[0] is None, m[0] or "", m[1] is None, m[1] or 0))
        assert [now[m] for m in new] == list(range(len(seen) + 1, len(now) + 1))
        seen = now
        keyed = keys.registered_key(members.withColumn("more", F.lit(1)), registry, "key", ["a", "b"])
        assert rows_of(keyed) == sorted([(now[r], *r, 1) for r in rows], key=repr)


def test_a_rebuilt_warehouse_keeps_its_keys(spark, folder):
    def build(players, keep):
        bronze = {"matches_participants": bronze_rows(spark, "matches_participants", [{"puuid": p, "match_id": "m"} for p in players]),
                  "ladder": bronze_rows(spark, "ladder", [])}
        store = Warehouse(spark, bronze, f"{folder}/lake-{keep}", keep_keys=keep)
        return dict(rows_of(store.table("dim_player"), "puuid", "player_key"))

    assert build(["d", "b"], True) == {"b": 1, "d": 2}
    assert build(["a", "d", "c"], True) == {"d": 2, "a": 3, "c": 4}
    assert build(["b", "a"], True) == {"b": 1, "a": 3}
    assert build(["d", "b"], False) == {"b": 1, "d": 2} and build(["a", "d"], False) == {"a": 1, "d": 2}


# --- folded state


def test_folds_agree_with_the_whole_history_in_any_order(spark, database):
    rng = random.Random(8)
    rows = [(rng.choice([1, 2, 3, 4, None]), at(rng.choice([None, *range(1, 6)])), rng.choice(["a", "b", None]), rng.randrange(5)) for _ in range(120)]
    history = spark.createDataFrame(rows, KIND)
    expected = rows_of(keys.latest_per_key(history, ["k"], "at", ["v", "n"]))
    parts = [rows[i::5] for i in range(5)]
    for attempt in range(2):
        rng.shuffle(parts)
        for part in [*parts, parts[0], []]:
            state.fold_latest(f"{database}.s{attempt}", spark.createDataFrame(part, KIND), ["k"], "at", ["v", "n"], 4)
        assert rows_of(spark.table(f"{database}.s{attempt}")) == expected


def test_a_fold_shuffles_and_reads_only_the_ingest(spark, database):
    """The history is not an input; the state is read in its buckets, without an exchange above it."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders = samples.inputs(spark, SMALL, "orders")["orders"].select("o_custkey", "o_orderdate", "o_orderkey")
        state.fold_latest(f"{database}.s", orders, ["o_custkey"], "o_orderdate", ["o_orderkey"], 4)
        news = spark.createDataFrame([(1, datetime(2030, 1, 1), 7)], "o_custkey bigint, o_orderdate timestamp, o_orderkey bigint")
        news = news.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))
        merged = state.merge_latest(spark.table(f"{database}.s"), news, ["o_custkey"], "o_orderdate", ["o_orderkey"], 4)
        plan = physical_plan(merged)
        scans = re.findall(r"FileScan parquet spark_catalog[^\n]*", plan)
        assert "/testdata/" not in plan and len(scans) == plan.count("FileScan") == 3
        # Both joins read the state by bucket; an exchange would switch that off.
        assert all("Bucketed: true" in s for s in scans) and plan.count("SelectedBucketsCount: 4 out of 4") >= 2
        assert rows_of(merged.filter("o_custkey = 1"), "o_orderkey") == [(7,)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
