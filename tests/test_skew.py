"""A third and more of the rows under one key: results stay whole, and the plan splits or pre-reduces."""

import random

import pytest
from pyspark.sql import functions as F

from medalstar.operators import joins, keys, shape, skew, topk
from medalstar.operators.skew import hot_keys, join_hot_keys
from medalstar.plans import gold
from tests.support import physical_plan, rows_of

ROWS = 60000


@pytest.fixture(scope="module")
def hot(spark):
    """Half of the rows under key 'hot', a tenth under NULL."""
    k = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 10 == 1, None).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))
    )
    return spark.range(ROWS, numPartitions=8).select("id", k.alias("k"), (F.col("id") % 50).alias("v")).cache()


def test_selection_per_hot_key(spark, hot):
    best = {}
    for r in hot.select("id", "k").collect():
        best[r["k"]] = max(best.get(r["k"], -1), r["id"])
    assert dict(rows_of(keys.latest_per_key(hot, ["k"], "id", []), "k", "id")) == best
    firsts = keys.top_n_per_key(hot, ["k"], keys.ascending(["id"]), 20)
    assert firsts.filter("k = 'hot'").count() == 20
    assert [r["id"] for r in firsts.filter("k = 'hot'").orderBy("id").collect()] == list(range(0, 40, 2))


def test_shuffle_of_a_hot_key_carries_few_rows(spark, hot):
    ranked = keys.latest_per_key(hot, ["k"], "id", [])
    ranked.collect()
    # The shuffle below the final rank gets at most one row per key and input task.
    plan = ranked._jdf.queryExecution().executedPlan()
    written = [int(n) for n in _shuffle_records(plan)]
    assert written and max(written) <= 8 * hot.select("k").distinct().count()


def _shuffle_records(plan):
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        yield from _shuffle_records(plan.executedPlan())
    elif name == "ShuffleQueryStageExec":
        yield plan.plan().metrics().apply("shuffleRecordsWritten").value()
    elif name.endswith("QueryStageExec"):
        yield from _shuffle_records(plan.plan())
    else:
        children = plan.children()
        for i in range(children.size()):
            yield from _shuffle_records(children.apply(i))


def test_adaptive_execution_splits_a_hot_join_key(spark, hot, folder):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        # Stored, as in the warehouse: both sides shuffle right below the join.
        unique = hot.filter("k is not null").select("k").distinct()
        unique.selectExpr("k", "'x' as p", "length(k) as lp").write.parquet(f"{folder}/snapshot")
        snapshot = spark.read.parquet(f"{folder}/snapshot")
        joined = joins.join_snapshot(hot.withColumn("p", F.lit("x")), snapshot, "k", "p", {"lp": "lp"})
        found = joined.agg(F.count("*"), F.count("lp"), F.sum("lp"), F.countDistinct("id"))
        expected = hot.agg(F.count("*"), F.count("k"), F.sum(F.length("k")), F.lit(ROWS).cast("bigint"))
        assert tuple(found.first()) == tuple(expected.first())
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_a_hot_key_stays_visible_above_2000_partitions(spark, folder):
    # Spark averages block sizes there; the launch settings keep the large ones exact.
    settings = {
        "spark.sql.shuffle.partitions": "2500",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        spark.range(20000).selectExpr("concat('k', id) as k", "id as v").write.parquet(f"{folder}/right")
        k = F.when(F.col("id") % 3 == 0, "k7").otherwise(F.concat(F.lit("k"), (F.col("id") % 20000).cast("string")))
        left = spark.range(0, 300000, 1, 8).select(k.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
        joined = left.join(spark.read.parquet(f"{folder}/right"), "k", "left").filter("v is null or length(x) > 0")
        rows = joined.select("v", "x").collect()
        assert len(rows) == 300000 and sum(r["v"] == 7 for r in rows) >= 100000
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    plan = physical_plan_of_last_query(spark)
    assert "skew=true" in plan


def physical_plan_of_last_query(spark) -> str:
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    return runs.apply(runs.size() - 1).physicalPlanDescription()


def test_distinct_and_orphans_of_a_hot_key(spark, hot):
    assert rows_of(shape.unpivot_distinct(hot, ["v", "v"], "x")) == sorted(((i,) for i in range(50)), key=repr)
    parent = hot.select("k").filter("k <> 'hot'").distinct()
    assert rows_of(joins.orphans(hot, "k", parent, "k")) == [("hot", ROWS // 2)]


def test_first_n_over_a_hot_key(spark, hot):
    first_seen = {}
    for r in hot.select("id", "k").filter("k is not null").collect():
        first_seen[r["k"]] = min(first_seen.get(r["k"], ROWS), r["id"])
    expected = [k for k, _ in sorted(first_seen.items(), key=lambda kv: kv[1])][:30]
    found = topk.first_n(hot.filter("k is not null"), "k", ["id"], 30)
    assert [r["k"] for r in found.collect()] == expected


def test_players_of_a_hot_puuid(spark, hot):
    rows = hot.select(
        F.col("k").alias("puuid"), F.lit("VN2").alias("platform"), F.lit("").alias("summoner_name"),
        F.col("k").alias("riot_id_name"), F.lit("t").alias("riot_id_tagline"),
        F.timestamp_millis(F.col("id")).alias("ingest_ts"),
    )
    assert gold.current_players(rows).count() == hot.select("k").filter("k is not null").distinct().count()


# --- salted joins


def _sides(spark, hot_left, hot_right):
    """3000 rows left, 900 right; key 1 is hot as asked, key 2 is missing right, some keys are NULL."""
    rng = random.Random(5)
    left = [(1 if hot_left and i % 3 == 0 else 2 if i % 11 == 0 else rng.choice([None, *range(3, 400)]), "x" if i % 2 else None, i) for i in range(3000)]
    right = [(1 if hot_right and i % 3 == 0 else rng.choice([None, *range(3, 400)]), "x", i) for i in range(900)]
    if hot_left and not hot_right:
        right.append((1, "x", 9999))
    return (spark.createDataFrame(left, "k int, side string, l int").repartition(4),
            spark.createDataFrame(right, "k int, side string, r int").repartition(3))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot", [(True, False), (False, True), (True, True), (False, False)])
@pytest.mark.parametrize("keys", [["k"], ["k", "side"]])
def test_salted_joins_agree_with_plain_ones(spark, how, hot, keys):
    left, right = _sides(spark, *hot)
    if keys == ["k"]:
        right = right.drop("side")
    got = join_hot_keys(left, right, keys, how, share=0.15, salts=5)
    plain = left.join(right, keys, how).select(got.columns)
    # A key that is hot on one side only has few rows on the other; compare counts and checksums of large results.
    told = [df.groupBy(F.xxhash64(*df.columns).alias("h")).count().agg(F.count("*"), F.sum("count"), F.bit_xor(F.xxhash64("h", "count"))).first() for df in (got, plain)]
    assert told[0] == told[1] and told[0][1] > 0
    assert ("_salt" in physical_plan(got) or "_right" in physical_plan(got)) == any(hot)


def test_hot_keys_are_found_and_dealt_out(spark):
    left, right = _sides(spark, True, True)
    found = hot_keys(left, ["k"], 0.05)
    assert len(found) == 2 and max(found.values()) >= 1000
    assert hot_keys(spark.createDataFrame([], "k int"), ["k"], 0.05) == {}
    assert hot_keys(spark.range(5000), ["id"], 0.01) == {}
    with pytest.raises(ValueError):
        hot_keys(left, ["k"], 0.0001)
    with pytest.raises(ValueError):
        join_hot_keys(left, right, ["k"], "full")
    # No part of the hot key holds much more than its share of the salts.
    dealt = skew._salted(left.filter("k = 1"), "_salt", 8).groupBy("_salt").count().agg(F.count("*"), F.max("count")).first()
    assert dealt[0] == 8 and dealt[1] < 2 * 1000 / 8
