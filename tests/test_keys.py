import os
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

from medalstar.operators import keys
from medalstar.session import scratch, shared_dir
from tests.support import physical_plan, rows_of

SCHEMA = "k string, ts int, v string"
ROWS = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "b"), ("b", None, "n"), ("b", 0, "z"), (None, 5, "q")]


def test_latest_breaks_ties_and_puts_null_times_last(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert rows_of(keys.latest_per_key(df, ["k"], "ts", ["v"])) == sorted(
        [("a", 2, "b"), ("b", 0, "z"), (None, 5, "q")], key=repr
    )


def test_latest_does_not_depend_on_order_or_partitions(spark):
    results = set()
    for seed, parts in ((1, 1), (2, 3), (3, 7)):
        shuffled = ROWS * 5
        random.Random(seed).shuffle(shuffled)
        df = spark.createDataFrame(shuffled, SCHEMA).repartition(parts)
        results.add(tuple(rows_of(keys.latest_per_key(df, ["k"], "ts", ["v"]))))
    assert len(results) == 1


def test_latest_as_of(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    found = keys.latest_as_of(df, ["k"], "ts", F.lit(1), ["v"])
    assert rows_of(found) == [("a", 1, "x"), ("b", 0, "z")]


def test_preferred_beats_newer(spark):
    rows = [("a", 1, "name"), ("a", 9, " "), ("b", 1, ""), ("b", 2, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    found = keys.preferred_latest(df, ["k"], F.trim("v") != "", "ts", ["v"])
    assert rows_of(found) == [("a", 1, "name"), ("b", 2, "")]


def test_dedupe_first_and_top_n(spark):
    rows = [("m1", i, "p") for i in (5, 3, 4)] + [("m2", 1, "p")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(keys.dedupe_first(df, ["k"], ["ts"])) == [("m1", 3, "p"), ("m2", 1, "p")]
    assert rows_of(keys.top_n_per_key(df, ["k"], keys.ascending(["ts"]), 2), "k", "ts") == [
        ("m1", 3), ("m1", 4), ("m2", 1)
    ]


def test_rank_filter_limits_rows_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    plan = physical_plan(keys.latest_per_key(df, ["k"], "ts", []))
    below_the_shuffle = plan.split("Exchange", 1)[1]
    assert "WindowGroupLimit" in below_the_shuffle


def test_dense_key_over_several_columns_with_nulls(spark):
    pairs = [("b", None), ("a", "z"), ("b", "a"), ("a", None), (None, "a"), ("a", "b")]
    df = spark.createDataFrame(pairs, "x string, y string").repartition(3)
    keyed = keys.dense_key(df, "key", ["x", "y"])
    assert [tuple(r) for r in keyed.orderBy("key").collect()] == [
        (1, "a", "b"), (2, "a", "z"), (3, "a", None), (4, "b", "a"), (5, "b", None), (6, None, "a"),
    ]
    assert dict(keyed.dtypes)["key"] == "bigint"


def test_dense_key_computes_its_input_once_and_leaves_no_folder(spark, folder):
    path = f"{folder}/out"
    seen = Observation()
    before = set(os.listdir(shared_dir(spark)))
    with scratch(spark):
        df = spark.range(500).observe(seen, F.count(F.lit(1)).alias("rows"))
        keys.dense_key(df, "key", ["id"]).write.parquet(path)
    assert seen.get["rows"] == 500
    assert set(os.listdir(shared_dir(spark))) == before
    assert rows_of(spark.read.parquet(path).filter("key <> id + 1")) == []


def test_dense_key_of_nothing(spark):
    assert keys.dense_key(spark.createDataFrame([], "x string"), "key", ["x"]).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(-10**6, 10**6), min_size=1, max_size=300, unique=True), parts=st.integers(1, 6))
def test_dense_key_numbers_rows_in_order(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values], "x bigint").repartition(parts)
    numbered = {r["x"]: r["key"] for r in keys.dense_key(df, "key", ["x"]).collect()}
    assert numbered == {v: i for i, v in enumerate(sorted(values), start=1)}


def test_dense_key_over_many_partitions_has_no_single_partition_step(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20000).select(F.sha2(F.col("id").cast("string"), 256).alias("x"))
        keyed = keys.dense_key(df, "key", ["x"])
        assert len(keyed.inputFiles()) > 1
        # The rows themselves are neither shuffled nor sorted again, only the list of files is.
        rows = physical_plan(keyed).split("BroadcastExchange")[0]
        assert "FileScan" in rows and "Exchange" not in rows and "Window" not in rows and "Sort" not in rows
        expected = df.selectExpr("row_number() over (order by x) as key", "x")
        assert keyed.select("key", "x").exceptAll(expected.select(F.col("key").cast("bigint"), "x")).count() == 0
        assert keyed.count() == 20000
        # Evaluated again, every row keeps its key.
        assert keyed.join(keyed.withColumnRenamed("key", "again"), "x").filter("key <> again").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
