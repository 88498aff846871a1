from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalstar.operators import shape, topk
from tests.support import physical_plan, rows_of

TIERS = ["CHALLENGER", "GRANDMASTER", "MASTER"]


def test_unpivot_distinct_equals_a_union_of_columns(spark):
    df = spark.range(200).select(*[
        F.when(F.col("id") % 11 != i, (F.col("id") * (i + 1)) % 50).alias(f"c{i}") for i in range(7)
    ])
    legs = [df.select(F.col(f"c{i}").alias("v")) for i in range(7)]
    union = reduce(DataFrame.union, legs).distinct().filter("v is not null")
    assert rows_of(shape.unpivot_distinct(df, df.columns, "v")) == rows_of(union)


def test_unpivot_scans_once(spark, folder):
    spark.range(10).selectExpr("id as a", "id + 1 as b").write.parquet(f"{folder}/t")
    plan = physical_plan(shape.unpivot_distinct(spark.read.parquet(f"{folder}/t"), ["a", "b"], "v"))
    assert plan.count("FileScan") == 1


def test_union_all_fills_missing_columns(spark):
    left = spark.createDataFrame([(1, "a")], "n int, s string")
    right = spark.createDataFrame([("b",)], "s string")
    assert rows_of(shape.union_all([left, right])) == [(1, "a"), (None, "b")]


def test_select_present(spark):
    df = spark.createDataFrame([(1, 2)], "b int, a int")
    assert shape.select_present(df, ["a", "missing", "b"]).columns == ["a", "b"]


def ladder(spark):
    sizes = {"CHALLENGER": 3, "GRANDMASTER": 4, "MASTER": 5}
    rows = [(f"{t[0]}{i}", t, 100 * i + len(t)) for t, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows + [("G9", "GRANDMASTER", 5000), ("X", "IRON", 9999)], "p string, tier string, lp int")


def waterfall_by_hand(rows, k):
    admitted = []
    for tier in TIERS:
        if len(admitted) < k:
            admitted += [r for r in rows if r[1] == tier]
    return sorted(admitted, key=lambda r: (-r[2], r[0]))[:k]


def test_ladder_waterfall(spark):
    df = ladder(spark)
    rows = [tuple(r) for r in df.collect()]
    for k in (2, 3, 4, 5, 8, 9, 100):
        found = [tuple(r) for r in topk.ladder_waterfall(df, TIERS, "tier", "lp", k, ["p"]).collect()]
        assert found == waterfall_by_hand(rows, k), k


def test_ladder_waterfall_is_one_plan(spark):
    plan = physical_plan(topk.ladder_waterfall(ladder(spark), TIERS, "tier", "lp", 5, ["p"]))
    assert "Subquery" in plan and "TakeOrderedAndProject" in plan


def test_tier_major_rank_keeps_tiers_apart(spark):
    opens = {"CHALLENGER": 0, "GRANDMASTER": 3, "MASTER": 6}
    found = topk.tier_major_rank(ladder(spark), opens, "tier", "lp", 5, ["p"])
    assert [tuple(r) for r in found.orderBy("rank").select("rank", "p").collect()] == [
        (1, "C2"), (2, "C1"), (3, "C0"), (4, "G9"), (5, "G3"),
    ]
    # At or below the first limit only the top tier takes part, even if it is short.
    assert topk.tier_major_rank(ladder(spark), {"CHALLENGER": 0, "GRANDMASTER": 300}, "tier", "lp", 200, ["p"]).count() == 3


def test_top_k_breaks_equal_points_at_the_cut(spark):
    df = spark.createDataFrame([("b", 7), ("a", 7), ("c", 9)], "p string, lp int")
    assert [r["p"] for r in topk.top_k(df, "lp", 2, ["p"]).collect()] == ["c", "a"]


def test_first_n_puts_unknown_arrival_last(spark):
    df = spark.createDataFrame([("m1", None), ("m2", 2025), ("m3", 2024)], "m string, at int")
    assert [r["m"] for r in topk.first_n(df, "m", ["at"], 2).collect()] == ["m3", "m2"]


def test_first_n_follows_arrival(spark):
    rows = [("m2", 1), ("m1", 2), ("m2", 3), ("m3", 4), ("m1", 0)]
    df = spark.createDataFrame(rows, "m string, at int")
    assert [r["m"] for r in topk.first_n(df, "m", ["at"], 2).collect()] == ["m1", "m2"]
