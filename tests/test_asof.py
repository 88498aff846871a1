"""As-of joins against brute force, and how a hot key is split."""

import random
import re
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from medalstar.operators.asof import join_as_of
from tests.support import optimized_plan, physical_plan, rows_of

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
LEFT = "player string, platform string, seconds bigint, row bigint, tier string"
RIGHT = "player string, platform string, seconds bigint, tier string, points bigint"


def frames(spark, left, right):
    timed = [spark.createDataFrame(rows, kind).withColumn("at", F.timestamp_seconds("seconds")).drop("seconds")
             for rows, kind in ((left, LEFT), (right, RIGHT))]
    return timed[0], timed[1].withColumnRenamed("at", "since")


def brute(left, right, inclusive):
    out = []
    for player, platform, at, row, tier in left:
        best = None
        for p, q, since, t, points in right:
            if None in (player, platform, at, p, q, since) or (p, q) != (player, platform):
                continue
            if since < at or inclusive and since == at:
                rank = (-since, t is None, t or "", points is None, points or 0)
                if best is None or rank < best[0]:
                    best = rank, t, points
        out.append((player, platform, row, tier, *(best[1:] if best else (None, None))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("inclusive, bucket", [(True, 86_400), (False, 86_400), (True, 7), (False, 7)])
def test_as_of_is_that_of_brute_force(spark, inclusive, bucket):
    """Nulls everywhere, equal times, repeated rows, times before 1970, clashing names; buckets of all sizes."""
    rng = random.Random(bucket)
    who = lambda: rng.choice(["a", "a", "a", "b", "c", None])
    when = lambda: rng.choice([None, *range(-40, 80)])
    left = [(who(), rng.choice(["x", "y", None]), when(), i % 290, rng.choice(["own", None])) for i in range(300)]
    right = [(who(), rng.choice(["x", "y", None]), when(), rng.choice(["gold", "iron", None]), rng.choice([1, 2, None]))
             for _ in range(90)]
    matches, history = frames(spark, left, right)
    got = join_as_of(matches, history, ["player", "platform"], "at", "since", {"tier": "tier_then", "points": "points_then"},
                     ["tier", "points"], bucket, inclusive)
    assert got.columns == [*matches.columns, "tier_then", "points_then"]
    assert rows_of(got.drop("at")) == brute(left, right, inclusive)


def test_empty_sides(spark):
    one = [("a", "x", 5, 1, None)]
    for left, right in (([], []), (one, []), ([], [("a", "x", 1, "gold", 3)])):
        got = join_as_of(*frames(spark, left, right), ["player"], "at", "since", {"points": "p"}, ["tier"])
        assert rows_of(got, "player", "p") == [("a", None) for _ in left]


def test_a_hot_player_is_split_by_time(spark):
    """Every window that sees matches is cut by time; the pass by player sees a row per bucket."""
    n, days = 30_000, 300
    player = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 500))
    at = F.timestamp_seconds((F.col("id") * 7919) % (days * 86_400))
    matches = spark.range(n).select("id", player.alias("player"), at.alias("at"))
    history = spark.range(3000).select(player.alias("player"), F.timestamp_seconds(F.col("id") * 8640).alias("since"), F.col("id").alias("points"))
    got = join_as_of(matches, history, ["player"], "at", "since", {"points": "points"}, ["points"])
    # Partitioning of every window: player and bucket or moment, or player alone over the rows of the second pass.
    specs = re.findall(r"windowspecdefinition\((.*?), specifiedwindowframe", optimized_plan(got))
    assert specs and all(re.search(r"_bucket#|_at#", s) for s in specs)
    sizes = matches.filter("player = 'hot'").groupBy(F.to_date("at")).count().agg(F.max("count")).first()[0]
    assert sizes < n / 3 / 50  # what one window of the hot player holds
    assert "CartesianProduct" not in physical_plan(got) and "BroadcastNestedLoopJoin" not in physical_plan(got)
    answered = got.filter("points IS NOT NULL").agg(F.count("*"), F.max(F.col("points"))).first()
    expected = spark.sql("""SELECT count(*) FROM {m} m WHERE EXISTS (SELECT 1 FROM {h} h WHERE h.player = m.player AND h.since <= m.at)""",
                            m=matches, h=history).first()[0]
    assert answered[0] == expected > 0 and got.count() == n
    wrong = got.join(history.select("player", F.col("points").alias("q"), "since"), "player").filter(
        "since <= at AND q > points").limit(1)  # points rise with time, so a later row would have more
    assert wrong.collect() == []
