"""As-of joins: each row with the newest row of a history that is not later than it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medalstar.operators.keys import ascending, top_n_per_key


def _all_present(*columns: str) -> Column:
    return reduce(Column.__and__, (F.col(c).isNotNull() for c in columns))


def join_as_of(
    left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, since: str, columns: Mapping[str, str],
    ties: Sequence[str], bucket_seconds: int = 86_400, inclusive: bool = True,
) -> DataFrame:
    """``left`` plus ``columns`` (history name -> output name) of its newest ``right`` row with ``since`` <= ``at``.

    All rows of ``left`` stay; without a key, a time or an earlier history row the columns are NULL. Of history rows with
    one key and time the first in the order of ``ties`` counts. Not ``inclusive`` asks for ``since`` < ``at``.

    The distinct moments of ``left`` and the history are put in one order of time within (key, time bucket), where the
    last history row before a moment is its answer; the last one of all earlier buckets comes from a second, small pass with
    one row per bucket. So a key with any share of the rows is split by time, the wide rows of ``left`` are
    never sorted, and they meet the answers in an equi-join on key and time, which adaptive execution can split.
    ``left`` is read for its moments and again for the join: pass a stored table.
    """
    keys = list(keys)
    fact, moment = (0, 1) if inclusive else (2, 1)
    told = right.filter(_all_present(*keys, since)).select(
        *keys, F.col(since).cast("timestamp").alias("_at"), F.struct(*[F.col(old).alias(new) for old, new in columns.items()]).alias("_value"),
        *[F.col(c).alias(f"_tie{i}") for i, c in enumerate(ties)])
    told = top_n_per_key(told, [*keys, "_at"], ascending([f"_tie{i}" for i in range(len(ties))]) or [F.lit(1)])
    asked = left.filter(_all_present(*keys, at)).select(*keys, F.col(at).cast("timestamp").alias("_at")).distinct()
    events = told.select(*keys, "_at", F.lit(fact).alias("_kind"), "_value").unionByName(
        asked.select(*keys, "_at", F.lit(moment).alias("_kind"), F.lit(None).cast(told.schema["_value"].dataType).alias("_value")))
    events = events.withColumn("_bucket", F.expr(f"unix_micros(_at) div {bucket_seconds * 1_000_000}"))

    inside = Window.partitionBy(*keys, "_bucket").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    local = events.withColumn("_local", F.last("_value", ignorenulls=True).over(inside)).filter(F.col("_kind") == moment)
    lasts = events.groupBy(*keys, "_bucket").agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col("_at"))).alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select(*keys, "_bucket", F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    answers = local.join(carried, [*keys, "_bucket"]).select(
        *keys, "_at", F.coalesce("_local", "_carried").alias("_value")).filter(F.col("_value").isNotNull())
    rows = left.withColumn("_at", F.col(at).cast("timestamp"))
    return rows.join(answers, [*keys, "_at"], "left").select(
        *left.columns, *[F.col(f"_value.{new}").alias(new) for new in columns.values()])
