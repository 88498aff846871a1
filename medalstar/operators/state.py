"""Results kept as state: an ingest is merged into what is stored, the history is not read again."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalstar.operators.keys import latest_per_key
from medalstar.sources.tables import replace_table


def same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    """Equality of all ``columns``, where NULL equals NULL."""
    return reduce(Column.__and__, (left[c].eqNullSafe(right[c]) for c in columns))


def _goes_first(ts: str, ties: Sequence[str], one: str, other: str) -> Column:
    """Whether row ``one`` stands before ``other`` in the order of ``latest_per_key``."""
    a, b = F.col(f"{one}.{ts}"), F.col(f"{other}.{ts}")
    newer = (a > b) | (a.isNotNull() & b.isNull())
    rank = [F.struct(*[x for c in ties for x in (F.col(f"{row}.{c}").isNull(), F.col(f"{row}.{c}"))]) for row in (one, other)]
    return F.coalesce(newer, F.lit(False)) | (a.eqNullSafe(b) & (rank[0] < rank[1]))


def merge_latest(
    state: DataFrame, news: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str], buckets: int,
) -> DataFrame:
    """The newest row per key of ``state``, which holds one row per key, and ``news``.

    As taking the newest is a maximum in a total order, ingests may be merged in any order, in parts or twice. The
    state is only joined by its keys: stored in ``buckets`` of them, it is not shuffled. One row per key of the news
    is brought to as many partitions, as Spark would rather shuffle the state than join unequal numbers.
    """
    fresh = latest_per_key(news.select(state.columns), keys, ts, ties).repartition(buckets, *keys)
    keyless = reduce(Column.__or__, (F.col(c).isNull() for c in keys))
    rows = [df.filter(~keyless).select(*keys, F.struct(*df.columns).alias(name)) for df, name in ((state, "_old"), (fresh, "_new"))]
    newest = F.when(F.col("_new").isNotNull() & _goes_first(ts, ties, "_new", "_old"), F.col("_new")).otherwise(F.col("_old"))
    kept = rows[0].join(rows[1], list(keys), "left").select(newest.alias("_row")).select("_row.*")
    added = rows[1].join(rows[0].select(*keys), list(keys), "left_anti").select("_new.*")
    # NULL is a key like any other, but joins do not match it: those few rows are ordered anew.
    without = latest_per_key(state.filter(keyless).unionByName(fresh.filter(keyless)), keys, ts, ties)
    return kept.unionByName(added).unionByName(without)


def fold_latest(table: str, news: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str], buckets: int) -> None:
    """Merge an ingest into the stored newest rows, a table in buckets by key; made where it does not exist.

    The new state is written from the buckets of the old one, without a shuffle of it, and replaces it in one step.
    """
    spark = news.sparkSession
    if not spark.catalog.tableExists(table):
        replace_table(latest_per_key(news, keys, ts, ties), table, keys, buckets)
        return
    replace_table(merge_latest(spark.table(table), news, keys, ts, ties, buckets), table, keys, buckets, in_place=True)
