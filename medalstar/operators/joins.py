"""Join helpers. All joins are equi-joins under SQL equality: NULL keys never match."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Upper bound on what is broadcast, measured rather than estimated.
BROADCAST_BYTES = 16 * 1024 * 1024


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the rows: 16 per value plus the text. One aggregate over the frame."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    width = F.lit(16 * len(df.columns))
    for name in texts:
        width = width + F.coalesce(F.octet_length(name), F.lit(0))
    return df.agg(F.coalesce(F.sum(width.cast("bigint")), F.lit(0))).first()[0]


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only where the measured size allows; otherwise Spark shuffles the join.

    Meant for stored or checkpointed frames, where measuring costs one small scan.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def join_lookup(df: DataFrame, rows: Sequence[tuple], schema: str, key: str) -> DataFrame:
    """Left join to a fixed list of rows written in the code."""
    table = df.sparkSession.createDataFrame(rows, schema)
    return df.join(F.broadcast(table), key, "left")


def join_snapshot(
    df: DataFrame, snapshot: DataFrame, key: str, same: str, columns: Mapping[str, str]
) -> DataFrame:
    """Left join on ``key`` and ``same`` to a snapshot that holds one row per ``key``.

    Because ``key`` alone is unique in the snapshot, it carries the join, and ``same`` only decides
    whether the joined values count. Both sides can then reuse a partitioning by ``key``. Where
    ``df`` may hold a hot key, pass a stored snapshot: adaptive execution splits a skewed join only
    if both sides are shuffled right below it.
    ``columns`` maps snapshot columns to output names.
    """
    right = snapshot.select(
        key, F.col(same).alias("_same"), *[F.col(old).alias(f"_snap_{new}") for old, new in columns.items()]
    )
    agrees = F.col(same) == F.col("_same")
    return df.join(right, key, "left").select(
        *df.columns, *[F.when(agrees, F.col(f"_snap_{new}")).alias(new) for new in columns.values()]
    )


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign keys without a parent row and how many child rows carry each; NULL keys pass.

    The child is grouped first, so the anti join sees each key once, however hot it is.
    """
    keys = child.filter(F.col(foreign_key).isNotNull()).groupBy(foreign_key).agg(F.count("*").alias("child_rows"))
    return keys.join(parent.select(F.col(parent_key).alias(foreign_key)), foreign_key, "left_anti")
