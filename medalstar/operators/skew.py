"""Joins whose hot keys are found first and salted; all other keys join as usual."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TRACKED = 4096  # keys a sketch holds; it overcounts by at most about one in a thousand of the rows
_MERGERS = 256


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def hot_keys(df: DataFrame, keys: Sequence[str], share: float) -> dict[int, int]:
    """Hash -> estimated rows of the keys that hold ``share`` of the rows or more; at most 1 / ``share`` of them.

    Every task keeps a sketch of frequent items; the sketches meet in groups of tasks and then once more. A sketch never
    misses a key above its error, so a share below 0.002 needs more tracked keys and is refused.
    """
    if share < 0.002:
        raise ValueError("share must be at least 0.002")
    known = df.select(*keys).na.drop()
    if known.isEmpty():
        return {}
    known = known.select(_hash(keys).alias("k"), F.pmod(F.spark_partition_id(), F.lit(_MERGERS)).alias("part"))
    parts = known.groupBy("part").agg(F.expr(f"approx_top_k_accumulate(k, {_TRACKED})").alias("sketch"), F.count("*").alias("n"))
    row = parts.agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {_TRACKED}), {int(2 / share)})").alias("top"), F.sum("n").alias("n")).first()
    return {t["item"]: t["count"] for t in row["top"] if t["count"] >= share * row["n"]}


def _among(hashed: Column, keys: dict[int, int]) -> Column:
    return hashed.isin(list(keys)) if keys else F.lit(False)


def _salted(df: DataFrame, name: str, salts: int) -> DataFrame:
    """Rows dealt out by their content, so that a repeated task deals them alike."""
    return df.withColumn(name, F.pmod(F.xxhash64(F.lit(17), *df.columns), F.lit(salts)).cast("int"))


def _copied(df: DataFrame, name: str, salts: int) -> DataFrame:
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def join_hot_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", share: float = 0.005, salts: int = 32,
) -> DataFrame:
    """Inner or left join under SQL equality, for keys that hold a large share of either side.

    A key that is hot on the left only: its left rows are dealt to ``salts`` parts, its right rows copied to each. A key that is
    hot on the right: both sides are dealt and copied, into ``salts`` parts for a side on which it is hot, so that
    no task holds more than a part of either. As such a key has right rows, a left join of it is an inner one, and
    no left row stays alone in one part only. The rest joins plainly. Without hot keys this is the plain join. Copies
    grow by ``salts`` times the rows of hot keys; completely equal left rows stay in one part.
    """
    if how not in ("inner", "left"):
        raise ValueError("hot keys can be salted in inner and left joins")
    keys = list(keys)
    on_left, on_right = hot_keys(left, keys, share), hot_keys(right, keys, share)
    if not on_left and not on_right:
        return left.join(right, keys, how)
    columns = [*left.columns, *[c for c in right.columns if c not in keys]]
    only_left = {k: n for k, n in on_left.items() if k not in on_right}
    here = {df: _hash(keys) for df in (left, right)}

    def side(df: DataFrame, chosen: dict[int, int]) -> DataFrame:
        return df.filter(_among(here[df], chosen))

    cold = ~_among(_hash(keys), {**on_left, **on_right})
    parts = [left.filter(cold).join(right.filter(cold), keys, how)]
    if only_left:
        parts.append(_salted(side(left, only_left), "_salt", salts).join(
            _copied(side(right, only_left), "_salt", salts), [*keys, "_salt"], how))
    both, just_right = ({k: n for k, n in on_right.items() if (k in on_left) == wanted} for wanted in (True, False))
    for chosen, left_salts in ((both, salts), (just_right, 1)):
        if chosen:
            dealt = _copied(_salted(side(left, chosen), "_left", left_salts), "_right", salts)
            met = _copied(_salted(side(right, chosen), "_right", salts), "_left", left_salts)
            # A hash that other keys share is hot for all of them: those without a right row are kept by the anti join.
            parts.append(dealt.join(met, [*keys, "_left", "_right"], "inner"))
            if how == "left":
                present = side(right, chosen).select(*keys).distinct()  # as few as there are hot keys
                parts.append(side(left, chosen).join(F.broadcast(present), keys, "left_anti"))
    result = parts[0].select(columns)
    for part in parts[1:]:
        result = result.unionByName(part.drop("_salt", "_left", "_right"), allowMissingColumns=True)
    return result.select(columns)
