"""Mixing sources to target weights by a low-discrepancy schedule.

* Targets. Sources share all words by weight; none gets more than ``EPOCHS`` times what it has, and
  what it cannot take goes to the others by weight.
* Schedule. Slot j stands at the fractional part of j times the golden ratio. The targets, laid end to
  end, cut the unit interval; the piece a slot falls into is its source, so that at every moment each
  source has had its share to within a few slots. A slot's rank among its source's slots names the
  block it takes. Slots beyond a source's target are left out, and what is then missing to a target, a
  few slots, is appended.
* Blocks. A source's documents are shuffled by a hash and laid end to end; every ``block`` words are a
  block, the last one of a target is cut to fit. After the last block comes the first again, up to
  ``EPOCHS`` times.

The result has one row per part of a document in a slot. Everything is a DataFrame operation: cumulative
sums run over bounded buckets of a source and then over the buckets' totals, so that a source with most
of the rows is spread over many tasks.

Null and empty texts have no words and are never taken. Null is a source of its own, the last one. A
null key is a key like any other. Repeated rows are rows of their own. Where there are no words at all,
nothing is taken. Columns other than those named are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medalstar.llm.common import ROW, WORD, broadcast_if_few, staged, with_rows

EPOCHS = 3
WEIGHTS = (5, 2, 1)  # of the sources by code point, repeating
PER_BUCKET = 4096  # documents that are summed up in one go
PER_CHUNK = 8192  # slots that are ranked in one go
MOST_BLOCK = 1024  # words
_SOURCE_BYTES = 512  # of a broadcast row of a source, generously
SLOTS = 1 << 16  # below this many slots blocks get shorter
# The fractional parts of the golden ratio and of 2^20 times it.
_GOLDEN, _GOLDEN_HIGH = 0.6180339887498949, 0.9390062499151099


def sized(df: DataFrame, key: str, text: str, source: str, seed: int) -> DataFrame:
    """Per row its words, its source and its place in the source's shuffle."""
    rows = with_rows(df)
    return staged(rows.select(
        F.col(key).alias("key"), F.col(source).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.xxhash64(F.lit(seed), F.col(key), F.col(text)).alias("spread"), ROW,
    ), "sizes")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per source: number, size, rows and target. Small: it grows with the sources only."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    # UTF-8 keeps the order of code points, and texts are compared by their bytes.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sources.withColumn("number", place).withColumn("weight", cycle[F.col("number") % len(weights)])
    # Sources stop in the order of how often their weight goes into what they can give at most. With the
    # first ones stopped, the others get ``level`` per weight; the right level is the first one, in that
    # order, that does not stop the next source.
    most = F.lit(float(EPOCHS)) * F.col("source_size")
    order = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), "number")
    so_far = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(most).over(so_far), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(so_far), F.lit(0.0))
    levelled = weighed.withColumn("level", left / weight_left).withColumn("stops", most <= F.col("level") * F.col("weight"))
    levelled = levelled.withColumn("turn", F.row_number().over(order))
    level = F.min(F.when(~F.col("stops"), F.struct("turn", "level"))).over(everything)["level"]
    target = F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(
        F.least(most, F.coalesce(level, F.lit(float("inf"))) * F.col("weight")))
    return staged(levelled.select("source", "number", "source_size", "rows", target.alias("target")), "targets")


def _offsets(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """Per row with words the place of its first word in its source's shuffled words."""
    rows = sizes.filter("size > 0").join(
        broadcast_if_few(plan, _SOURCE_BYTES).select(
            F.col("source").alias("_source"), "number", "source_size", "rows", "target"),
        F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "source")
    # Buckets in the order of the hash: its leading bits, as many as the source's rows call for.
    buckets = F.greatest(F.lit(1.0), F.ceil(F.col("rows") / PER_BUCKET).cast("double"))
    share = (F.col("spread").cast("double") + 9223372036854775808.0) / 18446744073709551616.0
    rows = rows.withColumn("bucket", F.least(F.floor(share * buckets), buckets - 1).cast("bigint"))
    inside = Window.partitionBy("number", "bucket").orderBy("spread", "size", "key", ROW)
    before = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = rows.groupBy("number", "bucket").agg(F.sum("size").alias("total"))
    earlier = Window.partitionBy("number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("number", "bucket", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    return rows.withColumn("inside", before).join(totals, ["number", "bucket"]).withColumn(
        "start", (F.col("base") + F.col("inside")).cast("bigint"))


def schedule(spark, plan: DataFrame, total: int, block: int) -> DataFrame:
    """(slot, number, nth): source and rank within the source of every slot, all targets met."""
    slots = -(-total // block)
    needed = F.ceil(F.col("goal") / block)
    ends = Window.orderBy("number")
    pieces = plan.filter("target > 0").withColumn("goal", F.round("target").cast("bigint")).withColumn(
        "high", F.sum("target").over(ends))
    pieces = pieces.withColumn("low", (F.col("high") - F.col("target")) / F.sum("target").over(Window.partitionBy()))
    pieces = pieces.withColumn("high", F.col("high") / F.sum("target").over(Window.partitionBy())).select(
        "number", "low", "high", needed.cast("bigint").alias("needed"))
    # A grid makes finding a slot's piece an equi-join: a cell meets the few pieces that lie in it.
    cells = 1 << max(10, (2 * plan.count()).bit_length())
    pieces = pieces.withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("low") * cells).cast("bigint"),
        F.least(F.floor(F.col("high") * cells), F.lit(cells - 1)).cast("bigint"))))
    j = F.col("id")
    high, low = F.shiftright(j, 20).cast("double"), j.bitwiseAND(F.lit((1 << 20) - 1)).cast("double")
    point = F.pmod(F.pmod(high * _GOLDEN_HIGH, F.lit(1.0)) + low * _GOLDEN, F.lit(1.0))
    points = spark.range(slots).select(j.alias("slot"), point.alias("point")).withColumn(
        "cell", F.floor(F.col("point") * cells).cast("bigint"))
    placed = points.join(pieces, "cell").filter("point >= low and point < high").select("slot", "number", "needed")
    placed = staged(placed.withColumn("chunk", F.floor(F.col("slot") / PER_CHUNK)), "slots")
    inside = F.row_number().over(Window.partitionBy("number", "chunk").orderBy("slot")) - 1
    earlier = Window.partitionBy("number").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("number", "chunk").agg(F.count("*").alias("n"))
    counts = counts.select("number", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = placed.withColumn("inside", inside).join(counts, ["number", "chunk"]).select(
        "slot", "number", (F.col("base") + F.col("inside")).cast("bigint").alias("nth"), "needed")
    kept = ranked.filter("nth < needed").select("slot", "number", "nth")
    got = placed.groupBy("number").agg(F.count("*").alias("got"))
    missing = pieces.select("number", "needed").distinct().join(got, "number", "left").withColumn(
        "got", F.coalesce("got", F.lit(0))).filter("got < needed")
    tail = missing.select((F.lit(slots) + F.col("number")).alias("slot"), "number",
                          F.explode(F.sequence("got", F.col("needed") - 1)).alias("nth"))
    return kept.unionByName(tail)


def mix(
    df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, seed: int = 42,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(parts, documents, targets).

    parts: slot, number (of the source), nth, epoch, key, _row, first (word of the document), words.
    documents: key, _row, source, size of every row. targets: see ``targets``.
    """
    sizes = sized(df, key, text, source, seed)
    plan = targets(sizes, weights)
    total = plan.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    block = max(1, min(MOST_BLOCK, total // SLOTS))
    slots = schedule(df.sparkSession, plan, total, block).join(
        broadcast_if_few(plan, _SOURCE_BYTES).filter("source_size > 0").select("number", "source_size", F.round("target").cast("bigint").alias("goal")),
        "number")
    # A slot's words, counted through all epochs, are [nth * block, (nth + 1) * block) up to the goal. A
    # block may run over the end of the shuffle into the next epoch, so it is cut there.
    begin, end = F.col("nth") * block, F.least((F.col("nth") + 1) * block, F.col("goal"))
    runs = slots.withColumn("begin", begin).withColumn("end", end).filter("begin < end").withColumn(
        "epoch", F.explode(F.sequence(F.floor(F.col("begin") / F.col("source_size")),
                                      F.floor((F.col("end") - 1) / F.col("source_size")))))
    low = F.greatest("begin", F.col("epoch") * F.col("source_size")) - F.col("epoch") * F.col("source_size")
    high = F.least("end", (F.col("epoch") + 1) * F.col("source_size")) - F.col("epoch") * F.col("source_size")
    runs = runs.select("slot", "number", "nth", "epoch", low.alias("low"), high.alias("high"))
    # Documents and runs meet in the blocks of the shuffle that they touch: an equi-join on fine keys.
    docs = _offsets(sizes, plan).select("number", "key", ROW, "start", (F.col("start") + F.col("size")).alias("stop"))
    touch = lambda low, high: F.sequence(F.floor(F.col(low) / block), F.floor((F.col(high) - 1) / block))
    runs = runs.withColumn("block", F.explode(touch("low", "high")))
    docs = docs.withColumn("block", F.explode(touch("start", "stop")))
    first = F.greatest("start", "low", F.col("block") * block)
    last = F.least("stop", "high", (F.col("block") + 1) * block)
    parts = docs.join(runs, ["number", "block"]).withColumn("first", first).withColumn("last", last).filter(
        "first < last").select("slot", "number", "nth", "epoch", "key", ROW, (F.col("first") - F.col("start")).alias("first"),
                               (F.col("last") - F.col("first")).alias("words"))
    return parts, sizes.select("key", ROW, "source", "size"), plan


def taken(df: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """(key, size, source_size, target, taken, _row): how many words the mix takes of every row."""
    parts, documents, plan = mix(df, key, **options)
    words = parts.groupBy(ROW).agg(F.sum("words").alias("taken"))
    plan = broadcast_if_few(plan, _SOURCE_BYTES).select(F.col("source").alias("_source"), "source_size", "target")
    return documents.join(words, ROW, "left").join(
        plan, F.col("source").eqNullSafe(F.col("_source"))).select(
        F.col("key").alias(key), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), ROW)
