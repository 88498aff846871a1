"""MinHash near-deduplication with fast similarity sketches.

A document's set holds its distinct shingles. Two documents are linked if
``100 * intersection >= percent * union``; a component is what links connect.

1. Sketch. In round i every shingle is thrown into one of ``T`` bins by a hash of that round, and a bin
   that was empty before the round takes its smallest hash. After ``T`` rounds, round ``T + j`` throws
   all shingles into bin j. So every coordinate is filled, two sets agree in a coordinate with the
   probability of their similarity, and the agreement is as concentrated as for independent hashes.
2. Equal sets become one class, whose smallest row speaks for it.
3. Banding. ``BANDS`` bands of ``ROWS`` coordinates make buckets. At a similarity of 0.8, two documents
   share no bucket with a probability of (1 - 0.8^8)^60, about 2e-5; at 0.35, where texts with a
   common passage lie, one with a probability of about 0.01.
4. Verification on the full sets, in two steps. First one member of every bucket leads and is compared to
   the others, which joins large groups of near copies at a comparison or a few per member. Then,
   in buckets that still hold several components, every member outside the bucket's largest component is
   compared to all members of other components. These comparisons happen in blocks of bounded size
   inside the tasks, and only confirmed links leave them. So no link between components is missed.

Nothing is capped. Null and empty texts, and texts without words, have an empty set and are linked
with nothing. A text with fewer words than a shingle has its whole sequence as the one shingle. Texts
are read whole. ``component_id`` is the smallest key of the component, nulls aside; ``kept`` is true for one row
of each component, the first by key (nulls last). Columns other than key and text are not read, so their
names cannot clash. Sets are compared as sets of 64-bit hashes, and equal sets are told by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalstar.llm.bpe import gather
from medalstar.llm.common import (
    ROW, broadcast_if_few, give_back, map_arrow, mixed, shingle_sets, slices, small_batches, staged, trimmed,
    with_rows,
)

ROWS, BANDS = 8, 60
T = ROWS * BANDS
PROBES, TARGETS = 256, 2048  # members of a bucket in a block
PER_SHELF = 1000  # rows of blocks that a group takes at least
_EMPTY = np.uint64(2**64 - 1)
_SEEDS = mixed(np.arange(1, 2 * T + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_SIDE_BYTES = 64  # of a broadcast row of a few numbers, generously


def sketches(owner: np.ndarray, shingle: np.ndarray, n: int) -> np.ndarray:
    """(n, T) coordinates of the sets given as (set number, shingle); rows of empty sets stay ``_EMPTY``."""
    out = np.full((n, T), _EMPTY, dtype=np.uint64)
    flat = out.reshape(-1)
    full = np.bincount(owner, minlength=n) == 0
    for i in range(2 * T):
        if full.any():
            left = ~full[owner]
            owner, shingle = owner[left], shingle[left]
        if not len(owner):
            break
        value = mixed(shingle ^ _SEEDS[i])
        if i < T:
            bins = ((value >> np.uint64(32)) % np.uint64(T)).astype(np.int64)
        else:
            bins = np.full(len(owner), i - T)
        at = owner * T + bins
        free = flat[at] == _EMPTY
        # The first round finds all bins free; later ones throw few shingles into free bins.
        np.minimum.at(flat, at[free], value[free])
        if i < T:
            live = np.unique(owner)
            full[live] = (out[live] != _EMPTY).all(axis=1)
    return out


def bands(coordinates: np.ndarray) -> np.ndarray:
    """(n, BANDS) bucket numbers; the band's own number is part of the hash."""
    key = np.tile(_SEEDS[:BANDS], (len(coordinates), 1))
    for r in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + coordinates[:, r::ROWS])
    return key


def _sketched(docs: DataFrame, width: int) -> DataFrame:
    """Per row the size of its set, 128 bits that tell the set, and its buckets."""
    key_type = docs.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(trimmed(batches), "text", 1 << 20):
            n = batch.num_rows
            owner, shingle = shingle_sets(batch.column("text").to_pylist(), width)
            sizes = np.bincount(owner, minlength=n)
            tells = [np.zeros(n, dtype=np.uint64) for _ in range(2)]
            for tell, seed in zip(tells, _SEEDS[-2:]):
                np.add.at(tell, owner, mixed(shingle + seed))
            keys = bands(sketches(owner, shingle, n))
            offsets = np.concatenate(([0], np.cumsum(np.where(sizes > 0, BANDS, 0))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("file"), batch.column("position"), pa.array(sizes, pa.int64()),
                 *(pa.array(t.view(np.int64)) for t in tells),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                          pa.array(keys[sizes > 0].reshape(-1).view(np.int64)))],
                names=["key", "file", "position", "n", "a", "b", "bands"])
        give_back()

    picked = docs.select("key", F.col(f"{ROW}.file").alias("file"), F.col(f"{ROW}.position").alias("position"), "text")
    return map_arrow(
        picked, run, f"key {key_type}, file bigint, position bigint, n bigint, a bigint, b bigint, bands array<bigint>")


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(slices(trimmed(batches), "left", 1 << 20), "right", 1 << 20):
            n = batch.num_rows
            sets = [shingle_sets(batch.column(side).to_pylist(), width) for side in ("left", "right")]
            owner, shingle = (np.concatenate(x) for x in zip(*sets))
            order = np.lexsort((shingle, owner))
            owner, shingle = owner[order], shingle[order]
            both = np.bincount(owner[1:][(owner[1:] == owner[:-1]) & (shingle[1:] == shingle[:-1])], minlength=n)
            union = np.bincount(owner, minlength=n) - both
            linked = pa.array((100 * both >= percent * union) & (union > 0))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(linked)
        give_back()

    both = pairs.join(texts.select(F.col("cid").alias("b"), F.col("text").alias("right")), "b").join(
        texts.select(F.col("cid").alias("a"), F.col("text").alias("left")), "a")
    return map_arrow(both.select("a", "b", "left", "right"), run, "a bigint, b bigint")


def connected(links: DataFrame) -> DataFrame:
    """(cid, comp) for every linked node: the smallest node it is connected to.

    Every step takes the smallest label among the neighbours and then that label's own label; stars
    and chains shrink at least by half. A step aggregates before its shuffle, so hubs stay cheap.
    """
    edges = staged(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = staged(edges.groupBy(F.col("a").alias("cid")).agg(F.min("b").alias("near")).select(
        "cid", F.least("cid", "near").alias("comp")), "labels")
    while True:
        near = edges.join(labels.select(F.col("cid").alias("b"), "comp"), "b").groupBy(F.col("a").alias("cid")).agg(
            F.min("comp").alias("near"))
        lower = labels.join(near, "cid").select("cid", F.col("comp").alias("old"), F.least("comp", "near").alias("next"))
        jump = labels.select(F.col("cid").alias("next"), F.col("comp").alias("far"))
        step = staged(lower.join(jump, "next").select(
            "cid", F.least("next", "far").alias("comp"), (F.least("next", "far") != F.col("old")).alias("moved")), "labels")
        labels = step.select("cid", "comp")
        if not step.filter("moved").limit(1).count():
            return labels


def _led(members: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(pairs of each bucket's leader with its other members, leaders)."""
    lead = members.groupBy("band").agg(F.min(F.struct("tie", "cid", "n")).alias("lead")).select(
        "band", F.col("lead.cid").alias("l_cid"), F.col("lead.n").alias("l_n"))
    lead = staged(lead, "leaders")
    sizes = 100 * F.least("n", "l_n") >= percent * F.greatest("n", "l_n")
    pairs = members.join(lead, "band").filter(sizes & (F.col("cid") != F.col("l_cid"))).select(
        F.least("cid", "l_cid").alias("a"), F.greatest("cid", "l_cid").alias("b")).distinct()
    return staged(pairs, "pairs"), lead


def _apart(members: DataFrame, lead: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members, less the leaders, of buckets that still hold several components; with each bucket's
    largest component and sizes."""
    rest = members.join(lead.select("band", F.col("l_cid").alias("cid")), ["band", "cid"], "left_anti").drop("tie")
    if labels is None:
        rest = rest.withColumn("comp", F.col("cid"))
    else:
        rest = rest.join(labels, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    rest = staged(rest, "rest")
    sizes = rest.groupBy("band", "comp").agg(F.count("*").alias("c")).groupBy("band").agg(
        F.max(F.struct("c", "comp")).alias("most"), F.sum("c").alias("all"), F.count("*").alias("comps"))
    sizes = staged(sizes.filter("comps > 1").select("band", F.col("most.comp").alias("most"), (
        F.col("all") - F.col("most.c")).alias("others"), "all"), "apart")
    return rest.join(sizes, "band")


def _blocks(apart: DataFrame) -> DataFrame:
    """Every member as a target and, outside the largest component, as a probe, in blocks of bounded size."""
    spread = F.xxhash64("cid")
    probes, targets = (F.ceil(F.col(c) / n).cast("bigint") for c, n in (("others", PROBES), ("all", TARGETS)))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))
    asks = apart.filter(F.col("comp") != F.col("most")).withColumn("p", F.pmod(spread, probes)).withColumn("t", each(targets))
    held = apart.withColumn("t", F.pmod(F.shiftright(spread, 20), targets)).withColumn("p", each(probes))
    columns = ["band", "p", "t", "cid", "comp", "most"]
    return asks.select(*columns, F.lit(True).alias("asks")).unionByName(held.select(*columns, F.lit(False).alias("asks")))


def _confirmed_in_blocks(blocks: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) between members of different components of a bucket."""
    rows = staged(blocks, "blocks")
    # A task takes several blocks, so that there are not more groups than needed.
    shelves = max(1, -(-rows.count() // PER_SHELF))
    rows = rows.withColumn("shelf", F.pmod(F.xxhash64("band", "p", "t"), F.lit(shelves)))

    def compare(group: pa.Table) -> pa.Table:
        cids = group.column("cid").to_numpy()
        known, first = np.unique(cids, return_index=True)
        owner, shingle = shingle_sets(group.column("text").take(pa.array(first)).to_pylist(), width)
        size = np.bincount(owner, minlength=len(known))
        begin = np.cumsum(size) - size
        number = np.unique(shingle, return_inverse=True)[1]
        at, comp = np.searchsorted(known, cids), group.column("comp").to_numpy()
        most, asks = group.column("most").to_numpy(), group.column("asks").to_numpy(zero_copy_only=False)
        block = np.column_stack([group.column(c).to_numpy() for c in ("band", "p", "t")])
        order = np.lexsort((~asks, *block.T[::-1]))
        new = np.concatenate(([True], (np.diff(block[order], axis=0) != 0).any(axis=1)))
        marked, found = np.zeros(len(shingle) + 1, dtype=np.int64), []
        for own in np.split(order, np.flatnonzero(new)[1:]):
            asking, held = own[asks[own]], own[~asks[own]]
            if not len(asking) or not len(held):
                continue
            flat, sizes = gather(number, begin[at[held]], size[at[held]])
            starts = np.cumsum(sizes) - sizes
            for i in asking:
                mine = number[begin[at[i]] : begin[at[i]] + size[at[i]]]
                marked[mine] = 1
                both = np.add.reduceat(marked[flat], starts)
                marked[mine] = 0
                # Two probes meet twice; once is enough.
                wanted = (comp[held] != comp[i]) & ((comp[held] == most[i]) | (cids[held] > cids[i]))
                linked = held[wanted & (100 * both >= percent * (sizes + len(mine) - both))]
                # One link to a component is as good as many.
                linked = linked[np.unique(comp[linked], return_index=True)[1]]
                found += [(min(cids[i], c), max(cids[i], c)) for c in cids[linked]]
        a, b = zip(*found) if found else ((), ())
        del owner, shingle, number, marked, group
        give_back()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.join(texts, "cid").groupBy("shelf").applyInArrow(compare, "a bigint, b bigint")


def _components(members: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame | None:
    """(cid, comp) of all classes that have a link; None without any. members: (band, cid, n, tie)."""
    pairs, lead = _led(members, percent)
    links = staged(_confirmed(pairs, texts, width, percent), "links")
    labels = connected(links) if links.limit(1).count() else None
    more = staged(_confirmed_in_blocks(_blocks(_apart(members, lead, labels)), texts, width, percent), "links")
    if not more.limit(1).count():
        return labels
    return connected(links.unionByName(more))


def deduplicate(
    df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """(key, n_shingles, component_id, kept, _row) for every row of ``df``; ``kept`` marks one row per component."""
    with small_batches(df.sparkSession):  # all that runs in Python is staged inside
        return _deduplicated(df, key, text, width, percent)


def _deduplicated(df: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    rows = with_rows(df)
    docs = rows.select(F.col(key).alias("key"), F.col(text).alias("text"), ROW)
    sketched = staged(_sketched(docs, width), "sketches")
    order = F.struct(F.col("key").isNull().alias("none"), "key", "file", "position")
    classes = sketched.filter("n > 0").groupBy("a", "b").agg(
        F.min(order).alias("first"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = staged(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")

    # One order for all buckets, so that the same member leads in most buckets of a group.
    tie = F.xxhash64("cid")
    banded = classes.select("cid", "n", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("c")).filter("c > 1").select("band")
    members = staged(banded.join(shared, "band").select("band", "cid", "n", tie.alias("tie")),
                     "members")
    wanted = members.select("cid").distinct().join(classes.select("cid", "first"), "cid").select(
        "cid", F.struct("first.file", "first.position").alias(ROW))
    wanted = broadcast_if_few(staged(wanted, "wanted"), _SIDE_BYTES)
    texts = staged(docs.select("text", ROW).join(wanted, ROW).select("cid", "text"), "texts")
    labels = _components(members, texts, width, percent)

    named = classes.select("a", "b", "cid", "first")
    if labels is None:
        named = named.withColumn("lowest", F.col("first"))
    else:
        named = staged(named.join(labels, "cid", "left").withColumn("comp", F.coalesce("comp", "cid")), "named")
        # Staged, so that both sides of the join are shuffled right below it and a hot component can be split.
        lowest = staged(named.groupBy("comp").agg(F.min("first").alias("lowest")), "lowest")
        named = named.join(lowest, "comp")
    named = staged(named.select("a", "b", "lowest"), "components")
    own = F.struct("file", "position")
    linked = sketched.filter("n > 0").join(named, ["a", "b"]).select(
        "key", "n", F.col("lowest.key").alias("component_id"),
        (F.struct("lowest.file", "lowest.position") == own).alias("kept"), own.alias(ROW))
    alone = sketched.filter("n = 0").select("key", "n", F.col("key").alias("component_id"), F.lit(True).alias("kept"),
                                            own.alias(ROW))
    return linked.unionByName(alone).withColumnsRenamed({"key": key, "n": "n_shingles"})
