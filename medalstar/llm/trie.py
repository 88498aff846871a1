"""Prefix trie of conversations, screened by a count-min sketch.

Every distinct sequence of first turns is a node; the conversations that begin with it are its members.

1. Turns are numbered along their conversations and reduced to digests: texts are not shuffled. A prefix is told by
   128 bits, running exclusive-ors of the hashes of its numbered turns.
2. Every task counts the prefixes of its conversations in a count-min sketch of two rows, whose cells tell 0, 1 and
   more. The cells of all tasks are added block by block and broadcast; their number follows that of the
   prefixes up to ``MOST_CELLS``.
3. A sketch never counts too little, so an estimate of one proves a singleton, and with it every longer prefix of that
   conversation: such tails become nodes where they are, without a shuffle. Only the other prefixes are grouped exactly.
   With very many prefixes the bounded sketch proves fewer singletons and more narrow rows are grouped; the nodes
   are the same.
4. Sums over subtrees need no walk through the tree: a node counts for the conversation it is named after, its
   smallest member, and a subtree sums what its members count at and below its top.

Turns stand in the order of ``turn`` (null first), then role and digest of the text; a repeated row is a turn of its own.
Null roles and texts count as empty, however long a text is only its digest and size move. Rows without
conversation id take no part. Turns of a conversation are numbered over sorted ranges, and sums along it are taken over
blocks of ``_BLOCK`` turns, so one conversation may hold any share of the rows. An empty table has no node, not even a
root. Columns other than those named are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medalstar.llm.common import chosen_rows, map_arrow, staged

MOST_CELLS = 1 << 25  # of one of the two rows of the sketch: 16 MB of bits in all
_CELLS_A_BLOCK = 1 << 15
_BLOCK = 1024  # turns of a conversation that one window orders
_IDS_A_BLOCK = 4096
_KEY = ["a", "b", "depth"]


def numbered_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """(conv, depth, digest, size): every turn with its number from 1, its digest and the UTF-8 bytes of its text."""
    rows = chosen_rows(df, conv=conv, turn=turn, role=role, text=text).filter(F.col("conv").isNotNull())
    said, spoke = F.coalesce("text", F.lit("")), F.coalesce(F.col("role").cast("string"), F.lit(""))
    narrow = rows.select(
        "conv", "turn", spoke.alias("role"), F.sha2(said, 256).alias("sha"),
        F.octet_length(said).cast("bigint").alias("size"), "_row")
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("sha"), F.col("_row")]
    # Sorted ranges: a row's number is its place in its part plus the rows of its conversation in earlier parts.
    placed = staged(narrow.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", F.unhex(F.sha2(F.concat_ws("\n", F.length("role").cast("string"), "role", "sha"), 256)).alias("digest"),
        "size", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")), "turns")
    pieces = placed.groupBy("conv", "part").agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = staged(pieces.select("conv", "part", "first", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before")), "pieces")
    depth = (F.col("before") + F.col("place") - F.col("first") + 1).alias("depth")
    return placed.join(pieces, ["conv", "part"]).select("conv", depth, "digest", "size")


def _along(df: DataFrame, columns: dict[str, Column], fold: Callable, join: Callable, backwards: bool = False) -> DataFrame:
    """Adds running values of ``columns`` along every conversation, in two levels: inside blocks, over blocks.

    ``df`` is staged; ``fold`` aggregates a column, ``join`` puts the two levels together.
    """
    block = F.expr(f"(depth - 1) div {_BLOCK}")
    rows = df.withColumn("block", block)
    depth, number = (F.col(c).desc() if backwards else F.col(c) for c in ("depth", "block"))
    inside = Window.partitionBy("conv", "block").orderBy(depth)
    totals = rows.groupBy("conv", "block").agg(*[fold(c).alias(n) for n, c in columns.items()])
    before = Window.partitionBy("conv").orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("conv", "block", *[fold(F.col(n)).over(before).alias(f"_{n}") for n in columns])
    carried = carried.filter(F.col(f"_{next(iter(columns))}").isNotNull())  # only conversations of several blocks
    local = rows.withColumns({n: fold(c).over(inside) for n, c in columns.items()})
    both = local.join(carried, ["conv", "block"], "left")
    return both.withColumns({n: join(F.col(n), F.coalesce(F.col(f"_{n}"), F.lit(0))) for n in columns}).drop(
        "block", *[f"_{n}" for n in columns])


def _cells(batch: pa.RecordBatch, mask: int) -> list[np.ndarray]:
    """The cell of every prefix in each row of the sketch: the two halves of its digest."""
    return [batch.column(c).to_numpy().astype(np.int64) & mask for c in ("a", "b")]


def _sketch(prefixes: DataFrame, cells: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each row of the sketch: cells that hold more than one, as packed bits."""
    blocks = max(1, cells // _CELLS_A_BLOCK)
    width = cells // blocks

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = np.zeros((2, cells), dtype=bool)
        more = np.zeros((2, cells), dtype=bool)
        for batch in batches:
            for row, cell in enumerate(_cells(batch, cells - 1)):
                values, counts = np.unique(cell, return_counts=True)
                more[row, values] |= once[row, values] | (counts > 1)
                once[row, values] = True
        for row in range(2):
            kept = np.flatnonzero(once[row].reshape(blocks, width).any(axis=1))
            bits = [np.packbits(x[row].reshape(blocks, width)[kept], axis=1) for x in (once, more)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(kept + row * blocks, pa.int64()), *(pa.array([r.tobytes() for r in b], pa.binary()) for b in bits)],
                names=["block", "once", "more"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds the blocks of all tasks, one block after another."""
        current, once, more = None, None, None
        for batch in batches:
            for block, o, m in zip(*(c.to_pylist() for c in batch.columns)):
                o, m = np.frombuffer(o, np.uint8), np.frombuffer(m, np.uint8)
                if block != current:
                    if current is not None:
                        yield one(current, once, more)
                    current, once, more = block, o, m
                else:
                    more = more | m | (once & o)
                    once = once | o
        if current is not None:
            yield one(current, once, more)

    def one(block: int, once: np.ndarray, more: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([once.tobytes()], pa.binary()), pa.array([more.tobytes()], pa.binary())],
            names=["block", "once", "more"])

    schema = "block bigint, once binary, more binary"
    parts = map_arrow(prefixes.select("a", "b"), count, schema)
    whole = map_arrow(parts.repartition("block").sortWithinPartitions("block"), add, schema)
    more = np.zeros((2 * blocks, -(-width // 8)), dtype=np.uint8)
    for r in whole.select("block", "more").collect():  # at most 2 * MOST_CELLS bits
        more[r["block"]] = np.frombuffer(r["more"], np.uint8)
    return [more[:blocks], more[blocks:]]


def _screened(prefixes: DataFrame) -> DataFrame:
    """``prefixes`` with ``alone``: proved to be the prefix of one conversation only."""
    wanted = 8 * max(1, prefixes.count())
    cells = min(MOST_CELLS, max(1 << 10, 1 << wanted.bit_length()))
    shared = prefixes.sparkSession.sparkContext.broadcast(_sketch(prefixes, cells))
    width = cells // max(1, cells // _CELLS_A_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        more = shared.value
        last_conv, last_depth, proven = None, 0, False
        for batch in batches:
            if not batch.num_rows:
                continue
            alone = np.zeros(batch.num_rows, dtype=bool)
            for row, cell in enumerate(_cells(batch, cells - 1)):
                block, at = cell // width, cell % width
                alone |= (more[row][block, at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 0
            # What is longer than a singleton is one too: carry the proof along runs of a conversation.
            depth = batch.column("depth").to_numpy()
            conv = batch.column("conv").to_pylist()
            for i in range(batch.num_rows):
                same = conv[i] == last_conv and depth[i] > last_depth
                proven = bool(alone[i]) or (same and proven)
                alone[i], last_conv, last_depth = proven, conv[i], depth[i]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(alone)], names=[*batch.schema.names, "alone"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in prefixes.schema)
    return map_arrow(prefixes, run, f"{kinds}, alone boolean")


def prefix_trie(turns: DataFrame, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends).

    ``turns``: (conv, depth, digest, size), depths from 1 without gaps. ``lengths``: (conv, n), one row per conversation, also
    those without turns. nodes: conv (the smallest member), depth, parent, n_convs, n_children, n_leaves, saved,
    n_ends, last_end (a member that ends there). ends: (lead, depth, conv), the members that end at nodes where
    several do.
    """
    lengths = staged(lengths, "lengths")
    own = {name: F.xxhash64(F.lit(seed), "depth", "digest") for name, seed in (("a", 1), ("b", 2))}
    turns = staged(turns.join(lengths, "conv").select("conv", "depth", "digest", "size", (F.col("depth") == F.col("n")).alias("ends")), "told")
    prefixes = staged(_along(turns, own, F.bit_xor, lambda x, y: x.bitwiseXOR(y)).select(
        "conv", "depth", "size", "ends", "a", "b",
        F.col("a").bitwiseXOR(own["a"]).alias("above_a"), F.col("b").bitwiseXOR(own["b"]).alias("above_b")), "prefixes")
    marked = staged(_screened(prefixes), "screened")
    tails, possible = marked.filter("alone"), marked.filter(~F.col("alone"))

    # Exact grouping of the prefixes that may be shared.
    groups = staged(possible.groupBy(*_KEY).agg(
        F.min("conv").alias("lead"), F.count("*").alias("n_convs"), F.count_if("ends").alias("n_ends"),
        F.max(F.when(F.col("ends"), F.col("conv"))).alias("last_end"), F.max("size").alias("size"),
        F.max("above_a").alias("above_a"), F.max("above_b").alias("above_b")), "groups")
    found = staged(possible.select("conv", *_KEY, "ends").join(
        groups.select(*_KEY, "lead", "n_convs", "n_ends", "size"), _KEY), "members")
    leads = F.col("conv") == F.col("lead")
    childless = F.col("n_ends") == F.col("n_convs")
    counted = found.select("conv", *_KEY, F.when(leads, (F.col("n_convs") - 1) * F.col("size")).otherwise(0).alias("saved"),
                           (F.col("ends") & leads & childless).alias("leaf"))
    # A conversation is a leaf's own if it alone goes on, or if it gives a childless node its name.
    single = marked.filter("alone AND ends").select("conv", F.lit(1).cast("bigint").alias("own"))
    single = single.unionByName(counted.filter("leaf").select("conv", F.lit(1).cast("bigint").alias("own")))
    below = _along(staged(counted.drop("leaf"), "counted"), {"saved": F.col("saved")}, F.sum, lambda x, y: x + y, backwards=True)
    summed = below.join(staged(single, "own"), "conv", "left").groupBy(*_KEY).agg(
        F.sum("saved").alias("saved"), F.sum(F.coalesce("own", F.lit(0))).alias("n_leaves"))

    # Children: groups and first turns of tails, by the prefix above them.
    above = [F.col("above_a").alias("a"), F.col("above_b").alias("b"), (F.col("depth") - 1).alias("depth")]
    children = groups.select(*above).unionByName(tails.select(*above)).groupBy(*_KEY).agg(F.count("*").alias("n_children"))
    shared = groups.join(staged(summed, "summed"), _KEY).join(staged(children, "children"), _KEY, "left").select(
        F.col("lead").alias("conv"), "depth", F.col("above_a").alias("a"), F.col("above_b").alias("b"), "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved", "n_ends", "last_end",
        ((F.col("n_convs") - 1) * F.col("size")).alias("spared"))
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    alone = tails.select(
        "conv", "depth", F.col("above_a").alias("a"), F.col("above_b").alias("b"), one.alias("n_convs"),
        F.when(F.col("ends"), zero).otherwise(one).alias("n_children"), one.alias("n_leaves"), zero.alias("saved"),
        F.col("ends").cast("bigint").alias("n_ends"), F.when(F.col("ends"), F.col("conv")).alias("last_end"), zero.alias("spared"))
    # A node's parent is named after a group, or else is a singleton: then it bears the same name.
    parents = staged(groups.select("a", "b", (F.col("depth") + 1).alias("depth"), F.col("lead").alias("over")), "parents")
    nodes = staged(shared.unionByName(alone), "untied").join(parents, ["a", "b", "depth"], "left")
    none = F.lit(None).cast(lengths.schema["conv"].dataType)
    least = lengths.agg(F.min("conv")).first()[0]
    least = F.lit(least).cast(lengths.schema["conv"].dataType)  # the root is named after it
    nodes = nodes.select(
        "conv", "depth", F.when(F.col("depth") == 1, least).otherwise(F.coalesce("over", "conv")).alias("parent"),
        "n_convs", "n_children", "n_leaves", "saved", "n_ends", "last_end", "spared")
    nodes = staged(nodes, "nodes")

    sums = lengths.select(
        "conv", one.alias("n_convs"), zero.alias("children"), zero.alias("leaves"), zero.alias("saved"),
        (F.col("n") == 0).cast("bigint").alias("n_ends"), F.when(F.col("n") == 0, F.col("conv")).alias("last_end")
    ).unionByName(nodes.select(
        none.alias("conv"), zero.alias("n_convs"), (F.col("depth") == 1).cast("bigint").alias("children"),
        (F.col("n_children") == 0).cast("bigint").alias("leaves"), F.col("spared").alias("saved"), zero.alias("n_ends"),
        none.alias("last_end")))
    root = sums.agg(
        F.min("conv").alias("conv"), zero.alias("depth"), none.alias("parent"), F.sum("n_convs").alias("n_convs"),
        F.sum("children").alias("n_children"), F.greatest(one, F.sum("leaves")).alias("n_leaves"), F.sum("saved").alias("saved"),
        F.sum("n_ends").alias("n_ends"), F.max("last_end").alias("last_end")).filter("n_convs > 0")
    several = found.filter(F.col("ends") & (F.col("n_ends") > 1)).select("lead", "depth", "conv")
    at_root = lengths.filter("n = 0").select(least.alias("lead"), zero.alias("depth"), "conv")
    return nodes.drop("spared").unionByName(root), several.unionByName(at_root)


def ends_digest(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """``nodes`` with ``ends_sha256``: the digest of the decimal ids of the members that end there, ascending.

    Ids are put together by blocks of numbers in parallel; the digest of a node runs over its blocks in order.
    """
    block = F.floor(F.col("conv") / _IDS_A_BLOCK).alias("block")
    texts = ends.groupBy("lead", "depth", block).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    kind = ends.schema["lead"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            rows: list[tuple] = []
            for lead, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("lead", "depth", "ids"))):
                if (lead, depth) != current:
                    if current is not None:
                        rows.append((*current, state.hexdigest()))
                    current, state = (lead, depth), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield done(rows, batch.schema.field("lead").type)
        if current is not None:
            yield done([(*current, state.hexdigest())], pa.int64())

    def done(rows: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], key_type), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
            names=["conv", "depth", "digest"])

    digests = map_arrow(texts.repartition("lead", "depth").sortWithinPartitions("lead", "depth", "block"), run,
                        f"conv {kind}, depth bigint, digest string")
    simple = F.sha2(F.coalesce(F.col("last_end").cast("string"), F.lit("")), 256)
    return nodes.join(staged(digests, "digests"), ["conv", "depth"], "left").withColumn(
        "ends_sha256", F.coalesce("digest", simple)).drop("digest")


def rebuilt(turns: DataFrame, lengths: DataFrame, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another: (turns, lengths) as ``prefix_trie`` takes them.

    Conversation c begins with the first h turns of c - c % ``every`` and goes on with its own after its first h;
    h is the CRC-32 of its decimal id modulo ``most``.
    """
    base = F.col("conv") - F.col("conv") % every
    head = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(most))
    plan = lengths.select("conv", F.col("n").alias("own"), base.alias("base"), head.alias("h"))
    known = lengths.select(F.col("conv").alias("base"), F.col("n").alias("there"))
    taken = F.least(F.col("h"), F.coalesce("there", F.lit(0)))
    plan = staged(plan.join(known, "base", "left").select(
        "conv", "base", "h", taken.alias("taken"), (taken + F.greatest(F.lit(0), F.col("own") - F.col("h"))).alias("n")), "plan")
    # At most ``most`` - 1 rows of a base, each for at most a few conversations.
    heads = turns.filter(F.col("depth") < most).withColumnRenamed("conv", "base").join(
        plan.filter("taken > 0").select("conv", "base", "taken"), "base").filter("depth <= taken")
    rest = turns.join(plan.select("conv", "h", "taken"), "conv").filter("depth > h").withColumn(
        "depth", F.col("depth") - F.col("h") + F.col("taken"))
    names = ["conv", "depth", "digest", "size"]
    return heads.select(names).unionByName(rest.select(names)), plan.select("conv", "n")


def lengths_of(turns: DataFrame) -> DataFrame:
    return turns.groupBy("conv").agg(F.max("depth").alias("n"))


def trie(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(nodes, ends) of the conversations of ``df`` as they are; see ``prefix_trie``."""
    turns = staged(numbered_turns(df, conv, turn, role, text), "numbered")
    return prefix_trie(turns, lengths_of(turns))
