"""Chat formatting over a prefix tree of conversations.

Conversations that begin with the same turns share the nodes of those turns. Trees are laid out depth
first, every node's formatted text and tokens once, with

* ``start``: where the node's tokens stand in the tree's sequence,
* ``position``: the position id of its first token, the tokens before it in a conversation,
* ``attends``: the intervals of the sequence that hold its ancestors, in front of its own tokens,
* ``loss``: the part of the formatted text (in characters) that is trained on, an assistant's text.

A node belongs to the smallest conversation that passes through it; children stand in the order of those
conversations. So the nodes of one conversation that belong to it follow each other in the sequence (a
chain), the ancestors of a node are one interval per chain, and the layout needs no tree in memory: chains
are sorted by the path that leads to them, and sums of their lengths are their places.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts a backslash is doubled and a
control string gets a backslash behind its first character, which ``unescaped`` undoes; so no text can
pass for a control string.

Turns are taken in the order of ``turn`` (null last), then role and text; a repeated row is a turn of its
own. Null roles and texts count as empty, a null conversation id is one conversation, the last one. An
empty table gives no node. Columns other than those named are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medalstar.llm.bpe import Shared, load_vocabulary
from medalstar.llm.common import map_arrow, slices, staged

BEGIN, END = "<|im_start|>", "<|im_end|>"
# Strings that mark something in this or other templates.
CONTROLS = [BEGIN, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_INSIDE = "|".join(re.escape(c) for c in CONTROLS)
# The first character of a control string, found by looking ahead so that overlapping ones count too.
_FIRST = r"([<\[])(?=" + "|".join(re.escape(c[1:]) for c in CONTROLS) + ")"
_TURN = re.compile(re.escape(BEGIN) + r"(.*?)\n(.*)" + re.escape(END) + r"\n", re.DOTALL)
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _FIRST, r"$1\\")


def escaped_role(role: Column) -> Column:
    """As ``escaped``; a line end, which would end the role, is written as backslash and n."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def unescaped_role(role: str) -> str:
    return re.sub(r"\\([\\n]?)", lambda m: "\n" if m[1] == "n" else m[1], role)


def _turns(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Every turn with its number in the conversation and 128 bits that tell the prefix it ends."""
    rows = df.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    rows = rows.withColumn("depth", F.row_number().over(order))
    # A prefix is the set of its numbered turns: running exclusive-ors of their hashes tell it, and
    # Spark keeps a running aggregate in a row however long the conversation is.
    numbered = Window.partitionBy("conv").orderBy("depth")
    told = [F.bit_xor(F.xxhash64(F.lit(seed), "depth", "role", "text")).over(numbered) for seed in (1, 2)]
    return rows.select("conv", "depth", "role", "text", told[0].alias("a"), told[1].alias("b"))


def _last_null(column: Column) -> Column:
    return F.struct(column.isNull().alias("none"), column.alias("id"))


def format_tree(
    df: DataFrame, vocabulary_path: str, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(nodes, paths).

    nodes: node, tree, depth, formatted, loss (struct of begin and end in ``formatted``, or null), ids, start,
    position, attends. paths: conversation, depth, node; read in order of depth, a conversation.
    """
    turns = staged(_turns(df, conv, turn, role, text), "turns")
    # Nodes. Turns that a prefix shares collapse before the shuffle.
    nodes = turns.groupBy("a", "b", "depth", "role", "text").agg(F.min(_last_null(F.col("conv"))).alias("lead"))
    header = F.concat(F.lit(BEGIN), escaped_role(F.col("role")), F.lit("\n"))
    body = escaped(F.col("text"))
    nodes = nodes.select(
        "a", "b", "depth", "lead", F.concat(header, body, F.lit(END + "\n")).alias("formatted"),
        F.when(F.col("role") == ASSISTANT, F.struct(
            F.length(header).alias("begin"), (F.length(header) + F.length(body)).alias("end"))).alias("loss"))
    nodes = staged(_tokenised(nodes.withColumn("node", F.monotonically_increasing_id()), vocabulary_path), "nodes")

    # Paths: the node, its owner and its tokens for every turn.
    paths = staged(turns.select("conv", "depth", "a", "b").join(
        nodes.select("a", "b", "depth", "node", "lead", F.size("ids").cast("bigint").alias("n")), ["a", "b", "depth"]
    ).select(F.struct(F.col("conv").isNull().alias("none"), F.col("conv").alias("id")).alias("conv"),
             "depth", "node", "lead", "n"), "paths")
    along = Window.partitionBy("conv").orderBy("depth")
    paths = paths.withColumn("position", F.sum("n").over(along) - F.col("n"))
    # Chains along a conversation: who owns them, how deep and long they are.
    chains = paths.groupBy("conv", "lead").agg(
        F.min("depth").alias("top"), F.count("*").alias("nodes"), F.sum("n").alias("tokens"))
    # A conversation's way through the tree: chains from the root; of two that part, the one that stays
    # longer in the common chain comes first.
    way = chains.groupBy("conv").agg(F.sort_array(F.collect_list(
        F.struct("top", "lead", (-F.col("nodes")).alias("less"), "tokens"))).alias("way"))
    own = chains.filter(F.col("conv") == F.col("lead")).select("conv", F.col("tokens").alias("own"))
    key = F.transform("way", lambda x: F.struct(x["lead"].alias("lead"), x["less"].alias("less")))
    order = staged(way.join(own, "conv").select(
        "conv", "own", F.col("way")[0]["lead"].alias("tree"), key.alias("key"), "way")
        .repartitionByRange("tree", "key").sortWithinPartitions("tree", "key")
        .withColumn("part", F.spark_partition_id()), "chains")
    # Places in the tree's sequence: sums inside the sorted parts, then over the parts of a tree.
    inside = Window.partitionBy("part", "tree").orderBy("key")
    sums = order.groupBy("tree", "part").agg(F.sum("own").alias("own"))
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("tree", "part", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("base"))
    placed = order.withColumn("inside", F.sum("own").over(inside) - F.col("own")).join(sums, ["tree", "part"])
    placed = staged(placed.select("conv", "tree", (F.col("base") + F.col("inside")).alias("at"), "way"), "placed")

    # A node stands behind the nodes of its chain above it, and attends to the chains that lead to it.
    steps = placed.select("conv", F.posexplode("way").alias("step", "chain"))
    begin = placed.select(F.col("conv").alias("lead"), F.col("at").alias("chain_at"))
    above = steps.filter(F.col("chain.lead") != F.col("conv")).select(
        "conv", "step", F.col("chain.lead").alias("lead"), F.col("chain.tokens").alias("tokens"))
    above = above.join(begin, "lead").groupBy("conv").agg(F.sort_array(F.collect_list(F.struct(
        "step", F.col("chain_at").alias("begin"), (F.col("chain_at") + F.col("tokens")).alias("end")))).alias("above"),
        F.sum("tokens").alias("offset"))
    owned = paths.filter(F.col("conv") == F.col("lead")).select("conv", "node", "position")
    spans = F.transform(F.coalesce("above", F.array()), lambda x: F.struct(x["begin"].alias("begin"), x["end"].alias("end")))
    laid = owned.join(placed.select("conv", "tree", "at"), "conv").join(above, "conv", "left").withColumn(
        "start", F.col("at") + F.col("position") - F.coalesce("offset", F.lit(0)))
    # Its own chain counts from the chain's begin to the node.
    attends = F.concat(spans, F.when(F.col("start") > F.col("at"), F.array(
        F.struct(F.col("at").alias("begin"), F.col("start").alias("end")))).otherwise(F.array()))
    laid = laid.select("node", F.col("tree.id").alias("tree"), "start", "position", attends.alias("attends"))
    done = nodes.drop("a", "b", "lead").join(laid, "node")
    return done, paths.select(F.col("conv.id").alias(conv), "depth", "node")


def _tokenised(nodes: DataFrame, vocabulary_path: str) -> DataFrame:
    """Adds the token ids of ``formatted``. Turns are tokenised one by one, so nodes end where tokens end."""
    shared = Shared(nodes.sparkSession, load_vocabulary(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.encoder()
        for batch in slices(batches, "formatted", 3 << 20):
            values, offsets = encoder.encode(batch.column("formatted"))
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, "ids"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema)
    return map_arrow(nodes, run, f"{kinds}, ids array<int>")


def read_back(nodes: DataFrame, paths: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conversation, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from the output alone.

    Digests run along the sorted turns of a conversation, so a long one is never held whole.
    """
    kind = paths.schema[conv].dataType.simpleString()
    turns = paths.select(F.col(conv).alias("conv"), "depth", "node").join(
        nodes.select("node", "formatted", "loss"), "node").select("conv", "depth", "formatted", "loss")
    turns = turns.repartition("conv").sortWithinPartitions("conv", "depth")
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, out = None, None, []

        def ended() -> None:
            if state:
                out.append((current[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for batch in batches:
            for key, formatted, loss in zip(*(batch.column(n).to_pylist() for n in ("conv", "formatted", "loss"))):
                if current != (key,):
                    ended()
                    current, state = (key,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                found = _TURN.fullmatch(formatted)
                role, text = unescaped_role(found[1]), unescaped(found[2])
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if loss is not None:
                    trained = unescaped(formatted[loss["begin"] : loss["end"]])
                    state[2] += len(trained)
                    state[3].update(trained.encode())
                state[4] += len(formatted)
            if out:
                yield _batch(out, batch.schema.field("conv").type)
                out = []
        ended()
        if out:
            yield _batch(out, batch.schema.field("conv").type)

    def _batch(rows: list, key_type: pa.DataType) -> pa.RecordBatch:
        types = [key_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    result = map_arrow(turns, run, f"conv {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                                   "loss_sha256 string, formatted_chars bigint")
    return result.withColumnRenamed("conv", conv)
