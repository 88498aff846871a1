"""Exact deduplication by an exchange of Golomb-coded fingerprints.

1. Every partition normalises its texts (each run of spaces becomes one blank), digests them and takes
   the leading ``BITS`` bits of the digest as fingerprint. Fingerprints are divided among owners by
   their leading bits. For each owner the partition sorts its distinct fingerprints and sends the
   differences Golomb-Rice coded: one blob per partition and owner, however often a text repeats.
2. An owner decodes the blobs, finds the fingerprints that several partitions sent or one partition
   had more than once, and returns a bitmap per partition: bit i says that its i-th one repeats.
3. Rows whose bit is set are suspects. Only their texts are shuffled, grouped by the text itself, which
   compares them byte by byte; copies collapse before the shuffle, so a hot text costs one row a task.

Nulls count as the empty text, and empty texts are copies of each other. Of equal texts the row with
the smallest key stays, nulls last; of rows that repeat key and text, exactly one. A null key is kept
as a null; ``keep_id`` is null only where all keys of a group are. Texts are compared whole. Columns
other than key and text are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalstar.llm.common import ROW, SPACE, broadcast_if_few, map_arrow, staged, with_rows

BITS = 48  # of a fingerprint; more bits mean fewer false suspects
PER_OWNER = 1 << 20  # fingerprints an owner should have to decode
MAX_OWNER_BITS = 14
_ROW_BYTES = 48  # of a broadcast row of two numbers, generously


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def golomb_encode(sorted_values: np.ndarray, flags: np.ndarray) -> bytes:
    """Rice code of ascending distinct numbers, each with one flag bit.

    Number of values (8 bytes) and parameter (1 byte); then the quotients in unary, the remainders, and the
    flags as three bit strings.
    """
    gaps = np.diff(sorted_values.astype(np.int64), prepend=np.int64(0))
    mean = max(1, int(sorted_values[-1]) // max(1, len(sorted_values))) if len(sorted_values) else 1
    low = min(48, max(0, mean.bit_length() - 1))
    quotients = gaps >> low
    unary = np.zeros(int(quotients.sum()) + len(gaps), dtype=np.uint8)
    if len(gaps):
        unary[np.cumsum(quotients + 1) - 1] = 1
    rest = ((gaps[:, None] >> np.arange(low)) & 1).astype(np.uint8).ravel()
    head = len(gaps).to_bytes(8, "little") + bytes([low]) + len(unary).to_bytes(8, "little")
    return head + b"".join(np.packbits(x).tobytes() for x in (unary, rest, flags.astype(np.uint8)))


def golomb_decode(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, low, width = int.from_bytes(blob[:8], "little"), blob[8], int.from_bytes(blob[9:17], "little")
    sizes = [-(-width // 8), -(-n * low // 8), -(-n // 8)]
    raw = np.frombuffer(blob, dtype=np.uint8, offset=17)
    parts = np.split(raw, np.cumsum(sizes)[:-1])
    ends = np.flatnonzero(np.unpackbits(parts[0], count=width))
    quotients = np.diff(ends, prepend=-1) - 1
    rest = np.unpackbits(parts[1], count=n * low).reshape(n, low).astype(np.int64)
    gaps = (quotients.astype(np.int64) << low) + (rest << np.arange(low)).sum(axis=1)
    return np.cumsum(gaps), np.unpackbits(parts[2], count=n).astype(bool)


def _fingerprints(docs: DataFrame, owner_bits: int) -> DataFrame:
    """Per row (key, row, sha, part, owner, slot), and per partition and owner one row with a blob."""
    key_type = docs.schema["key"].dataType.simpleString()
    shift = BITS - owner_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        kept = [b for b in batches if b.num_rows]
        if not kept:
            return
        table = pa.Table.from_batches(kept).combine_chunks()  # narrow: no texts
        head = table.column("head").combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)
        values, slot, counts = np.unique(head, return_inverse=True, return_counts=True)
        owners = values >> shift
        first = np.searchsorted(owners, owners)  # where an owner's values begin
        n = table.num_rows
        yield from pa.table({
            "key": table.column("key"), "file": table.column("file"), "position": table.column("position"),
            "sha": table.column("sha"), "part": pa.array(np.full(n, part)), "owner": pa.array(owners[slot]),
            "slot": pa.array((np.arange(len(values)) - first)[slot]), "blob": pa.nulls(n, pa.binary()),
        }).to_batches()
        bounds = [*np.unique(first).tolist(), len(values)]
        blobs = [golomb_encode(values[a:b] & ((1 << shift) - 1), counts[a:b] > 1) for a, b in zip(bounds, bounds[1:])]
        m = len(blobs)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(m, table.schema.field("key").type), *(pa.nulls(m, pa.int64()) for _ in range(2)),
             pa.nulls(m, pa.binary()), pa.array(np.full(m, part)), pa.array(owners[bounds[:-1]]),
             pa.nulls(m, pa.int64()), pa.array(blobs, pa.binary())],
            names=["key", "file", "position", "sha", "part", "owner", "slot", "blob"])

    digest = F.sha2(normalised(F.col("text")), 256)
    narrow = docs.select(
        "key", F.col(f"{ROW}.file").alias("file"), F.col(f"{ROW}.position").alias("position"),
        F.unhex(digest).alias("sha"), F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("bigint").alias("head"))
    return map_arrow(
        narrow, run, f"key {key_type}, file bigint, position bigint, sha binary, part bigint, owner bigint, slot bigint, "
             "blob binary")


def _bitmaps(blobs: DataFrame) -> DataFrame:
    """(part, owner, bits): the answer of each owner to each partition."""

    def answer(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        decoded = [golomb_decode(b) for b in group["blob"]]
        values = np.concatenate([v for v, _ in decoded])
        again = np.concatenate([f for _, f in decoded])
        _, inverse, counts = np.unique(values, return_inverse=True, return_counts=True)
        repeats = again | (counts[inverse] > 1)
        repeats |= np.bincount(inverse, weights=again)[inverse] > 0
        cuts = np.cumsum([len(v) for v, _ in decoded])[:-1]
        bits = [np.packbits(x, bitorder="little").tobytes() for x in np.split(repeats, cuts)]
        return pd.DataFrame({"part": group["part"], "owner": key[0], "bits": bits})

    return blobs.select("part", "owner", "blob").groupBy("owner").applyInPandas(
        answer, "part bigint, owner bigint, bits binary")


def deduplicate(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, keep_id, group_size, kept, text_sha256, _row) for every row of ``df``."""
    rows = with_rows(df)
    docs = rows.select(F.col(key).alias("key"), F.col(text).alias("text"), ROW)
    # The number of owners follows the number of rows, so that an owner's share stays bounded.
    owner_bits = min(MAX_OWNER_BITS, max(3, (df.count() // PER_OWNER).bit_length()))
    found = staged(_fingerprints(docs, owner_bits), "fingerprints")
    own = found.filter(F.col("blob").isNull()).drop("blob")
    bits = _bitmaps(found.filter(F.col("blob").isNotNull()))
    byte = F.conv(F.hex(F.expr("substring(bits, cast(shiftright(slot, 3) + 1 as int), 1)")), 16, 10).cast("int")
    bit = F.expr("cast(slot & 7 as int)")
    # Bitmaps are cut into their set bits, so that the join key is as fine as the rows.
    flagged = staged(
        bits.select("part", "owner", F.explode(F.expr("sequence(0L, 8L * length(bits) - 1)")).alias("slot"), "bits")
        .filter(F.getbit(byte, bit) == 1).select("part", "owner", "slot"), "repeats")
    marked = staged(own.join(
        broadcast_if_few(flagged, _ROW_BYTES).withColumn("suspect", F.lit(True)), ["part", "owner", "slot"], "left"
    ).select("key", "file", "position", "sha", F.coalesce("suspect", F.lit(False)).alias("suspect")), "marked")
    suspects = marked.filter("suspect")

    # Only texts of suspects move. Grouping by the text compares whole texts.
    ids = broadcast_if_few(suspects.select(F.struct("file", "position").alias(ROW)), _ROW_BYTES)
    order = F.struct(F.col("key").isNull().alias("none"), "key", ROW)
    classes = docs.join(ids, ROW, "left_semi").select("key", ROW, normalised(F.col("text")).alias("norm")).groupBy(
        "norm").agg(F.min(order).alias("first"), F.count("*").alias("group_size"))
    classes = classes.select(F.unhex(F.sha2("norm", 256)).alias("sha"), "first", "group_size")
    # Two different texts of one digest would make the join below ambiguous; none are known to exist.
    classes = staged(classes.groupBy("sha").agg(
        F.min("first").alias("first"), F.min("group_size").alias("group_size"),
        F.assert_true(F.count("*") == 1, F.lit("two different texts have one SHA-256")).alias("checked")), "classes")
    row = F.struct("file", "position").alias(ROW)
    sha = F.lower(F.hex("sha")).alias("text_sha256")
    repeated = suspects.join(classes, "sha").select(
        F.col("key").alias(key), F.col("first.key").alias("keep_id"), "group_size",
        (F.col(f"first.{ROW}") == row).alias("kept"), sha, row)
    single = marked.filter(~F.col("suspect")).select(
        F.col("key").alias(key), F.col("key").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), sha, row)
    return single.unionByName(repeated)
