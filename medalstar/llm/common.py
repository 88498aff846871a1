"""What several operators share: row identity, staged tables, words and shingles as arrays."""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import medalstar
from medalstar.operators.joins import BROADCAST_BYTES
from medalstar.session import new_shared_folder

ROW = "_row"  # struct(file, position): identifies a stored row
_ROW_TYPE = "struct<file:bigint,position:bigint>"
HIDING = (ROW, "_metadata")  # columns of a caller's table that stand in the way of the identity
SPACE = r"[\x20\x09-\x0D]+"  # what separates words in the contracts of the operators
WORD = r"[^\x20\x09-\x0D]+"
_WORD_BYTES = np.ones(256, dtype=bool)
_WORD_BYTES[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# Odd multipliers of the hashes; any odd constants would do.
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, survives lost executors."""
    path = new_shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_rows(df: DataFrame) -> DataFrame:
    """``df`` plus ``_row``, an identity that every later read of the same files repeats.

    A frame that has a ``_row`` of that type keeps it: who joins results back to their rows takes the identity
    once and hands on the frame that has it. Parquet scans know file and position of a row. A frame that is not
    a scan, filtered and projected at most, is staged first: joins and exploded arrays would repeat positions.
    Positions stay the same however the files are split, so results do not depend on retries. Other columns named
    ``_row`` or ``_metadata`` would hide what is needed and are left out.
    """
    if ROW in df.columns and df.schema[ROW].dataType.simpleString() == _ROW_TYPE:
        return df
    df = df.drop(*[c for c in HIDING if c in df.columns])
    position = F.struct(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("position")
    ).alias(ROW)
    try:
        return (df if _is_scan(df) else staged(df, "rows")).select("*", position)
    except AnalysisException:  # a scan of files without positions
        return staged(df, "rows").select("*", position)


def chosen_rows(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under the names given, plus ``_row``; other columns of ``df`` cannot clash with them."""
    return with_rows(df.select(*[F.col(old).alias(new) for new, old in columns.items()]))


def _is_scan(df: DataFrame) -> bool:
    """Whether every row of ``df`` is a row of a file, the same one at every read."""
    plan = df._jdf.queryExecution().analyzed()
    steady = plan.deterministic()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    return steady and plan.nodeName() == "LogicalRelation"


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, also where it is not installed on the executors.

    The driver serves the package to executors as an application's own files are served. Nothing
    happens where the environment already names the package's folder.
    """
    context, root = spark.sparkContext, Path(medalstar.__file__).resolve().parent.parent
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or context.applicationId in _SHIPPED:
        return
    archive = Path(tempfile.mkdtemp(prefix="medalstar-code-")) / "medalstar.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted((root / "medalstar").rglob("*.py")):
            out.write(file, file.relative_to(root))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


_SHIPPED: set[str] = set()


@contextmanager
def small_batches(spark: SparkSession, most_bytes: int = 8 << 20) -> Iterator[None]:
    """Arrow batches of bounded bytes for the jobs that run inside: Spark counts rows only, however wide they are."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(most_bytes))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def map_arrow(df: DataFrame, run: Callable, schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with this package at hand."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def broadcast_if_few(df: DataFrame, bytes_per_row: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint where the counted rows fit the limit; otherwise the join shuffles. For staged frames."""
    return F.broadcast(df) if df.count() * bytes_per_row <= limit else df


def held_out(key: Column) -> Column:
    """Rows never learned from: crc32 of the key as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def bounded_sample(df: DataFrame, by: list[str], seed: int, rows: int) -> list:
    """At most ``rows`` rows, those with the smallest hash of ``by``: the same ones in every run.

    Each task sends its own ``rows`` smallest at most.
    """
    spread = F.xxhash64(F.lit(seed), *by)
    return df.withColumn("_spread", spread).orderBy("_spread", *by).limit(rows).drop("_spread").collect()


def among_first(spread: Column, rows: int, total: Column) -> Column:
    """Whether the hash ``spread`` is one of about ``2 * rows`` out of ``total``; always true of fewer rows.

    Thins rows before their ``rows`` smallest hashes are looked for, so that what is moved for a
    bounded sample is bounded too, however many tasks read the table.
    """
    return F.pmod(spread, F.lit(1 << 32)).cast("double") * total <= F.lit(2.0 * rows * (1 << 32))


def empty_like(schema: str, spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schema)


def give_back() -> None:
    """Return freed memory to the system: Python workers are kept for later tasks, of other stages too."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # absent outside glibc
    if trim is not None:
        trim(0)


def bound_batches(spark: SparkSession, most_bytes: int = 8 << 20) -> None:
    """``small_batches`` for a frame that runs only when its caller writes it: the session keeps the bound, or its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(most_bytes))


def trimmed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; what was freed while one of them was worked on is returned to the system before the next."""
    for batch in batches:
        yield batch
        give_back()


def slices(batches: Iterable[pa.RecordBatch], column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Zero-copy pieces of the batches whose ``column`` holds at most ``most_bytes``, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        piece = np.cumsum(sizes) // most_bytes
        starts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for start, end in zip(starts, starts[1:]):
            yield batch.slice(start, end - start)


def mixed(x: np.ndarray) -> np.ndarray:
    """Well mixed 64-bit values (the finaliser of a published generator)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * _STEP)
_UNIT = np.uint64(0xD1342543DE82EF95)  # odd, so every power of it can be undone
_UNDO = np.uint64(pow(int(_UNIT), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


def _prefix_sums(raw: np.ndarray) -> np.ndarray:
    """Sums of the weighted values before every byte and behind the last; few arrays of eight times the text at once."""
    values = _powers(_UNIT, len(raw))
    values *= _BYTE_VALUES[raw]
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(values, out=sums[1:])
    return sums


def shingle_sets(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, 64-bit shingle): the distinct shingles of ``width`` words of every whole text, sorted.

    Words are runs without space, tab or line ends, A-Z lowered. A text with fewer words gives its
    whole sequence as one shingle; a text without words, or null, gives none.
    """
    joined = b" ".join((t or "").encode("utf-8", "surrogatepass").translate(_LOWER) for t in texts) + b" "
    lengths = np.fromiter((len((t or "").encode("utf-8", "surrogatepass")) + 1 for t in texts), np.int64, len(texts))
    raw = np.frombuffer(joined, dtype=np.uint8)
    inside = _WORD_BYTES[raw]
    edges = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    sums = _prefix_sums(raw)
    words = mixed((sums[ends] - sums[starts]) * _powers(_UNDO, len(raw) + 1)[starts] + (ends - starts).astype(np.uint64))
    owner = np.searchsorted(np.cumsum(lengths), starts, side="right")
    first = np.concatenate(([True], owner[1:] != owner[:-1]))
    begin = np.flatnonzero(first)
    count = np.diff(np.concatenate((begin, [len(owner)])))
    # A shingle starts at every word that has width - 1 more behind it, and at the first word of a short text.
    left = np.repeat(begin + count, count) - np.arange(len(owner))
    at = np.flatnonzero((left >= width) | first)
    shingle = np.zeros(len(at), dtype=np.uint64)
    for k in range(width):
        there = left[at] > k
        shingle[there] = mixed(shingle[there] * _STEP + words[at[there] + k] + np.uint64(k + 1))
    order = np.lexsort((shingle, owner[at]))
    owner, shingle = owner[at][order], shingle[order]
    new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (shingle[1:] != shingle[:-1])))
    return owner[new], shingle[new]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash, text number) of every word of UTF-8 texts, in order. Words are taken unchanged."""
    joined = b" ".join(texts) + b" "
    raw = np.frombuffer(joined, dtype=np.uint8)
    edges = np.diff(np.concatenate(([False], _WORD_BYTES[raw], [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    sums = _prefix_sums(raw)
    words = mixed((sums[ends] - sums[starts]) * _powers(_UNDO, len(raw) + 1)[starts] + (ends - starts).astype(np.uint64))
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    return words, np.searchsorted(np.cumsum(lengths), starts, side="right")


WORDS = re.compile(WORD)
