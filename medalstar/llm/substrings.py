"""Removal of repeated passages by prefix-partitioned suffix trees.

A suffix starts at every word that has ``width - 1`` more behind it in its document. Two suffixes repeat each other
where a suffix tree has them below one node at least ``width`` words deep.

1. **Variable-length prefixes.** A suffix is filed under the smallest hash among the ``GRAM``-word sequences of its first
   ``width`` words; the prefix that it shares with others in that file ends with that sequence, at the earliest after
   ``GRAM`` words, at the latest after ``width``. Equal sequences of ``width`` words have equal smallest hashes, so
   repeats always meet. Neighbouring suffixes mostly share their file and travel as one segment of words.
2. **Counting before shipping.** Files are counted by hash. A file with one segment holds no repeat unless the segment
   is periodic, and its words never move. In the others equal segments collapse to one with a count, before their words are fetched.
3. **Subtrees.** A file within ``FILE_SEGMENTS`` segments is small enough for memory: its subtree grows by a few
   words a round, as long as a node holds suffixes that stand for two places or more; the rest are leaves and done. What
   is left at ``width`` words lies below a deep internal node. Larger files are split by longer prefixes, at once by all
   ``width`` words: those suffixes are told apart by digests of whole prefixes, counted with partial sums.
4. **Maximal repeats.** The marked suffixes go back to their documents, where overlapping ones join to spans.

``repeats`` gives a row per document with its spans, ``removed`` the text without them. Words are runs without
space, tab or line ends, unchanged. Null and empty texts have no words and lose none; texts shorter than ``width`` words are never
touched. A repeated row is a document of its own, so all its long passages repeat. Keys may be null or repeat. A text is held
whole by the task that reads it, whatever its length; equal passages, however many, move as one segment a task and
as narrow rows. Empty tables give no rows. Columns other than key and text are not read, so their names
cannot clash. Segments are told apart by 128 bits of hash; subtrees compare the words themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalstar.llm.common import (
    ROW, SPACE, broadcast_if_few, chosen_rows, map_arrow, mixed, slices, staged, word_hashes,
)

WIDTH = 35  # words of a passage
GRAM = 8  # words of the sequences whose smallest hash files a suffix
FILE_SEGMENTS = 4096  # segments of a file whose subtree is grown in memory
_BATCH_WORDS = 600_000  # words of the files whose subtrees grow side by side
_ROUND = 3  # words by which nodes grow a round; their numbers fit 64 bits
_ROW_BYTES = 64
_ODD = np.uint64(0xD1342543DE82EF95)
_ODD_BACK = np.uint64(pow(int(_ODD), -1, 1 << 64))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by minima of doubling width."""
    have, best = 1, values
    while 2 * have <= width:
        best = np.minimum(best[:-have], best[have:])
        have *= 2
    return np.minimum(best[: len(values) - width + 1], best[width - have :]) if width > have else best


def segments_of(texts: list[bytes], width: int) -> tuple[np.ndarray, ...]:
    """(text number, first word, suffixes, file, segment hash, periodic) of the segments of all texts.

    A segment is a run of at most ``width - GRAM + 1`` neighbouring suffixes of one file. In a periodic one the smallest
    sequence occurs twice, without which none of its suffixes can repeat another.
    """
    words, owner = word_hashes(texts)
    n = len(words)
    if n < width:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64, bool))
    grams = np.zeros(n - GRAM + 1, dtype=np.uint64)
    for k in range(GRAM):
        grams = mixed(grams * _STEP + words[k : n - GRAM + 1 + k] + np.uint64(k + 1))
    reach = width - GRAM + 1
    file = _smallest(grams, reach)  # one for every suffix, those that cross texts included
    inside = owner[: n - width + 1] == owner[width - 1 :]
    starts = np.flatnonzero(inside)
    if not len(starts):
        return segments_of([], width)
    new = np.concatenate(([True], (np.diff(starts) > 1) | (owner[starts[1:]] != owner[starts[:-1]])
                          | (file[starts[1:]] != file[starts[:-1]])))
    run = np.flatnonzero(new)
    place = np.arange(len(starts)) - np.repeat(run, np.diff(np.append(run, len(starts))))
    first = starts[place % reach == 0]
    size = np.diff(np.append(np.flatnonzero(place % reach == 0), len(starts)))
    # Polynomial hash of the words of a segment, from sums along all words.
    powers = np.full(n + 1, _ODD, dtype=np.uint64)
    powers[0] = 1
    back = np.full(n + 1, _ODD_BACK, dtype=np.uint64)
    back[0] = 1
    powers, back = np.multiply.accumulate(powers), np.multiply.accumulate(back)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(words * powers[:n], dtype=np.uint64)))
    ends = first + size + width - 1
    segment = mixed((sums[ends] - sums[first]) * back[first] + size.astype(np.uint64))
    # Sequences that are smallest for some suffix, and neighbours among them that are equal.
    pad = np.zeros(reach - 1, dtype=np.uint64)
    chosen = np.flatnonzero(grams == ~_smallest(~np.concatenate((pad, file, pad)), reach))
    equal = np.flatnonzero(grams[chosen[1:]] == grams[chosen[:-1]])
    left, right = chosen[equal], np.append(chosen[equal + 1], n)
    periodic = right[np.searchsorted(left, first)] <= first + size + reach - 2
    begin_of_text = np.searchsorted(owner, owner[first])
    return owner[first], first - begin_of_text, size, file[first], segment, periodic


def _segments(docs: DataFrame, width: int) -> DataFrame:
    """(file, position, begin, size, prefix, segment, periodic) of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            owner, begin, size, prefix, segment, periodic = segments_of(texts, width)
            at = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [batch.column("file").take(at), batch.column("position").take(at), pa.array(begin, pa.int32()),
                 pa.array(size, pa.int32()), pa.array(prefix.view(np.int64)), pa.array(segment.view(np.int64)),
                 pa.array(periodic)],
                names=["file", "position", "begin", "size", "prefix", "segment", "periodic"])

    narrow = docs.select("text", F.col(f"{ROW}.file").alias("file"), F.col(f"{ROW}.position").alias("position"))
    return map_arrow(narrow, run, "file bigint, position bigint, begin int, size int, prefix bigint, segment bigint, "
                                  "periodic boolean")


def _fetched(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """The words of the wanted segments; of large files the digests of their suffixes, one a row.

    (prefix, segment, size, n, text, digest, number); ``text`` is null for large files.
    """
    lists = staged(wanted.groupBy("file", "position").agg(
        F.collect_list(F.struct("begin", "size", "prefix", "segment", "n", "large")).alias("wanted")), "wanted")
    narrow = docs.select("text", F.col(f"{ROW}.file").alias("file"), F.col(f"{ROW}.position").alias("position"))
    rows = narrow.join(broadcast_if_few(lists.select("file", "position"), _ROW_BYTES), ["file", "position"], "left_semi")
    names = ["prefix", "segment", "size", "n", "text", "digest", "number"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            out: list[tuple] = []
            for text, chosen in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("wanted").to_pylist()):
                words = text.split()
                for s in chosen:
                    mine = words[s["begin"] : s["begin"] + s["size"] + width - 1]
                    head = (s["prefix"], s["segment"], s["size"], s["n"])
                    if not s["large"]:
                        out.append((*head, b" ".join(mine), None, None))
                        continue
                    out += [(*head, None, hashlib.blake2b(b" ".join(mine[i : i + width]), digest_size=16).digest(), i)
                            for i in range(s["size"])]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return map_arrow(rows.join(lists, ["file", "position"]).select("text", "wanted"), run,
                     "prefix bigint, segment bigint, size int, n bigint, text binary, digest binary, number int")


def deep_suffixes(files: np.ndarray, texts: list[bytes], sizes: np.ndarray, counts: np.ndarray, width: int) -> np.ndarray:
    """For each segment a mask of its suffixes below an internal node of ``width`` words or more.

    ``files`` numbers the files; ``counts`` tells how many places a segment stands for.
    """
    numbers: dict[bytes, int] = {}
    lists = [t.split() for t in texts]
    words = np.array([numbers.setdefault(w, len(numbers)) for ws in lists for w in ws], dtype=np.int64)
    base = np.cumsum([0, *map(len, lists)])[:-1]
    segment = np.repeat(np.arange(len(sizes)), sizes)
    number = np.arange(len(segment)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at, node, weight = base[segment] + number, files[segment], counts[segment]
    bits, depth = max(1, len(numbers)).bit_length(), 0
    step = min(_ROUND, 63 // bits)
    while depth < width and len(at):
        key = np.zeros(len(at), dtype=np.int64)
        for k in range(depth, min(width, depth + step)):
            key = (key << bits) | words[at + k]
        depth += step
        order = np.lexsort((key, node))
        new = np.concatenate(([True], (np.diff(node[order]) != 0) | (np.diff(key[order]) != 0)))
        child = np.cumsum(new) - 1
        places = np.bincount(child, weights=weight[order])  # sums of counts, exact below 2^53
        stays = order[places[child] >= 2]  # the others are leaves of their own
        node = child[places[child] >= 2]
        at, weight, segment, number = at[stays], weight[stays], segment[stays], number[stays]
    masks = np.zeros(len(sizes), dtype=np.int64)
    np.bitwise_or.at(masks, segment, np.int64(1) << number)
    return masks


def _subtrees(fetched: DataFrame, width: int) -> DataFrame:
    """(prefix, segment, mask) of the files that fit memory, several of them at a time."""
    sorted_files = fetched.filter(F.col("text").isNotNull()).select("prefix", "segment", "size", "n", "text").repartition(
        "prefix").sortWithinPartitions("prefix")

    def grow(prefix: list, segment: list, size: list, n: list, texts: list) -> pa.RecordBatch:
        _, files = np.unique(np.array(prefix, dtype=np.int64), return_inverse=True)
        masks = deep_suffixes(files, texts, np.array(size, dtype=np.int64), np.array(n, dtype=np.int64), width)
        keep = np.flatnonzero(masks)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(prefix, dtype=np.int64)[keep]), pa.array(np.array(segment, dtype=np.int64)[keep]),
             pa.array(masks[keep])], names=["prefix", "segment", "mask"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in range(5)]
        words = 0
        for batch in slices(batches, "text", 1 << 20):
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if words >= _BATCH_WORDS and row[0] != held[0][-1]:
                    yield grow(*held)
                    held, words = [[] for _ in range(5)], 0
                for column, value in zip(held, row):
                    column.append(value)
                words += row[2] + width
        if held[0]:
            yield grow(*held)

    return map_arrow(sorted_files, run, "prefix bigint, segment bigint, mask bigint")


def _split_files(fetched: DataFrame) -> DataFrame:
    """(prefix, segment, mask) of the files that don't fit: suffixes counted by their whole prefix."""
    suffixes = fetched.filter(F.col("digest").isNotNull()).select("prefix", "segment", "n", "digest", "number")
    deep = staged(suffixes.groupBy("prefix", "digest").agg(F.sum("n").alias("places")).filter("places > 1").drop(
        "places"), "deep")
    return suffixes.join(deep, ["prefix", "digest"], "left_semi").groupBy("prefix", "segment").agg(
        F.bit_or(F.expr("shiftleft(1L, number)")).alias("mask"))


def _spans(marked: DataFrame, width: int) -> DataFrame:
    """(file, position, n_removed, spans): the words below marked suffixes, overlapping ones joined."""
    lists = marked.groupBy("file", "position").agg(F.sort_array(F.collect_list(F.struct("begin", "mask"))).alias("marks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, spans = [], []
            for marks in batch.column("marks").to_pylist():
                joined: list[list[int]] = []
                for m in marks:
                    for i in range(m["mask"].bit_length()):
                        if m["mask"] >> i & 1:
                            begin = m["begin"] + i
                            if joined and begin <= joined[-1][1]:
                                joined[-1][1] = begin + width
                            else:
                                joined.append([begin, begin + width])
                total.append(sum(b - a for a, b in joined))
                spans.append([{"begin": a, "end": b} for a, b in joined])
            kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("position"), pa.array(total, pa.int64()), pa.array(spans, kind)],
                names=["file", "position", "n_removed", "spans"])

    return map_arrow(lists, run, "file bigint, position bigint, n_removed bigint, spans array<struct<begin:bigint,end:bigint>>")


def repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(file, position, n_removed, spans) of the documents that hold a repeated passage; ``docs`` has text and ``_row``.

    Spans are half-open ranges of word numbers, maximal and ascending.
    """
    if not GRAM < width < GRAM + 62:
        raise ValueError(f"width must lie between {GRAM + 1} and {GRAM + 61}")
    found = staged(_segments(docs, width), "segments")
    shared = found.groupBy("prefix").agg(F.count("*").alias("n"), F.max("periodic").alias("periodic")).filter(
        "n > 1 OR periodic").select("prefix")
    hits = staged(found.join(staged(shared, "prefixes"), "prefix", "left_semi"), "hits")
    place = F.struct("file", "position", "begin", "size")
    distinct = staged(hits.groupBy("prefix", "segment").agg(F.count("*").alias("n"), F.min(place).alias("first")).select(
        "prefix", "segment", "n", "first.*"), "distinct")
    large = distinct.groupBy("prefix").agg(F.count("*").alias("members")).filter(F.col("members") > FILE_SEGMENTS)
    large = staged(large.select("prefix", F.lit(True).alias("large")), "large")
    wanted = distinct.join(broadcast_if_few(large, _ROW_BYTES), "prefix", "left").withColumn(
        "large", F.coalesce("large", F.lit(False)))
    fetched = staged(_fetched(docs, wanted, width), "fetched")
    masks = staged(_subtrees(fetched, width).unionByName(_split_files(fetched)), "masks")
    marked = hits.select("file", "position", "begin", "prefix", "segment").join(masks, ["prefix", "segment"])
    return _spans(marked.select("file", "position", "begin", "mask"), width)


def removed(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(key, n_words, n_removed, spans, kept) for every row: ``kept`` is the words that stay, joined by one space."""
    rows = chosen_rows(df, key=key, text=text)
    docs = rows.select("key", F.coalesce("text", F.lit("")).alias("text"), ROW)
    spans = staged(repeats(docs, width), "spans")
    words = F.trim(F.regexp_replace("text", SPACE, " "))
    all_of = docs.select("key", F.col(f"{ROW}.file").alias("file"), F.col(f"{ROW}.position").alias("position"), "text")
    # Only texts that lose some of their words are shuffled, if the others can be told without that.
    some = broadcast_if_few(spans.select("file", "position"), _ROW_BYTES)
    n_words = F.when(words == "", 0).otherwise(F.size(F.split(words, " "))).cast("bigint").alias("n_words")
    none = F.lit(0).cast("bigint").alias("n_removed"), F.array().cast(spans.schema["spans"].dataType).alias("spans")
    whole = all_of.join(some, ["file", "position"], "left_anti").select("key", n_words, *none, words.alias("kept"))
    touched = all_of.join(some, ["file", "position"], "left_semi").join(spans, ["file", "position"])
    kind = docs.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            sizes, kept = [], []
            for content, cut in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist()):
                ws = content.split()
                sizes.append(len(ws))
                edges = [0, *(x for s in cut for x in (s["begin"], s["end"])), len(ws)]
                kept.append(b" ".join(w for a, b in zip(edges[::2], edges[1::2]) for w in ws[a:b]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(sizes, pa.int64()), batch.column("n_removed"), batch.column("spans"),
                 pa.array(kept, pa.binary()).cast(pa.string())], names=["key", "n_words", "n_removed", "spans", "kept"])

    cut = map_arrow(touched.select("key", "text", "n_removed", "spans"), run,
                    f"key {kind}, n_words bigint, n_removed bigint, spans array<struct<begin:bigint,end:bigint>>, kept string")
    return whole.unionByName(cut).withColumnRenamed("key", key)
