"""Byte-pair encoding and decoding with a contiguous rank array.

A short word is held as a row of parts together with the merge rank of every adjacent pair, side by
side in one array. Each step scans the ranks for the minimum, deletes the boundary there, and looks
up the ranks left and right of the new part anew. All short words of a batch take their steps
together, one array row each; that changes nothing in a word's own steps. Words beyond ``SHORT``
bytes, for which scanning would cost the square of their length, keep their ranks in a heap.

Nulls and empty texts have no tokens and decode to the empty text. Texts are encoded whole, whatever
their length. Rows are kept one by one: repeated rows, repeated or null keys stay as they are, and
columns other than key and text are not read, so their names cannot clash.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medalstar.llm.common import bound_batches, give_back, map_arrow, slices, trimmed

SHORT = 48  # bytes of a word that is merged by scanning
REMEMBERED = 250_000  # units whose ids a worker keeps before it starts anew
LONGEST = 400  # characters of a unit that is kept
NONE = np.int32(2**31 - 1)  # rank of a pair that cannot be merged
# Fixed value: the pattern that splits text into words before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ENCODED = "ids array<int>, decoded string"


@dataclass(frozen=True)
class Vocabulary:
    """A byte-level vocabulary: token bytes by id, merges in order of rank, special strings."""

    tokens: list
    merges: np.ndarray  # (n, 3): left id, right id, merged id
    specials: dict


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def load_vocabulary(path: str) -> Vocabulary:
    """Read a byte-level BPE file. It is of fixed size, so it is read by the driver and broadcast."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model, alphabet = content["model"], byte_alphabet()
    specials = {t["content"]: t["id"] for t in content.get("added_tokens", [])}
    tokens: list = [b""] * (1 + max([*model["vocab"].values(), *specials.values()]))
    for token, i in model["vocab"].items():
        tokens[i] = bytes(alphabet[c] for c in token)
    for token, i in specials.items():
        tokens[i] = token.encode()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    vocab = model["vocab"]
    return Vocabulary(tokens, np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], np.int64), specials)


class Encoder:
    """Encodes and decodes texts with one vocabulary; remembers the ids of recent units."""

    def __init__(self, vocabulary: Vocabulary):
        self.token_bytes = np.frombuffer(b"".join(vocabulary.tokens), np.uint8)
        self.token_sizes = np.fromiter(map(len, vocabulary.tokens), np.int64, len(vocabulary.tokens))
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes
        self.byte_ids = np.zeros(256, dtype=np.int64)
        for i, token in enumerate(vocabulary.tokens):
            if len(token) == 1:
                self.byte_ids[token[0]] = i
        left, right, self.merged = vocabulary.merges.T
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = np.append(keys[order], np.int64(2**62)), np.append(order.astype(np.int32), NONE)
        self.rank_of = dict(zip(keys.tolist(), range(len(keys))))
        self.byte_ranks = self._rank(self.byte_ids[:, None], self.byte_ids[None, :])
        self.pattern = regex.compile(PATTERN)
        self.specials = {s: np.array([i], np.int32).tobytes() for s, i in vocabulary.specials.items()}
        # The longest special string wins where one begins with another.
        self.special = re.compile(
            "(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")"
        ) if self.specials else None
        self.units: dict[str, bytes | None] = {}
        self.counts: dict[str, int] = {}  # tokens of words, for those who only count

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge_short(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids one word after the other, number of ids of each word) by the rank array, in step."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        width = int(lengths.max())
        raw = np.zeros((len(words), width), dtype=np.uint8)
        raw[np.arange(width) < lengths[:, None]] = np.frombuffer(b"".join(words), dtype=np.uint8)
        parts, count, row = self.byte_ids[raw], lengths.copy(), np.arange(len(words))
        ranks = np.full((len(words), max(width - 1, 1)), NONE, dtype=np.int32)
        if width > 1:
            ranks[:] = self.byte_ranks[raw[:, :-1], raw[:, 1:]]
            ranks[np.arange(width - 1) >= (count - 1)[:, None]] = NONE
        merged, sizes = np.zeros((len(words), width), dtype=np.int32), count.copy()
        while len(row):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(row)), at]
            ended = best == NONE
            if ended.any():
                merged[row[ended], : parts.shape[1]], sizes[row[ended]] = parts[ended], count[ended]
                go = ~ended
                parts, ranks, count, row, at, best = parts[go], ranks[go], count[go], row[go], at[go], best[go]
            if not len(row):
                break
            count -= 1
            each, last = np.arange(len(row)), ranks.shape[1] - 1
            parts[each, at] = self.merged[best]
            # Delete the boundary: what lies behind it moves one place left, parts and ranks alike.
            places = np.arange(parts.shape[1] - 1)
            parts = np.take_along_axis(parts, places + (places > at[:, None]), axis=1)
            if not last:
                ranks[:] = NONE
                continue
            places = np.arange(last)
            ranks = np.take_along_axis(ranks, places + (places >= at[:, None]), axis=1)
            # Refresh the ranks next to the new part.
            right = np.flatnonzero(at + 1 < count)
            ranks[right, at[right]] = self._rank(parts[right, at[right]], parts[right, at[right] + 1])
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self._rank(parts[left, at[left] - 1], parts[left, at[left]])
        return merged[np.arange(width) < sizes[:, None]], sizes

    def merge_long(self, word: bytes) -> np.ndarray:
        """Ids of one long word: the same merges, the minimum found by a heap."""
        parts = self.byte_ids[np.frombuffer(word, dtype=np.uint8)].tolist()
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        rank = lambda i, j: self.rank_of.get(parts[i] << 32 | parts[j])
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(len(parts) - 1) if (r := rank(i, i + 1)) is not None]
        heapq.heapify(heap)
        while heap:
            best, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j >= len(parts) or parts[j] != right:
                continue  # a neighbour has been merged since
            parts[i], parts[j] = int(self.merged[best]), -1
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
                if (r := rank(i, after[i])) is not None:
                    heapq.heappush(heap, (r, i, parts[i], parts[after[i]]))
            if (h := before[i]) >= 0 and (r := rank(h, i)) is not None:
                heapq.heappush(heap, (r, h, parts[h], parts[i]))
        return np.array([p for p in parts if p >= 0], dtype=np.int32)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where each word's ids begin, how many there are)."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts, sizes, flat, filled = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), [], 0
        kind = np.where(lengths > SHORT, -1, -(-lengths // 4))  # words of like length share an array
        for k in np.unique(kind):
            own = np.flatnonzero(kind == k)
            if k < 0:
                each = [self.merge_long(words[i]) for i in own]
                ids, size = np.concatenate(each), np.array([len(x) for x in each])
            else:
                ids, size = self.merge_short([words[i] for i in own])
            starts[own], sizes[own] = filled + np.cumsum(size) - size, size
            flat.append(ids)
            filled += len(ids)
        return np.concatenate(flat) if flat else np.empty(0, np.int32), starts, sizes

    def learn(self, units: list[str]) -> None:
        """Remember the ids of new units; None for those the cheap cut may have got wrong."""
        found = [self.pattern.findall(u) if _is_unit(u) else () for u in units]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        coded = pc.dictionary_encode(pa.array([w for own in found for w in own], pa.string()))
        flat, starts, sizes = self.merge([w.encode() for w in coded.dictionary.to_pylist()])
        codes = np.asarray(coded.indices, dtype=np.int64)
        ids, size = gather(flat, starts[codes], sizes[codes])
        data = ids.astype(np.int32).tobytes()
        ends = (4 * np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(counts)))]).tolist()
        for unit, a, b in zip(units, ends, ends[1:]):
            self.units[unit] = data[a:b] or None

    def known(self, units: list[str]) -> list[bytes | None]:
        if len(self.units) > REMEMBERED:
            self.units = {}
        new = [u for u in units if u not in self.units]
        if new:
            self.learn(new)
        out = [self.units[u] for u in units]
        for unit in new:
            if len(unit) > LONGEST:
                self.units.pop(unit, None)
        return out

    def forget(self) -> None:
        """Drop what is remembered; Python workers are kept for later tasks, of other stages too."""
        self.units, self.counts = {}, {}
        give_back()

    def encode_one(self, text: str) -> bytes:
        """Ids of any text. Special strings are cut out first, as the vocabulary's own library does."""
        out = []
        for i, piece in enumerate(self.special.split(text) if self.special else [text]):
            if i % 2:
                out.append(self.specials[piece])
            elif piece:
                # A word is a unit of itself, unless it is made of spaces.
                words = self.pattern.findall(piece)
                stored = self.known(words)
                spaces = sorted({w for w, x in zip(words, stored) if x is None})
                flat, starts, sizes = self.merge([w.encode() for w in spaces])
                rest = {w: flat[a : a + n].astype(np.int32).tobytes() for w, a, n in zip(spaces, starts, sizes)}
                out += [rest[w] if x is None else x for w, x in zip(words, stored)]
        return b"".join(out)

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, where each text begins and the last one ends).

        The pattern ends a word before a blank that stands between two characters other than spaces,
        and before and after such a line end. A batch is cut there into units, of which every
        distinct one is encoded once. Texts with other spaces or special strings take ``encode_one``.
        """
        texts = pc.fill_null(texts, "")
        cut = pc.replace_substring(pc.replace_substring(texts, " ", "\0 "), "\n", "\0\n\0")
        lists = pc.split_pattern(cut, "\0")
        bounds = np.asarray(lists.offsets, dtype=np.int64)
        found = pc.dictionary_encode(lists.flatten())
        stored, codes = self.known(found.dictionary.to_pylist()), np.asarray(found.indices, dtype=np.int64)
        units = found.dictionary.to_pylist()
        wrong = np.fromiter((x is None for x in stored), bool, len(stored))[codes]
        if "" in units and len(codes):
            # Before a first cut and behind a last one stands nothing, so there is no word either.
            edges = np.concatenate((bounds[:-1], bounds[1:] - 1))
            wrong[edges] &= codes[edges] != units.index("")
        odd = np.add.reduceat(wrong, bounds[:-1]) > 0 if len(codes) else np.zeros(len(texts), bool)
        for special in [*self.specials, "\0"]:
            odd |= np.asarray(pc.match_substring(texts, special).to_numpy(zero_copy_only=False), dtype=bool)
        if odd.any():
            codes = codes[np.repeat(~odd, np.diff(bounds))]
        counts = np.where(odd, 0, np.diff(bounds))
        size = np.fromiter((len(x or b"") for x in stored), np.int64, len(stored)) // 4
        values, size = gather(np.frombuffer(b"".join([x or b"" for x in stored]), np.int32),
                              (np.cumsum(size) - size)[codes], size[codes])
        ends = np.concatenate(([0], np.cumsum(size)))
        offsets = ends[np.concatenate(([0], np.cumsum(counts)))]
        if odd.any():
            pieces = [np.frombuffer(self.encode_one(texts[i].as_py()), np.int32) if odd[i] else values[a:b]
                      for i, (a, b) in enumerate(zip(offsets, offsets[1:]))]
            values, offsets = np.concatenate(pieces), np.cumsum([0, *map(len, pieces)])
        return values, offsets

    def decode(self, values: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The text of each run of ids between two offsets."""
        raw, size = gather(self.token_bytes, self.token_starts[values], self.token_sizes[values])
        data, ends = raw.tobytes(), np.concatenate(([0], np.cumsum(size)))[offsets].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]


def _is_unit(unit: str) -> bool:
    body = unit.removeprefix(" ")
    return unit == "\n" or bool(body) and not body[0].isspace() and not body[-1].isspace()


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` that begin at ``starts``, one after the other, and their sizes."""
    shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return flat[shift + np.arange(len(shift))], sizes


class Shared:
    """A vocabulary for the tasks: broadcast once, an encoder built once per worker."""

    def __init__(self, spark: SparkSession, vocabulary: Vocabulary):
        self.value = spark.sparkContext.broadcast(vocabulary)

    def encoder(self) -> Encoder:
        return _encoder(self.value)


def _encoder(broadcast) -> Encoder:
    key = id(broadcast.value)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(broadcast.value)
    return _ENCODERS[key]


_ENCODERS: dict[int, Encoder] = {}


def encode_decode(df: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, decoded): the token ids of every whole text, and the text decoded from those ids."""
    shared = Shared(df.sparkSession, load_vocabulary(vocabulary_path))
    source = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    key_type = df.schema[key].dataType.simpleString()
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.encoder()
        for batch in trimmed(slices(batches, "text", 1 << 20)):
            values, offsets = encoder.encode(batch.column("text"))
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))
            decoded = pa.array(encoder.decode(values, offsets), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("key"), ids, decoded], names=["key", "ids", "decoded"])
            del values, offsets, ids, decoded, batch
        encoder.forget()

    return map_arrow(source, run, f"key {key_type}, {ENCODED}").withColumnRenamed("key", key)


def digests(encoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of what ``encode_decode`` returns."""
    return encoded.select(
        key,
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
