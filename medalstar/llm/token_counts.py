"""Token counts that follow edits.

A document keeps a segment tree over its pre-tokens. A leaf is a run of at most ``LEAF`` pre-tokens with its
characters and tokens; an inner node holds the sums of its two children. An edit replaces some
characters. Only the leaves it touches are encoded again, together with boundary context: the scan starts at
a leaf that ends ``CONTEXT`` characters before the edit, where no pre-token can have seen the edited text, and
ends at the first old leaf boundary behind the edit that is a boundary of the new text too. From there on
the old leaves hold. Sums are updated along the paths of the leaves that changed.

Null texts count as empty. Edits of a document apply in the order of ``seq`` (nulls first, then by place), each
to the text left by the one before; places beyond the end are moved to the end, and null or negative numbers
count as 0, a null insert as empty. Edits of unknown documents are ignored, documents without edits keep
their counts. Rows that repeat a key each get all its edits, unless edits name single rows. A null key matches no edit. Columns other than
those named are not read, so their names cannot clash.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate
from operator import add

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalstar.llm.bpe import Encoder, Shared, load_vocabulary
from medalstar.llm.common import ROW, map_arrow, slices, with_rows

LEAF = 8  # pre-tokens
FEW = 48  # pre-tokens that are merged one by one; more are merged together
REMEMBERED, LONGEST = 400_000, 64  # pre-tokens whose counts a worker keeps, and characters of one at most
CONTEXT = 16  # characters; more than the longest special string or look-ahead of the pattern
TREE = "leaf_chars array<int>, leaf_tokens array<int>, sums array<bigint>"


def pre_tokens(encoder: Encoder, text: str) -> list[str]:
    """Pre-tokens of a text; special strings are one each."""
    out = []
    for i, piece in enumerate(encoder.special.split(text) if encoder.special else [text]):
        out += [piece] if i % 2 else encoder.pattern.findall(piece)
    return out


def count_tokens(encoder: Encoder, words: list[str], known: dict[str, int] | None = None) -> list[int]:
    """Tokens of each pre-token; ``known`` holds the counts found before and takes in the new ones."""
    size = {} if known is None else known
    plain = [w for w in dict.fromkeys(words) if w not in size and w not in encoder.specials]
    if 0 < len(plain) <= FEW:
        size.update((w, len(encoder.merge_long(w.encode("utf-8", "surrogatepass")))) for w in plain)
    elif plain:
        _, _, sizes = encoder.merge([w.encode("utf-8", "surrogatepass") for w in plain])
        size.update(zip(plain, sizes.tolist()))
    return [size.get(w, 1) for w in words]


def trim(known: dict[str, int]) -> None:
    """Bound what a worker remembers after a batch, in number and in length."""
    if len(known) > REMEMBERED:
        known.clear()
    for word in [w for w in known if len(w) > LONGEST]:
        del known[word]


def leaves_of(
    encoder: Encoder, words: list[str], known: dict[str, int] | None = None
) -> tuple[list[int], list[int]]:
    """(characters, tokens) of the leaves over consecutive pre-tokens."""
    chars, tokens, at = list(map(len, words)), count_tokens(encoder, words, known), range(0, len(words), LEAF)
    return [sum(chars[i : i + LEAF]) for i in at], [sum(tokens[i : i + LEAF]) for i in at]


def _levels(leaves: list[int], size: int) -> list[int]:
    """The nodes of a tree of ``size`` leaves, root at 1, each the sum of its children."""
    levels = [leaves + [0] * (size - len(leaves))]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append(list(map(add, below[::2], below[1::2])))
    return [0, *(x for level in reversed(levels) for x in level)]


class SegmentTree:
    """Sums of characters and tokens over the leaves. Node i has the children 2i and 2i + 1."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.size, self.n = 1 << max(0, len(chars) - 1).bit_length(), len(chars)
        self.chars, self.sums = _levels(chars, self.size), _levels(tokens, self.size)

    def leaf_at(self, place: int) -> tuple[int, int]:
        """(leaf that holds the character at ``place``, where it begins); the last leaf beyond the end."""
        node, begin, chars = 1, 0, self.chars
        while node < self.size:
            node *= 2
            left = chars[node]
            if place >= begin + left and chars[node + 1]:
                begin, node = begin + left, node + 1
        return node - self.size, begin

    def replace(self, first: int, last: int, chars: list[int], tokens: list[int]) -> None:
        """Put new leaves in the place of [first, last). As many as before: only their paths change."""
        if last - first == len(chars):
            for sums, new in ((self.chars, chars), (self.sums, tokens)):
                low, high = self.size + first, self.size + last - 1
                sums[low : high + 1] = new
                while low > 1:
                    low, high = low // 2, high // 2
                    for i in range(low, high + 1):
                        sums[i] = sums[2 * i] + sums[2 * i + 1]
            return
        old_chars, old_tokens = self.leaves()
        self.__init__([*old_chars[:first], *chars, *old_chars[last:]], [*old_tokens[:first], *tokens, *old_tokens[last:]])

    @property
    def tokens(self) -> int:
        return self.sums[1]

    def leaves(self) -> tuple[list[int], list[int]]:
        """Characters and tokens of the leaves."""
        own = slice(self.size, self.size + self.n)
        return self.chars[own], self.sums[own]


def edit(
    encoder: Encoder, tree: SegmentTree, text: str, start: int, cut: int, insert: str, known: dict[str, int] | None = None
) -> tuple[str, int]:
    """(the edited text, characters encoded again); the tree follows. ``known`` as for ``count_tokens``."""
    start = min(max(start, 0), len(text))
    cut = min(max(cut, 0), len(text) - start)
    new = text[:start] + insert + text[start + cut :]
    if not tree.n or not new:
        tree.__init__(*leaves_of(encoder, pre_tokens(encoder, new), known))
        return new, len(new)
    first, begin = tree.leaf_at(max(0, start - CONTEXT))
    grown = len(insert) - cut
    last, stop = tree.leaf_at(start + cut + CONTEXT)
    while True:
        stop += tree.chars[tree.size + last]  # end of the leaf, in the old text
        last += 1
        end = stop + grown
        whole = last >= tree.n
        # Some characters more, so that the last pre-token ends where it does in the whole text.
        words = pre_tokens(encoder, new[begin:] if whole else new[begin : end + CONTEXT])
        ends = list(accumulate(map(len, words), initial=begin))
        at = len(words) if whole else bisect_left(ends, end)
        if whole or (at < len(ends) and ends[at] == end):
            words = words[:at]
            chars, tokens = leaves_of(encoder, words, known)
            tree.replace(first, last, chars, tokens)
            return new, sum(chars)


def apply_edits(
    df: DataFrame, edits: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text", by: str | None = None
) -> DataFrame:
    """(key, tokens_before, tokens_after, edits, chars_again, chars_after, leaf_chars, leaf_tokens, sums).

    ``edits``: ``by``, seq, start, cut, insert. ``by`` is the key unless given; ``_row`` names single rows, for
    which ``df`` has that column too. Edits stream behind their document, sorted, so a task holds one document and
    a batch, however many edits it gets.
    """
    shared, by = Shared(df.sparkSession, load_vocabulary(vocabulary_path)), by or key
    kind = df.schema[key].dataType.simpleString()
    zero = lambda c: F.greatest(F.coalesce(F.col(c).cast("bigint"), F.lit(0)), F.lit(0)).alias(c)
    changes = edits.filter(F.col(by).isNotNull()).select(
        F.col(by).alias("by"), F.col("seq").cast("bigint").alias("seq"), zero("start"), zero("cut"),
        F.coalesce("insert", F.lit("")).alias("insert"))
    docs = with_rows(df).select(F.col(by).alias("by"), F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text"), ROW)
    if by == ROW:
        changes = changes.withColumnRenamed("by", ROW)
    else:
        changes = docs.filter(F.col("by").isNotNull()).select("by", ROW).join(changes, "by").drop("by")
    place = ["file", "position"]
    own = [F.col(f"{ROW}.{c}").alias(c) for c in place]
    rows = docs.select(*own, F.lit(False).alias("change"), "key", "text").unionByName(
        changes.select(*own, F.lit(True).alias("change"), "seq", "start", "cut", "insert"), allowMissingColumns=True)
    rows = rows.repartition(*place).sortWithinPartitions(*place, "change", "seq", "start", "cut", "insert")
    names = ["key", "tokens_before", "tokens_after", "edits", "chars_again", "chars_after", "leaf_chars", "leaf_tokens", "sums"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.encoder()
        at = key_ = tree = None  # place, key and tree of the document in hand
        text_, before, changed, again = "", 0, 0, 0
        known = encoder.counts

        def packed(done: list[tuple]) -> pa.RecordBatch:
            types = [key_type] + [pa.int64()] * 5 + [pa.list_(pa.int32())] * 2 + [pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*done), types)], names=names)

        def result() -> tuple:
            return key_, before, tree.tokens, changed, again, len(text_), *tree.leaves(), tree.sums

        for batch in slices(slices(batches, "text", 3 << 20), "insert", 3 << 20):
            key_type = batch.schema.field("key").type
            # One pass over the batch's distinct pre-tokens counts the leaves of all its documents.
            fresh = batch.filter(pc.invert(batch.column("change")))
            words = [pre_tokens(encoder, t) for t in fresh.column("text").to_pylist()]
            count_tokens(encoder, [w for own in words for w in own], known)
            done, next_ = [], iter(words)
            columns = (batch.column(c).to_pylist() for c in (*place, "change", "key", "text", "start", "cut", "insert"))
            for file, position, change, new_key, new_text, start, cut, insert in zip(*columns):
                if change:
                    if at == (file, position):
                        text_, read = edit(encoder, tree, text_, start, cut, insert, known)
                        again, changed = again + read, changed + 1
                    continue
                if at is not None:
                    done.append(result())
                tree = SegmentTree(*leaves_of(encoder, next(next_), known))
                at, key_, text_, before, changed, again = (file, position), new_key, new_text, tree.tokens, 0, 0
            if done:
                yield packed(done)
            trim(known)
        if at is not None:
            yield packed([result()])

    return map_arrow(rows, run, f"key {kind}, tokens_before bigint, tokens_after bigint, edits bigint, chars_again bigint, "
                                f"chars_after bigint, {TREE}").withColumnRenamed("key", key)


def sample_edits(df: DataFrame, key: str = "doc_id", text: str = "text", by: str | None = None) -> DataFrame:
    """Four edits for every row with a key, told by its key and length, under its ``by`` (the key unless given): an insert near the front, a word cut in the
    middle, a passage of its own repeated at the end, and a few characters replaced in the last third."""
    n = F.coalesce(F.length(text), F.lit(0))
    h = F.pmod(F.xxhash64(F.lit(17), F.col(key)), F.lit(97))
    rows = [
        (1, F.least(h, n), F.lit(0), F.lit(" edited passage, inserted")),
        (2, F.floor(n / 2), F.least(h % 9 + 1, n), F.lit("")),
        (3, n, F.lit(0), F.coalesce(F.substring(F.col(text), 1, 40), F.lit(""))),
        (4, F.floor(n * 2 / 3), F.least(h % 5, n), F.lit("'s\n")),
    ]
    return df.filter(F.col(key).isNotNull()).select(F.col(by or key), F.explode(F.array(*[F.struct(
        F.lit(seq).alias("seq"), start.cast("bigint").alias("start"), cut.cast("bigint").alias("cut"),
        insert.alias("insert")) for seq, start, cut, insert in rows])).alias("e")).select(by or key, "e.*")
