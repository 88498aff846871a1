"""Ranked lexical search by presence masks.

1. Documents are read once per block of items and reduced to their postings: the terms of the block's items
   that they hold, with counts, and the number of all their terms. Every task adds up how many documents hold each
   term, so that only sums are shuffled.
2. A task takes its documents in groups. Within a group each item sets one bit per term in the documents that hold
   it: documents with one mask hold the same terms of the item. A mask's ceiling is the sum of the largest gains
   that its terms have in the group. Distinct masks are evaluated by descending ceiling, until the ceiling
   falls below the k-th score that the task has found for the item. No document that could enter is left out.
3. The k best of each task meet in a top-k per item, first by slices of the tasks, then over all.

Terms are maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z lowered, over the whole text. With N
documents that have a term, L terms in all, df documents that hold a term, n terms in a document and tf of them the
term: its weight is ``floor(1000 * ln((2N + 2) / (2df + 1)))``, never below 0; the document's m is
``10 + (90 * n * N) div L``; the score sums ``weight * ((10^9 * tf) div (1000 * tf + 8m))`` over an item's distinct terms.

Items are taken in blocks of at most ``ITEM_BYTES`` of text or one item, so the broadcast terms are bounded however
many items there are; a further block reads the documents once more. Null and empty texts have no term: such
documents are never found, such items find nothing. Scores of 0 are left out. Ties go to the smaller document key (null
last), then to the row's place; a repeated row is a document, or an item, of its own. A document's text is held whole, its
postings are bounded by the block's terms. Empty tables give no rows. Columns other than the two keys and
texts are not read, so their names cannot clash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medalstar.llm.common import chosen_rows, map_arrow, slices, staged
from medalstar.operators.keys import top_n_per_key

ITEM_BYTES = 4 << 20  # text of the items of one block
GROUP_ROWS = 8192  # documents whose masks are compared at a time
_AT_ONCE = 64  # documents evaluated between two looks at the k-th score
_SLICES = 64
# ASCII letters and digits and all bytes of characters beyond ASCII belong to terms.
_FOLD = bytes(b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalnum() else 0x20 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order, with repeats."""
    return text.translate(_FOLD).split()


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _item_blocks(items: DataFrame) -> Iterator[list]:
    """The items in lists of (key, sorted distinct terms), each list within ``ITEM_BYTES`` or of one item."""
    kind = items.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            terms = [sorted(set(terms_of(t))) for t in _texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("spread"), pa.array(terms, pa.list_(pa.binary()))],
                names=["key", "spread", "terms"])

    spread = F.xxhash64("_row.file", "_row.position").alias("spread")
    listed = staged(map_arrow(
        items.select("key", "text", spread), run, f"key {kind}, spread bigint, terms array<binary>"), "items")
    size = F.aggregate("terms", F.lit(0).cast("bigint"), lambda a, t: a + F.length(t) + 1)
    blocks = 1
    while True:  # halve the blocks until the largest one with several items is measured to fit
        block = F.pmod("spread", F.lit(blocks))
        most = listed.groupBy(block).agg(F.count("*").alias("n"), F.sum(size).alias("bytes")).filter("n > 1").agg(
            F.max("bytes")).first()[0]
        if (most or 0) <= ITEM_BYTES:
            break
        blocks *= 2
    for b in range(blocks):
        yield listed.filter(block == b).orderBy("spread").select("key", "terms").collect()


def _postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document its postings; per task one row with ``df``: sums over the task's documents."""
    kind = docs.schema["key"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    names = ["key", "file", "position", "n", "terms", "tfs", "docs", "df"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, df, total, holders, key_type = shared.value, None, 0, 0, None
        df = np.zeros(len(known), dtype=np.int64)
        for batch in slices(batches, "text"):
            key_type = batch.schema.field("key").type
            counts, found = [], []
            for text in _texts(batch):
                terms = terms_of(text)
                counts.append(len(terms))
                found.append(sorted((known[t], c) for t, c in Counter(terms).items() if t in known))
            offsets = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            flat = np.array([x for f in found for x in f], dtype=np.int32).reshape(-1, 2)
            df += np.bincount(flat[:, 0], minlength=len(df))
            total, holders = total + sum(counts), holders + sum(c > 0 for c in counts)
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(flat[:, i]))) for i in (0, 1)]
            rows = len(counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("file"), batch.column("position"), pa.array(counts, pa.int64()),
                 *lists, pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.list_(pa.int64()))], names=names)
        if key_type is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, key_type), *(pa.nulls(1, pa.int64()) for _ in range(2)), pa.array([total], pa.int64()),
                 *(pa.nulls(1, pa.list_(pa.int32())) for _ in range(2)), pa.array([holders], pa.int64()),
                 pa.array([df], pa.list_(pa.int64()))], names=names)

    narrow = docs.select("key", "text", F.col("_row.file").alias("file"), F.col("_row.position").alias("position"))
    return map_arrow(narrow, run, f"key {kind}, file bigint, position bigint, n bigint, terms array<int>, "
                                  "tfs array<int>, docs bigint, df array<bigint>")


class _Group:
    """Documents whose masks are compared: postings by document and by term."""

    def __init__(self, n: np.ndarray, offsets: np.ndarray, terms: np.ndarray, tfs: np.ndarray, docs: int, total: int):
        self.rows, self.offsets, self.terms = len(n), offsets, terms
        m = 10 + (90 * n * docs) // total
        doc = np.repeat(np.arange(self.rows), np.diff(offsets))
        tfs = tfs.astype(np.int64)
        self.gain = (10**9 * tfs) // (1000 * tfs + 8 * m[doc])
        order = np.argsort(terms, kind="stable")
        by_term, self.holders = terms[order], doc[order]
        self.first = np.flatnonzero(np.diff(by_term, prepend=-1))
        self.last = np.append(self.first[1:], len(by_term))
        self.present = by_term[self.first]
        self.most = np.maximum.reduceat(self.gain[order], self.first) if len(by_term) else np.empty(0, np.int64)

    def masks(self, slots: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(mask number of every document, ceilings of the masks, documents in order of mask numbers)."""
        number = np.zeros(self.rows, dtype=np.int64)
        ceilings = np.zeros(1, dtype=np.int64)
        for at in range(0, len(slots), 64):
            word = np.zeros(self.rows, dtype=np.uint64)
            tops = np.zeros(64, dtype=np.int64)
            for bit, slot in enumerate(slots[at : at + 64]):
                word[self.holders[self.first[slot] : self.last[slot]]] |= np.uint64(1 << bit)
                tops[bit] = weights[at + bit] * self.most[slot]
            values, inverse = np.unique(word, return_inverse=True)
            pieces = values.view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
            tables = bits @ tops.reshape(8, 8).T  # what each value of a byte adds, by byte
            part = tables[pieces, np.arange(8)].sum(axis=1)
            if at == 0:
                number, ceilings = inverse, part
            else:  # more than 64 terms: one more word of the mask
                both, first, inverse2 = np.unique(
                    number * len(values) + inverse, return_index=True, return_inverse=True)
                ceilings, number = ceilings[number[first]] + part[inverse[first]], inverse2
        return number, ceilings, np.argsort(number, kind="stable")

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores of documents that hold a term, by weights over the whole vocabulary."""
        begin, size = self.offsets[docs], self.offsets[docs + 1] - self.offsets[docs]
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) + np.repeat(begin - (ends - size), size)
        return np.add.reduceat(weights[self.terms[at]] * self.gain[at], ends - size)


def _best(postings: DataFrame, items: list, ids: list[np.ndarray], weights: np.ndarray, docs: int, total: int,
          k: int, item_type: str) -> DataFrame:
    """(number, item, key, file, position, score): the ``k`` best documents of every item within every task."""
    kind = postings.schema["key"].dataType.simpleString()
    shared = postings.sparkSession.sparkContext.broadcast((ids, weights, [i["key"] for i in items]))
    out_type = pa.schema([("number", pa.int64()), ("item", _arrow(postings, item_type)),
                          ("key", _arrow(postings, kind)), ("file", pa.int64()), ("position", pa.int64()),
                          ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms_of_items, weight, names = shared.value
        best: list[list[tuple]] = [[] for _ in names]
        full = np.zeros(len(weight), dtype=np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, GROUP_ROWS):
                batch = whole.slice(at, GROUP_ROWS)
                lists, tfs = batch.column("terms"), batch.column("tfs").flatten().to_numpy()
                offsets = lists.offsets.to_numpy().astype(np.int64)
                group = _Group(batch.column("n").to_numpy().astype(np.int64), offsets - offsets[0],
                              lists.flatten().to_numpy(), tfs, docs, total)
                place = [batch.column(c) for c in ("key", "file", "position")]
                for i, mine in enumerate(terms_of_items):
                    slot = np.searchsorted(group.present, mine)
                    there = slot < len(group.present)
                    there[there] = group.present[slot[there]] == mine[there]
                    there &= weight[mine] > 0
                    if not there.any():
                        continue
                    number, ceilings, members = group.masks(slot[there], weight[mine[there]])
                    bar = best[i][-1][5] if len(best[i]) == k else 1
                    rank = np.argsort(-ceilings, kind="stable")
                    rank = rank[ceilings[rank] >= bar]
                    sizes = np.bincount(number, minlength=len(ceilings))
                    begins = np.cumsum(sizes) - sizes
                    full[mine] = weight[mine]
                    done = 0
                    while done < len(rank) and ceilings[rank[done]] >= bar:
                        ahead = np.cumsum(sizes[rank[done : done + _AT_ONCE]])
                        upto = done + min(len(ahead), 1 + int(np.searchsorted(ahead, _AT_ONCE)))
                        rows = np.concatenate([members[begins[g] : begins[g] + sizes[g]] for g in rank[done:upto]])
                        done = upto
                        score = group.scores(rows, full)
                        good = np.flatnonzero(score >= bar)
                        if len(good) > k:  # those that tie with the k-th stay for now
                            good = good[score[good] >= np.partition(score[good], -k)[-k]]
                        for row, s in zip(rows[good].tolist(), score[good].tolist()):
                            key, file, position = (c[row].as_py() for c in place)
                            best[i].append((-s, key is None, key, file, position, s))
                        best[i].sort(key=_order)
                        del best[i][k:]
                        bar = best[i][-1][5] if len(best[i]) == k else 1
                    full[mine] = 0
        rows = [(i, names[i], b[2], b[3], b[4], b[5]) for i, found in enumerate(best) for b in found]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), out_type)], names=out_type.names)

    return map_arrow(postings, run, f"number bigint, item {item_type}, key {kind}, file bigint, position bigint, score bigint")


def _order(found: tuple) -> tuple:
    """Score, then key with null last, then place. Null keys are not compared."""
    return (found[0], found[1], 0 if found[1] else found[2], found[3], found[4])


def _arrow(df: DataFrame, kind: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    return to_arrow_type(StructType.fromDDL(f"x {kind}")["x"].dataType)


def search(items: DataFrame, docs: DataFrame, k: int = 10, item: str = "item_id", item_text: str = "text",
           doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(item, rank, doc, score): the ``k`` best documents of every row of ``items``, scores above 0."""
    queries = chosen_rows(items, key=item, text=item_text)
    corpus = chosen_rows(docs, key=doc, text=text)
    item_type = queries.schema["key"].dataType.simpleString()
    found = None
    for block, rows in enumerate(_item_blocks(queries)):
        vocabulary = {t: i for i, t in enumerate(sorted({bytes(t) for r in rows for t in r["terms"]}))}
        postings = staged(_postings(corpus, vocabulary), "postings")
        sums = postings.filter(F.col("df").isNotNull())
        head = sums.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
        dfs = sums.select(F.posexplode("df").alias("term", "df")).groupBy("term").agg(F.sum("df").alias("df")).collect()
        weights = np.zeros(len(vocabulary), dtype=np.int64)
        for row in dfs:
            weights[row["term"]] = math.floor(1000 * math.log((2 * head["docs"] + 2) / (2 * row["df"] + 1)))
        ids = [np.array(sorted(vocabulary[bytes(t)] for t in r["terms"]), dtype=np.int64) for r in rows]
        documents = postings.filter(F.col("df").isNull() & (F.size("terms") > 0)).select(
            "key", "file", "position", "n", "terms", "tfs")
        best = _best(documents, rows, ids, weights, head["docs"], max(1, head["n"]), k, item_type).withColumn(
            "block", F.lit(block))
        found = best if found is None else found.unionByName(best)
    order = [F.col("score").desc(), F.col("key").asc_nulls_last(), F.col("file"), F.col("position")]
    slice_of = F.pmod(F.xxhash64("file", "position"), F.lit(_SLICES))
    sliced = top_n_per_key(found.withColumn("slice", slice_of), ["block", "number", "slice"], order, k)
    rank = F.row_number().over(Window.partitionBy("block", "number").orderBy(*order))
    return sliced.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        F.col("item").alias(item), "rank", F.col("key").alias(doc), "score")
