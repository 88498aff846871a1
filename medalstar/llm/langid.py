"""Language identification by rank-order profiles.

A profile lists the most frequent n-grams (one to three letters, a blank marking word ends) by rank.
A language's profile is learned from texts marked with it; a document's profile is compared to each by
the out-of-place distance: the sum over the document's n-grams of how far their ranks lie apart, with
the profile's length for an n-gram the language does not list. The nearest language wins.

Profiles are learned from a bounded sample of the marked rows (``Bounds``); every text is judged
whole. Language, source and key are no input of a prediction. Null texts and texts without a letter
are ``und`` with score 0; so is every text if no language could be learned. Rows whose language is
null, or whose text has no letter, teach nothing. Of languages at equal distance the one first in
code point order wins, of n-grams of equal count the one first in code point order. Repeated rows are
judged one by one. Columns other than those named are carried along, not read; only ``lang_pred`` and
``score`` would be replaced.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalstar.llm.common import among_first, held_out, map_arrow, slices

LENGTHS = (1, 2, 3)
UNKNOWN = "und"
_BITS = np.uint64(21)  # of a code point, so three fit into 64 bits


@dataclass(frozen=True)
class Bounds:
    """What is learned from at most: rows per language in the order of a hash, n-grams of a profile."""

    rows: int = 2000
    profile: int = 400


@dataclass(frozen=True)
class Profiles:
    """Per language the n-grams by rank; a few hundred numbers each."""

    languages: list
    grams: list  # one array of n-gram codes per language, by rank
    size: int


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def gram_codes(text: str) -> np.ndarray:
    """The n-grams of a whole text as numbers; empty without a letter. Anything but letters is a blank."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, dtype=np.uint64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one blank after each word
    chars = np.where(letter, points, 32)[keep].astype(np.uint64)
    chars = np.concatenate(([32], chars)).astype(np.uint64)
    out, code = [], np.zeros(len(chars), dtype=np.uint64)
    for n in range(1, max(LENGTHS) + 1):
        if len(chars) < n:
            break
        code = (code[: len(chars) - n + 1] << _BITS) | chars[n - 1 :]
        if n in LENGTHS:
            # Blanks count at the ends of an n-gram only, and not alone.
            inner = chars[n - 1 :] != 32 if n == 1 else np.ones(len(code), bool)
            for k in range(1, n - 1):
                inner &= chars[k : len(chars) - n + 1 + k] != 32
            out.append(code[inner])
    return np.concatenate(out)


def ranked(codes: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams by rank."""
    grams, counts = np.unique(codes, return_counts=True)
    return grams[np.lexsort((grams, -counts))[:size]]


class Judge:
    """All languages' ranks in one table, so that a document is looked up once."""

    def __init__(self, profiles: Profiles):
        self.languages, self.size = profiles.languages, profiles.size
        self.grams = np.unique(np.concatenate(profiles.grams)) if profiles.grams else np.empty(0, np.uint64)
        self.ranks = np.full((len(self.grams) + 1, len(profiles.languages)), -1, dtype=np.int64)
        for j, grams in enumerate(profiles.grams):
            self.ranks[np.searchsorted(self.grams, grams), j] = np.arange(len(grams))

    def __call__(self, text: str | None) -> tuple[str, float]:
        own = ranked(gram_codes(text), self.size) if text else ()
        if not len(own) or not self.languages:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        there = np.where(self.grams[at] == own, at, len(self.grams))
        ranks = self.ranks[there]
        apart = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own))[:, None]))
        distance = apart.sum(axis=0)
        best = int(distance.argmin())
        rest = np.delete(distance, best)
        # How much nearer than the next language, as a share; 1 with a single language at distance 0.
        next_best = rest.min() if len(rest) else self.size * len(own)
        return self.languages[best], float(1 - distance[best] / next_best) if next_best else 0.0


def fit(
    documents: DataFrame, key: str = "doc_id", text: str = "text", language: str = "lang", bounds: Bounds = Bounds()
) -> Profiles:
    """Learn a profile per language from marked rows that are not held out."""
    known = documents.select(
        F.col(language).cast("string").alias("_lang"), F.col(text).alias("_text"),
        F.xxhash64(F.lit(5), F.col(key), F.col(text)).alias("_spread"), F.col(key).alias("_key"),
    ).filter(F.col("_lang").isNotNull() & F.col("_text").isNotNull() & ~held_out(F.col("_key")))
    # Thinned by hash, so that texts beyond the sample stay where they are; then the first of each language.
    sizes = known.groupBy("_lang").agg(F.count("*").alias("_rows"))
    known = known.join(F.broadcast(sizes), "_lang").filter(
        among_first(F.col("_spread"), bounds.rows, F.col("_rows").cast("double")))
    first = Window.partitionBy("_lang").orderBy("_spread")
    known = known.withColumn("_place", F.row_number().over(first)).filter(F.col("_place") <= bounds.rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            langs = np.array(batch.column("_lang").to_pylist(), dtype=object)
            codes = [gram_codes(t) for t in batch.column("_text").to_pylist()]
            for lang in sorted(set(langs)):
                own = [codes[i] for i in np.flatnonzero(langs == lang)]
                grams, counts = np.unique(np.concatenate(own), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(counts)],
                    names=["_lang", "gram", "n"])

    counted = map_arrow(known.select("_lang", "_text"), run, "_lang string, gram bigint, n bigint")
    counted = counted.groupBy("_lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("_lang").orderBy(F.desc("n"), "gram"))
    top = counted.withColumn("rank", rank).filter(F.col("rank") <= bounds.profile).collect()
    by_language: dict[str, list] = {}
    for row in sorted(top, key=lambda r: (r["_lang"], r["rank"])):
        by_language.setdefault(row["_lang"], []).append(row["gram"])
    return Profiles([*by_language], [np.array(g, dtype=np.int64).astype(np.uint64) for g in by_language.values()],
                    bounds.profile)


def predict(df: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """``df`` plus ``lang_pred`` and ``score`` of every whole text."""
    value = df.sparkSession.sparkContext.broadcast(profiles)
    kept = df.drop("lang_pred", "score")
    names = [*kept.columns, *["lang_pred", "score"]]
    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(value.value)
        for batch in slices(batches, text):
            found = [judge(t) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())],
                names=names)

    return map_arrow(kept, run, schema)
