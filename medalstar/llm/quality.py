"""Quality classifier by compression.

Two zstandard dictionaries are trained, one on text labelled good and one on text labelled bad. A
text is cut into windows, and each window is compressed with either dictionary: text that resembles
the good examples comes out smaller with theirs. From the compressed sizes of its windows a text gets

* the difference of the total sizes divided by their sum,
* the smallest such difference of a window, which shows a bad passage inside a good text,
* the smallest and the mean ratio of compressed to raw size, which show repetition,

and a logistic curve fitted to labelled texts that no dictionary has seen turns these into a score.

Dictionaries and curve are fitted on bounded samples of the labelled rows (``Bounds``); every text is
scored whole. Labels, language, source and key are no input of a score. Nulls count as the empty
text, whose features are all zero; it gets the score of such a point. A row without label, or whose
label is null or neither 0 nor 1, is not learned from. Where one of the two labels has no example,
every text gets the share of good labels (0.5 without any label). Repeated rows are scored one by
one, and rows of the label table that repeat a key count as often as they occur. Columns other than
those named are carried along, not read; only ``score`` would be replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalstar.llm.common import among_first, bounded_sample, held_out, map_arrow, slices, staged
from medalstar.operators.shape import union_all

WINDOW = 1024  # characters
LEVEL = 3
KEEP = 0.7  # score from which a text counts as good
FEATURES = ["difference", "worst", "densest", "density"]


@dataclass(frozen=True)
class Bounds:
    """What is learned from at most; rows are taken in the order of a hash, the same in every run."""

    rows: int = 4000  # labelled rows per label, whose windows the dictionaries are trained on
    windows: int = 4000  # of these rows, per label
    texts: int = 8000  # labelled rows for the curve
    dictionary: int = 112_640  # bytes of a dictionary


@dataclass(frozen=True)
class Model:
    """All of it is of bounded size: two dictionaries and a few numbers."""

    good: bytes
    bad: bytes
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # one per feature and the constant
    constant: float | None = None  # the score of every text if there was nothing to compare


def windows(text: str) -> list[str]:
    return [text[i : i + WINDOW] for i in range(0, len(text), WINDOW)]


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; the text itself where there is too little to train on."""
    size = min(size, max(256, sum(map(len, samples)) // 4))
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(samples)[:size]


class Compressors:
    def __init__(self, model: Model):
        self.good, self.bad = (self._with(data) for data in (model.good, model.bad))

    @staticmethod
    def _with(data: bytes) -> zstandard.ZstdCompressor:
        held = zstandard.ZstdCompressionDict(data)
        held.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_dict_id=False)

    def features(self, text: str | None) -> tuple[float, float, float, float]:
        cut = [w.encode("utf-8", "replace") for w in windows(text or "")]
        if not cut:
            return 0.0, 0.0, 0.0, 0.0
        good = np.array([len(self.good.compress(w)) for w in cut], dtype=float)
        bad = np.array([len(self.bad.compress(w)) for w in cut], dtype=float)
        # The constant keeps frame bytes of very short windows from deciding.
        difference = (bad - good) / (bad + good + 20)
        density = np.minimum(good, bad) / (np.array([len(w) for w in cut]) + 20)
        total = (bad.sum() - good.sum()) / (bad.sum() + good.sum() + 20)
        return float(total), float(difference.min()), float(density.min()), float(density.mean())


def _features(df: DataFrame, model: Model, keep: list[str], text: str) -> DataFrame:
    """``keep`` plus the features of every whole text."""
    value = df.sparkSession.sparkContext.broadcast(model)
    columns = [c for c in keep if c not in FEATURES]
    picked = df.select(*columns, F.col(text).alias("_text"))
    schema = T.StructType([*df.select(*columns).schema.fields, *[T.StructField(n, T.DoubleType()) for n in FEATURES]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = Compressors(value.value)
        for batch in slices(batches, "_text"):
            found = [compressors.features(t) for t in batch.column("_text").to_pylist()]
            values = [pa.array(x, pa.float64()) for x in zip(*found)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), *values], names=[*columns, *FEATURES])

    return map_arrow(picked, run, schema)


def _curve(points: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression by Newton's method, held back a little so that it always ends."""
    centre, scale = points.mean(axis=0), points.std(axis=0) + 1e-6
    x = np.column_stack(((points - centre) / scale, np.ones(len(points))))
    weights, hold = np.zeros(x.shape[1]), 0.05 * np.eye(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - labels) + hold @ weights
        weights = weights - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + hold, gradient)
    return centre, scale, weights


def fit(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    bounds: Bounds = Bounds(),
) -> Model:
    """Learn from labelled rows that are not held out.

    The labels are sampled before they meet the texts: a bounded number of keys is broadcast, and only the
    texts of these keys are kept, so nothing that grows with the corpus is shuffled.
    """
    marked = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label"))
    marked = marked.filter(F.col("_label").isin(0, 1) & ~held_out(F.col("_key")))
    sizes = {r["_label"]: r["n"] for r in marked.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    share = sizes.get(1, 0) / sum(sizes.values()) if sizes else 0.5
    # Every fourth row is kept from the dictionaries, for the curve.
    for_curve = F.pmod(F.xxhash64(F.lit(11), "_key"), F.lit(4)) == 0

    def sampled(rows: DataFrame, of: int, most: int, seed: int) -> DataFrame:
        spread = F.xxhash64(F.lit(seed), "_key")
        return rows.filter(among_first(spread, most, F.lit(float(of)))).orderBy(spread, "_key").limit(most)

    picked = union_all([
        sampled(marked.filter(for_curve), sum(sizes.values()) // 4, bounds.texts, 13),
        *[sampled(marked.filter(~for_curve & (F.col("_label") == value)), n * 3 // 4, bounds.rows, 17)
          for value, n in sizes.items()],
    ])
    known = staged(
        documents.select(F.col(key).alias("_key"), F.coalesce(text, F.lit("")).alias("_text"))
        .join(F.broadcast(picked), "_key"), "labelled")
    cut = known.filter(~for_curve).select("_label", F.explode(F.expr(
        f"transform(sequence(0, greatest(length(_text) - 1, 0) div {WINDOW}), i -> "
        f"substring(_text, i * {WINDOW} + 1, {WINDOW}))")).alias("_window"))
    samples = [
        [r["_window"].encode("utf-8", "replace") for r in bounded_sample(
            cut.filter((F.col("_label") == value) & (F.col("_window") != "")), ["_window"], 7, bounds.windows)]
        for value in (1, 0)
    ]
    good, bad = (train_dictionary(s, bounds.dictionary) for s in samples)
    flat = Model(good, bad, np.zeros(4), np.ones(4), np.zeros(5), share)
    if not all(samples):
        return flat
    spread = F.xxhash64(F.lit(13), "_key", "_text")
    texts = known.filter(for_curve).withColumn("_spread", spread).orderBy("_spread").limit(bounds.texts)
    points = _features(texts, flat, ["_label"], "_text").collect()
    y = np.array([p["_label"] for p in points], dtype=float)
    if len(set(y)) < 2:
        return flat
    x = np.array([[p[n] for n in FEATURES] for p in points])
    return Model(good, bad, *_curve(x, y))


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` plus ``score`` (0 to 1, higher: label 1 likelier) of every whole text."""
    value = df.sparkSession.sparkContext.broadcast(model)
    kept = df.drop("score")
    names = [*kept.columns, *["score"]]
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = value.value
        compressors = None if m.constant is not None else Compressors(m)
        for batch in slices(batches, text):
            texts = batch.column(text).to_pylist()
            if m.constant is not None:
                scores = np.full(len(texts), m.constant)
            else:
                points = (np.array([compressors.features(t) for t in texts]) - m.centre) / m.scale
                scores = 1 / (1 + np.exp(-np.clip(points @ m.weights[:-1] + m.weights[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=names)

    return map_arrow(kept, run, schema)
