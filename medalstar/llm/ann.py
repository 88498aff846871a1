"""Approximate nearest neighbours by balanced posting lists.

* Space. The largest inner product is the smallest distance once every vector gets one more component
  that brings it to the largest norm, and queries get a zero there.
* Lists. Centroids come from balanced k-means on a bounded sample (``Index``): clusters are halved until
  none is above its share. Every vector is put into the list of its nearest centroid, and a boundary
  vector also into those of centroids hardly farther away.
* Search. Centroids are linked into a graph of near neighbours, held in memory by the tasks; queries walk
  it best first, in rounds that open all of their best at once. A query's reach is the distance at which the lists up to there hold ``enough`` times ``k`` + 1
  vectors, replicas not counted; lists within a ratio of the reach are searched. A query whose lists may not all
  be among those found looks at all centroids. The ratio is fitted: sampled vectors are searched in the sample by
  brute force, and it is the one at which ``recall`` of their true neighbours lie in lists within it. Long lists
  are cut into pieces; pieces are dealt out to shelves of bounded size. A vector stands once, with its own list, beside
  the numbers of all lists that have it, so it is moved once and compared once to a query, however many of its lists the
  query asks. A task holds one shelf at a time; the queries that ask it, each with the set of its lists, stream behind in
  blocks, each of which returns its best of the shelf.
* Shortfall. Queries that are still left with fewer than ``k`` results although there are more candidates (ids
  that repeat with many vectors) are compared to all vectors in blocks.

Vectors that are null, empty, zero or hold null or non-finite components take no part, neither do those whose
length is not the most frequent one. Equal vectors are indexed once for the ``k`` + 1 smallest ids, more can
never be needed, and equal queries are searched once, so a very common vector costs no more than a rare one.
Of equal scores the smaller id goes first. Every query gets ``k`` results, or all candidates where there are fewer.
Rows with a null id take no part. Of rows that repeat an id, vectors that differ are kept apart. Columns
other than id and vector are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medalstar.llm.common import among_first, give_back, map_arrow, ship, small_batches, staged


@dataclass(frozen=True)
class Index:
    """Bounds and settings. Centroids grow with the vectors up to ``centroids``; so does the sample."""

    per_list: int = 64  # vectors a list should have, before boundary vectors
    centroids: int = 4096  # at most; held by every task
    sample: int = 65_536  # vectors the centroids and the ratio are fitted on at most
    replicas: int = 8  # lists of a boundary vector at most
    boundary: float = 1.2  # times the nearest distance up to which a vector is at the boundary
    links: int = 16  # of a centroid in the graph
    recall: float = 0.96  # of the sample's own neighbours, by which the ratio is fitted
    fitted: int = 256  # sampled vectors that are searched for that
    piece: int = 4096  # vectors of a list that stay together
    shelf: int = 65_536  # vectors of a shelf
    shelves: int = 16  # at least
    asks: int = 256  # queries that are compared to a shelf at a time
    enough: int = 2  # times k + 1 vectors that the lists of a query hold at least
    probes: int = 1024  # queries of a block of the exact search
    targets: int = 16_384  # vectors of such a block


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all rows of ``b``."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T), 0)


def balanced_centroids(points: np.ndarray, count: int, seed: int = 1) -> np.ndarray:
    """Halve the largest cluster at the median between two centres until there are ``count``."""
    rng, groups = np.random.default_rng(seed), [np.arange(len(points))]
    target = max(1, -(-len(points) // count))
    done: list[np.ndarray] = []
    while groups:
        group = groups.pop()
        if len(group) <= target or len(group) < 2:
            done.append(group)
            continue
        own = points[group]
        a, b = own[rng.choice(len(own), 2, replace=False)]
        for _ in range(6):
            side = own @ (a - b)
            cut = np.median(side)
            low, high = own[side <= cut], own[side > cut]
            if not len(low) or not len(high):
                break
            a, b = high.mean(0), low.mean(0)
        order = np.argsort(own @ (a - b), kind="stable")
        half = len(group) // 2
        groups += [group[order[:half]], group[order[half:]]]
    centroids = np.array([points[g].mean(0) for g in done])
    for _ in range(3):  # a few rounds of plain k-means settle the borders
        nearest = np.concatenate([squared(points[i : i + 512], centroids).argmin(1) for i in range(0, len(points), 512)])
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        size = np.bincount(nearest, minlength=len(centroids))
        centroids = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centroids)
    return centroids


class Graph:
    """Near-neighbour graph of the centroids and a best-first search, for many queries in step."""

    def __init__(self, centroids: np.ndarray, links: int):
        self.centroids, n = centroids, len(centroids)
        links = min(links, n - 1)
        near = np.zeros((n, links), dtype=np.int64)
        for i in range(0, n, 256):
            far = squared(centroids[i : i + 256], centroids)
            far[np.arange(len(far)), np.arange(i, i + len(far))] = np.inf
            near[i : i + 256] = np.argsort(far, axis=1)[:, :links]
        # Links go both ways, and a ring makes sure that every centroid can be reached.
        lists = [[*r] for r in near.tolist()]
        for i, row in enumerate(near.tolist()):
            for j in row:
                if len(lists[j]) < 2 * links:
                    lists[j].append(i)
        lists = [{*r, (i + 1) % n, (i - 1) % n} - {i} for i, r in enumerate(lists)]
        width = max(map(len, lists), default=0)
        self.near = np.array([[*r, *[i] * (width - len(r))] for i, r in enumerate(lists)], dtype=np.int64).reshape(n, width)
        self.entry = np.unique(np.linspace(0, n - 1, min(n, 32)).astype(np.int64))

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, distances) of the ``beam`` best found for each query, nearest first; -1 where fewer were."""
        beam = min(beam, len(self.centroids))
        far = np.empty((len(queries), beam))
        found = np.empty(far.shape, dtype=np.int64)
        for row, query in enumerate(queries):
            seen = self._walk(query, beam)
            found[row] = np.argsort(seen, kind="stable")[:beam]
            far[row] = seen[found[row]]
        return np.where(np.isinf(far), -1, found), far

    def _walk(self, query: np.ndarray, beam: int) -> np.ndarray:
        """Distances of the centroids, infinite for those not looked at.

        A round opens all of the ``beam`` best that are not open yet, so there are as many rounds as links lead
        to the last of them; no more than one by one are left out.
        """
        far, open_ = np.full(len(self.centroids), np.inf), np.zeros(len(self.centroids), dtype=bool)
        fresh = self.entry
        while len(fresh):
            far[fresh] = ((self.centroids[fresh] - query) ** 2).sum(axis=1)
            nodes = np.flatnonzero((far <= np.partition(far, beam - 1)[beam - 1]) & np.isfinite(far) & ~open_)
            open_[nodes] = True
            linked = np.zeros(len(far), dtype=bool)
            linked[self.near[nodes]] = True
            fresh = np.flatnonzero(linked & np.isinf(far))
        return far


def lists_of(points: np.ndarray, centroids: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of the point, list, whether it is the point's own): the nearest list of every point is its own,
    boundary points have more."""
    far = squared(points, centroids)
    width = min(index.replicas, len(centroids))
    near = np.argpartition(far, width - 1, axis=1)[:, :width]
    distance = np.take_along_axis(far, near, 1)
    rows, places = np.nonzero(distance <= index.boundary**2 * distance.min(axis=1, keepdims=True))
    return rows, near[rows, places], places == distance.argmin(axis=1)[rows]


def reach(far: np.ndarray, held: np.ndarray, least: int) -> np.ndarray:
    """Per row of distances, nearest first, the one up to which the lists hold ``least`` vectors, which are
    counted in ``held``; infinite where they do not."""
    full = np.cumsum(held, axis=1) >= least
    first = far[np.arange(len(far)), full.argmax(axis=1)]
    return np.where(full.any(axis=1), first, np.inf)


def fitted_ratio(
    points: np.ndarray, centroids: np.ndarray, held: np.ndarray, index: Index, k: int, least: int, lift
) -> tuple[float, int]:
    """(ratio of distances, number of lists within it for nearly all queries), by brute force on the sample.

    ``held``: vectors of every list, replicas not counted.
    """
    asked = np.linspace(0, len(points) - 1, min(index.fitted, len(points))).astype(np.int64)
    all_needed, all_ratios = [], []
    for start in range(0, len(asked), 32):
        some = asked[start : start + 32]
        scores = points[some] @ points.T
        scores[np.arange(len(some)), some] = -np.inf
        true = np.argsort(-scores, axis=1, kind="stable")[:, : min(k, len(points) - 1)]
        far = np.sqrt(squared(lift(points[some], True), centroids))
        order = np.argsort(far, axis=1, kind="stable")
        ratios = far / np.maximum(reach(np.take_along_axis(far, order, 1), held[order], least)[:, None], 1e-12)
        rows, numbers, _ = lists_of(lift(points[true.ravel()], False), centroids, index)
        needed = np.full(true.size, np.inf)
        np.minimum.at(needed, rows, ratios[np.repeat(np.arange(len(some)), true.shape[1])[rows], numbers])
        all_needed.append(needed)
        all_ratios.append(ratios)
    needed, ratios = np.concatenate(all_needed), np.concatenate(all_ratios)
    ratio = max(1.0, float(np.quantile(needed, index.recall))) if needed.size else 1.0
    return ratio, int(np.quantile((ratios <= ratio).sum(axis=1), 0.99))


def chosen(
    graph: Graph, queries: np.ndarray, beam: int, held: np.ndarray, least: int, ratio: float
) -> list[np.ndarray]:
    """The lists to be searched for each query."""

    def within(found: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        far = np.sqrt(far)
        # The small margin keeps rounding from deciding.
        most = ratio * reach(far, np.where(found >= 0, held[found], 0), least)[:, None] * (1 + 1e-9)
        return (found >= 0) & (far <= most), np.isinf(most[:, 0]) | (far[:, -1] <= most[:, 0])

    found, far = graph.search(queries, beam)
    use, short = within(found, far)
    out = [numbers[mine] for numbers, mine in zip(found, use)]
    # Where the last list found is within the ratio, more lists may be.
    again = np.flatnonzero(short) if found.shape[1] < len(graph.centroids) or (found < 0).any() else []
    for start in range(0, len(again), 256):
        rows = again[start : start + 256]
        all_far = squared(queries[rows], graph.centroids)
        order = np.argsort(all_far, axis=1, kind="stable")
        use, _ = within(order, np.take_along_axis(all_far, order, 1))
        for row, numbers, mine in zip(rows, order, use):
            out[row] = numbers[mine]
    return out


def usable(vector: Column) -> Column:
    """Not null, empty or zero, and free of null and non-finite components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


class Shelf:
    """The vectors of some pieces, in the order of their lists, and for each the numbers of the lists that have it."""

    def __init__(self, parts: list[pa.RecordBatch], most: int):
        own = pa.Table.from_batches(parts)
        lists = own.column("list").to_numpy()
        order = np.argsort(lists, kind="stable")
        self.vectors = np.concatenate([_matrix(b.column("v")) for b in parts])[order]
        self.ids, lists = own.column("class").to_numpy()[order], lists[order]
        self.norm = float(np.sqrt((self.vectors**2).sum(axis=1).max()))
        members = own.column("lists").combine_chunks().take(pa.array(order))
        count = np.diff(members.offsets.to_numpy())
        self.lists = np.repeat(lists[:, None], count.max(), axis=1)  # shorter ones are filled up with the own list
        row = np.repeat(np.arange(len(count)), count)
        self.lists[row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)] = members.flatten().to_numpy()
        new = np.flatnonzero(np.diff(lists, prepend=-1))
        self.parts = [(i, min(i + most, b)) for a, b in zip(new, [*new[1:], len(lists)]) for i in range(a, b, most)]


def _best_of_shelf(shelf: Shelf, asks: pa.RecordBatch, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, class, score): the ``keep`` best of the shelf for each query, among the vectors that its lists have."""
    vectors, ids, questions, n = shelf.vectors, shelf.ids, _matrix(asks.column("v")), asks.num_rows
    # A bit for each query in a row for each list: those of a vector's lists together say who compares it.
    sets = np.frombuffer(b"".join(asks.column("asked").to_pylist()), dtype=np.uint8).reshape(n, -1)
    askers = np.packbits(np.pad(np.unpackbits(sets, axis=1).T, ((0, 0), (0, -n % 64))), axis=1)
    askers = np.ascontiguousarray(askers).view(np.uint64)
    # What the product of two matrices may differ by from the scores.
    slack = 4 * vectors.shape[1] * np.finfo(np.float64).eps * shelf.norm * np.sqrt((questions**2).sum(axis=1))
    bound = np.full(n, -np.inf)
    row, place, score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    rows, places, waiting = [], [], 0

    def settle() -> None:
        """Only the best stay; a full query takes nothing below its last one from now on."""
        nonlocal row, place, score, rows, places, waiting
        more, at = np.concatenate([*rows, row[:0]]), np.concatenate([*places, place[:0]])
        # Scored anew, pair by pair: the same pair gets the same bits on whatever shelf it is scored.
        fresh = [(vectors[at[i : i + 65536]] * questions[more[i : i + 65536]]).sum(axis=1) for i in range(0, len(at), 65536)]
        row, place, score = np.concatenate((row, more)), np.concatenate((place, at)), np.concatenate([score, *fresh])
        order = np.lexsort((ids[place], -score, row))
        row, place, score = row[order], place[order], score[order]
        turn = np.arange(len(row)) - np.searchsorted(row, row)
        last = np.flatnonzero(turn == keep - 1)
        bound[row[last]] = score[last] - slack[row[last]]
        row, place, score = row[turn < keep], place[turn < keep], score[turn < keep]
        rows, places, waiting = [], [], 0

    for a, b in shelf.parts:
        bits = np.bitwise_or.reduce(askers[shelf.lists[a:b]], axis=1)
        who = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(bits, axis=0).view(np.uint8))[:n])
        if not len(who):
            continue
        asked = np.unpackbits(bits.view(np.uint8), axis=1).view(bool)
        asked, mine = (asked[:, :n], questions) if len(who) == n else (asked[:, who], questions[who])
        at, column = np.nonzero(~(vectors[a:b] @ mine.T < bound[who]) & asked)
        rows.append(who[column])
        places.append(a + at)
        waiting += len(at)
        if waiting > 32 * n:
            settle()
    settle()
    return asks.column("q").to_numpy()[row], ids[place], score


def search(
    df: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector: str = "embedding",
    index: Index = Index(),
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found by inner product for every query row."""
    spark = df.sparkSession
    ship(spark)
    rows = df.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"),
                     F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = staged(rows.filter(F.col("id").isNotNull() & usable(F.col("v"))), "vectors")
    widths = rows.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n"))
    common = widths.orderBy(F.desc("n"), "width").first()
    result = "query_id bigint, rank int, vec_id bigint, score double"
    if common is None:
        return spark.createDataFrame([], result)
    rows = rows.filter(F.size("v") == common["width"])
    # Equal vectors: candidates beyond the k + 1 smallest ids can never be among the k nearest. A group
    # limit before the shuffle, so a hot vector sends k + 1 rows a task at most.
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    members = rows.select("id", "v").distinct().withColumn("place", place).filter(F.col("place") <= k + 1).drop("place")
    grouped = members.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))  # k + 1 at most
    distinct = staged(grouped.withColumn("class", F.monotonically_increasing_id()), "classes")
    asking = staged(rows.filter("asks").select("v").distinct().withColumn("q", F.monotonically_increasing_id()), "queries")

    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    facts = distinct.agg(F.count("*").alias("n"), F.max(norm).alias("norm")).first()
    lists = int(min(index.centroids, max(1, facts["n"] // index.per_list)))
    spread = F.xxhash64(F.lit(3), "class")
    spread = distinct.filter(among_first(spread, index.sample, F.lit(float(facts["n"])))).orderBy(spread, "class").limit(index.sample)
    sample = _matrix(spread.select("v").toArrow().column("v").combine_chunks())
    top = facts["norm"]

    def lift(points: np.ndarray, asking: bool) -> np.ndarray:
        """On the sphere of the largest norm. Of a query only the direction counts, so it gets that norm."""
        if asking:
            points = points * (top / np.sqrt((points**2).sum(1, keepdims=True)))
        return np.column_stack((points, np.sqrt(np.maximum(top**2 - (points**2).sum(1), 0))))

    centroids = balanced_centroids(lift(sample, False), lists)
    centroids *= top / np.maximum(np.sqrt((centroids**2).sum(1, keepdims=True)), 1e-300)
    graph = spark.sparkContext.broadcast(Graph(centroids, index.links))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                at, numbers, own = lists_of(lift(_matrix(part.column("v")), False), graph.value.centroids, index)
                ends = np.concatenate(([0], np.cumsum(np.bincount(at, minlength=part.num_rows))))
                yield pa.RecordBatch.from_arrays(
                    [part.column("class"), part.column("v"), pa.array(numbers[own]),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(numbers))],
                    names=["class", "v", "list", "lists"])

    # Few bytes, much to compute: dealt out to as many tasks as a shuffle has.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    posted = staged(map_arrow(distinct.select("class", "v").repartition(tasks), post, "class bigint, v array<double>, list bigint, lists array<bigint>"), "lists")
    # A row per list, so no more than there are centroids.
    counted = staged(posted.groupBy("list").agg(F.count("*").alias("own")), "counted")
    held = np.zeros(len(centroids), dtype=np.int64)
    for r in counted.collect():
        held[r["list"]] = r["own"]
    # So many classes hold k ids besides the query's own.
    least = min(index.enough * (k + 1), facts["n"])
    ratio, beam = fitted_ratio(sample, centroids, held, index, k, least, lift)
    beam = min(len(centroids), max(32, beam + beam // 4))
    shelves = max(index.shelves, -(-int(facts["n"]) // index.shelf))
    cut = counted.select("list", F.ceil(F.col("own") / index.piece).alias("pieces"))
    # Lists and their pieces go round the shelves. Neighbouring lists have close numbers, so a query asks all alike.
    piece = F.pmod(F.xxhash64("class"), F.col("pieces"))
    posted = posted.join(F.broadcast(cut), "list").withColumn("shelf", (F.col("list") + piece) % shelves).drop("pieces")
    # No more rows than centroids times shelves.
    there = posted.select(F.explode("lists").alias("list"), "shelf").distinct().toArrow()
    holds = np.zeros((len(centroids), shelves), dtype=bool)
    holds[there.column("list").to_numpy(), there.column("shelf").to_numpy()] = True
    holds = spark.sparkContext.broadcast(holds)

    def aim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                asked = lift(_matrix(part.column("v")), True)
                sets = np.zeros((part.num_rows, len(held)), dtype=bool)
                shelf = np.zeros((part.num_rows, shelves), dtype=bool)
                for row, numbers in enumerate(chosen(graph.value, asked, beam, held, least, ratio)):
                    sets[row, numbers] = True
                    shelf[row] = holds.value[numbers].any(axis=0)
                at, shelf = np.nonzero(shelf)
                sets = pa.array([x.tobytes() for x in np.packbits(sets, axis=1)], pa.binary())
                picked = part.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shelf), picked.column("q"), picked.column("v"), sets.take(pa.array(at))],
                    names=["shelf", "q", "v", "asked"])

    aimed = map_arrow(asking.repartition(tasks), aim, "shelf bigint, q bigint, v array<double>, asked binary")

    # The vectors of a shelf, then the queries that ask it.
    dealt = posted.withColumn("asks", F.lit(False)).unionByName(
        aimed.withColumn("asks", F.lit(True)), allowMissingColumns=True)
    dealt = dealt.repartitionById(shelves, F.col("shelf").cast("int")).sortWithinPartitions("shelf", "asks")

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, shelf = None, [], None
        for batch in batches:
            shelf_of, asking_ = batch.column("shelf").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
            turns = np.flatnonzero((np.diff(shelf_of) != 0) | (asking_[1:] != asking_[:-1])) + 1
            for a, b in zip([0, *turns.tolist()], [*turns.tolist(), batch.num_rows]):
                if a == b:
                    continue
                if shelf_of[a] != number:
                    number, parts, shelf = shelf_of[a], [], None
                if not asking_[a]:
                    parts.append(batch.slice(a, b - a).select(["list", "lists", "class", "v"]))
                    continue
                if parts:
                    shelf, parts = Shelf(parts, index.piece), []
                for start in range(a, b if shelf else a, index.asks):
                    found = _best_of_shelf(shelf, batch.slice(start, min(index.asks, b - start)), k + 1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(found, (pa.int64(), pa.int64(), pa.float64()))],
                        names=["q", "class", "score"])
        give_back()

    scored = map_arrow(dealt, best, "q bigint, class bigint, score double")
    # A class stands on one shelf. The k + 1 best classes hold the k + 1 best candidates.
    nearest = Window.partitionBy("q").orderBy(F.desc("score"), "lowest")
    classes = distinct.select("class", "ids", F.col("ids")[0].alias("lowest"))
    found = scored.join(classes, "class")
    found = found.withColumn("place", F.row_number().over(nearest)).filter(F.col("place") <= k + 1)
    found = found.select("q", "score", F.explode("ids").alias("vec_id"))
    first = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    with small_batches(spark, 4 << 20):
        found = staged(found.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= k + 1).drop("place"), "found")
    queries = rows.filter("asks").select(F.col("id").alias("query_id"), "v").distinct().join(asking, "v").drop("v")
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    answers = queries.join(found, "q").filter(F.col("vec_id") != F.col("query_id"))
    ranked = lambda x: x.withColumn("rank", F.row_number().over(own).cast("int")).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
    answers = staged(ranked(answers), "answers")
    # A query may have all members but those of its own id.
    queries, members = staged(queries, "asked"), staged(members, "members")
    got = answers.groupBy("query_id").agg(F.count("*").alias("got"))
    short = staged(queries.select("query_id").distinct().join(got, "query_id", "left").filter(
        F.coalesce("got", F.lit(0)) < k).select("query_id"), "short")
    if not short.limit(1).count():
        return answers
    mine = members.join(short, F.col("id") == F.col("query_id"), "left_semi").groupBy(F.col("id").alias("query_id")).agg(
        F.count("*").alias("mine"))
    got = short.join(got, "query_id", "left").join(mine, "query_id", "left")
    lacking = staged(got.filter(
        F.coalesce("got", F.lit(0)) < F.least(F.lit(k), F.lit(members.count()) - F.coalesce("mine", F.lit(0)))
    ).select("query_id"), "lacking")
    if not lacking.limit(1).count():
        return answers
    asks = queries.join(lacking, "query_id").join(asking, "q").select("query_id", "q", "v")
    exact = _exact(asks, members, k, index)
    return answers.join(lacking, "query_id", "left_anti").unionByName(ranked(exact))


def _exact(asks: DataFrame, members: DataFrame, k: int, index: Index) -> DataFrame:
    """(query_id, vec_id, score): for each of ``asks`` the ``k`` best of every block of members with other ids."""
    asks, least = staged(asks, "asks"), F.lit(0).cast("bigint")
    blocks, pieces = (max(1, -(-x.count() // n)) for x, n in ((asks, index.probes), (members, index.targets)))
    spread = lambda n, *by: F.pmod(F.xxhash64(*by), F.lit(n))
    each = lambda n: F.explode(F.sequence(least, F.lit(n - 1).cast("bigint")))
    asks = asks.withColumn("block", spread(blocks, "q", "query_id")).withColumn("piece", each(pieces))
    members = members.withColumn("piece", spread(pieces, "id", "v")).withColumn("block", each(blocks))

    def best(key: tuple, own: pa.Table, asks: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if own.num_rows and asks.num_rows:
            ids, names = own.column("id").to_numpy(), asks.column("query_id").to_numpy()
            vectors, questions = (_matrix(x.column("v").combine_chunks()) for x in (own, asks))
            for name, question in zip(names, questions):
                score = (vectors * question).sum(axis=1)
                top = np.lexsort((ids, -score))
                top = top[ids[top] != name][:k]
                out.append((np.full(len(top), name), ids[top], score[top]))
        columns = [np.concatenate(c) for c in zip(*out)] or [[], [], []]
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))],
                        names=["query_id", "vec_id", "score"])

    return members.groupBy("block", "piece").cogroup(asks.groupBy("block", "piece")).applyInArrow(
        best, "query_id bigint, vec_id bigint, score double")
