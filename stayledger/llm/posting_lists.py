"""Nearest neighbours from balanced posting lists, searched through an in-memory graph of their centroids (SPANN, Chen
and others 2021).

Inner products are turned into Euclidean distances by one more coordinate, sqrt(M^2 - |x|^2) for vectors (M is the
largest norm of all) and 0 for queries. Lists come from a balanced bisection of a bounded sample: each cut is at the
median of the projection on the difference of two means, so all lists of the sample are equally long. Every vector is
then put into its nearest list and, as a boundary vector, into up to ``COPIES`` - 1 others that are nearly as near, unless
the other list is close to one already chosen.

The centroids (at most ``MOST_LISTS``) and a graph of their neighbours go to every executor. A query walks the graph,
always expanding the nearest centroid seen, and takes all lists whose distance is within a ratio of the nearest one's. The
ratio is measured on the sample by such walks: it is the least that finds ``RECALL`` of the true neighbours there, where
neighbours are farther than in the whole table. What a walk misses thus raises the ratio.

Lists are searched in shards of ``SHARD`` lists. The vectors of a shard are cut into blocks by hash and so are its queries;
each block of queries meets each block of vectors in a task of its own, so no task grows with the table. A task returns the best of each query in its block, in double precision on the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import vectors
from .storage import written

SAMPLE = 16_384
LIST = 256  # vectors wanted in a list
MOST_LISTS = 16_384
SHARD = 64
BLOCK = 65_536  # vectors of a shard searched in one task
ASKERS = 16_384  # queries of a shard that one task answers
QUERIES = 64  # queries of a block scored together
COPIES = 4
BEAM = 16  # nearest centroids that a vector's walk settles
CLOSE = 1.15  # a boundary vector's other lists are at most this many times as far as its own
SPREAD = 0.5  # a further list is taken if its distance from those already taken is at least so much of the vector's
NEIGHBOURS = 16
RECALL = 0.97
TRIALS = 1024  # queries on which the ratio is measured
WALKS = 256  # walks made together


def balanced_lists(rows: np.ndarray, k: int, seed: int = 5) -> np.ndarray:
    """Means of ``k`` equally large parts of ``rows``, neighbours in the order standing near each other."""
    pick = np.random.default_rng(seed)

    def cut(part: np.ndarray, count: int) -> list[np.ndarray]:
        if count <= 1 or len(part) < 2:
            return [part.mean(axis=0)]
        one, two = part[pick.choice(len(part), 2, replace=False)]
        for _ in range(4):
            near_one = part @ (two - one) <= (two @ two - one @ one) / 2
            if near_one.all() or not near_one.any():
                break
            one, two = part[near_one].mean(axis=0), part[~near_one].mean(axis=0)
        order = np.argsort(part @ (two - one), kind="stable")
        left = count // 2
        at = max(1, min(len(part) - 1, round(len(part) * left / count)))
        return cut(part[order[:at]], left) + cut(part[order[at:]], count - left)

    return np.array(cut(rows, min(k, len(rows))))


class Index(NamedTuple):
    """Centroids in the space with one more coordinate, their graph, the largest norm and the search ratio."""

    centroids: np.ndarray
    graph: np.ndarray
    norm: float
    ratio: float

    def lifted(self, rows: np.ndarray, queries: bool) -> np.ndarray:
        extra = np.zeros(len(rows)) if queries else np.sqrt(np.maximum(0.0, self.norm**2 - (rows**2).sum(axis=1)))
        return np.column_stack([rows, extra])

    def search(self, points: np.ndarray, ratio: float, least: int, all_within: bool) -> tuple[np.ndarray, np.ndarray]:
        """Distances to the centroids that each point's walk has seen (infinite for others), and which of these lie
        within ``ratio`` times the nearest. A walk ends when the ``least`` nearest centroids are expanded and, if ``all_within``,
        all within the ratio are, too."""
        n, k = len(points), len(self.centroids)
        seen = np.full((n, k), np.inf)
        open_ = np.full((n, k), np.inf)  # distance of what is seen and not yet expanded
        every = np.arange(n)
        starts = np.unique(np.linspace(0, k - 1, min(k, max(8, math.isqrt(k)))).astype(int))
        for start in starts:
            seen[:, start] = open_[:, start] = np.linalg.norm(points - self.centroids[start], axis=1)
        while True:
            at = open_.argmin(axis=1)
            nearest = open_[every, at]
            limit = np.partition(seen, min(k, least) - 1, axis=1)[:, min(k, least) - 1]
            if all_within:
                limit = np.maximum(limit, ratio * seen.min(axis=1))
            live = np.flatnonzero(np.isfinite(nearest) & (nearest <= limit))
            if not len(live):
                break
            open_[live, at[live]] = np.inf
            around = self.graph[at[live]]
            new = np.isinf(seen[live[:, None], around])
            row, column = np.nonzero(new)
            row, column = live[row], around[row, column]
            distance = np.linalg.norm(points[row] - self.centroids[column], axis=1)
            seen[row, column] = open_[row, column] = distance
        return seen, seen <= ratio * seen.min(axis=1, keepdims=True)

    def assign(self, rows: np.ndarray) -> list[np.ndarray]:
        """The lists of each vector, its nearest first."""
        points = self.lifted(rows, queries=False)
        seen, close = self.search(points, CLOSE, BEAM, False)
        out = []
        for distances, inside in zip(seen, close):
            order = np.flatnonzero(inside)
            order = order[np.argsort(distances[order], kind="stable")][:BEAM]
            around = self.centroids[order]
            apart = np.linalg.norm(around[:, None, :] - around[None, :, :], axis=2)
            chosen: list[int] = []
            for i in range(len(order)):
                if all(apart[i, j] >= SPREAD * distances[order[i]] for j in chosen):
                    chosen.append(i)
                    if len(chosen) == COPIES:
                        break
            out.append(order[chosen])
        return out

    def probe(self, queries: np.ndarray) -> list[np.ndarray]:
        """The lists to search for each query."""
        _, within = self.search(self.lifted(queries, queries=True), self.ratio, BEAM, True)
        return [np.flatnonzero(row) for row in within]


def centroid_graph(centroids: np.ndarray) -> np.ndarray:
    """For each centroid its nearest others, with the one before and after it, so that all are connected."""
    k = len(centroids)
    near = min(NEIGHBOURS, k - 1)
    graph = np.empty((k, near + 2), np.int64)
    graph[:, near], graph[:, near + 1] = (np.arange(k) - 1) % k, (np.arange(k) + 1) % k
    squares = (centroids**2).sum(axis=1)
    for start in range(0, k, 1024):
        block = squares[None, :] - 2 * centroids[start : start + 1024] @ centroids.T
        block[np.arange(len(block)), start + np.arange(len(block))] = np.inf
        if near:
            graph[start : start + 1024, :near] = np.argpartition(block, near - 1, axis=1)[:, :near]
    return graph


def fit(sample: np.ndarray, lists: int, norm: float, neighbours: int) -> Index:
    """An index from a sample, with the ratio that finds ``RECALL`` of the sample's own neighbours."""
    index = Index(np.zeros((0, 0)), np.zeros((0, 0), np.int64), norm, 1.0)
    centroids = balanced_lists(index.lifted(sample, queries=False), lists)
    index = index._replace(centroids=centroids, graph=centroid_graph(centroids))
    asked = sample[:TRIALS]
    want = min(neighbours, len(sample) - 1)
    if want < 1:
        return index
    best = np.empty((len(asked), want), np.int64)
    for start in range(0, len(asked), WALKS):
        scores = asked[start : start + WALKS] @ sample.T
        own = np.arange(len(scores))
        scores[own, start + own] = -np.inf
        best[start : start + WALKS] = np.argpartition(scores, len(sample) - want, axis=1)[:, -want:]
    which, place = np.unique(best, return_inverse=True)
    place = place.reshape(best.shape)
    homes = np.full((len(which), COPIES), len(centroids))  # padded by a list that is never searched
    for start in range(0, len(which), WALKS):
        for row, own in enumerate(index.assign(sample[which[start : start + WALKS]]), start):
            homes[row, : len(own)] = own

    def found(ratio: float) -> bool:
        trial, hits = index._replace(ratio=ratio), 0
        searched = np.zeros(len(centroids) + 1, bool)
        for start in range(0, len(asked), WALKS):
            for row, lists in zip(place[start : start + WALKS], trial.probe(asked[start : start + WALKS])):
                searched[lists] = True
                hits += int(searched[homes[row]].any(axis=1).sum())
                searched[lists] = False
        return hits >= RECALL * best.size

    low, high = 1.0, 1.0
    while not found(high) and high < 1e6:
        low, high = high, 1 + 2 * (high - 1) + 0.01
    while high - low > 0.002:
        middle = (low + high) / 2
        low, high = (low, middle) if found(middle) else (middle, high)
    return index._replace(ratio=high)


def _routed(rows: DataFrame, index, asks: bool) -> DataFrame:
    """node, least_id and vec once for each shard that holds one of the row's lists, with those lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, WALKS):
                part = batch.slice(start, WALKS)
                own = index.value
                points = vectors.matrix(part.column(2))
                found = own.probe(points) if asks else own.assign(points)
                row = np.repeat(np.arange(len(found)), [len(f) for f in found])
                lists = np.concatenate(found)
                pairs, first = np.unique(np.column_stack([row, lists // SHARD]), axis=0, return_index=True)
                order = np.lexsort([lists, lists // SHARD, row])
                grouped = np.split(lists[order], np.flatnonzero((np.diff(row[order]) != 0) | (np.diff(lists[order] // SHARD) != 0)) + 1)
                taken = part.take(pa.array(pairs[:, 0]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[:, 1], pa.int32()), vectors.lists(grouped, pa.int32()), *taken.columns], ["shard", "lists", "node", "least_id", "vec"]
                )

    return rows.select("node", "least_id", "vec").mapInArrow(run, "shard int, lists array<int>, node long, least_id long, vec array<double>")


def search_block(table: pa.Table, wanted: int) -> pa.Table:
    """The best ``wanted`` nodes of a block for each query in it, by score and then least_id."""
    vec, node, least_id = vectors.matrix(table["vec"]), table["node"].to_numpy(), table["least_id"].to_numpy()
    asks = table["asks"].to_numpy(zero_copy_only=False)
    listed = table["lists"].combine_chunks()
    sizes = np.diff(listed.offsets.to_numpy())
    flat, owner = listed.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)
    everyone = np.flatnonzero(asks)
    members = {int(c): owner[(flat == c) & ~asks[owner]] for c in np.unique(flat[asks[owner]])}
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for start in range(0, len(everyone), QUERIES):
        some = everyone[start : start + QUERIES]
        scores = np.full((len(some), len(node)), -np.inf)
        here = np.isin(owner, some)
        for c in np.unique(flat[here]):
            inside, row = members[int(c)], np.searchsorted(some, owner[here & (flat == c)])
            if len(inside):
                scores[np.ix_(row, inside)] = vec[some[row]] @ vec[inside].T
        if len(node) > wanted:
            border = np.partition(scores, len(node) - wanted, axis=1)[:, [len(node) - wanted]]
            q, m = np.nonzero((scores >= border) & np.isfinite(scores))
        else:
            q, m = np.nonzero(np.isfinite(scores))
        order = np.lexsort([node[m], least_id[m], -scores[q, m], q])
        q, m = q[order], m[order]
        best = np.arange(len(q)) - np.searchsorted(q, q) < wanted
        parts.append((some[q[best]], m[best]))
    q, m = (np.concatenate([np.zeros(0, np.int64), *(part[i] for part in parts)]) for i in (0, 1))
    return pa.table({"asking": node[q], "node": node[m], "least_id": least_id[m]})


def _blocks(rows: DataFrame, name: str, size: int) -> DataFrame:
    """Into how many blocks of about ``size`` rows each shard is cut."""
    return rows.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))


def _hashed_to(blocks: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(blocks), "node"), F.col(blocks)).cast("int")


def _each(blocks: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))


def nearest(rows: DataFrame, every: int = 20, neighbours: int = 20, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The neighbours with the largest inner product of each row whose id is divisible by ``every``: query_id, rank
    (from 1), id, score. Ties go to the smaller id; with fewer candidates all are returned.

    Vectors that are null, empty, zero, of another length than most, or hold null or non-finite components take no part,
    and neither do rows without id. Rows that repeat an id are candidates each; a query's own id is none of its
    candidates. Equal vectors are searched once, and a query that repeats is answered once.
    """
    wanted = neighbours + 1  # one may be the query itself
    typed = written(vectors.nodes(rows, id, vector).filter("id IS NOT NULL AND node IS NOT NULL"), "vectors")
    distinct = typed.groupBy("node").agg(F.min("id").alias("least_id"), F.min("vec").alias("vec"))
    distinct = written(distinct, "distinct-vectors")
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    total, largest = distinct.agg(F.count(F.lit(1)), F.max(norm)).first()
    asking = typed.filter(F.pmod("id", F.lit(every)) == 0)
    schema = f"query_id long, rank int, {id} long, score double"
    if not total:
        return asking.sparkSession.createDataFrame([], schema)
    sample = distinct.select("vec").orderBy(F.xxhash64(F.lit(7), "node")).limit(SAMPLE).collect()
    made = fit(np.array([row.vec for row in sample]), max(1, min(MOST_LISTS, total // LIST)), largest, neighbours)
    index = asking.sparkSession.sparkContext.broadcast(made)  # at most MOST_LISTS centroids

    postings = written(_routed(distinct, index, False), "postings")
    queries = distinct.join(asking.select("node").distinct(), "node", "left_semi")
    routed = written(_routed(queries, index, True), "asked-lists")
    counts = _blocks(postings, "blocks", BLOCK).join(_blocks(routed, "ask_blocks", ASKERS), "shard")
    placed = postings.join(counts, "shard").withColumn("block", _hashed_to("blocks")).withColumn("ask_block", _each("ask_blocks"))
    sent = routed.join(counts, "shard").withColumn("block", _each("blocks")).withColumn("ask_block", _hashed_to("ask_blocks"))
    columns = ["shard", "block", "ask_block", "lists", "node", "least_id", "vec"]
    both = placed.select(*columns, F.lit(False).alias("asks")).unionAll(sent.select(*columns, F.lit(True).alias("asks")))

    def run(table: pa.Table) -> pa.Table:
        return search_block(table, wanted)

    found = both.groupBy("shard", "block", "ask_block").applyInArrow(run, "asking long, node long, least_id long").distinct()
    # Scores are taken again from the vectors, in one fixed order of additions.
    pairs = written(found, "nearest-nodes")
    answers = pairs.join(distinct.select(F.col("node").alias("asking"), F.col("vec").alias("one")), "asking")
    answers = answers.join(distinct.select("node", F.col("vec").alias("two")), "node")
    products = F.aggregate(F.zip_with("one", "two", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    scored = answers.select("asking", "node", "least_id", products.alias("score"))
    best = Window.partitionBy("asking").orderBy(F.desc("score"), "least_id", "node")
    top = scored.withColumn("at", F.row_number().over(best)).filter(F.col("at") <= wanted).drop("at")
    smallest = Window.partitionBy("node").orderBy("id")
    ids = typed.select("node", "id").join(pairs.select("node").distinct(), "node", "left_semi")
    ids = ids.withColumn("at", F.row_number().over(smallest)).filter(F.col("at") <= wanted).select("node", "id")
    by_id = Window.partitionBy("asking").orderBy(F.desc("score"), "id")
    named = top.join(ids, "node").withColumn("at", F.row_number().over(by_id)).filter(F.col("at") <= wanted)
    answer = asking.select("node", F.col("id").alias("query_id")).distinct().withColumn("ask", F.struct("node"))
    ranked = Window.partitionBy("query_id", "node").orderBy(F.desc("score"), "id")
    out = answer.join(named.select(F.struct(F.col("asking").alias("node")).alias("ask"), "id", "score"), "ask").filter(F.col("id") != F.col("query_id"))
    out = out.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= neighbours)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id), "score")
