"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one representative of each group.

Vectors are scaled to length 1 and belong to the cell of their nearest centre. Two vectors with a cosine of at least
``COSINE`` are at most sqrt(2 - 2 * COSINE) apart, so if they are in different cells, the one of the higher cell lies
within that of the plane between the two centres. Every vector visits the lower cells whose plane is that near, and is
compared with their members: no link is lost at a border, and every pair meets once.

Centres are fitted on a bounded sample (``SAMPLE`` vectors, at most ``MOST_CELLS`` centres); every vector is assigned.
Where the sample says that cells spare next to no comparison, fewer cells are taken, as each visit is a copy to send.
Equal vectors are one node with a count. A cell's members and visitors are cut into blocks, and a task multiplies two
blocks, so a cell may hold any share of the vectors. A task returns per vector how many it is linked to, and one edge to
the smallest of the linked vectors it can reach inside the task, never the pairs themselves. The tasks are run in rounds
that send each vector ``COPIES`` times or so, and a round's shuffle files go when it is written: without clusters the
number of copies grows with the square of the vectors, the disk in use does not.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import shuffles_removed
from . import vectors
from .components import components
from .storage import written

COSINE = 0.9
SAMPLE = 8192
MOST_CELLS = 1024
CELL = 4096  # vectors wanted in a cell
BLOCK = 32768  # most rows of a block, fewer if they are long or the vectors few
BLOCK_VALUES = 1 << 21  # most numbers of a block
SMALL_BLOCK = 4096  # not cut further to have a task for every core
STRIP_VALUES = 1 << 22  # products held at a time inside a task
COPIES = 2  # of each vector sent in a round
SPARED = 1.25  # times the fewest comparisons any number of cells needs is as good
ROUNDS = 12


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = np.asarray(rows, np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # so that no square is out of range
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def spherical_means(rows: np.ndarray, k: int, seed: int = 11) -> np.ndarray:
    """Unit centres of ``k`` cells, or fewer if rows are few. An empty cell takes the row that fits its own worst."""
    rows = _unit(rows)
    pick = np.random.default_rng(seed)
    k = min(k, len(rows))
    centres = rows[pick.choice(len(rows), k, replace=False)]
    for _ in range(ROUNDS):
        likeness = rows @ centres.T
        home = likeness.argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, rows)
        empty = np.linalg.norm(sums, axis=1) < 1e-12
        if empty.any():
            sums[empty] = rows[np.argsort(likeness.max(axis=1))[: int(empty.sum())]]
        centres = _unit(sums)
    return centres


def _apart(centres: np.ndarray) -> np.ndarray:
    return np.array([np.linalg.norm(centres - one, axis=1) for one in centres])


def homes_and_visits(rows: np.ndarray, centres: np.ndarray, apart: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each row, and a table of the lower cells it visits. ``apart``: the distances of the centres."""
    likeness = _unit(rows) @ centres.T
    home = likeness.argmax(axis=1)
    own = likeness[np.arange(len(rows)), home]
    reach = np.sqrt(2 - 2 * cosine)
    near = own[:, None] - likeness <= reach * apart[home] + 1e-9
    return home, near & (np.arange(len(centres)) < home[:, None])


def _cells(sample: np.ndarray, total: int, block: int, cosine: float) -> np.ndarray:
    """The centres, as many as let the fewest copies be sent for nearly the fewest comparisons, by the sample."""
    tried = []
    k = min(MOST_CELLS, -(-total // CELL))
    while k:
        centres = spherical_means(sample, k)
        apart = _apart(centres)
        own, guests = np.zeros(len(centres)), np.zeros(len(centres))
        for start in range(0, len(sample), 1024):
            home, visits = homes_and_visits(sample[start : start + 1024], centres, apart, cosine)
            own += np.bincount(home, minlength=len(centres))
            guests += visits.sum(axis=0)
        own, guests = own * total / len(sample), guests * total / len(sample)
        h, v = _blocks(own, guests, block)
        tried.append(((own * own / 2 + own * guests).sum(), (own * (h + v) + guests * h).sum(), centres))
        k //= 4
    fewest = min(pairs for pairs, _, _ in tried)
    return min((one for one in tried if one[0] <= SPARED * fewest), key=lambda one: one[1])[2]


def _blocks(own: np.ndarray, guests: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Into how many blocks the members and the visitors of each cell are cut."""
    return np.maximum(1, np.ceil(own / block)).astype(np.int64), np.ceil(guests / block).astype(np.int64)


def _places(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each index of ``sizes`` as often as its size says, and 0, 1, ... for each of them."""
    index = np.repeat(np.arange(len(sizes)), sizes)
    return index, np.arange(len(index)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _tasks(node: np.ndarray, home: np.ndarray, visits: np.ndarray, h: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Columns row, cell, kind, i, j, side: the tasks each row is sent to. Kind 0 compares two blocks of members, or one with
    itself, kind 1 a block of members with one of visitors. Nodes are hashes, so their rest names a block."""
    spread = node.astype(np.uint64)

    def block_of(row, parts):
        return (spread[row] % parts.astype(np.uint64)).astype(np.int64)

    row, other = _places(h[home])
    own = block_of(row, h[home[row]])
    among = [row, home[row], np.zeros_like(row), np.minimum(own, other), np.maximum(own, other), (other < own).astype(np.int64)]
    row, other = _places(v[home])
    met = [row, home[row], np.ones_like(row), block_of(row, h[home[row]]), other, np.zeros_like(row)]
    guest, cell = np.nonzero(visits)
    at, other = _places(h[cell])
    row, cell = guest[at], cell[at]
    visiting = [row, cell, np.ones_like(row), other, block_of(row, v[cell]), np.ones_like(row)]
    return np.hstack([np.array(part, np.int64) for part in (among, met, visiting)])


def _assigned(distinct: DataFrame, centres: np.ndarray, cosine: float, result: str, give) -> DataFrame:
    """What ``give(batch, home, visits)`` makes of every vector, in pieces."""
    shared = distinct.sparkSession.sparkContext.broadcast(centres)  # at most MOST_CELLS vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apart = _apart(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                yield give(part, *homes_and_visits(vectors.matrix(part.column("vec")), shared.value, apart, cosine))

    return distinct.select("node", "copies", "vec").mapInArrow(run, result)


def _sizes(distinct: DataFrame, centres: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """How many members and visitors each cell has."""

    def give(part, home, visits):
        own = np.bincount(home, minlength=len(visits[0]))
        return pa.RecordBatch.from_arrays([pa.array(np.arange(len(own)), pa.int32()), pa.array(own), pa.array(visits.sum(axis=0))], ["cell", "own", "guests"])

    counted = _assigned(distinct, centres, cosine, "cell int, own long, guests long", give).groupBy("cell").agg(F.sum("own").alias("own"), F.sum("guests").alias("guests"))
    own, guests = np.zeros(len(centres), np.int64), np.zeros(len(centres), np.int64)
    for row in counted.collect():  # a row per cell
        own[row.cell], guests[row.cell] = row.own, row.guests
    return own, guests


def compare_blocks(table: pa.Table, cosine: float) -> pa.Table:
    """Compare the two blocks in ``table`` (its rows are marked ``side`` 0 and 1, or only 0 for a block with itself)."""
    table = table.sort_by("node")
    unit = _unit(vectors.matrix(table["vec"]))
    node, copies, side = (table[name].to_numpy() for name in ("node", "copies", "side"))
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if (side == 1).any() else left
    links, root = np.zeros(len(node), np.int64), np.arange(len(node))
    others = unit[right].T
    strip = max(1, STRIP_VALUES // len(right))
    for start in range(0, len(left), strip):
        one = left[start : start + strip]
        a, b = np.nonzero(unit[one] @ others >= cosine)
        a, b = one[a], right[b]
        if right is left:
            a, b = a[a < b], b[a < b]
        links += np.bincount(a, copies[b], len(node)).astype(np.int64) + np.bincount(b, copies[a], len(node)).astype(np.int64)
        if len(a):
            joined = np.flatnonzero(root != np.arange(len(node)))  # of the strips before, an edge a row
            root = _roots(np.vstack([np.column_stack([a, b]), np.column_stack([joined, root[joined]])]), len(node))
    some = np.flatnonzero(links)
    return pa.table({"node": node[some], "links": links[some], "root": node[root[some]]})


def _roots(pairs: np.ndarray, n: int) -> np.ndarray:
    """The smallest place each of ``n`` places can reach over ``pairs``."""
    label = np.arange(n)
    while len(pairs):
        least = label.copy()
        np.minimum.at(least, pairs[:, 0], label[pairs[:, 1]])
        np.minimum.at(least, pairs[:, 1], label[pairs[:, 0]])
        least = least[least]
        if (least == label).all():
            break
        label = least
    return label


def _compared(distinct: DataFrame, centres: np.ndarray, block: int, cosine: float) -> DataFrame:
    """node, links and root, from every pair of blocks that shares a cell."""
    own, guests = _sizes(distinct, centres, cosine)
    h, v = _blocks(own, guests, block)
    tasks = int((h * (h + 1) // 2 + h * v).sum())
    rounds = max(1, -(-int((own * (h + v) + guests * h).sum()) // (COPIES * int(own.sum()))))
    kind = distinct.schema["vec"].dataType.simpleString()

    def sent(this: int) -> DataFrame:
        def give(part, home, visits):
            row, *task, side = _tasks(part.column("node").to_numpy(), home, visits, h, v)
            now = sum(task) % rounds == this
            taken = part.take(pa.array(row[now]))
            columns = [pa.array(c[now], pa.int32()) for c in (*task, side)]
            return pa.RecordBatch.from_arrays([*columns, *taken.columns], ["cell", "kind", "i", "j", "side", *taken.schema.names])

        return _assigned(distinct, centres, cosine, f"cell int, kind int, i int, j int, side int, node long, copies long, vec {kind}", give)

    def run(table: pa.Table) -> pa.Table:
        return compare_blocks(table, cosine)

    keys = ["cell", "kind", "i", "j"]
    width = max(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(2 * -(-tasks // rounds), 2000))
    parts = []
    for this in range(rounds):
        dealt = sent(this).repartition(width, *keys)  # few bytes make a long task: none is merged with others
        parts.append(written(dealt.groupBy(*keys).applyInArrow(run, "node long, links long, root long"), "vector-links"))
    return reduce(DataFrame.unionAll, parts)


def _groups(typed: DataFrame, cosine: float) -> DataFrame:
    """id, n_links and component (a node) of every row."""
    distinct = typed.filter("node IS NOT NULL").groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.min("vec").alias("vec"))
    distinct = written(distinct, "distinct-vectors")
    total = distinct.count()
    sample = distinct.select("vec").orderBy(F.xxhash64(F.lit(3), "node")).limit(SAMPLE).collect() if total else []
    if not sample:
        return typed.select("id", F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component"))
    fitted = np.array([row.vec for row in sample])
    block = max(1, min(BLOCK, BLOCK_VALUES // fitted.shape[1], max(SMALL_BLOCK, -(-total // 6))))
    compared = _compared(distinct, _cells(fitted, total, block, cosine), block, cosine)
    linked = components(compared.select(F.col("node").alias("u"), F.col("root").alias("v")))
    counts = compared.groupBy("node").agg(F.sum("links").alias("links"))
    known = distinct.select("node", "copies").join(counts, "node", "left").join(linked, "node", "left")
    links = F.coalesce("links", F.lit(0)) + F.col("copies") - 1
    known = known.select(F.struct("node").alias("at"), links.alias("n_links"), F.coalesce("component", "node").alias("component"))
    return written(typed.select("id", F.struct("node").alias("at")).join(known, "at", "left").drop("at"), "vector-groups")


def near_vectors(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """Per row: id (long), n_links, component_id (smallest id that links lead to), kept.

    Vectors that are null, empty, zero, or hold null or non-finite components, and those of another length than most,
    link with nothing. Equal vectors link with each other. Where the id is null in a whole component, so is
    component_id, and its rows are kept.
    """
    typed = vectors.nodes(rows, id, vector)
    if rows.schema[vector].dataType == T.ArrayType(T.FloatType(), rows.schema[vector].dataType.containsNull):
        typed = typed.withColumn("vec", F.col("vec").cast("array<float>"))  # exact again, and half as long
    with shuffles_removed(rows.sparkSession):
        found = _groups(written(typed, "vectors"), cosine)
    least = found.groupBy("component").agg(F.min("id").alias("least")).filter("component IS NOT NULL")
    joined = found.withColumn("at", F.struct("component")).join(least.select(F.struct("component").alias("at"), "least"), "at", "left")
    component_id = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("least"))
    return joined.select(
        F.col("id").alias(id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component_id.alias("component_id"), F.col("id").eqNullSafe(component_id).alias("kept")
    )
