"""Near-duplicate documents: MinHash bands propose, a sequential Bayesian test prunes, full sets decide.

Two documents are linked when their sets of five-word shingles have a Jaccard similarity of at least ``SIMILARITY``.
Documents with the same set are one node. Nodes that share one of 32 bands of 4 hashes are candidates; at the threshold
a pair is missed with probability (1 - 0.75^4)^32 = 5e-6. The signatures of a candidate pair are compared in batches
(BayesLSH, Satuluri and Parthasarathy 2012): after each batch the pair is dropped if, given the matches so far and a
uniform prior, the similarity reaches the threshold with less than ``MISS`` probability. What survives is compared on
the full sets.

Pairs inside a bucket are not listed. First each member is compared with the bucket's smallest node only. Most groups of
copies are one component after that and their buckets are done, since links inside a component change nothing. In
buckets that still hold several components, the members outside the largest one are compared with all members of other
components, in pairs of blocks of the bucket. A first pass over signatures finds the members that are in a candidate
pair; their full sets go to the same task again, which verifies its pairs, each in the first band its signatures share,
unless links it found have joined the two already. A task returns the edges of a forest, never the pairs themselves.

Set hashes have 64 bits: with n different shingles or sets, two are taken for one with probability n^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from . import shingles
from .components import components
from .keys import fingerprint
from .storage import written

SIMILARITY = 0.75
MISS = 1e-6
STEP = 32  # hashes compared at a time
BLOCK = 2048  # members of a bucket in a block; a task compares two blocks
BLOCK_SHINGLES = 1 << 20  # and their shingles


def least_matches(threshold: float = SIMILARITY, miss: float = MISS) -> dict[int, int]:
    """After n hashes, the fewest matches with which P(similarity >= threshold) is at least ``miss``.

    With a uniform prior the posterior after m matches of n is Beta(m + 1, n - m + 1), whose upper tail is the chance
    of at most m successes in n + 1 trials.
    """
    found = {}
    for n in range(STEP, shingles.HASHES + 1, STEP):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        found[n] = m
    return found


def likely(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Places of the rows of two signature tables that pass every batch of the sequential test."""
    alive = np.arange(len(one))
    matches = np.zeros(len(one), np.int64)
    for n, least in least_matches().items():
        matches = matches + (one[alive, n - STEP : n] == two[alive, n - STEP : n]).sum(axis=1)
        passed = matches >= least
        alive, matches = alive[passed], matches[passed]
    return alive


def _signed(docs: DataFrame) -> DataFrame:
    """Of every row: id, k1, k2, n (shingles), node (hash of the set), signature and band keys; the last three are null
    for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, signatures = [], [], []
            for found in shingles.shingle_sets(batch.column(3)):
                sizes.append(len(found))
                nodes.append(np.array(xxhash.xxh3_64_intdigest(found.tobytes()), np.uint64).astype(np.int64) if len(found) else None)
                signatures.append(shingles.signature(found) if len(found) else None)
            full = [s for s in signatures if s is not None]
            keys = iter(shingles.band_keys(np.array(full)).astype(np.int64) if full else ())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.int64()),
                    pa.array([None if s is None else s.tobytes() for s in signatures], pa.binary()),
                    pa.array([None if s is None else next(keys) for s in signatures], pa.list_(pa.int64())),
                ],
                ["id", "k1", "k2", "n", "node", "signature", "bands"],
            )

    schema = "id long, k1 long, k2 long, n long, node long, signature binary, bands array<long>"
    return docs.mapInArrow(run, schema)


def _sets(texts: DataFrame) -> DataFrame:
    """node and the sorted shingle hashes, from node and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [found.tobytes() for found in shingles.shingle_sets(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["node", "shingles"])

    return texts.mapInArrow(run, "node long, shingles binary")


def _tested(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures pass the sequential test, and how many of their hashes match."""
    left = signatures.select(F.col("node").alias("a"), F.col("signature").alias("sa"))
    right = signatures.select(F.col("node").alias("b"), F.col("signature").alias("sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(-1, shingles.HASHES) for k in (2, 3))
            alive = likely(one, two)
            matches = pa.array((one[alive] == two[alive]).sum(axis=1), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.select(["a", "b"]).take(pa.array(alive)).columns, matches], ["a", "b", "matches"])

    return pairs.join(right, "b").join(left, "a").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long, matches long")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("one"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("two"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                keep = []
                for one, two in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                    a, b = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                    both = np.sort(np.concatenate([a, b]), kind="stable")  # two sorted runs
                    shared = int((both[1:] == both[:-1]).sum())
                    keep.append(shared >= SIMILARITY * (len(a) + len(b) - shared))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(right, "b").join(left, "a").select("a", "b", "one", "two").mapInArrow(run, "a long, b long")


TASK = ["key", "kind", "i", "j"]


def _tasks(members: DataFrame, linked: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, once for each pair of blocks they are compared in.

    Links inside the largest component of a bucket change nothing, so its blocks (``side`` 1 of kind 1) meet those of
    the other members only; those meet each other too (kind 0). Blocks are bounded by members and by shingles.
    """
    labels = linked.select(F.struct("node").alias("of"), "component")
    labelled = members.select("key", "band", "node", "n", F.struct("node").alias("of")).join(labels, "of", "left")
    labelled = written(labelled.select("key", "band", "node", "n", F.coalesce("component", "node").alias("component")), "bucket-components")
    sizes = labelled.groupBy("key", "component").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("weight"))
    top = F.max(F.struct("size", "weight", "component")).alias("top")
    largest = sizes.groupBy("key").agg(top, F.sum("size").alias("size"), F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("kinds"))

    def blocks(size, weight):
        return F.ceil(F.greatest(size / BLOCK, weight / BLOCK_SHINGLES)).cast("int")

    rest = blocks(F.col("size") - F.col("top.size"), F.col("weight") - F.col("top.weight"))
    several = largest.filter("kinds > 1").select(
        F.struct("key").alias("at"), F.col("top.component").alias("main"), rest.alias("q"), blocks(F.col("top.size"), F.col("top.weight")).alias("m")
    )

    def task(kind, i, j, side):
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), F.lit(side).alias("side"))

    every_q, every_m = (F.sequence(F.lit(0), F.col(name) - 1) for name in ("q", "m"))
    own = F.pmod(F.xxhash64("node", "key"), F.when(F.col("component") == F.col("main"), F.col("m")).otherwise(F.col("q"))).cast("int")
    among = F.transform(
        every_q,
        lambda k: F.when(k > F.col("block"), task(0, F.col("block"), k, 0)).when(k < F.col("block"), task(0, k, F.col("block"), 1)).otherwise(task(0, k, k, 0)),
    )
    outside = F.concat(among, F.transform(every_m, lambda k: task(1, F.col("block"), k, 0)))
    inside = F.transform(every_q, lambda k: task(1, k, F.col("block"), 1))
    placed = labelled.withColumn("at", F.struct("key")).join(several, "at").withColumn("block", own)
    dealt = placed.withColumn("task", F.explode(F.when(F.col("component") == F.col("main"), inside).otherwise(outside)))
    return dealt.select("key", "task.kind", "task.i", "task.j", "task.side", "band", "node", "component")


def _candidates(table: pa.Table, group: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Places of a task's rows and of the rows each is to be compared with: those of other groups whose signatures pass
    the sequential test and share no earlier band, so that a pair counts in one bucket only. ``group`` may change
    meanwhile."""
    signatures = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint32).reshape(-1, shingles.HASHES)
    bands, side = shingles.band_keys(signatures), table["side"].to_numpy()
    band = table["band"][0].as_py()
    asking, asked = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    within = table["i"][0].as_py() == table["j"][0].as_py() and table["kind"][0].as_py() == 0
    for place, q in enumerate(asking.tolist()):
        other = asking[place + 1 :] if within else asked
        other = other[group[other] != group[q]]
        hits = other[likely(np.broadcast_to(signatures[q], (len(other), shingles.HASHES)), signatures[other])]
        hits = hits[~(bands[hits, :band] == bands[q, :band]).any(axis=1)]
        if len(hits):
            yield q, hits


def promising(table: pa.Table) -> pa.Table:
    """The rows of a task that are in a candidate pair, without signatures."""
    some = np.zeros(table.num_rows, bool)
    for q, hits in _candidates(table, table["component"].to_numpy()):
        some[q] = some[hits] = True
    return table.select([*TASK, "side", "band", "node", "component"]).filter(pa.array(some))


def linking(table: pa.Table) -> pa.Table:
    """Edges (u, v) that join the components of a task as all its candidate pairs with similar full sets do."""
    node, group = table["node"].to_numpy(), np.unique(table["component"].to_numpy(), return_inverse=True)[1]
    sets = [np.frombuffer(s, np.uint64) for s in table["shingles"].to_pylist()]
    sizes = np.array([len(s) for s in sets], np.int64)
    known, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    marked = np.zeros(len(known), bool)
    edges = []
    for q, hits in _candidates(table, group):
        own = flat[starts[q] : starts[q] + sizes[q]]
        marked[own] = True
        shared = np.array([np.count_nonzero(marked[flat[starts[t] : starts[t] + sizes[t]]]) for t in hits.tolist()])
        marked[own] = False
        for t in hits[shared >= SIMILARITY * (sizes[q] + sizes[hits] - shared)].tolist():
            if group[t] != group[q]:
                group[group == group[t]] = group[q]
                edges.append((node[q], node[t]))
    pairs = np.array(edges, np.int64).reshape(-1, 2)
    return pa.table({"u": pa.array(pairs[:, 0], pa.int64()), "v": pa.array(pairs[:, 1], pa.int64())})


def _across(members: DataFrame, linked: DataFrame, signatures: DataFrame, sets: DataFrame) -> DataFrame:
    """Edges (u, v) that join what is still apart in the buckets of several components. Signatures go to every pair of
    blocks, full sets only to those where a candidate pair was found."""
    dealt = _tasks(members, linked).join(signatures, "node")
    schema = "key long, kind int, i int, j int, side int, band int, node long, component long"
    columns = [*TASK, "side", "band", "node", "component"]
    found = written(dealt.select(*columns, "signature").groupBy(*TASK).applyInArrow(promising, schema), "promising")
    complete = found.join(signatures, "node").join(sets.hint("merge"), "node").select(*columns, "signature", "shingles")
    return complete.groupBy(*TASK).applyInArrow(linking, "u long, v long")


def near_groups(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n (shingles of the text), component (a number that linked rows share; null for a text
    without words, which is linked with nothing).

    A-Z are lower-cased; words are runs of anything but ASCII spaces; fewer than five words make one shingle. Rows are
    kept as they are, so equal rows and null ids get a component like any other.
    """
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    one, two = fingerprint(F.col("id"), F.col("text"))
    keyed = rows.select("id", one.alias("k1"), two.alias("k2"), "text")
    signed = written(_signed(keyed), "signatures")
    # Buckets of two or more nodes. Copies of a set add nothing to the minimum and maximum.
    banded = signed.filter("node IS NOT NULL").select(F.posexplode("bands").alias("band", "key"), "node", "n")
    buckets = banded.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).filter("first < last")
    shared = buckets.select(F.struct("key").alias("at"), "first")
    members = banded.withColumn("at", F.struct("key")).join(shared, "at")
    members = members.groupBy("key", "node").agg(F.min("first").alias("first"), F.min("n").alias("n"), F.min("band").alias("band"))
    members = written(members, "bucket-members")
    # One signature, and one document to take the set from, for each node in such a bucket.
    wanted = members.select("node").distinct()
    chosen = signed.join(wanted, "node", "left_semi").groupBy("node").agg(F.min(F.struct("k1", "k2")).alias("doc"))
    chosen = written(chosen.select("node", "doc.k1", "doc.k2"), "chosen")
    own = signed.select("node", "k1", "k2", "signature").join(chosen, ["node", "k1", "k2"], "left_semi").dropDuplicates(["node"])
    signatures = written(own.select("node", "signature"), "node-signatures")
    # Merge joins at every size: a table of texts or sets is shuffled the same way on a small corpus as on a large one.
    texts = keyed.join(chosen.hint("merge"), ["k1", "k2"]).dropDuplicates(["node"]).select("node", "text")
    sets = written(_sets(texts), "node-shingles")

    first = members.filter("first < node").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    # Of a member's likely firsts the likeliest is verified; what that leaves apart is settled in the buckets.
    likeliest = _tested(first, signatures).groupBy("b").agg(F.max(F.struct("matches", "a")).alias("best")).select("best.a", "b")
    links = written(_verified(written(likeliest, "likely"), sets), "links")
    linked = written(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "components")

    more = written(_across(members, linked, signatures, sets), "links-across")
    if not more.isEmpty():
        linked = written(components(more.unionAll(linked.select(F.col("node").alias("u"), F.col("component").alias("v")))), "components")
    found = signed.select("id", "n", "node").withColumn("at", F.struct("node"))
    answer = found.join(linked.select(F.struct("node").alias("at"), "component"), "at", "left")
    return answer.select("id", "n", F.coalesce("component", F.col("node")).alias("component"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id that links lead to), kept.

    A text without words is a component by itself. Where doc_id is null in a whole component, so is component_id, and
    its rows are kept; other rows without doc_id are not.
    """
    grouped = written(near_groups(docs), "near-groups")
    ids = grouped.groupBy("component").agg(F.min("id").alias("component_id")).filter("component IS NOT NULL")
    joined = grouped.withColumn("at", F.struct("component")).join(ids.select(F.struct("component").alias("at"), "component_id"), "at", "left")
    component_id = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return joined.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component_id.alias("component_id"), F.col("id").eqNullSafe(component_id).alias("kept")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that of the smallest doc_id, null last. Rows whose text
    has no words all stay."""
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("doc")
    landed = written(docs.select(F.monotonically_increasing_id().alias("row"), whole), "near-documents")
    grouped = written(near_groups(landed.select("row", F.col("doc.text").alias("text")), "row"), "near-groups")
    ordered = grouped.filter("component IS NOT NULL").join(landed.select(F.col("row").alias("id"), F.col("doc.doc_id").cast("long").alias("doc_id")), "id")
    first = ordered.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "id")).alias("first"))
    stay = first.select(F.col("first.id").alias("row")).unionAll(grouped.filter("component IS NULL").select(F.col("id").alias("row")))
    return landed.join(stay, "row", "left_semi").select(*[F.col(f"doc.`{name}`") for name in docs.columns])
