"""The best documents for each item of a query set, by the terms they share.

A document counts only through its bag: how often it holds each term of the items, and a length step m. Documents with
one bag and one m form a class. They are brought together by a hash of both, and the bags themselves are part of the
grouping key, so a class never holds two that differ. Classes are scored once, in blocks of classes against all items;
the best classes of an item are then expanded to their documents by ascending doc_id.

A class ahead of another holds at least one document ahead of all of the other's, so as many classes as documents are
wanted are enough, and of each class as many documents. The items are worked off in blocks of bounded size, so that the
vocabulary sent to the tasks is bounded whatever the number of items.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .storage import written

# The scoring formula.
TERM_SCALE, TF_SCALE, TF_WEIGHT, M_WEIGHT, M_BASE, M_SLOPE = 1000, 1_000_000_000, 1000, 12, 75, 25

BLOCK_TERMS, BLOCK_ITEMS = 1_000_000, 4096  # of the items worked off together
CHUNK = 1 << 22  # bytes of a text split at once
CELLS = 1 << 22  # scores held at once

_TO_TERMS = bytes(32 if code < 128 and not chr(code).isalnum() else code + 32 if 65 <= code <= 90 else code for code in range(256))


def terms(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in parts: runs of ASCII letters and digits and of everything beyond ASCII, A-Z in lower case."""
    data = text.encode().translate(_TO_TERMS)
    start = 0
    while start < len(data):
        stop = data.find(b" ", start + CHUNK) if len(data) - start > CHUNK else -1
        stop = len(data) if stop < 0 else stop
        yield data[start:stop].split()
        start = stop


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
            counts: dict[bytes, int] = {}
            for part in terms(text or ""):
                for term in part:
                    counts[term] = counts.get(term, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * len(counts), pa.string()), pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["key", "term", "times"]
            )


def _bag_maker(vocabulary):
    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value.get
        for batch in batches:
            sizes, made = [], []
            for text in batch.column("text").to_pylist():
                n, held = 0, []
                for part in terms(text or ""):
                    n += len(part)
                    held += [at for at in map(known, part) if at is not None]
                ids, times = np.unique(np.array(held, np.int64), return_counts=True)
                sizes.append(n)
                made.append(np.stack([ids, times]).astype("<i4").tobytes("F"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(made, pa.binary())], names=["doc_id", "n", "bag"])

    return bags


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many bags hold each term, partially summed."""
    total = np.zeros(0, np.int64)
    for batch in batches:
        flat = np.frombuffer(b"".join(batch.column("bag").to_pylist()), "<i4")[::2]
        found = np.bincount(flat)
        if len(found) > len(total):
            total, found = found, total
        total[: len(found)] += found
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], names=["term", "df"])


def _scorer(weights, most: int):
    """Scores of classes with all items of a block; of each part of the classes the best ``most`` of every item."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # By term: the places of the items that hold it, and their weight times repeats; the items' numbers.
        starts, items, values, numbers = weights.value
        n_items = len(numbers)
        width = max(1, min(8192, CELLS // n_items))
        for batch in batches:
            for begin in range(0, batch.num_rows, width):
                part = batch.slice(begin, width)
                bags = [np.frombuffer(bag, "<i4").astype(np.int64) for bag in part.column("bag").to_pylist()]
                rows = np.repeat(np.arange(len(bags)), [len(bag) // 2 for bag in bags])
                flat = np.concatenate(bags) if bags else np.zeros(0, np.int64)
                m = part.column("m").to_numpy()
                shares = TF_SCALE * flat[1::2] // (TF_WEIGHT * flat[1::2] + M_WEIGHT * m[rows])
                order = np.argsort(flat[::2], kind="stable")
                ids, rows, shares = flat[::2][order], rows[order], shares[order]
                scores = np.zeros((len(bags), n_items), np.int64)
                cuts = np.flatnonzero(np.diff(ids, prepend=-1, append=-1)).tolist()
                for start, stop in zip(cuts, cuts[1:]):
                    own = slice(starts[ids[start]], starts[ids[start] + 1])
                    # A row holds a term once, and an item too, so no cell is met twice.
                    scores[np.ix_(rows[start:stop], items[own])] += np.multiply.outer(shares[start:stop], values[own])
                yield _best(scores, part, most, numbers)

    return scored


def _best(scores: np.ndarray, part: pa.RecordBatch, most: int, numbers: np.ndarray) -> pa.RecordBatch:
    """The best classes of a block for each item: highest score, then smallest first document (the order of the rows)."""
    first = part.column("first").to_numpy()
    by_first = np.argsort(first, kind="stable")
    scores = scores[by_first]
    if len(scores) > most:
        border = np.partition(scores, len(scores) - most, axis=0)[-most]
    else:
        border = np.zeros(scores.shape[1], np.int64)
    row, item = np.nonzero(scores >= np.maximum(border, 1))
    value = scores[row, item]
    order = np.lexsort([row, -value, item])
    row, item, value = row[order], item[order], value[order]
    place = np.arange(len(item)) - np.searchsorted(item, item)
    keep = place < most
    return pa.RecordBatch.from_arrays(
        [pa.array(numbers[item[keep]], pa.int64()), part.column("class").take(pa.array(by_first[row[keep]])), pa.array(first[by_first[row[keep]]], pa.int64()), pa.array(value[keep], pa.int64())],
        names=["item", "class", "first", "score"],
    )


def _ranked(rows: DataFrame, keys: list[str], order: list, most: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= most)


def best_documents(docs: DataFrame, items: DataFrame, most: int = 20) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``most`` documents of ``docs`` (doc_id, text) with the highest score
    above 0 for each row of ``items`` (item_id, text); equal scores by ascending doc_id, documents without one last.

    Rows of ``docs`` that are equal in all are different documents. Items without terms, or whose terms no document
    holds, have no rows, and so has everything where a table is empty. Items that share an item_id are one with the terms
    of all. Other columns are ignored.
    """
    spark = docs.sparkSession
    # Documents without id come after all others, under the largest number there is.
    numbered = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc_id"), "text")
    named = items.select(F.coalesce(F.concat(F.lit("i"), F.col("item_id").cast("string")), F.lit("")).alias("key"), "item_id", "text")
    listed = written(named.select("key", "item_id").distinct().withColumn("item", F.monotonically_increasing_id()), "items")
    held = named.select("key", "text").mapInArrow(_item_terms, "key string, term binary, times long").groupBy("key", "term").agg(F.sum("times").alias("times"))
    item_terms = written(held.join(listed, "key").select("item", "term", "times"), "item-terms")
    sizes = item_terms.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    blocks = _blocks(sizes)
    results = [_one_block(numbered, listed, item_terms, block, most) for block in blocks]
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    result = results[0]
    for more in results[1:]:
        result = result.unionAll(more)
    return result


def _blocks(sizes: DataFrame) -> list[tuple[int, int]]:
    """Ranges of item numbers with at most ``BLOCK_ITEMS`` items and about ``BLOCK_TERMS`` terms each. Items are numbered along
    partitions, so a range is found from running totals per item; a row per item goes to the driver as two numbers."""
    ranges, begin, n, total = [], None, 0, 0
    last = None
    for row in sizes.select("item", "n").orderBy("item").toLocalIterator():
        if begin is not None and (n >= BLOCK_ITEMS or total + row.n > BLOCK_TERMS):
            ranges.append((begin, last))
            begin = None
        if begin is None:
            begin, n, total = row.item, 0, 0
        n, total, last = n + 1, total + row.n, row.item
    if begin is not None:
        ranges.append((begin, last))
    return ranges


def _one_block(docs: DataFrame, listed: DataFrame, item_terms: DataFrame, block: tuple[int, int], most: int) -> DataFrame:
    context = docs.sparkSession.sparkContext
    own = item_terms.filter(F.col("item").between(*block)).orderBy("term", "item").collect()  # bounded: one block of items
    numbers = sorted({row.item for row in own})
    place = {item: at for at, item in enumerate(numbers)}
    vocabulary: dict[bytes, int] = {}
    for row in own:
        vocabulary.setdefault(bytes(row.term), len(vocabulary))
    sent = context.broadcast(vocabulary)
    bags = written(docs.mapInArrow(_bag_maker(sent), "doc_id long, n long, bag binary").withColumn("hash", F.xxhash64("bag")), "bags")
    totals = bags.filter("n > 0").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("l")).first()
    n_docs, n_terms = totals.n, totals.l or 1
    held = bags.filter(F.octet_length("bag") > 0)
    frequency = {r.term: r.df for r in held.select("bag").mapInArrow(_term_counts, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()}  # one row per term of the block
    weight = [math.floor(TERM_SCALE * math.log((2 * n_docs + 2) / (2 * frequency[t] + 1))) if t in frequency else 0 for t in range(len(vocabulary))]
    at = np.array([vocabulary[bytes(row.term)] for row in own], np.int64)
    starts = np.searchsorted(at, np.arange(len(vocabulary) + 1))
    values = np.array([row.times * weight[t] for row, t in zip(own, at.tolist())], np.int64)
    weights = context.broadcast((starts, np.array([place[row.item] for row in own], np.int64), values, np.array(numbers, np.int64)))

    m = F.lit(M_BASE).cast("long") + F.expr(f"(cast({M_SLOPE} as bigint) * n * cast({n_docs} as bigint)) div cast({n_terms} as bigint)")
    # The hash leads the key; bag and m in it tell apart what only the hash has in common. The first documents of each
    # class are picked before the shuffle, so copies by the thousand send a few rows.
    members = _ranked(held.select("doc_id", "hash", m.alias("m"), "bag"), ["hash", "m", "bag"], [F.col("doc_id")], most)
    members = written(members.withColumn("class", F.concat_ws("-", F.hex("hash"), F.col("m"), F.md5("bag"))), "class-members")
    classes = members.filter("rank = 1").select("class", "m", "bag", F.col("doc_id").alias("first"))
    scored = classes.mapInArrow(_scorer(weights, most), "item long, class string, first long, score long")
    chosen = written(_ranked(scored, ["item"], [F.desc("score"), F.col("first"), F.col("class")], most).drop("rank"), "best-classes")
    found = chosen.join(members.select("class", "doc_id"), "class")
    ranked = _ranked(found, ["item"], [F.desc("score"), F.col("doc_id")], most)
    ids = F.broadcast(listed.filter(F.col("item").between(*block)).select("item", "item_id"))  # one block of items
    doc_id = F.when(F.col("doc_id") != (1 << 63) - 1, F.col("doc_id"))
    result = written(ranked.join(ids, "item").select("item_id", F.col("rank").cast("int").alias("rank"), doc_id.alias("doc_id"), "score"), "best-documents")
    sent.destroy()
    weights.destroy()
    return result
