"""Exact substring dedup with a run-length compressed index: which bytes lie in a string of 400 that starts elsewhere too?

Spark brings together the places that can match. In every window of ``SPAN`` bytes the k-gram with the smallest hash is
the window's anchor; equal windows have equal anchors in the same place, so windows only need to be compared within an
anchor. Neighbouring windows with one anchor form a context, at most 2 * SPAN bytes long. An anchor seen once, which is
nearly all text that is not repeated, settles its windows without looking at them again, and so does a context that
occurs twice as a whole. Of the 368 other bytes of a window at least half lie on one side of its anchor, so a context is also
settled if no other has the same ``HALF`` bytes before the anchor, and none the same ones after it.

What is left, contexts that differ but share an anchor, is highly repetitive. A task sorts the suffixes of such
contexts, takes the Burrows-Wheeler transform, and keeps of it the runs: at the first and last suffix of each run the
text position and the match length with the suffix before or after. Elsewhere the match length of a position is that of
the position before it less one (Karkkainen, Manzini and Puglisi 2009), so streaming over the text from sample to
sample gives the matching statistics of every position, the longest match with any other place. Positions with a
statistic of at least ``SPAN`` start a repeated string.

Contexts are indexed in batches of ``BATCH`` bytes, whole anchors at a time. An anchor of more than ``MOST_CONTEXTS``
different contexts would be too much for one task: the windows of its contexts are counted by hash over all tasks
instead, with the same result.

Hashes are 64 bits for anchors, which only bring candidates together, and 128 bits for contexts and counted windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .keys import fingerprint
from .storage import written

SPAN = 400
GRAM = 32  # bytes of the k-gram; a power of two
HALF = (SPAN - GRAM) // 2
CHUNK = 1 << 20  # window starts hashed together
BATCH = 1 << 21
MOST_CONTEXTS = 4096

_RANDOM = np.random.default_rng(20090622)
_BYTE = _RANDOM.integers(0, 1 << 64, (2, 257), dtype=np.uint64)
_BASE = [int(x) * 2 + 1 for x in _RANDOM.integers(1 << 40, 1 << 62, 2)]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
    return out[:n]


class Prefix:
    """Hashes of any stretches of a sequence of small numbers, from sums over its prefixes."""

    def __init__(self, codes: np.ndarray, which: int, table: np.ndarray | None = None) -> None:
        base = _BASE[which]
        values = (_BYTE[which] if table is None else table)[codes]
        self._back = _powers(pow(base, -1, 1 << 64), len(codes) + 1)
        self._sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(values * _powers(base, len(codes)), out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self._sums[end] - self._sums[start]) * self._back[start]


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """A hash of the k-gram at each place that has one."""
    found, size = _BYTE[0][codes], 1
    while size < GRAM:
        factor = np.uint64(pow(_BASE[0], size, 1 << 64))
        found = found[:-size] + found[size:] * factor
        size *= 2
    found = (found ^ found >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    return found ^ found >> np.uint64(29)


def window_anchors(hashes: np.ndarray) -> np.ndarray:
    """Place of the smallest of each ``SPAN - GRAM + 1`` neighbouring hashes, the leftmost of equal ones. Only the upper
    bits are compared, the others hold the place."""
    width = SPAN - GRAM + 1
    bits = np.uint64(max(1, len(hashes).bit_length()))
    places = np.arange(len(hashes), dtype=np.uint64)
    keyed = hashes >> bits << bits | places
    padded = np.full(-(-len(keyed) // width) * width, np.iinfo(np.uint64).max)
    padded[: len(keyed)] = keyed
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: len(keyed) - width + 1], ahead[width - 1 : len(keyed)])
    return (least & (np.uint64(1) << bits) - np.uint64(1)).astype(np.int64)


def contexts(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays (text, start, count, anchor, one, two, left, right): runs of ``count`` windows from byte ``start`` of a text
    that share an anchor, with the anchor's hash, two hashes of the bytes that the windows cover, and the hashes of
    ``HALF`` bytes on either side of the anchor (masked where no window reaches as far)."""
    pieces, size = [], 0
    for number, text in enumerate(texts):
        for start in range(0, max(0, len(text) - SPAN + 1), CHUNK):
            piece = text[start : start + CHUNK + SPAN - 1]
            pieces.append((number, start, piece))
            size += len(piece)
            if size >= CHUNK:
                yield _contexts(pieces)
                pieces, size = [], 0
    if pieces:
        yield _contexts(pieces)


def _contexts(pieces: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
    codes = np.frombuffer(b"".join(piece for _, _, piece in pieces), np.uint8)
    sizes = np.array([len(piece) for _, _, piece in pieces])
    first = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(pieces)), sizes - SPAN + 1)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(sizes - SPAN + 1) - (sizes - SPAN + 1), sizes - SPAN + 1)
    starts = first[owner] + within
    hashes = gram_hashes(codes)
    anchor = window_anchors(hashes)[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(starts)))
    begin = starts[head]
    end, gram = begin + count + SPAN - 1, anchor[head]
    prefixes = [Prefix(codes, k) for k in (0, 1)]
    one, two = (prefix.of(begin, end).view(np.int64) for prefix in prefixes)
    before, after = np.maximum(gram - HALF, 0), np.minimum(gram + GRAM + HALF, len(codes))
    left = np.ma.array(prefixes[0].of(before, gram).view(np.int64), mask=gram - HALF < begin)
    right = np.ma.array(prefixes[0].of(gram + GRAM, after).view(np.int64), mask=gram + GRAM + HALF > end)
    number = np.array([p[0] for p in pieces])[owner[head]]
    offset = np.array([p[1] for p in pieces])[owner[head]] + within[head]
    return number, offset, count, hashes[gram].view(np.int64), one, two, left, right


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a sequence that ends in a symbol of its own, by prefix doubling. Suffixes that are alone
    in their group keep their place and are left out of later rounds."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    sorted_ranks = rank[order]
    first = np.flatnonzero(np.diff(sorted_ranks, prepend=-1))
    rank[order] = np.repeat(first, np.diff(np.append(first, n)))
    step = 1
    while True:
        ranks = rank[order]
        alone = np.ones(n, bool)
        same = ranks[1:] == ranks[:-1]
        alone[1:] &= ~same
        alone[:-1] &= ~same
        places = np.flatnonzero(~alone)
        if not len(places):
            return order
        some = order[places]
        key = rank[some] * (n + 1) + np.where(some + step < n, rank[np.minimum(some + step, n - 1)] + 1, 0)
        moved = np.argsort(key, kind="stable")
        some, key = some[moved], key[moved]
        order[places] = some
        fresh = np.flatnonzero(np.diff(key, prepend=-1))
        rank[some] = np.repeat(places[fresh], np.diff(np.append(fresh, len(some))))
        step *= 2


class RunLengthIndex:
    """The runs of the Burrows-Wheeler transform of some texts, with what is sampled at their ends."""

    def __init__(self, texts: list[bytes]) -> None:
        sizes = np.array([len(text) + 1 for text in texts])
        self.ends = np.cumsum(sizes)
        # Every text ends in a symbol of its own, so no match runs across.
        symbols = np.frombuffer(b"\x00".join([*texts, b""]), np.uint8).astype(np.int64) + len(texts)
        symbols[self.ends - 1] = np.arange(len(texts))
        order = suffix_array(symbols)
        before = symbols[order - 1]
        changes = np.flatnonzero(before[1:] != before[:-1]) + 1
        self.size = len(symbols)
        self.heads, self.tails = order[changes], order[changes - 1]
        # the suffixes at a border between runs are neighbours, so one match length serves both
        table = np.random.default_rng(3).integers(0, 1 << 64, len(texts) + 256, dtype=np.uint64)
        self.border = _common_prefix(Prefix(symbols, 0, table), self.tails, self.heads, int(sizes.max()), self.size)
        self.first, self.last = int(order[0]), int(order[-1])

    def matching_statistics(self) -> np.ndarray:
        """For each position, the longest match with a string that starts anywhere else."""
        before = self._stream(np.append(self.heads, self.first), np.append(self.border, 0))
        after = self._stream(np.append(self.tails, self.last), np.append(self.border, 0))
        return np.maximum(before, after)

    def _stream(self, positions: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Lengths at all positions: that of the sample at or before a position, less the distance."""
        reach = np.full(self.size, -1, np.int64)
        reach[positions] = positions
        at = np.maximum.accumulate(reach)
        value = np.zeros(self.size, np.int64)
        value[positions] = lengths
        return np.where(at >= 0, value[at] - (np.arange(self.size) - at), 0)


def _common_prefix(prefix: Prefix, one: np.ndarray, two: np.ndarray, longest: int, size: int) -> np.ndarray:
    """Length of the longest common prefix of each pair of suffixes, by halving with hashes."""
    low = np.zeros(len(one), np.int64)
    high = np.minimum(longest, size - np.maximum(one, two))
    while (low < high).any():
        middle = (low + high + 1) >> 1
        same = prefix.of(one, one + middle) == prefix.of(two, two + middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def repeated_windows(texts: list[bytes]) -> list[np.ndarray]:
    """For each text the places where a string of ``SPAN`` bytes starts that starts in another place too."""
    index = RunLengthIndex(texts)
    statistics = index.matching_statistics()
    begin = np.append(0, index.ends[:-1])
    return [np.flatnonzero(statistics[a:b] >= SPAN) for a, b in zip(begin, index.ends)]


def merged(spans: np.ndarray) -> np.ndarray:
    """Overlapping and touching spans (start, end) as one."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.lexsort([spans[:, 1], spans[:, 0]])]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, spans[1:, 0] > reach[:-1])
    return np.column_stack([spans[new, 0], reach[np.append(np.flatnonzero(new)[1:] - 1, len(spans) - 1)]])


def _spans(starts: np.ndarray, offset: int) -> np.ndarray:
    """Spans of the windows at ``starts``, counted from ``offset``."""
    return merged(np.column_stack([starts, starts + SPAN])) + offset


_KEYS = ["k1", "k2"]


def _all_contexts(keyed: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text.encode() for text in batch.column(2).to_pylist()]
            for number, *found in contexts(texts):
                owner = batch.select(_KEYS).take(pa.array(number))
                columns = [pa.array(f.data, mask=np.ma.getmaskarray(f)) if np.ma.isMaskedArray(f) else pa.array(f) for f in found]
                yield pa.RecordBatch.from_arrays([*owner.columns, *columns], [*_KEYS, "start", "count", "anchor", "one", "two", "left", "right"])

    rows = keyed.filter(F.octet_length("text") >= SPAN).select(*_KEYS, "text")
    return rows.mapInArrow(run, "k1 long, k2 long, start long, count long, anchor long, one long, two long, left long, right long")


def _with_bytes(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """anchor, k1, k2, start, copies and the bytes of each wanted context."""
    by_doc = wanted.groupBy(*_KEYS).agg(F.collect_list(F.struct("anchor", "start", "count", "copies")).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for k1, k2, text, some in zip(*(batch.column(k).to_pylist() for k in range(4))):
                data = text.encode()
                for w in some:
                    row = (w["anchor"], k1, k2, w["start"], w["copies"], data[w["start"] : w["start"] + w["count"] + SPAN - 1])
                    for column, value in zip(columns, row):
                        column.append(value)
            types = [pa.int64()] * 5 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["anchor", *_KEYS, "start", "copies", "bytes"])

    joined = keyed.select(*_KEYS, "text").join(by_doc, _KEYS).select(*_KEYS, "text", "wanted")
    return joined.mapInArrow(run, "anchor long, k1 long, k2 long, start long, copies long, bytes binary")


def _indexed(rows: DataFrame) -> DataFrame:
    """Spans (k1, k2, start, end) of repeated windows, from the contexts of whole anchors."""
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])

    def search(held: list[dict]) -> pa.RecordBatch:
        found = [(row, _spans(starts, row["start"])) for row, starts in zip(held, repeated_windows([row["bytes"] for row in held])) if row["copies"] == 1]
        k1, k2 = ([row[k] for row, spans in found for _ in spans] for k in _KEYS)
        spans = np.concatenate([np.zeros((0, 2), np.int64), *(spans for _, spans in found)])
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (k1, k2, spans[:, 0], spans[:, 1])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0
        for batch in batches:
            for row in batch.to_pylist():
                if size >= BATCH and row["anchor"] != held[-1]["anchor"]:
                    yield search(held)
                    held, size = [], 0
                held.append(row)
                size += len(row["bytes"]) + 1
        if held:
            yield search(held)

    return rows.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "k1 long, k2 long, start long, end long")


def _counted(rows: DataFrame) -> DataFrame:
    """The same spans, by counting the windows of all contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes = np.frombuffer(row["bytes"], np.uint8)
                starts = np.arange(len(codes) - SPAN + 1)
                one, two = (Prefix(codes, k).of(starts, starts + SPAN).view(np.int64) for k in (0, 1))
                same = [pa.array(np.full(len(starts), row[k])) for k in ("k1", "k2", "copies")]
                yield pa.RecordBatch.from_arrays([*same, pa.array(starts + row["start"]), pa.array(one), pa.array(two)], ["k1", "k2", "copies", "start", "one", "two"])

    windows = written(rows.mapInArrow(run, "k1 long, k2 long, copies long, start long, one long, two long"), "windows")
    repeated = windows.groupBy("one", "two").agg(F.sum("copies").alias("n")).filter("n > 1")
    at = F.struct("one", "two").alias("at")
    found = windows.filter("copies = 1").select(*_KEYS, "start", at).join(repeated.select(at), "at", "left_semi")
    return found.select(*_KEYS, "start", (F.col("start") + SPAN).alias("end"))


def repeated_spans(keyed: DataFrame) -> DataFrame:
    """k1, k2, start, end (bytes): spans that cover what repeats, from k1, k2 and non-null text. They may overlap."""
    every = written(_all_contexts(keyed), "contexts")
    anchors = every.groupBy("anchor").agg(F.count(F.lit(1)).alias("rows"), F.min("one").alias("low"), F.max("one").alias("high")).filter("rows > 1")
    shared = anchors.select(F.struct("anchor").alias("at"), (F.col("low") != F.col("high")).alias("several"))
    rows = written(every.withColumn("at", F.struct("anchor")).join(shared, "at").drop("at"), "shared-contexts")
    kinds = ["anchor", "one", "two", "count"]
    first = [F.first(name).alias(name) for name in ("several", "left", "right")]
    distinct = rows.groupBy(*kinds).agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct(*_KEYS, "start")).alias("at"), *first)
    distinct = written(distinct, "distinct-contexts")
    copied = distinct.filter("copies > 1").select(F.struct(*kinds).alias("kind"))
    whole = rows.withColumn("kind", F.struct(*kinds)).join(copied, "kind", "left_semi")
    spans = whole.select(*_KEYS, "start", (F.col("start") + F.col("count") + SPAN - 1).alias("end"))

    several = distinct.filter("several")
    for side in ("left", "right"):
        halves = several.groupBy("anchor", side).agg(F.count(F.lit(1)).alias("n")).filter(F.col(side).isNotNull() & (F.col("n") > 1))
        same = halves.select(F.struct("anchor", side).alias("on"), F.lit(True).alias(f"same_{side}"))
        several = several.withColumn("on", F.struct("anchor", side)).join(same, "on", "left").drop("on")
    several = written(several.filter("same_left OR same_right"), "open-contexts")
    groups = several.groupBy("anchor").agg(F.count(F.lit(1)).alias("contexts"), F.min("copies").alias("least")).filter("contexts > 1 AND least = 1")
    open_ = several.withColumn("on", F.struct("anchor")).join(groups.select(F.struct("anchor").alias("on"), "contexts"), "on")
    wanted = open_.select("anchor", "at.k1", "at.k2", "at.start", "count", "copies")
    fetched = written(_with_bytes(keyed, wanted), "context-bytes")
    large = groups.filter(F.col("contexts") > MOST_CONTEXTS).select("anchor")
    found = spans.unionAll(_indexed(fetched.join(large, "anchor", "left_anti")))
    return found.unionAll(_counted(fetched.join(large, "anchor", "left_semi")))


def _with_spans(docs: DataFrame) -> DataFrame:
    """Every row's doc_id and text, with the spans to remove."""
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))
    one, two = fingerprint(doc_id, text)
    keyed = docs.select(doc_id.alias("doc_id"), text.alias("text"), one.alias("k1"), two.alias("k2"))
    spans = repeated_spans(keyed.select("k1", "k2", "text"))
    by_doc = spans.groupBy(*_KEYS).agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return keyed.join(written(by_doc, "spans"), _KEYS, "left").select("doc_id", "text", "spans")


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (the bytes left), kept_sha256.

    Texts are UTF-8 bytes, null counts as empty; a match stays inside a document. Every copy goes, the first as well.
    Rows that are equal are documents with the same text. What is left may cut a character in two, so it is bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, runs, kept = [], [], [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = text.encode()
                gone = merged(np.array([(s["start"], s["end"]) for s in spans or ()], np.int64).reshape(-1, 2))
                sizes.append(len(data))
                removed.append(int((gone[:, 1] - gone[:, 0]).sum()))
                runs.append(len(gone))
                borders = [0, *gone.ravel().tolist(), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(borders[::2], borders[1::2])))
            digests = pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())
            counts = [pa.array(x, pa.int64()) for x in (sizes, removed, runs)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array(kept, pa.binary()), digests], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]
            )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    return _with_spans(docs).mapInArrow(run, schema)
