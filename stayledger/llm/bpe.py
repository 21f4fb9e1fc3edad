"""Byte-level BPE: encode texts to token ids by a rank file, and decode ids back to bytes.

Pre-tokens are linked lists of parts. Every pair of neighbours that has a rank lies in the bucket of that rank, and a
three-level bitmap over the ranks says which buckets are in use, so finding the next rank is three find-first-set
steps however many pairs wait. Entries that a later merge has made stale are skipped when they come up. A pre-token of
n bytes takes O(n log n) steps, also when a text of megabytes holds no space; many short ones share one queue, so that
a bucket is worked off in one go.

Spark splits the rows; a task encodes whole texts one after another and keeps a bounded cache of pre-tokens. No rows
are shuffled.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

KEPT_ENTRIES = 100_000  # per generation of a worker's caches
LONGEST_KEPT = 64  # characters; longer pieces are encoded each time they come
TEXTS_TOGETHER = 1 << 20  # characters of texts whose unknown pieces are encoded together
MERGED_TOGETHER = 1 << 14  # bytes of pieces that share one queue, few enough for a processor's cache


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class RankQueue:
    """Positions by rank: a bucket per rank in use and a bitmap of three levels of 64-bit words over the ranks."""

    __slots__ = ("buckets", "_low", "_middle", "_top")

    def __init__(self) -> None:
        self.buckets: dict[int, list[int]] = {}
        self._low: dict[int, int] = {}
        self._middle: dict[int, int] = {}
        self._top = 0

    def open(self, rank: int, positions: list[int]) -> None:
        """Start the bucket of a rank that has none."""
        self.buckets[rank] = positions
        word, group = rank >> 6, rank >> 12
        self._low[word] = self._low.get(word, 0) | 1 << (rank & 63)
        self._middle[group] = self._middle.get(group, 0) | 1 << (word & 63)
        self._top |= 1 << group

    def take(self) -> tuple[int, list[int]] | None:
        """The lowest rank in use with its bucket, which is removed; None when all are empty."""
        if not self._top:
            return None
        group = (self._top & -self._top).bit_length() - 1
        bits = self._middle[group]
        word = group << 6 | (bits & -bits).bit_length() - 1
        bits = self._low[word]
        rank = word << 6 | (bits & -bits).bit_length() - 1
        self._low[word] &= bits - 1
        if not self._low[word]:
            self._middle[group] &= self._middle[group] - 1
            if not self._middle[group]:
                self._top &= self._top - 1
        return rank, self.buckets.pop(rank)


def _by_value(values: np.ndarray) -> Iterator[tuple[int, list[int]]]:
    """Every value from 0 up with the places where it stands."""
    order = np.argsort(values, kind="stable")
    order = order[np.searchsorted(values[order], 0) :]
    if len(order):
        cuts = np.flatnonzero(np.diff(values[order])) + 1
        for places in np.split(order, cuts):
            yield int(values[places[0]]), places.tolist()


def rank_table(ranks: dict[bytes, int]) -> np.ndarray:
    """Rank of each pair of single bytes, -1 for none."""
    table = np.full(1 << 16, -1, np.int64)
    for token, rank in ranks.items():
        if len(token) == 2:
            table[token[0] << 8 | token[1]] = rank
    return table


def merge_all(pieces: list[bytes], ranks: dict[bytes, int], pair_ranks: np.ndarray) -> list[list[int]]:
    """Token ids of each pre-token."""
    ids, borders = merge_flat(pieces, ranks, pair_ranks)
    return [part.tolist() for part in np.split(ids, borders[:-1])] if len(borders) else []


def merge_flat(pieces: list[bytes], ranks: dict[bytes, int], pair_ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of the pre-tokens one after another and where each one's end, all merged in one linked list that no
    pair crosses from piece to piece.

    Pieces are not empty. A rank's bucket is worked off from left to right. If a merge makes a pair of a lower rank,
    which must come first, the rest of the bucket that belongs to the same piece goes back into the queue. A piece
    that is a token itself is not taken apart.
    """
    joined = b"".join(pieces)
    sizes = np.array([len(piece) for piece in pieces], np.int64)
    lasts = np.cumsum(sizes)
    stop = np.repeat(lasts, sizes)  # end of the piece around a part's start
    rank_of = ranks.get
    single = np.array([rank_of(piece, -1) for piece in pieces], np.int64)
    whole = np.repeat(single >= 0, sizes)
    firsts = lasts - sizes
    codes = np.frombuffer(joined, np.uint8).astype(np.int64)
    tokens = np.array([rank_of(bytes([code]), -2) for code in range(256)], np.int64)[codes]  # of the part at i, -1 for none, -2 for an unknown byte
    tokens[whole] = -1
    tokens[firsts[single >= 0]] = single[single >= 0]
    pairs = np.full(len(joined), -1, np.int64)  # rank of the pair that starts at i, -1 for none
    pairs[:-1] = pair_ranks[codes[:-1] << 8 | codes[1:]]
    pairs[lasts - 1] = -1
    pairs[whole] = -1
    ends = np.arange(1, len(joined) + 1)  # part at i: joined[i:ends[i]]; the next part starts there
    ends[whole] = stop[whole]
    before = np.arange(-1, len(joined))
    before[firsts] = -1
    queue = RankQueue()
    for rank, positions in _by_value(pairs):
        queue.open(rank, positions)
    ends, before, current, stop, tokens = ends.tolist(), before.tolist(), pairs.tolist(), stop.tolist(), tokens.tolist()
    buckets = queue.buckets
    while (found := queue.take()) is not None:
        rank, bucket = found
        bucket.sort()
        held = -1
        for i in bucket:
            if current[i] != rank:
                continue  # stale: a neighbour was merged meanwhile
            if i < held:
                if rank in buckets:
                    buckets[rank].append(i)
                else:
                    queue.open(rank, [i])
                continue
            last = stop[i]
            j = ends[i]
            end = ends[i] = ends[j]
            current[j] = current[i] = tokens[j] = -1
            tokens[i] = rank
            left = before[i]
            if end < last:
                before[end] = i
                new = rank_of(joined[i : ends[end]])
                if new is not None:
                    current[i] = new
                    if new in buckets:
                        buckets[new].append(i)
                    else:
                        queue.open(new, [i])
                    if new < rank:
                        held = last
            if left >= 0:
                new = rank_of(joined[left:end])
                if new is None:
                    current[left] = -1
                else:
                    current[left] = new
                    if new in buckets:
                        buckets[new].append(left)
                    else:
                        queue.open(new, [left])
                    if new < rank:
                        held = last
    ids = np.array(tokens, np.int64)
    if (ids == -2).any():
        raise KeyError(joined[int(np.argmax(ids == -2))])
    left = ids >= 0
    return ids[left].astype("<u4"), np.cumsum(left)[lasts - 1]


class _Kept:
    """Results of short keys in two generations: when the young one is full it becomes the old one, which is dropped."""

    def __init__(self) -> None:
        self.young: dict[str, bytes | None] = {}
        self.old: dict[str, bytes | None] = {}

    def missing(self, keys: Iterable[str]) -> list[str]:
        """The keys without a result, once each. Those of the old generation move to the young one."""
        absent = set(keys).difference(self.young)
        old = self.old
        known = [key for key in absent if key in old]
        self.young.update((key, old[key]) for key in known)
        return list(absent.difference(known))

    def trim(self, fresh: Iterable[str]) -> None:
        for key in fresh:
            if len(key) > LONGEST_KEPT:
                del self.young[key]
        if len(self.young) > KEPT_ENTRIES:
            self.young, self.old = {}, self.young


# White space, or the mark that units are cut at, where a unit of one visible word has none.
_UNUSUAL = re.compile(r".\s|.[\x00\x1c-\x1f]|\A[^\S \n]|\A ?\Z", re.DOTALL)
# Latin letters with a space before and common punctuation behind them, which the pattern below cuts before the
# punctuation only.
_PLAIN = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ɏ]+)([.,;:!?]*)")
_CUTS_PLAIN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Texts to ids and back for one rank file and pre-token pattern. Ids are little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str, pattern: str) -> None:
        self.ranks = read_ranks(path)
        by_rank = dict(sorted((rank, token) for token, rank in self.ranks.items()))
        self._flat = np.frombuffer(b"".join(by_rank.values()), np.uint8)
        self._lengths = np.zeros(max(by_rank) + 1, np.int64)
        self._lengths[list(by_rank)] = [len(token) for token in by_rank.values()]
        self._starts = np.cumsum(self._lengths) - self._lengths
        self._pairs = rank_table(self.ranks)
        self._find = regex.compile(pattern).findall
        self._plain = _PLAIN.fullmatch if pattern == _CUTS_PLAIN else None
        self._pieces, self._units = _Kept(), _Kept()

    def _learn(self, units: Iterable[str]) -> tuple[list[str], list[str]]:
        """Encode the units that are not known yet, their unknown pre-tokens together; a unit that holds unusual white
        space gets None. Returns the new units and pre-tokens."""
        fresh = self._units.missing(units)
        split: list[Sequence[str] | None] = []
        for unit in fresh:
            if self._plain and (two := self._plain(unit)):
                split.append(two.groups() if two[2] else (unit,))
            else:
                split.append(None if _UNUSUAL.search(unit) else self._find(unit))
        pieces = self._merge(chain.from_iterable(found for found in split if found))
        known, learned = self._pieces.young, self._units.young
        for unit, found in zip(fresh, split):
            if found is None:
                learned[unit] = None
            elif len(found) == 1:
                learned[unit] = known[found[0]]
            else:
                learned[unit] = b"".join([known[piece] for piece in found])
        return fresh, pieces

    def _merge(self, pieces: Iterable[str]) -> list[str]:
        fresh = self._pieces.missing(pieces)
        if fresh:
            spelled = [piece.encode() for piece in fresh]
            which = np.cumsum([len(piece) for piece in spelled]) // MERGED_TOGETHER
            cuts = [0, *(np.flatnonzero(np.diff(which)) + 1).tolist(), len(fresh)]
            for start, stop in zip(cuts, cuts[1:]):
                ids, borders = merge_flat(spelled[start:stop], self.ranks, self._pairs)
                data, borders = ids.tobytes(), (borders * 4).tolist()
                self._pieces.young.update((piece, data[a:b]) for piece, a, b in zip(fresh[start:stop], [0, *borders], borders))
        return fresh

    def encode_many(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text, in order.

        No pre-token goes across a single space or line feed between visible characters: it starts at the space, and
        a lone line feed is one by itself. Texts are cut there and the units looked up; a text with other white space
        is cut by the pattern as a whole.
        """
        group, size = [], 0
        for text in chain(texts, [None]):
            if text is not None:
                group.append(text)
                size += len(text)
            if text is None or size > TEXTS_TOGETHER:
                yield from self._encode_group(group)
                group, size = [], 0

    def _encode_group(self, texts: list[str]) -> Iterator[bytes]:
        cut = [[] if "\x00" in text else text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00") for text in texts]
        units, pieces = self._learn(chain.from_iterable(cut))
        unit, piece = self._units.young.__getitem__, self._pieces.young.__getitem__
        for text, parts in zip(texts, cut):
            try:
                made = b"".join(map(unit, parts))
            except TypeError:  # a unit without ids of its own
                parts = []
            if not parts:
                found = self._find(text)
                pieces += self._merge(found)
                made = b"".join(map(piece, found))
            yield made
        self._units.trim(units)
        self._pieces.trim(pieces)

    def decode(self, ids: bytes) -> bytes:
        which = np.frombuffer(ids, "<u4")
        lengths = self._lengths[which]
        ends = np.cumsum(lengths)
        if not len(ends):
            return b""
        return self._flat[np.repeat(self._starts[which] - ends + lengths, lengths) + np.arange(ends[-1])].tobytes()


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return Encoder(path, pattern)


def encode_texts(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Append the ids of every whole text as a binary column ``ids``; it takes the place of a column of that name.

    A null text counts as empty, and an empty text has no ids. Equal texts get equal ids. Special tokens do not
    exist: their spelling is ordinary text. ``path`` must be readable on every executor.
    """
    kept = [name for name in df.columns if name != ids]
    schema = df.select(*kept).schema.add(ids, "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            values = batch.column(text).to_pylist()
            made = pa.array(own.encode_many(value or "" for value in values), pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in kept), made], [*kept, ids])

    return df.mapInArrow(run, schema)


def decode_ids(df: DataFrame, path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Append the bytes that ``ids`` stand for as a binary column. Null ids count as none; an unknown id is an error."""
    kept = [name for name in df.columns if name != decoded]
    schema = df.select(*kept).schema.add(decoded, "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = encoder(path, pattern).decode
        for batch in batches:
            made = pa.array([decode(value or b"") for value in batch.column(ids).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in kept), made], [*kept, decoded])

    return df.mapInArrow(run, schema)


def token_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256, from one pass that encodes and decodes.

    Rows are kept as they are: repeated rows, null ids and null texts (empty) give a row each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            for made in own.encode_many(value or "" for value in batch.column(1).to_pylist()):
                counts.append(len(made) // 4)
                of_ids.append(hashlib.sha256(made).hexdigest())
                of_bytes.append(hashlib.sha256(own.decode(made)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(docs.doc_id.cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
