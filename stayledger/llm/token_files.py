"""Token ids of a corpus in files: Simple-8b blocks in ascending document order, and the way back.

Documents are range-partitioned and sorted by doc_id, so every task writes one run of the order and no step sorts or
numbers everything in one place. A block holds whole documents, ``BLOCK_IDS`` ids or a little more (one very long
document makes one block). The container is Parquet, because only Spark's writers reach every store; a row is a block:

    part, block   place in the order: files of a part go before those of the next
    doc_ids       the documents of the block, in order
    counts        ids of each document
    frames        ids before each ``FRAME_WORDS``-th word, so a reader can start inside a block
    words         the ids, packed by :mod:`simple8b`, little endian
"""

from __future__ import annotations

import os
import string
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from . import simple8b
from .shingles import groups, words_of

if TYPE_CHECKING:
    from tokenizers import Tokenizer

BLOCK_IDS = 1 << 16
FRAME_WORDS = 1024
WORD_END = "</w>"  # the mark on a token that closes a word
KEPT_PARTS = 500_000  # known to a worker; beyond, it forgets those that did not come again
PARTS_TOGETHER = 300  # in a call of the library
TEXTS_TOGETHER = 1 << 23  # bytes of texts whose different words are looked up together
_BEFORE_MARKS = r"^[^!-/:-@\[-`{-~]+"  # what is not ASCII punctuation

BLOCK_SCHEMA = "part int, block int, doc_ids array<long>, counts array<long>, frames array<long>, words binary"


class WordEncoder:
    """Ids of texts by a tokenizer that drops white space and lets no token cross it.

    Words repeat, so each different one of many texts is looked up once. Letters with ASCII punctuation behind them are two
    pre-tokens, which are kept apart; ASCII letters are lower-cased before, as the tokenizer would, and go straight to the
    library's model. Anything else goes to the library as it stands.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core already
        from tokenizers import Tokenizer, pre_tokenizers

        self._library = Tokenizer.from_file(path)
        # Lower-case ASCII letters are single pre-tokens, which the normalizer and the byte alphabet leave as they are.
        self._letters = Tokenizer(self._library.model)
        self._letters.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self._library.get_vocab()
        self._closing = np.zeros(max(vocabulary.values()) + 1, bool)
        self._closing[[number for token, number in vocabulary.items() if token.endswith(WORD_END)]] = True
        # The number of each known part, and where its ids begin and how many it has.
        self._known = {"": 0}
        self._ids, self._first, self._count = np.zeros(0, "<u4"), np.zeros(1, np.int64), np.zeros(1, np.int64)
        self._again = np.zeros(1, bool)  # whether it was asked for since it was learned or others were forgotten

    def encode_many(self, texts: pa.Array | list[str]) -> Iterator[np.ndarray]:
        for some in groups(pa.array(texts, pa.string()) if isinstance(texts, list) else texts, TEXTS_TOGETHER):
            words, ends = words_of(some, lower=False)
            which = words.indices.to_numpy()
            ids, first, count = self._words(words.dictionary)
            flat, borders = _gathered(ids, first[which], count[which])
            borders = np.append(0, borders)[np.append(0, ends)].tolist()
            for start, stop in zip(borders, borders[1:]):
                yield flat[start:stop]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of different words, and for each word where its ids begin and how many it has."""
        letters = pc.utf8_rtrim(words, characters=string.punctuation)
        plain = pc.utf8_is_alpha(letters).to_numpy(zero_copy_only=False).copy()
        marked = pc.not_equal(letters, words).to_numpy(zero_copy_only=False)
        # A few letters become a letter and a mark of its own, which the punctuation would go with.
        special = ~pc.string_is_ascii(letters).to_numpy(zero_copy_only=False) & marked & plain
        plain[special] = [unicodedata.normalize("NFC", some).lower().isalpha() for some in letters.filter(pa.array(special)).to_pylist()]
        marked &= plain
        marks = pc.replace_substring_regex(words.filter(pa.array(marked)), _BEFORE_MARKS, "").dictionary_encode()
        letters = letters.filter(pa.array(plain))
        letters = pc.if_else(pc.string_is_ascii(letters), pc.ascii_lower(letters), letters).dictionary_encode()
        asked = (letters.dictionary, marks.dictionary, words.filter(pa.array(~plain)))
        parts, ends, others = (some.to_numpy(zero_copy_only=False).tolist() for some in asked)  # to_pylist takes ten times as long
        numbers = self._numbers(parts + ends, others)
        # Two parts for each word: its letters and the marks behind them, or the word as it stands and nothing.
        pair = np.zeros((len(words), 2), np.int64)
        pair[plain, 0] = numbers[: len(parts)][letters.indices.to_numpy()]
        pair[marked, 1] = numbers[len(parts) : len(parts) + len(ends)][marks.indices.to_numpy()]
        pair[~plain, 0] = numbers[len(parts) + len(ends) :]
        of_pair = self._count[pair]
        ids, _ = _gathered(self._ids, self._first[pair].ravel(), of_pair.ravel())
        count = of_pair.sum(axis=1)
        return ids, np.cumsum(count) - count, count

    def _numbers(self, parts: list[str], others: list[str]) -> np.ndarray:
        """Numbers of single pre-tokens and of words as they stand, in the known parts. Unknown ones are learned."""
        asked = parts + others
        if len(self._known) > KEPT_PARTS:
            self._forget(asked)
        numbers = np.array(list(map(self._known.get, asked, repeat(-1))), np.int64)
        self._again[numbers[numbers >= 0]] = True
        new = np.flatnonzero(numbers < 0).tolist()
        single, whole = [k for k in new if k < len(parts)], [k for k in new if k >= len(parts)]
        letters = [k for k in single if asked[k].isascii() and asked[k].isalpha()]
        single = sorted(set(single).difference(letters))
        new = letters + single + whole
        learned = [
            *self._encode_parts(self._letters, [asked[k] for k in letters]),
            *self._encode_parts(self._library, [asked[k] for k in single]),
            *self._encode_each([asked[k] for k in whole]),
        ]
        if learned:
            numbers[new] = len(self._count) + np.arange(len(new))
            self._known.update(zip((asked[k] for k in new), numbers[new].tolist()))
            self._ids = np.concatenate([self._ids, *(ids for ids, _ in learned)])
            self._count = np.concatenate([self._count, *(count for _, count in learned)])
            self._first = np.cumsum(self._count) - self._count
            self._again = np.concatenate([self._again, np.zeros(len(new), bool)])
        return numbers

    def _forget(self, asked: list[str]) -> None:
        """Only those of the known parts that came again or are asked for now stay known."""
        known = self._known
        self._again[[0, *(known[part] for part in asked if part in known)]] = True
        again = self._again.tobytes()
        kept = [part for part, number in known.items() if again[number]]
        numbers = np.array([known[part] for part in kept])
        self._count = self._count[numbers]
        self._ids, ends = _gathered(self._ids, self._first[numbers], self._count)
        self._first, self._again = ends - self._count, np.zeros(len(kept), bool)
        self._known = dict(zip(kept, range(len(kept))))

    def _encode_parts(self, tokenizer: Tokenizer, parts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids and their numbers, of many pre-tokens in one call: the last id of each closes a word, which tells them apart.
        If their number is not right, the library cuts one of them differently, and each is encoded by itself."""
        for at in range(0, len(parts), PARTS_TOGETHER):
            some = parts[at : at + PARTS_TOGETHER]
            ids = np.array(tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self._closing[ids]) + 1
            if len(ends) == len(some):
                yield ids, np.diff(ends, prepend=0)
            else:
                yield from self._encode_each(some)

    def _encode_each(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for at in range(0, len(words), PARTS_TOGETHER):
            found = [x.ids for x in self._library.encode_batch_fast(words[at : at + PARTS_TOGETHER], add_special_tokens=False)]
            yield np.array([number for ids in found for number in ids], "<u4"), np.array([len(ids) for ids in found], np.int64)


def _gathered(ids: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``count`` ids from each of the places ``first`` on, one after another, and where those of each place end."""
    ends = np.cumsum(count)
    return ids[np.repeat(first - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)], ends


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str) -> None:
    """Encode ``text`` of every document, append ``end_id``, and write blocks in ascending doc_id order to ``folder``.

    A null text is empty, so its document is the end id alone. Documents without doc_id come last; rows of the same
    doc_id are ordered by their text's hash and equal ones are both written. Only doc_id and text are used.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc()]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, size = TaskContext.get().partitionId(), 0, 0
        names: list[int | None] = []
        held: list[np.ndarray] = []

        def made() -> pa.RecordBatch:
            counts = [len(ids) for ids in held]
            words = simple8b.pack(np.concatenate(held))
            per_word = simple8b.values_per_word(words)
            frames = (np.cumsum(per_word) - per_word)[::FRAME_WORDS]
            columns = [[part], [block], [names], [counts], [frames.tolist()], [words.astype("<u8").tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)

        end = np.array([end_id], np.uint32)
        for batch in batches:
            encoded = word_encoder(tokenizer).encode_many(batch.column(1))
            for name, ids in zip(batch.column(0).to_pylist(), encoded):
                names.append(name)
                held.append(np.concatenate([ids, end]))
                size += len(ids) + 1
                if size >= BLOCK_IDS:
                    yield made()
                    block, size, names, held = block + 1, 0, [], []
        if held:
            yield made()

    ranged.mapInArrow(run, BLOCK_SCHEMA).write.mode("overwrite").parquet(folder)


_ARROW = pa.schema(
    [
        ("part", pa.int32()), ("block", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
        ("frames", pa.list_(pa.int64())), ("words", pa.binary()),
    ]
)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of the files at ``folder``: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of
    the ids as little-endian unsigned 32-bit integers), ids (those bytes)."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(folder)
    sizes = blocks.select("part", "block", F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b).alias("n"))
    before = (Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))  # a row per file, so one task orders them
    parts = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(*before)), F.lit(0)).alias("_part"))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(*before)
    starts = sizes.select("part", "block", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("_block")).join(parts, "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.array(row["counts"], np.int64)
                ids = simple8b.unpack(np.frombuffer(row["words"], "<u8"), int(counts.sum())).astype("<u4")
                ends = np.cumsum(counts)
                data = [ids[a:b].tobytes() for a, b in zip((ends - counts).tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * len(data), pa.int32()),
                        pa.array([row["block"]] * len(data), pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(ends - counts, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array([zlib.crc32(x) for x in data], pa.int64()),
                        pa.array(data, pa.binary()),
                    ],
                    ["part", "block", "doc_id", "_in_block", "n_tokens", "ids_crc32", "ids"],
                )

    found = blocks.select("part", "block", "doc_ids", "counts", "words").mapInArrow(
        run, "part int, block int, doc_id long, _in_block long, n_tokens long, ids_crc32 long, ids binary"
    )
    start = (F.col("_part") + F.col("_block") + F.col("_in_block")).alias("start")
    return found.join(starts, ["part", "block"]).select("doc_id", start, "n_tokens", "ids_crc32", "ids")
