"""Score texts with a bitwise model that mixes several hashed contexts, and with a smoothed unigram model.

The text is a sequence of words, each spelled in bytes and closed by a space, with a line feed for the end. A byte is
eight binary decisions. For every decision, each of the contexts (the last one, two, three and five bytes, and the whole
word so far, together with the bits already known) points by hash at a slot that counts zeros and ones. The counts become
logits, which a weight vector combines; the vector is gated by the bit's place, by how often the word so far has been
seen, and if it has not, by how many of the other contexts have. The contexts of bytes go on across the space into the
words before; of these the longest sees ``HEAD`` bytes before the space.
An adaptive map from the mixed probability and the gate to what really happened refines the result. The sum of the
decisions' logarithms is the text's log probability, so its bits per byte follow.

The first ``HEAD`` bytes of a word are predicted with bytes before the word in sight, the others from the word alone. So
the cost of a text is a sum over two kinds of things that repeat, the rests of words and their starts: a start is one
of the first bytes with the ``HEAD`` bytes before it, the space left out, and where the space stands. Training and
scoring work on tables of different words and starts with their counts, over all documents, never on a sample:

1. Documents are read, and words and starts counted in training documents. Summed over all, that is the vocabulary.
2. Slots are counted over the vocabulary: tables per task, added block by block.
3. Weights are learned online over the vocabulary, in every partition for itself from the same start, and averaged by
   the bytes each has seen; the adaptive map is counted on the way. A word or start is predicted without one of its own
   occurrences, as if it were met for the last time.
4. Documents are read again, in chunks: each gives its different words, for each document which of them it has how
   often, and what its starts cost, which are so few that each task works them out for itself.
5. Every word's count and the cost of its rest go to the chunks that have it, which add them up per document.

The tables have a fixed size (``SLOTS`` per context), so what goes to each executor is bounded; the vocabulary is only
ever partitioned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .language import remainder
from .shingles import groups, mixed, words_of
from .storage import written

SLOTS = 1 << 18
RARE = 23  # in the context of the whole word, words below 1 / 2**23 of all tokens, and those met once, take no slots
ORDERS = (1, 2, 3, 5)  # bytes of the contexts, besides the whole word so far
CONTEXTS = len(ORDERS) + 1
HEAD = max(ORDERS) - 1  # first bytes of a word, whose contexts go on across the space
SEEN = (1, 2, 4, 16, 128)  # steps of how often the word so far has been seen
GATES = 8 * (CONTEXTS + len(SEEN))
LEVELS = 33  # steps of the adaptive map
TABLE_BLOCK = 1 << 15
CHUNK_BYTES = 1 << 24
STEP_BYTES = 1 << 14  # bytes of words worked on together
PRIOR = 0.4  # of each count
KEPT_STARTS = 1 << 20  # whose counts or costs a task holds at a time
RATE = 0.02
SPACE, END = 32, 10

_BYTE_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Priced:
    """Bytes to predict, with the hashes of their contexts: ``bytes``, their ``counts``, and whose each is."""

    bytes: np.ndarray
    counts: np.ndarray
    _hashes: list[np.ndarray]

    def whole(self, rare: int) -> np.ndarray:
        """Which bytes take slots in the context of the whole word so far."""
        return np.ones(len(self.bytes), bool)

    def decisions(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each bit, highest first: its number, its value, and the slot of each context."""
        known = np.ones(len(self.bytes), np.uint64)
        shift = np.uint64(64 - (SLOTS.bit_length() - 1))
        for k in range(8):
            bit = self.bytes >> (7 - k) & 1
            slots = np.stack([(mixed(h ^ known * np.uint64(0xD6E8FEB86659FD93)) >> shift).astype(np.int64) for h in self._hashes])
            yield k, bit, slots
            known = known << np.uint64(1) | bit.astype(np.uint64)


class Spelled(Priced):
    """Words spelled in bytes, with nothing before them; ``rests`` leaves out the first ``HEAD`` bytes of each."""

    def __init__(self, words: list[bytes], counts: np.ndarray, rests: bool = False) -> None:
        spelled = [word if word == b"\n" else word + b" " for word in words]
        sizes = np.array([len(s) for s in spelled], np.int64)
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8).astype(np.int64)
        self.word = np.repeat(np.arange(len(words)), sizes)
        begin = np.cumsum(sizes) - sizes
        place = np.arange(len(self.bytes)) - begin[self.word]
        codes = self.bytes.astype(np.uint64) + np.uint64(1)
        powers = np.ones(int(sizes.max(initial=1)) + 1, np.uint64)
        np.multiply.accumulate(np.full(len(powers) - 1, _BYTE_FACTOR), out=powers[1:])
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(mixed(codes) * powers[place], out=sums[1:])
        at = np.flatnonzero(place >= HEAD) if rests else np.arange(len(codes))
        place, word = place[at], self.word[at]
        hashes = []
        for order in ORDERS:
            found = np.full(len(at), order, np.uint64)
            for back in range(1, order + 1):
                found = found * _BYTE_FACTOR + np.where(place < back, np.uint64(0), codes[np.maximum(at - back, 0)])
            hashes.append(mixed(found))
        hashes.append(mixed(sums[at] - sums[begin[word]] + np.uint64(len(ORDERS) * 1000)))
        self.bytes, self.word, self.counts, self._hashes = self.bytes[at], word, counts[word], hashes

    def whole(self, rare: int) -> np.ndarray:
        return self.counts >= rare


class Starts(Priced):
    """Bytes at the start of words, from numbers of ``starts_of``."""

    def __init__(self, starts: np.ndarray, counts: np.ndarray) -> None:
        place = starts >> 8 * (HEAD + 1)
        self.bytes = starts & 255
        self.counts = counts
        hashes = []
        for order in ORDERS:
            found = np.full(len(starts), order, np.uint64)
            for back in range(1, order + 1):
                inside = starts >> 8 * back & 255
                outside = starts >> 8 * (back - 1) & 255
                code = np.where(back <= place, inside + 1, np.where((back > place + 1) & (outside > 0), outside + 1, 0))
                found = found * _BYTE_FACTOR + code.astype(np.uint64)
            hashes.append(mixed(found))
        so_far = np.zeros(len(starts), np.uint64)
        for earlier in range(HEAD - 1):
            code = (starts >> 8 * np.maximum(place - earlier, 0) & 255) + 1
            power = np.uint64(pow(int(_BYTE_FACTOR), earlier, 1 << 64))
            so_far += np.where(earlier < place, mixed(code.astype(np.uint64)) * power, np.uint64(0))
        hashes.append(mixed(so_far + np.uint64(len(ORDERS) * 1000)))
        self._hashes = hashes


def starts_of(words: pa.DictionaryArray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The starts in some texts, given as by ``words_of``, and the text of each.

    A start's number holds, from the lowest byte up, the byte, those before it as far as ``HEAD`` without the space
    before the word (zeros before the text), and above them the byte's place in the word. A word is closed by a space,
    a text by a word of one line feed.
    """
    spelled = words.dictionary.cast(pa.binary())
    offsets = np.frombuffer(spelled.buffers()[1], np.int32, len(spelled) + 1, spelled.offset * 4).astype(np.int64) if len(spelled) else np.zeros(1, np.int64)
    data = np.frombuffer(spelled.buffers()[2], np.uint8) if len(spelled) else np.zeros(1, np.uint8)
    sizes = np.diff(offsets)
    head, own = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for k in range(HEAD):
        first = data[np.minimum(offsets[:-1] + k, len(data) - 1)]
        head = head << 8 | np.where(k < sizes, first, np.where(k == sizes, SPACE, 0))
        last = data[np.maximum(offsets[1:] - 1 - k, 0)].astype(np.int64)
        own |= np.where(k < sizes, last, 0) << 8 * k
    which = words.indices.to_numpy()
    size, own = sizes[which], own[which]
    counts = np.diff(ends, prepend=0)
    owner = np.repeat(np.arange(len(ends)), counts)
    opens = np.zeros(len(which), bool)
    opens[(ends - counts)[counts > 0]] = True
    # A short word leaves room for the space before it and, at most, two bytes that the word before that ends with.
    near = np.where((size == 1) & ~opens, SPACE << 8 | own, own) & 0xFFFF
    tail = np.where((size < HEAD) & ~opens, (np.roll(near, 1) << 8 | SPACE) << 8 * np.minimum(size, HEAD) | own, own) & ((1 << 8 * HEAD) - 1)
    before = np.where(opens, 0, np.roll(tail, 1))
    found, texts = [], []
    for place in range(HEAD):
        has = size >= place
        rest = (before[has] & (1 << 8 * (HEAD - place)) - 1) << 8 * (place + 1)
        found.append(place << 8 * (HEAD + 1) | rest | head[which[has]] >> 8 * (HEAD - 1 - place))
        texts.append(owner[has])
    last = np.zeros(len(ends), np.int64)
    last[counts > 0] = tail[ends[counts > 0] - 1]
    return np.concatenate([*found, last << 8 | END]), np.concatenate([*texts, np.arange(len(ends))])


def _rests(words: list[bytes], counts: np.ndarray) -> Iterator[tuple[slice, Spelled]]:
    start, size = 0, 0
    for i, word in enumerate(words):
        size += max(len(word) + 1 - HEAD, 0)
        if size >= STEP_BYTES or i == len(words) - 1:
            yield slice(start, i + 1), Spelled(words[start : i + 1], counts[start : i + 1], rests=True)
            start, size = i + 1, 0


def _parts(batch: pa.RecordBatch) -> Iterator[Priced]:
    """The rests of the words and the starts among rows of a vocabulary."""
    words = batch.filter(batch.column("word").is_valid())
    for _, spelled in _rests(words.column("word").to_pylist(), words.column("count").to_numpy().astype(np.float64)):
        if len(spelled.bytes):
            yield spelled
    starts = batch.filter(batch.column("start").is_valid())
    number, counts = starts.column("start").to_numpy(), starts.column("count").to_numpy().astype(np.float64)
    for at in range(0, len(number), STEP_BYTES):
        yield Starts(number[at : at + STEP_BYTES], counts[at : at + STEP_BYTES])


class Mixer:
    """Slot counts, gated weights and the adaptive map."""

    def __init__(self, table: np.ndarray, rare: int) -> None:
        self.table = table  # context, slot, bit
        self.rare = rare  # words of fewer occurrences have no slots for the whole word
        self.weights = np.full((GATES, CONTEXTS), 0.3, np.float32)
        self.refined: np.ndarray | None = None  # gate, level: probability of a one
        self._ready: tuple[np.ndarray, ...] | None = None  # of every slot: logit, whether met, step of how often

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_ready": None}

    def inputs(self, k: int, bit: np.ndarray, slots: np.ndarray, priced: Priced | None) -> tuple[np.ndarray, np.ndarray]:
        """Logits of the contexts, and the gate. With ``priced``, one occurrence of each of its bytes is left out."""
        if priced is None:
            if self._ready is None:
                self._ready = self._inputs(self.table[..., 0], self.table[..., 1])
            every, met, step = self._ready
            logits = np.stack([every[c][slots[c]] for c in range(CONTEXTS)])
            others, seen = sum(met[c][slots[c]] for c in range(CONTEXTS - 1)), step[slots[-1]]
        else:
            zeros = np.stack([self.table[c, slots[c], 0] for c in range(CONTEXTS)])
            ones = np.stack([self.table[c, slots[c], 1] for c in range(CONTEXTS)])
            out = np.ones(zeros.shape, np.float32)
            out[-1] = priced.whole(self.rare)
            logits, met, seen = self._inputs(np.maximum(zeros - out * (1 - bit), 0), np.maximum(ones - out * bit, 0))
            others = met.sum(axis=0)
        return logits, k * (CONTEXTS + len(SEEN)) + np.where(seen > 0, CONTEXTS - 1 + seen, others)

    @staticmethod
    def _inputs(zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        logits = np.log((ones + np.float32(PRIOR)) / (zeros + np.float32(PRIOR))).clip(-12, 12)
        total = zeros + ones
        return logits, (total[:-1] >= 1).astype(np.int8), np.searchsorted(SEEN, total[-1], side="right").astype(np.int8)

    def mixed_logit(self, logits: np.ndarray, gate: np.ndarray) -> np.ndarray:
        return np.einsum("cn,nc->n", logits, self.weights[gate]).clip(-12, 12)

    def probability(self, logits: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """Of a one, never 0 or 1."""
        logit = self.mixed_logit(logits, gate)
        found = 1 / (1 + np.exp(-logit.astype(np.float64)))
        if self.refined is not None:
            found = (found + self.refined[gate, level(logit)]) / 2
        return found.clip(1e-6, 1 - 1e-6)

    def _costs(self, priced: Priced) -> np.ndarray:
        """Log probability of each byte."""
        total = np.zeros(len(priced.bytes))
        for k, bit, slots in priced.decisions():
            one = self.probability(*self.inputs(k, bit, slots, None))
            total += np.log10(np.where(bit == 1, one, 1 - one))
        return total

    def log10(self, words: list[bytes]) -> np.ndarray:
        """Log probability of the rest of each word with its closing space."""
        out = np.zeros(len(words))
        for place, spelled in _rests(words, np.ones(len(words))):
            out[place] = np.bincount(spelled.word, self._costs(spelled), place.stop - place.start)
        return out

    def log10_starts(self, starts: np.ndarray) -> np.ndarray:
        steps = range(0, len(starts), STEP_BYTES)
        return np.concatenate([np.zeros(0), *(self._costs(Starts(part, np.ones(len(part)))) for part in (starts[at : at + STEP_BYTES] for at in steps))])


def level(logit: np.ndarray) -> np.ndarray:
    return np.rint((logit + 12) * ((LEVELS - 1) / 24)).astype(np.int64)


def _count_slots(vocabulary: DataFrame, rare: int) -> np.ndarray:
    """Zeros and ones of every slot of every context, over all training tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((CONTEXTS, SLOTS * 2), np.int64)
        for batch in batches:
            for priced in _parts(batch):
                weight = priced.counts.astype(np.int64)
                of_words = np.where(priced.whole(rare), weight, 0)
                for _, bit, slots in priced.decisions():
                    for c in range(CONTEXTS):
                        np.add.at(table[c], slots[c] * 2 + bit, weight if c < CONTEXTS - 1 else of_words)
        flat = table.ravel()
        for start in range(0, len(flat), TABLE_BLOCK):
            part = flat[start : start + TABLE_BLOCK]
            if part.any():
                part = part.astype(np.int32) if part.max() < 1 << 31 else part  # told apart by their length
                yield pa.RecordBatch.from_arrays([pa.array([start]), pa.array([part.tobytes()], pa.binary())], ["start", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(TABLE_BLOCK, np.int64)
        for counts in table["counts"].to_pylist():
            total += np.frombuffer(counts, np.int32 if len(counts) == 4 * TABLE_BLOCK else np.int64)
        return pa.table({"start": table["start"].slice(0, 1), "counts": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    blocks = vocabulary.filter("count > 0").mapInArrow(run, "start long, counts binary")
    out = np.zeros(CONTEXTS * SLOTS * 2, np.float32)
    for row in blocks.groupBy("start").applyInArrow(add, "start long, counts binary").toLocalIterator():
        out[row.start : row.start + TABLE_BLOCK] = np.frombuffer(row.counts, np.float32)
    return out.reshape(CONTEXTS, SLOTS, 2)


def _learn(vocabulary: DataFrame, mixer) -> tuple[np.ndarray, np.ndarray]:
    """Weights after one online pass in each partition, averaged by the bytes it has seen; and the adaptive map, what share of ones
    came at each gate and level of the mixed logit during that pass, shrunk towards the level's own probability."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Mixer(mixer.value.table, mixer.value.rare)
        own.weights = mixer.value.weights.copy()
        scale = np.full(own.weights.shape, 1e-4, np.float32)
        came = np.zeros((2, GATES * LEVELS))
        seen = 0.0
        for batch in batches:
            for priced in _parts(batch):
                seen += float(priced.counts.sum())
                for k, bit, slots in priced.decisions():
                    logits, gate = own.inputs(k, bit, slots, priced)
                    logit = own.mixed_logit(logits, gate)
                    at = gate * LEVELS + level(logit)
                    came[1] += np.bincount(at, priced.counts * bit, came.shape[1])
                    came[0] += np.bincount(at, priced.counts * (1 - bit), came.shape[1])
                    error = (bit - 1 / (1 + np.exp(-logit))) * priced.counts
                    mass = np.bincount(gate, priced.counts, GATES)
                    slope = np.stack([np.bincount(gate, error * logits[c], GATES) for c in range(CONTEXTS)], axis=1)
                    slope /= np.maximum(mass, 1e-9)[:, None]
                    met = mass > 0
                    scale[met] = 0.95 * scale[met] + 0.05 * slope[met] ** 2
                    own.weights[met] += RATE * slope[met] / np.sqrt(scale[met])
                    own.weights = own.weights.clip(-2, 4).astype(np.float32)
        if seen:
            sums = np.concatenate([own.weights.ravel() * seen, came[0], came[1], [seen]])
            yield pa.RecordBatch.from_arrays([pa.array([sums.tolist()], pa.list_(pa.float64()))], ["sums"])

    learned = vocabulary.filter("count > 0").mapInArrow(run, "sums array<double>").select(F.posexplode("sums").alias("cell", "value"))
    start, cells = GATES * CONTEXTS, GATES * LEVELS
    total = np.zeros(start + 2 * cells + 1)
    for row in learned.groupBy("cell").agg(F.sum("value").alias("value")).collect():  # a fixed number of rows
        total[row.cell] = row.value
    weights = (total[:start] / total[-1]).reshape(GATES, CONTEXTS).astype(np.float32) if total[-1] else mixer.value.weights
    zeros, ones = total[start : start + cells], total[start + cells : -1]
    own = np.tile(1 / (1 + np.exp(-(np.arange(LEVELS) * (24 / (LEVELS - 1)) - 12))), GATES)
    return weights, ((ones + 20 * own) / (zeros + ones + 20)).reshape(GATES, LEVELS)


def fit(vocabulary: DataFrame) -> Mixer:
    """The model of a stored vocabulary (``word`` binary or else ``start`` long, ``count`` in training tokens). The word
    of a line feed stands for the end of a text. Words counted 0 teach nothing; without any others every bit has
    probability 1/2."""
    context = vocabulary.sparkSession.sparkContext
    rare = max(2, (vocabulary.filter("word IS NOT NULL").agg(F.sum("count")).first()[0] or 0) >> RARE)
    made = Mixer(_count_slots(vocabulary, rare), rare)
    made.weights, made.refined = _learn(vocabulary, context.broadcast(made))
    return made


def _named(words: pa.DictionaryArray, known: dict[bytes, int]) -> np.ndarray:
    """The number of each different word; new ones get the next."""
    return np.array([known.setdefault(word, len(known)) for word in words.dictionary.cast(pa.binary()).to_pylist()], np.int64)


def _cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Chunks of about ``CHUNK_BYTES``."""
    sizes = pc.binary_length(batch.column(2)).to_numpy().astype(np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // CHUNK_BYTES)) + 1
    borders = [0, *cuts.tolist(), batch.num_rows]
    for start, stop in zip(borders, borders[1:]):
        if stop > start:
            yield batch.slice(start, stop - start)


def _counted(docs: DataFrame) -> DataFrame:
    """Every ``word`` (0 if held out everywhere) and every ``start`` with its occurrences in training documents."""
    schema = pa.schema([("word", pa.binary()), ("start", pa.int64()), ("count", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, often = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.nulls(len(starts), pa.binary()), pa.array(starts), pa.array(often)], schema=schema)

        for batch in batches:
            for part in _cut(batch):
                learned = ~part.column(1).to_numpy(zero_copy_only=False).astype(bool)
                known: dict[bytes, int] = {}
                trained = np.zeros(0, np.int64)
                held = [(starts, often)]
                before = 0
                for texts in groups(part.column(2)):  # few texts are split into words at a time
                    words, ends = words_of(texts)
                    name = _named(words, known)
                    trained = np.pad(trained, (0, len(known) - len(trained)))
                    ours = learned[before : before + len(ends)]
                    which = words.indices.to_numpy()[np.repeat(ours, np.diff(ends, prepend=0))]
                    trained[name] += np.bincount(which, minlength=len(name))
                    found, text = starts_of(words, ends)
                    found = pa.array(found[ours[text]]).dictionary_encode()
                    held.append((found.dictionary.to_numpy(), np.bincount(found.indices.to_numpy(), minlength=len(found.dictionary))))
                    before += len(ends)
                starts, place = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
                often = np.bincount(place, np.concatenate([h[1] for h in held]), len(starts)).astype(np.int64)
                if len(starts) > KEPT_STARTS:
                    yield made()
                    starts, often = np.zeros(0, np.int64), np.zeros(0, np.int64)
                spelled = list(known)
                for at in range(0, len(spelled), 1 << 14):
                    some = pa.array(spelled[at : at + (1 << 14)], pa.binary())
                    yield pa.RecordBatch.from_arrays([some, pa.nulls(len(some), pa.int64()), pa.array(trained[at : at + len(some)])], schema=schema)
        yield made()

    rows = docs.mapInArrow(run, "word binary, start long, count long")
    return rows.groupBy("word", "start").agg(F.sum("count").alias("count"))


class _Costs:
    """What starts cost under a model, kept for a bounded number."""

    def __init__(self, model: Mixer) -> None:
        self._model = model
        self._starts, self._costs = np.zeros(0, np.int64), np.zeros(0)

    def of(self, starts: np.ndarray) -> np.ndarray:
        found = pa.array(starts).dictionary_encode()
        wanted = np.sort(found.dictionary.to_numpy())
        at = np.searchsorted(self._starts, wanted)
        fresh = wanted[np.append(self._starts, -1)[at] != wanted]
        if len(fresh) and len(self._starts) + len(fresh) > KEPT_STARTS:
            self._starts, self._costs, fresh = np.zeros(0, np.int64), np.zeros(0), wanted
        if len(fresh):
            at = np.searchsorted(self._starts, fresh)
            costs = self._model.log10_starts(fresh)
            self._starts, self._costs = np.insert(self._starts, at, fresh), np.insert(self._costs, at, costs)
        return self._costs[np.searchsorted(self._starts, found.dictionary.to_numpy())][found.indices.to_numpy()]


def _chunks(docs: DataFrame, model) -> DataFrame:
    """Rows of two kinds for each chunk of documents. With a ``word``: its number in the chunk. With ``documents``: of
    each document doc_id, held_out, its different words and how often each stands there, and the cost of its starts."""
    names = ["chunk", "number", "word", "documents"]
    types = [pa.int64(), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        costs = _Costs(model.value)
        for batch in batches:
            for part in _cut(batch):
                yield from _chunk(part, chunk, costs)
                chunk += 1

    def _chunk(part: pa.RecordBatch, chunk: int, costs: _Costs) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        number, times, different, cost = [], [], [], []
        for texts in groups(part.column(2)):  # few texts are split into words at a time
            words, ends = words_of(texts)
            name = _named(words, known)
            owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
            pairs, often = np.unique(owner * max(len(name), 1) + words.indices.to_numpy(), return_counts=True)
            owner, which = np.divmod(pairs, max(len(name), 1))
            number.append(name[which].astype("<u4"))
            times.append(often.astype("<u4"))
            different.append(np.bincount(owner, minlength=len(ends)))
            starts, text = starts_of(words, ends)
            cost.append(np.bincount(text, costs.of(starts), len(ends)))
        border = np.cumsum(np.concatenate([[0], *different]))
        document = pa.StructArray.from_arrays(
            [
                pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                pa.array([part.column(1).to_pylist()], pa.list_(pa.bool_())),
                pa.array([border.tolist()], pa.list_(pa.int64())),
                pa.array([np.concatenate(number).tobytes()], pa.binary()),
                pa.array([np.concatenate(times).tobytes()], pa.binary()),
                pa.array([np.concatenate(cost).tolist()], pa.list_(pa.float64())),
            ],
            ["doc_id", "held_out", "border", "number", "times", "starts"],
        )
        one = [pa.array([chunk], pa.int64()), *(pa.nulls(1, t) for t in types[1:]), document]
        yield pa.RecordBatch.from_arrays(one, names)
        spelled = list(known)
        for start in range(0, len(spelled), 1 << 14):
            some = spelled[start : start + (1 << 14)]
            place = np.arange(start, start + len(some), dtype=np.int32)
            columns = [np.full(len(some), chunk), place, some]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(columns, types)), pa.nulls(len(some), document.type)], names)

    inner = "struct<doc_id:array<long>,held_out:array<boolean>,border:array<long>,number:binary,times:binary,starts:array<double>>"
    return docs.mapInArrow(run, f"chunk long, number int, word binary, documents {inner}")


def score(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Rows whose crc32(doc_id as text) mod 7 is 2 are held out, the others are learned from (so are rows without doc_id).
    A-Z are lower-cased; tokens are words and one end, so a null or empty text is its end alone. base_score is the
    unigram model with one added to every count, score the mixing model's log10 probability, bits_per_byte the latter
    per byte of the words with their spaces and the end. Equal texts get equal scores.
    """
    doc_id = F.col("doc_id").cast("long")
    held_out = F.coalesce(remainder(doc_id, 7) == 2, F.lit(False))
    rows = docs.select(doc_id.alias("doc_id"), held_out.alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    counted = _counted(rows)
    ends = rows.filter(~F.col("held_out")).count()
    end_word = docs.sparkSession.createDataFrame([(bytearray([END]), None, ends)], "word binary, start long, count long")
    every = counted.unionAll(end_word)
    # In an order that is the same in every run and has nothing to do with the spelling.
    vocabulary = written(every.repartition("word", "start").sortWithinPartitions(F.xxhash64("word", "start")), "vocabulary")
    of_words = vocabulary.filter("word IS NOT NULL").select("word", "count")
    tokens, known = of_words.agg(F.sum("count"), F.count(F.when(F.col("count") > 0, 1))).first()
    model = fit(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    chunks = written(_chunks(rows, shared), "chunks")
    parts = chunks.filter("word IS NULL").select("chunk", "documents")

    def cost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.log10(batch.column("word").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], ["word", "count", "cost"])

    costs = written(of_words.mapInArrow(cost, "word binary, count long, cost double"), "word-costs")
    named = chunks.filter("word IS NOT NULL").select("chunk", "number", "word")
    back = named.join(costs, "word").select("chunk", "number", F.octet_length("word").alias("bytes"), "count", "cost")

    def add(words: pa.Table, held: pa.Table) -> pa.Table:
        documents = held["documents"].combine_chunks()[0].as_py()
        number = words["number"].to_numpy()
        count, cost_of, size = np.zeros(len(number)), np.zeros(len(number)), np.zeros(len(number))
        count[number], cost_of[number], size[number] = (words[name].to_numpy() for name in ("count", "cost", "bytes"))
        which, times = np.frombuffer(documents["number"], "<u4"), np.frombuffer(documents["times"], "<u4").astype(np.float64)
        border = np.array(documents["border"])

        def per_document(values: np.ndarray) -> np.ndarray:
            sums = np.add.reduceat(np.append(times * values[which], 0.0), border[:-1]) if len(border) > 1 else np.zeros(0)
            return np.where(np.diff(border) > 0, sums, 0.0)

        one = np.ones(len(number))
        n_tokens = per_document(one) + 1
        # Rounded, so that the order in which a chunk numbers its words leaves no trace.
        base = np.round(per_document(np.log10((count + 1) / (tokens + known + 1))) + np.log10((ends + 1) / (tokens + known + 1)), 9)
        scores = np.round(per_document(cost_of) + np.array(documents["starts"], float), 9)
        size = per_document(size + 1) + 1
        n_known = per_document(one * (count > 0)) + (ends > 0)
        columns = {
            "doc_id": pa.array(documents["doc_id"], pa.int64()),
            "held_out": pa.array(documents["held_out"], pa.bool_()),
            "n_tokens": pa.array(n_tokens.astype(np.int64)),
            "n_known": pa.array(n_known.astype(np.int64)),
            "train_tokens": pa.array(np.full(len(scores), tokens, np.int64)),
            "base_score": pa.array(base),
            "score": pa.array(scores),
            "bits_per_byte": pa.array(-scores * np.log2(10) / size),
        }
        return pa.table(columns)

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    return back.groupBy("chunk").cogroup(parts.select(F.col("chunk").alias("of"), "documents").groupBy("of")).applyInArrow(add, schema)
