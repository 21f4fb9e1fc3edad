"""Language of a text by cross-parsing: how few phrases of a language's own text does it take to write the text?

A suffix automaton of each language's labelled text accepts exactly its substrings. Parsing a text greedily into
longest matches gives a number of phrases; times the bits that point at one (log2 of the labelled text's length) and
per character, that is the cross entropy of Ziv and Merhav. A letter that the labelled text lacks has to be spelled as
well, with the bits of one letter of all. The language with the least wins.

The automata are fitted on a bounded sample of labelled rows: whole texts of at most ``LONGEST`` characters, by hash,
``SAMPLE_DOCS`` of a language at most, until a language has ``SAMPLE_CHARS`` characters or its part of ``ALL_CHARS``. What
goes to the executors, the steps of the automata, has a fixed bound. Every letter of the sample has a symbol of its own:
the most frequent get a column in a dense table, which every worker makes for itself, the steps of all others stay in a
sorted list. Whole texts are then parsed, in lanes of ``LANE`` symbols that step through the automata side by side; a phrase ends with
its lane, whatever rows happen to share a batch. No rows are shuffled but those of the sample.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

SAMPLE_DOCS = 128
SAMPLE_CHARS = 65_536
LONGEST = 20_000
ALL_CHARS = 400_000
LETTERS = 60  # letters of the labelled texts that get a column in the dense table
LANE = 1024
GROUP = 1 << 21  # symbols parsed together
UNKNOWN = "und"

_OTHER, _SPACE, _END = 0, 1, 2  # symbols: a letter never learned, anything between words, past the end


def remainder(doc_id: Column, by: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % by


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.array([chr(code).isalpha() for code in range(0x110000)], bool)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")


def symbols(codes: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """Symbols of a text: known letters, other letters, and one space for each run of anything else."""
    letter = _letters()[codes]
    at = np.searchsorted(alphabet, codes).clip(max=max(0, len(alphabet) - 1))
    known = alphabet[at] == codes if len(alphabet) else np.zeros(len(codes), bool)
    out = np.where(letter, np.where(known, at + 3, _OTHER), _SPACE).astype(np.int32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of a run of others
    return out[keep]


class SuffixAutomaton:
    """The smallest automaton of all substrings of a sequence, built symbol by symbol."""

    def __init__(self, sequence: list[int]) -> None:
        self.edges: list[dict[int, int]] = [{}]
        length, link, last = [0], [-1], 0
        edges = self.edges
        for symbol in sequence:
            state = len(edges)
            edges.append({})
            length.append(length[last] + 1)
            link.append(0)
            at = last
            while at >= 0 and symbol not in edges[at]:
                edges[at][symbol] = state
                at = link[at]
            if at >= 0:
                to = edges[at][symbol]
                if length[to] == length[at] + 1:
                    link[state] = to
                else:
                    copy = len(edges)
                    edges.append(dict(edges[to]))
                    length.append(length[at] + 1)
                    link.append(link[to])
                    link[to] = link[state] = copy
                    while at >= 0 and edges[at].get(symbol) == to:
                        edges[at][symbol] = copy
                        at = link[at]
            last = state

    def steps(self) -> np.ndarray:
        """Rows (state, symbol, next state), in order of state and symbol."""
        listed = np.array([(state, symbol, to) for state, edges in enumerate(self.edges) for symbol, to in edges.items()], np.int32).reshape(-1, 3)
        return listed[np.lexsort([listed[:, 1], listed[:, 0]])]


def parser(steps: np.ndarray, states: int, column: np.ndarray, size: int, first: int) -> np.ndarray:
    """Table over state and column: where a greedy parse goes next, times 4, plus the phrases that end there. Places are
    counted in cells, the automaton's first row being row ``first``.

    A dead end closes the phrase and starts the next one with the same symbol; a symbol that the labelled text lacks is a
    phrase by itself. Past the end nothing happens.
    """
    table = np.full((states, size), -1, np.int64 if (first + states) * size >= 1 << 29 else np.int32)
    at = column[steps[:, 1]]
    dense = (at >= 0) & (at != _OTHER)
    table[steps[dense, 0], at[dense]] = ((steps[dense, 2] + first) * size) << 2
    root = first * size
    for k, onward in enumerate(table[0].tolist()):
        closed = onward if onward >= 0 else root << 2 | 1  # and one more phrase for a symbol that the text lacks
        dead = table[:, k] < 0
        table[dead, k] = closed + 1
        if table[0, k] == closed + 1 and dead[0]:
            table[0, k] = closed
    table[:, _END] = (np.arange(states) + first) * size << 2
    return table


class Model:
    """Automata of all languages by their steps, and the table that parses with them."""

    def __init__(self, texts: dict[str, list[str]]) -> None:
        self.languages = sorted(texts)
        codes = {name: [_codes(text) for text in texts[name]] for name in self.languages}
        counts: Counter = Counter()
        for parts in codes.values():
            for part in parts:
                counts.update(part[_letters()[part]].tolist())
        self.alphabet = np.array(sorted(counts), np.int64)
        often = sorted(counts, key=lambda code: (-counts[code], code))[:LETTERS]
        self.column = np.full(len(counts) + 3, -1, np.int64)  # in the table, of each symbol
        self.column[:3] = range(3)
        self.column[np.searchsorted(self.alphabet, sorted(often)) + 3] = np.arange(len(often)) + 3
        self.size = len(often) + 3
        # Bytes of each symbol in UTF-8, by language; a letter that the language's sample lacks counts as one.
        wide = [1, 1, 1, *(len(chr(code).encode("utf-8", "surrogatepass")) for code in self.alphabet.tolist())]
        self.bytes = np.ones((len(self.languages), len(wide)), np.int64)
        self.known = np.zeros(self.bytes.shape, bool)
        steps, self.states, self.bits = [], [], []
        for at, name in enumerate(self.languages):
            sequence: list[int] = []
            for part in codes[name]:
                sequence += symbols(part, self.alphabet).tolist() + [_OTHER]
            own = np.unique(np.array(sequence, np.int64))
            self.bytes[at, own] = np.array(wide)[own]
            self.known[at, own[own != _OTHER]] = True
            automaton = SuffixAutomaton(sequence)
            steps.append(automaton.steps())
            self.states.append(len(automaton.edges))
            self.bits.append(float(np.log2(max(2, len(sequence)))))
            del automaton
        self.steps = steps
        first = np.cumsum([0, *self.states])
        self.roots = [int(row) * self.size for row in first[:-1]]
        # The steps of symbols without a column, in order of state and symbol.
        listed = np.concatenate([*[part[self.column[part[:, 1]] < 0] + np.array([row, 0, row]) for part, row in zip(steps, first)], np.zeros((0, 3), np.int64)])
        self.keys, self.goals = listed[:, 0] * len(self.column) + listed[:, 1], listed[:, 2]
        self._table: np.ndarray | None = None

    @property
    def table(self) -> np.ndarray:
        """Parsers of all languages in one table. It is many times the size of the steps, so it is not sent along."""
        if self._table is None:
            rows = sum(self.states)
            whole = np.empty((rows, self.size), np.int32 if rows * self.size < 1 << 29 else np.int64)
            row = 0
            for steps, states in zip(self.steps, self.states):
                whole[row : row + states] = parser(steps, states, self.column, self.size, row)
                row += states
            self._table = whole.ravel()
        return self._table

    def let_go(self) -> None:
        """Drop the table at the end of a task, so that a worker does not hold it through later stages."""
        self._table = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_table": None}

    def _listed(self, state: np.ndarray, symbol: np.ndarray, root: np.ndarray) -> np.ndarray:
        """What the table would hold for symbols without a column."""

        def goal(row: np.ndarray) -> np.ndarray:
            wanted = row * len(self.column) + symbol
            at = np.searchsorted(self.keys, wanted).clip(max=len(self.keys) - 1)
            return np.where(self.keys[at] == wanted, self.goals[at], -1)

        on, again = goal(state.astype(np.int64) // self.size), goal(root.astype(np.int64) // self.size)
        restart = np.where(again < 0, root, again * self.size) * 4 + (state != root) + (again < 0)
        return np.where(on < 0, restart, on * self.size * 4)

    def phrases(self, parts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each symbol sequence in each language."""
        sizes = np.array([len(part) for part in parts], np.int64)
        lanes = -(-sizes // LANE)
        owner = np.repeat(np.arange(len(parts)), lanes)
        first = np.cumsum(lanes) - lanes
        within = np.arange(int(lanes.sum())) - first[owner]
        length = np.minimum(LANE, sizes[owner] - within * LANE)
        order = np.argsort(-length, kind="stable")
        flat = np.concatenate([*parts, np.zeros(0, np.int32)])
        column = self.column[flat]
        unlisted = column >= 0
        listed_too = not unlisted.all()
        begin = ((np.cumsum(sizes) - sizes)[owner] + within * LANE)[order]
        length = length[order]
        roots = np.array(self.roots, self.table.dtype)[:, None]
        state = np.repeat(roots, len(order), axis=1)
        count = np.zeros(state.shape, np.int64)
        live = np.searchsorted(-length, -np.arange(1, LANE + 1), side="right")
        for step in range(int(length[0]) if len(length) else 0):
            k = live[step]
            at = begin[:k] + step
            found = self.table[state[:, :k] + column[at]]
            if listed_too and len(rest := np.flatnonzero(~unlisted[at])):
                found[:, rest] = self._listed(state[:, rest], flat[at[rest]], np.broadcast_to(roots, (len(roots), len(rest))))
            state[:, :k] = found >> 2
            count[:, :k] += found & 3
        count += state != roots  # the phrase that the end of a lane cuts off
        out = np.zeros((len(parts), len(self.languages)), np.int64)
        np.add.at(out, owner[order], count.T)
        return out

    def predict(self, texts: Iterable[str | None]) -> Iterator[tuple[str, float, float, float]]:
        """(language, score, symbols per phrase, fit) of each text. The fit is the matched bytes per phrase, so that a
        script of many letters, whose phrases have few, is measured like others; a text that is a single phrase of
        learned letters fits without limit."""
        group: list[np.ndarray | None] = []
        size = 0
        for text in texts:
            codes = _codes(text or "")
            has_letters = bool(self.languages) and bool(len(codes)) and bool(_letters()[codes].any())
            group.append(symbols(codes, self.alphabet) if has_letters else None)
            size += len(codes)
            if size > GROUP:
                yield from self._decide(group)
                group, size = [], 0
        if group:
            yield from self._decide(group)

    def _decide(self, group: list[np.ndarray | None]) -> Iterator[tuple[str, float, float, float]]:
        known = [part for part in group if part is not None]
        counts = iter(self.phrases(known)) if known else iter(())
        for part in group:
            if part is None:
                yield UNKNOWN, 0.0, 0.0, 0.0
                continue
            phrases = next(counts)
            counts_of = np.bincount(part, minlength=len(self.column))
            cost = phrases * np.array(self.bits) + ~self.known @ counts_of * np.log2(len(self.column))
            best = int(np.argmin(cost))  # the first by name among equals
            others = np.delete(cost, best)
            score = float(others.min() / (others.min() + cost[best])) if len(others) else 1.0
            whole = phrases[best] == 1 and bool(self.known[best, part].all())
            fit = float("inf") if whole else float(self.bytes[best, part].sum() / phrases[best])
            yield self.languages[best], score, float(len(part) / phrases[best]), fit


def learn(docs: DataFrame) -> Model:
    """Fit on labelled documents whose crc32(doc_id as text) mod 3 is not 1: those with the smallest hashes, up to
    ``SAMPLE_DOCS`` a language. A null text, language or doc_id teaches nothing."""
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder(F.col("doc_id"), 3) != 1))
    fair = usable.filter(F.length("text") <= LONGEST).select("lang", "text", F.xxhash64("doc_id", "text").alias("pick"))
    order = Window.partitionBy("lang").orderBy("pick", "text")
    ranked = fair.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= SAMPLE_DOCS)
    before = F.sum(F.length("text")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = ranked.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < SAMPLE_CHARS).orderBy("lang", "rank").collect()
    texts: dict[str, list[str]] = {}
    for row in rows:
        texts.setdefault(row.lang, []).append(row.text)
    share = min(SAMPLE_CHARS, ALL_CHARS // max(1, len(texts)))
    return Model({name: _first(parts, share) for name, parts in texts.items()})


def _first(parts: list[str], chars: int) -> list[str]:
    kept, size = [], 0
    for part in parts:
        if size + len(part) > chars and kept:
            break
        kept.append(part)
        size += len(part)
    return kept


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Append held_out, lang_pred, score and mean_match to ``docs``; columns of these names are replaced.

    Only ``text`` decides. lang_pred is ``und``, with score and mean_match 0, for a null text or one without a letter,
    and for all texts if nothing could be learned. score is the runner-up's cost by the sum of both: 0.5 says that two
    languages fit alike. mean_match is the length of a phrase. Equal texts get equal answers; rows are kept as they are.
    """
    added = ["lang_pred", "score", "mean_match"]
    kept = [name for name in docs.columns if name not in [*added, "held_out"]]
    held_out = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out")
    # Columns are told by place inside the tasks, as names may hold dots.
    rows = docs.select(*[F.col(f"`{name}`").alias(f"c{at}") for at, name in enumerate(kept)], held_out)
    schema = StructType([*[docs.schema[name] for name in kept], *[StructField(n, t) for n, t in (("held_out", BooleanType()), ("lang_pred", StringType()), ("score", DoubleType()), ("mean_match", DoubleType()))]])
    text = kept.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(shared.value.predict(value.as_py() for value in batch.column(text)))
            names, scores, matches, _ = zip(*found) if found else ((), (), (), ())
            columns = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(matches, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*kept, "held_out", *added])
        shared.value.let_go()

    return rows.mapInArrow(run, schema)


def in_known_language(docs: DataFrame, model: Model, least_match: float) -> DataFrame:
    """The rows of ``docs`` whose text is in a learned language: not ``und``, and with a fit (see ``Model.predict``) of
    at least ``least_match`` in its best language. No column is added or looked at but ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.predict(value.as_py() for value in batch.column(at))
            kept = batch.filter(pa.array([name != UNKNOWN and match >= least_match for name, _, _, match in found], pa.bool_()))
            yield pa.RecordBatch.from_arrays(kept.columns, names)
        shared.value.let_go()

    return docs.toDF(*[f"c{k}" for k in range(len(names))]).mapInArrow(run, docs.schema)
