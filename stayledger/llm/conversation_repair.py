"""Conversations with faults brought back to alternating turns by the cheapest edits.

The repaired roles are an optional system turn and then pairs of user and assistant. A row is reduced to one of nine
symbols: its role's initial with or without a cut end, or "must go" for blank rows and repeats. Every symbol has a
min-plus matrix over the four states of that pattern, whose entries hold the least cost and, as a rope, the least audit
of getting from state to state; inserts come before the row. Re-Pair replaces the commonest neighbours of all
conversations by new symbols, whose matrices are products of two others, computed once. A conversation is rewritten in
these symbols and needs one product for each that is left.

Rows are ordered by a range partitioning over conversation and turn, which splits a long conversation, and reach the
grammar as pieces of bounded length; repeats are found by partial aggregation over fingerprints. Only the last steps
stream a whole conversation through one task, in order and row by row: an audit and a digest are sequential.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.numbering import with_sequence
from .keys import fingerprint
from .storage import written

PIECE = 1 << 16  # rows
ROUNDS, MOST_RULES, LEAST_SHARE = 24, 1000, 0.002  # a rule has to take in that share of all neighbours
ROLES = {"s": "system", "u": "user", "a": "assistant"}

NO_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)
_INITIALS = "sua"
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
START, SYSTEM, USER, PAIR = range(4)
STATES, FIRST_RULE = 4, 9
_NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): PAIR, (PAIR, "u"): USER}
_FLAT = 512

# A rope is a text or (length, left, right).


def _length(rope) -> int:
    return len(rope) if isinstance(rope, str) else rope[0]


def joined(left, right):
    total = _length(left) + _length(right)
    if not _length(left) or not _length(right):
        return right if not _length(left) else left
    return left + right if total <= _FLAT else (total, left, right)


def leaves(rope) -> Iterator[str]:
    todo = [rope]
    while todo:
        top = todo.pop()
        if isinstance(top, str):
            yield top
        else:
            todo += [top[2], top[1]]


def smaller(one, two) -> bool:
    """Whether ``one`` comes before ``two``. Parts that both share are passed over."""
    if isinstance(one, str) and isinstance(two, str):
        return one < two
    left, right = [one], [two]
    while left and right:
        a, b = left.pop(), right.pop()
        if a is b:
            continue
        if not isinstance(a, str) and (isinstance(b, str) or a[0] >= b[0]):
            left += [a[2], a[1]]
            right.append(b)
        elif not isinstance(b, str):
            right += [b[2], b[1]]
            left.append(a)
        else:
            n = min(len(a), len(b))
            if a[:n] != b[:n]:
                return a < b
            if len(a) > n:
                left.append(a[n:])
            if len(b) > n:
                right.append(b[n:])
    return bool(right)


def _better(entry, best) -> bool:
    return best is None or entry[0] < best[0] or (entry[0] == best[0] and smaller(entry[1], best[1]))


def product(one: list, two: list) -> list:
    """Of two matrices: the best way from state to state by way of any other. Rows are states to come from. Two audits of
    one cost over the same rows never begin with each other, as inserts cost, so the least parts make the least whole."""
    rows = []
    for row in one:
        made = [None] * STATES
        for k, first in enumerate(row):
            if first is None:
                continue
            for j, second in enumerate(two[k]):
                if second is not None:
                    cost = first[0] + second[0]
                    if made[j] is None or cost <= made[j][0]:
                        entry = (cost, joined(first[1], second[1]))
                        if _better(entry, made[j]):
                            made[j] = entry
        rows.append(made)
    return rows


def _matrix(steps: list[tuple[int, int, int, str]]) -> list:
    rows = [[None] * STATES for _ in range(STATES)]
    for i, j, cost, audit in steps:
        if _better((cost, audit), rows[i][j]):
            rows[i][j] = (cost, audit)
    return rows


_STAY = _matrix([(i, i, 0, "") for i in range(STATES)])
_INSERT = _matrix([(i, j, 5, "I") for (i, role), j in _NEXT.items() if role != "s"] + [(i, i, 0, "") for i in range(STATES)])
INSERTS = product(_INSERT, product(_INSERT, _INSERT))  # more never pay: three steps reach every state


def _row_matrix(symbol: int) -> list:
    """Inserts before a row, and the row kept, given another role or deleted. Symbol 0 must go; the others are 1 + 2 *
    initial (system, user, assistant, another) + whether the end is cut."""
    steps = [(i, i, 2, "D") for i in range(STATES)]
    if symbol:
        initial, cut = divmod(symbol - 1, 2)
        own = _INITIALS[initial : initial + 1]
        for (i, role), j in _NEXT.items():
            if role == own:
                steps.append((i, j, 5 * cut, "K"))
            if role != "s":
                steps.append((i, j, 1 + 5 * cut, "R"))
    return product(INSERTS, _matrix(steps))


_SYMBOL_OF = np.array([0 if fault in (BLANK, DUPLICATE) else 1 + 2 * initial + (fault == TRUNCATED) for initial in range(4) for fault in range(4)], np.int32)


def _apart(places: np.ndarray) -> np.ndarray:
    """Of places in a row, every second one from the first, so that replaced pairs do not overlap."""
    fresh = np.diff(places, prepend=-2) != 1
    begun = np.maximum.accumulate(np.where(fresh, np.arange(len(places)), 0))
    return places[(np.arange(len(places)) - begun) % 2 == 0]


class Grammar:
    """Rules (left, right); the k-th makes symbol ``FIRST_RULE + k`` and is applied after those before it."""

    def __init__(self, rules: list[tuple[int, int]]):
        self.rules = rules
        self._matrices = [_row_matrix(symbol) for symbol in range(FIRST_RULE)]
        width = FIRST_RULE + len(rules)
        self.rank = np.full((width, width), len(rules), np.int32)
        for k, (left, right) in enumerate(rules):
            self.rank[left, right] = k
            self._matrices.append(product(self._matrices[left], self._matrices[right]))
        self._known: dict[bytes, list[int]] = {}

    def rewritten(self, symbols: np.ndarray) -> np.ndarray:
        while len(symbols) > 1:
            ranks = self.rank[symbols[:-1], symbols[1:]]
            best = ranks.min()
            if best == len(self.rules):
                break
            at = _apart(np.flatnonzero(ranks == best))
            symbols = symbols.copy()
            symbols[at] = FIRST_RULE + best
            symbols = np.delete(symbols, at + 1)
        return symbols

    def follow(self, ways: list, codes: bytes) -> list:
        """The best ways to each state after a piece of a conversation, from those before it."""
        found = self._known.get(codes)
        if found is None:
            found = self.rewritten(_SYMBOL_OF[np.frombuffer(codes, np.uint8)]).tolist()
            if len(codes) <= 64 and len(self._known) < 100_000:
                self._known[codes] = found
        for symbol in found:
            ways = product([ways], self._matrices[symbol])[0]
        return ways


def cheapest(ways: list) -> tuple[int, str]:
    """Cost and audit of the best way to end, with inserts behind the last row."""
    ends = product([ways], INSERTS)[0]
    best = None
    for state in (START, PAIR):
        if ends[state] is not None and _better(ends[state], best):
            best = ends[state]
    return best[0], "".join(leaves(best[1]))


BEGIN = [(0, ""), None, None, None]


def ordered_rows(conversations: DataFrame) -> DataFrame:
    """The rows with ``seq``, which grows by conversation and turn (nulls first; rows of one turn by role and text, by
    its first 256 characters and a hash), ``conv`` (the id as a text, told from null), turn, role, text and ``code``: the
    initial of the role and the fault, without repeats. Null roles and texts are one space."""
    as_text = F.col("conv_id").cast("string")
    rows = conversations.select(
        "conv_id", F.coalesce(F.concat(F.lit("c"), as_text), F.lit("")).alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    )
    end = F.rtrim("text", F.lit(_SPACE))
    fault = F.when(F.length(end) == 0, BLANK).when(~F.right(end, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(NO_FAULT)
    initial = F.position(F.substring("role", 1, 1), F.lit(_INITIALS))
    place = F.when((F.length("role") > 0) & (initial > 0), initial - 1).otherwise(3)
    hashes = [h.alias(n) for h, n in zip(fingerprint(F.col("role"), F.col("text")), ("h1", "h2"))]
    rows = rows.select("*", F.col("turn").isNotNull().alias("dated"), F.substring("text", 1, 256).alias("opening"), (place * 4 + fault).cast("int").alias("code"), *hashes)
    return written(with_sequence(rows, ["conv", "dated", "turn", "role", "opening", "h1"], "seq").drop("dated", "opening"), "turns")


_PIECES = "conv string, seq long, codes binary, first_turn long, last_turn long, turns long"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, gathered to the runs of one conversation: their codes, and the turns they begin and end with."""
    conv, held = None, []

    def made() -> pa.RecordBatch:
        codes, turns, seqs = (np.concatenate([part[k] for part in held]) for k in range(3))
        known = turns[:, 0][turns[:, 1] == 1]
        ends = [int(known[0]), int(known[-1])] if len(known) else [None, None]
        row = [conv, int(seqs[0]), codes.tobytes(), *ends, int((np.diff(known) != 0).sum()) + 1 if len(known) else 0]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()))], names=["conv", "seq", "codes", "first_turn", "last_turn", "turns"])

    size, out = 0, []
    for batch in batches:
        if not batch.num_rows:
            continue
        convs = batch.column("conv")
        codes = batch.column("code").to_numpy().astype(np.uint8)
        turn = batch.column("turn")
        turns = np.stack([turn.fill_null(0).to_numpy(), turn.is_valid().to_numpy(zero_copy_only=False).astype(np.int64)], axis=1)
        seqs = batch.column("seq").to_numpy()
        ids = convs.dictionary_encode().indices.to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
        for start, stop in zip(cuts, cuts[1:]):
            own = convs[start].as_py()
            if held and (own != conv or size + stop - start > PIECE):
                out.append(made())
                held, size = [], 0
            conv = own
            held.append((codes[start:stop], turns[start:stop], seqs[start:stop]))
            size += stop - start
        if len(out) > 1000:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
            out = []
    if held:
        out.append(made())
    if out:
        yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]


def conversation_pieces(rows: DataFrame) -> DataFrame:
    """Pieces of at most ``PIECE`` rows (an Arrow batch more), from the ordered rows, repeats marked."""
    first = rows.groupBy("conv", "h1", "h2").agg(F.min("seq").alias("seq")).select("seq", F.lit(True).alias("first"))
    repeated = F.col("first").isNull() & (F.col("code") % 4 != BLANK)
    code = F.when(repeated, F.col("code") - F.col("code") % 4 + DUPLICATE).otherwise(F.col("code"))
    marked = rows.select("conv", "seq", "turn", "code").join(first, "seq", "left").select("conv", "seq", "turn", code.alias("code"))
    return written(marked.repartitionByRange("seq").sortWithinPartitions("seq").mapInArrow(_pieces, _PIECES), "pieces")


def learn_grammar(pieces: DataFrame) -> Grammar:
    """Re-Pair over the pieces of all conversations. A round counts the neighbours in all of them, each distinct piece
    once with its copies, and makes rules of the commonest pairs that share no symbol. Rounds end when no pair makes up
    ``LEAST_SHARE`` of the neighbours there were at first. The driver gets the commonest pairs only."""
    distinct = written(pieces.groupBy("codes").agg(F.count(F.lit(1)).alias("copies")), "distinct-pieces")
    rules: list[tuple[int, int]] = []
    least = None
    for _ in range(ROUNDS):
        counts = distinct.mapInArrow(_pair_counter(rules), "left int, right int, n long").groupBy("left", "right").agg(F.sum("n").alias("n"))
        if least is None:
            counts = written(counts, "pairs")  # at most 81 rows
            least = max(2, LEAST_SHARE * (counts.agg(F.sum("n")).first()[0] or 0))
        used: set[int] = set()
        common = counts.filter(F.col("n") >= least).orderBy(F.desc("n"), "left", "right").limit(64).collect()
        for pair in common:
            if len(rules) < MOST_RULES and not {pair.left, pair.right} & used:
                used |= {pair.left, pair.right}
                rules.append((pair.left, pair.right))
        if not used:
            break
    return Grammar(rules)


def _pair_counter(rules: list[tuple[int, int]]):
    rules = list(rules)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, total = Grammar(rules), {}
        for batch in batches:
            for codes, copies in zip(batch.column("codes").to_pylist(), batch.column("copies").to_pylist()):
                symbols = grammar.rewritten(_SYMBOL_OF[np.frombuffer(codes, np.uint8)])
                pairs, n = np.unique(symbols[:-1].astype(np.int64) * (1 << 20) + symbols[1:], return_counts=True)
                for pair, times in zip(pairs.tolist(), n.tolist()):
                    total[pair] = total.get(pair, 0) + times * copies
        keys = list(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k >> 20 for k in keys], pa.int32()), pa.array([k & 0xFFFFF for k in keys], pa.int32()), pa.array(list(total.values()), pa.int64())], names=["left", "right", "n"]
        )

    return counted


_PLAN = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _planner(rules: list[tuple[int, int]]):
    def planned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, state, rows = Grammar(rules), None, []
        legal = np.zeros((4, 4), bool)
        for pair in ("su", "ua", "au"):
            legal[_INITIALS.index(pair[0]), _INITIALS.index(pair[1])] = True

        def finish():
            gaps = 0 if state["first"] is None else state["last"] - state["first"] + 1 - state["turns"]
            cost, audit = cheapest(state["ways"])
            rows.append((state["conv"], gaps, *state["faults"][1:], state["illegal"], cost, audit))

        def out() -> pa.RecordBatch:
            types = [pa.string(), *[pa.int64()] * 6, pa.string()]
            names = [field.split()[0] for field in _PLAN.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(column, t) for column, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            for piece in batch.to_pylist():
                if state is None or piece["conv"] != state["conv"]:
                    if state is not None:
                        finish()
                        if len(rows) >= 1000:
                            yield out()
                            rows.clear()
                    state = {"conv": piece["conv"], "ways": BEGIN, "first": None, "last": None, "turns": 0, "faults": [0] * 4, "illegal": 0, "initial": None}
                codes = piece["codes"]
                if not codes:
                    continue
                values = np.frombuffer(codes, np.uint8)
                initials = values >> 2
                if state["initial"] is not None:
                    initials = np.concatenate([[state["initial"]], initials])
                state["illegal"] += int((~legal[initials[:-1], initials[1:]]).sum())
                state["initial"] = int(initials[-1])
                state["faults"] = [have + int(n) for have, n in zip(state["faults"], np.bincount(values & 3, minlength=4))]
                if piece["first_turn"] is not None:
                    state["turns"] += piece["turns"] - (piece["first_turn"] == state["last"])
                    state["first"] = piece["first_turn"] if state["first"] is None else state["first"]
                    state["last"] = piece["last_turn"]
                state["ways"] = grammar.follow(state["ways"], codes)
        if state is not None:
            finish()
        if rows:
            yield out()

    return planned


def repair_plans(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """For every conversation of ``ids`` (conv_id): ``conv``, gaps, the faults, illegal, cost and audit. ``rows`` come from
    :func:`ordered_rows`. A conversation without rows has zeros and an empty audit."""
    pieces = conversation_pieces(rows)
    grammar = learn_grammar(pieces)
    every = ids.select(F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("")).alias("conv")).distinct()
    none = [F.lit(None).cast(t).alias(n) for n, t in (("codes", "binary"), ("first_turn", "long"), ("last_turn", "long"), ("turns", "long"))]
    seeds = every.select("conv", F.lit(-1).cast("long").alias("seq"), *none)
    together = pieces.unionByName(seeds).repartition("conv").sortWithinPartitions("conv", "seq")
    return written(together.mapInArrow(_planner(grammar.rules), _PLAN), "repair-plans")


_TURNS = "conv string, place long, edit string, role string, text string"


def _repairer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, each conversation's audit before them, turned into its edits."""
    audit, at, state, place, conv = "", 0, START, 0, None

    def insert():
        nonlocal at, state, place
        role = "a" if state == USER else "u"
        state, at, place = _NEXT[state, role], at + 1, place + 1
        return conv, place, "I", ROLES[role], ""

    def rest():
        while at < len(audit):
            yield insert()

    made: list[tuple] = []
    held = 0

    def out() -> pa.RecordBatch:
        types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(column, t) for column, t in zip(zip(*made), types)], names=[f.split()[0] for f in _TURNS.split(", ")])

    for batch in batches:
        for own, given, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv", "audit", "role", "text"))):
            if given is not None:
                made += rest()
                conv, audit, at, state, place = own, given, 0, START, 0
            else:
                while audit[at] == "I":
                    made.append(insert())
                edit = audit[at]
                at, place = at + 1, place + 1
                if edit == "K":
                    state = _NEXT[state, role[0]]
                elif edit == "R":
                    now = "a" if state == USER else "u"
                    state, role = _NEXT[state, now], ROLES[now]
                made.append((conv, place, edit, role, text))
                held += len(text)
            if len(made) >= 5000 or held > 1 << 24:
                yield out()
                made, held = [], 0
    made += rest()
    if made:
        yield out()


def repaired_turns(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The edits of every conversation in order: conv, place (from 1), edit (K, R, D or I), role and text after it. The
    repaired conversation are those but D. Each conversation's rows come together and in order."""
    none = F.lit(None).cast("string")
    notes = plans.select("conv", F.lit(-1).cast("long").alias("seq"), "audit", none.alias("role"), none.alias("text"))
    turns = rows.select("conv", "seq", none.alias("audit"), "role", "text")
    together = turns.unionByName(notes).repartition("conv").sortWithinPartitions("conv", "seq")
    return together.mapInArrow(_repairer, _TURNS)


def _digester(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, digest, rows, begun = None, None, [], False

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(column, pa.string()) for column in zip(*rows)], names=["conv", "sha256"])

    for batch in batches:
        for own, edit, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv", "edit", "role", "text"))):
            if own != conv:
                if conv is not None:
                    rows.append((conv, digest.hexdigest()))
                conv, digest, begun = own, hashlib.sha256(), False
            if edit != "D":
                digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
                begun = True
        if len(rows) >= 5000:
            yield out()
            rows = []
    if conv is not None:
        rows.append((conv, digest.hexdigest()))
    if rows:
        yield out()


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with a fault in about a quarter of them, drawn by crc32 of ``conv_id:turn``: 0 of 20 is left out, 1 loses its
    text, 2 its sentence ends, 3 comes twice, 4 is of role user. Nulls are one space, but for conv_id and turn themselves."""
    space = F.lit(" ")
    id_text, turn_text = (F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(F.concat(id_text, F.lit(":"), turn_text)) % 20).alias("drawn")
    ).filter("drawn <> 0")
    text = F.when(F.col("drawn") == 1, "").when(F.col("drawn") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("drawn") == 4, "user").otherwise(F.col("role"))
    times = F.array_repeat(F.lit(0), F.when(F.col("drawn") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def repair_report(damage: DataFrame, original: DataFrame) -> DataFrame:
    """For every conv_id of ``original``: gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of the
    rows that ``damage`` has of it.

    Conversations without rows have zeros, an empty audit and the digest of an empty text; a null conv_id is a
    conversation; other columns are ignored; an empty table gives no rows.
    """
    rows = ordered_rows(damage)
    plans = repair_plans(rows, original)
    digests = repaired_turns(rows, plans).mapInArrow(_digester, "conv string, sha256 string")
    ids = original.select("conv_id", F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("")).alias("conv")).distinct()
    empty = F.sha2(F.lit(""), 256)
    return ids.join(plans, "conv").join(digests, "conv", "left").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.coalesce("sha256", empty).alias("repaired_sha256")
    )
