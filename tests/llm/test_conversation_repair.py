import hashlib
import itertools
import random
import re
import zlib

import pytest

from stayledger.llm import conversation_repair as repair

WORD, ROLES = re.compile(r"[^\x20\x09-\x0D]"), {"u": "user", "a": "assistant"}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        drawn = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if drawn == 1:
            text = ""
        if drawn == 2:
            text = re.sub("[.!?]", "", text)
        out += [(conv, turn, "user" if drawn == 4 else role, text)] * {0: 0, 3: 2}.get(drawn, 1)
    return out


def faults(rows):
    found, seen = [], set()
    for role, text in rows:
        letters = WORD.findall(text)
        found.append("blank" if not letters else "duplicate" if (role, text) in seen else "truncated" if letters[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows, found):
    """Least (cost, audit), state by state over all edits, with plain strings."""
    def inserted(best):
        for _ in range(3):
            for (i, role), j in NEXT.items():
                if role != "s" and i in best:
                    way = (best[i][0] + 5, best[i][1] + "I")
                    best[j] = min(best.get(j, way), way)
        return best

    best = {"": (0, "")}
    for (role, _), fault in zip(rows, found):
        best, after = inserted(best), {}
        for i, (cost, audit) in best.items():
            ways = [(i, cost + 2, "D")]
            if fault not in ("blank", "duplicate"):
                cut = 5 * (fault == "truncated")
                ways += [(j, cost + cut, "K") for (k, r), j in NEXT.items() if k == i and r == role[:1]]
                ways += [(j, cost + cut + 1, "R") for (k, r), j in NEXT.items() if k == i and r != "s"]
            for j, c, edit in ways:
                after[j] = min(after.get(j, (c, audit + edit)), (c, audit + edit))
        best = after
    best = inserted(best)
    return min(best[state] for state in ("", "a") if state in best)


def every_edit(rows, found, most=2):
    """The same by trying every sequence of edits with up to ``most`` inserts at a place."""
    best = None
    for edits in itertools.product("DKR", repeat=len(rows)):
        for inserts in itertools.product(range(most + 1), repeat=len(rows) + 1):
            cost, state, fine = 0, "", True
            for n, step in zip(inserts, [*zip(edits, rows, found), None]):
                for _ in range(n):
                    state, cost = ("a" if state == "u" else "u"), cost + 5
                if step:
                    edit, (role, _), fault = step
                    if edit == "D":
                        cost += 2
                        continue
                    cost += 5 * (fault == "truncated") + (edit == "R")
                    role = role[:1] if edit == "K" else "a" if state == "u" else "u"
                    fine = fine and fault not in ("blank", "duplicate") and (state, role) in NEXT
                    state = NEXT.get((state, role), state)
            if fine and state in ("", "a"):
                audit = "".join("I" * n + e for n, e in zip(inserts, [*edits, ""]))
                best = min(best or (cost, audit), (cost, audit))
    return best


def report(rows):
    out = []
    for conv in dict.fromkeys(row[0] for row in rows):
        own = sorted((r for r in damage(rows) if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        turns = [r[1] for r in own if r[1] is not None]
        kept = [(r[2], r[3]) for r in own]
        found = faults(kept)
        cost, audit = cheapest(kept, found)
        result, state, rest = [], "", iter(kept)
        for edit in audit:
            role, text = next(rest) if edit != "I" else ("", "")
            if edit == "D":
                continue
            if edit != "K":
                role = ROLES["a" if state == "u" else "u"]
            state = role[:1]
            result.append(f"{role}:{text}")
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, *[found.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(result).encode()).hexdigest()))
    return out


def corpus(seed, n=300):
    pick = random.Random(seed)
    rows = []
    for conv in range(n):
        role = pick.choice(["user", "system", "assistant"])
        for turn in range(pick.randrange(9)):
            text = pick.choice(["Yes.", "No!", "cut", "", " \t\x0b", "Why?  \n", "é。", "…"]) + (str(pick.randrange(9)) + pick.choice([".", "", "? \r"]) if pick.random() < 0.6 else "")
            rows.append((conv, turn if pick.random() < 0.9 else turn + 7, role, text))
            role = pick.choice(["user", "assistant"]) if pick.random() < 0.2 else "assistant" if role == "user" else "user"
    rows += [(900, None, "user", "Hi."), (900, None, None, None), (900, 3, "", "x."), (901, 1, "tool", "Ran."), (901, 2, "User", "x!")]
    rows += [(None, t, r, f"{t}.") for t, r in enumerate(["user", "assistant"] * 4)]
    rows += [(902, t, "user" if t % 2 else "assistant", f"{t}." if t % 7 else "cut") for t in range(900)]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def test_against_plain_strings(spark):
    rows = corpus(1)
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = repair.repair_report(repair.damaged(table), table).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(report(rows), key=repr)


def test_split_conversations(spark, monkeypatch):
    """Pieces shorter than a conversation, from several partitions."""
    rows = [(7, t, ["user", "assistant", "user", "user", "system"][t * t % 5], f"{t % 50}{'.' if t % 3 else ''}") for t in range(3000)] + corpus(2, 20)
    table = spark.createDataFrame(rows, SCHEMA).repartition(6)
    ordered = repair.ordered_rows(repair.damaged(table))
    pieces = ordered.repartitionByRange(40, "seq").sortWithinPartitions("seq").mapInArrow(repair._pieces, repair._PIECES)
    assert pieces.filter("conv = 'c7'").count() > 20
    monkeypatch.setattr(repair, "conversation_pieces", lambda r: _in_parts(r))
    found = repair.repair_report(repair.damaged(table), table).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(report(rows), key=repr)


def _in_parts(rows):
    first = rows.groupBy("conv", "h1", "h2").agg(repair.F.min("seq").alias("seq")).withColumn("first", repair.F.lit(True)).select("seq", "first")
    code = repair.F.when(repair.F.col("first").isNull() & (repair.F.col("code") % 4 != 1), repair.F.col("code") - repair.F.col("code") % 4 + 2).otherwise(repair.F.col("code"))
    marked = rows.select("conv", "seq", "turn", "code").join(first, "seq", "left").select("conv", "seq", "turn", code.alias("code"))
    return marked.repartitionByRange(40, "seq").sortWithinPartitions("seq").mapInArrow(repair._pieces, repair._PIECES)


def test_strings_against_every_edit():
    pick = random.Random(3)
    for _ in range(150):
        rows = [(pick.choice(["user", "assistant", "system", "tool", ""]), pick.choice(["a.", "b.", "c", "", "d!"])) for _ in range(pick.randrange(4))]
        assert cheapest(rows, faults(rows)) == every_edit(rows, faults(rows)), rows


@pytest.mark.parametrize("seed", range(3))
def test_any_grammar_gives_the_same(seed):
    """Whatever the rules, and however deep they nest."""
    pick = random.Random(seed)
    rules = []
    while len(rules) < 40:
        most = repair.FIRST_RULE + len(rules)
        rule = (pick.randrange(most), pick.randrange(most))
        rules += [rule] if rule not in rules else []
    plain, deep = repair.Grammar([]), repair.Grammar(rules)
    for _ in range(200):
        codes = bytes(pick.randrange(16) for _ in range(pick.randrange(60)))
        assert repair.cheapest(plain.follow(repair.BEGIN, codes)) == repair.cheapest(deep.follow(repair.BEGIN, codes))
    long = bytes(pick.choice([4, 8, 7]) for _ in range(20_000))
    assert repair.cheapest(plain.follow(repair.BEGIN, long)) == repair.cheapest(deep.follow(repair.BEGIN, long))


def test_grammar_is_learned(spark):
    table = spark.createDataFrame([(c, t, "user" if t % 2 == 0 else "assistant", f"{t}.") for c in range(30) for t in range(16)], SCHEMA)
    grammar = repair.learn_grammar(repair.conversation_pieces(repair.ordered_rows(table)))
    symbols = repair._SYMBOL_OF[[4, 8] * 8]
    assert len(grammar.rules) >= 4 and len(grammar.rewritten(symbols)) == 1


def test_repaired_turns_are_returned(spark):
    table = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "There."), (1, 2, "assistant", "Ok."), (2, 0, "tool", "")], SCHEMA)
    rows = repair.ordered_rows(table)
    turns = repair.repaired_turns(rows, repair.repair_plans(rows, table)).orderBy("conv", "place").collect()
    assert [tuple(t) for t in turns] == [("c1", 1, "D", "user", "Hi."), ("c1", 2, "K", "user", "There."), ("c1", 3, "K", "assistant", "Ok."), ("c2", 1, "D", "tool", "")]


def test_empty_table_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repair_report(repair.damaged(empty), empty).collect() == []
    rows = corpus(4, 30)
    more = spark.createDataFrame([(*r, 5, "x", "y") for r in rows], SCHEMA + ", seq int, code string, conv string")
    assert sorted(map(tuple, repair.repair_report(repair.damaged(more), more).collect()), key=repr) == sorted(report(rows), key=repr)
