import random

import duckdb
import pytest

from stayledger.llm import line_runs as operator
from stayledger.llm.line_runs import line_report, without_repeats
from stayledger.llm.oracle_book import OP5


def brute_force(rows, min_words=8):
    """Kept lines of each row, rows in order of doc_id; equal rows count once."""
    docs = sorted({(doc_id, text) for doc_id, text in rows if text is not None}, key=lambda r: (r[0] is None, r[0]))
    worded = {row: [i for i, line in enumerate(row[1].split("\n")) if line.encode().split()] for row in docs}
    gone = {row: set() for row in docs}
    for length in range(1, min_words + 1):
        seen = set()
        for row in docs:
            lines, places = row[1].split("\n"), worded[row]
            for k in range(len(places) - length + 1):
                window = tuple(lines[i] for i in places[k : k + length])
                if window in seen and sum(len(line.encode().split()) for line in window) >= min_words:
                    gone[row].update(places[k : k + length])
                seen.add(window)
    return {row: (worded[row], gone[row]) for row in docs}


def corpus(seed=1):
    pick = random.Random(seed)
    pool = [" ".join(pick.choice("abcdefgh") for _ in range(pick.choice([1, 1, 2, 3, 9]))) for _ in range(25)] + ["", " \t"]
    rows = [(i, "\n".join(pick.choice(pool) for _ in range(pick.randrange(25)))) for i in range(80)]
    run = "\n".join(f"line {i}" for i in range(12))
    return rows + [(i, f"own {i}\n{run}\nend {i}") for i in range(100, 110)] + [(200, ""), (201, "\n\n"), (202, None), (3, rows[3][1]), (203, "x y z\n" * 30_000)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_windows(spark, seed):
    rows = corpus(seed) + [(None, "no id\n" + corpus(seed)[2][1])]
    docs = spark.createDataFrame([(i, t, len(t or ""), "x") for i, t in rows], "doc_id long, text string, n_chars long, flags string").repartition(6)
    expected = brute_force(rows)
    left, report = [], []
    for row in rows:
        if row[1] is None:
            left.append((*row, 0, "x"))
            report.append((row[0], 0, 0))
            continue
        lines, (places, gone) = row[1].split("\n"), expected[row]
        kept = "\n".join(line for i, line in enumerate(lines) if i not in gone)
        report.append((row[0], len(lines), len(gone)))
        if not gone or set(places) - gone:
            left.append((row[0], kept, len(kept), "x"))
    assert sorted(map(tuple, without_repeats(docs).collect()), key=repr) == sorted(left, key=repr)
    assert sorted(((r.doc_id, r.n_lines, r.n_removed) for r in line_report(docs).collect()), key=repr) == sorted(report, key=repr)


def test_against_sql(spark):
    rows = [row for row in {r[0]: r for r in corpus(3)}.values() if row[0] != 203]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"text": "string"}))
    expected = con.execute(OP5).fetchall()
    assert sorted(map(tuple, line_report(docs).collect())) == sorted(map(tuple, expected))


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert line_report(docs).collect() == [] and without_repeats(docs).collect() == []


def test_main_path_is_native(spark, capsys):
    line_report(spark.createDataFrame(corpus(), "doc_id long, text string")).explain()
    assert not any(word in capsys.readouterr().out for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def all_lengths(rows, min_words):
    """Number of deleted lines by doc_id, trying every length of a run."""
    seen, out = set(), {}
    docs = [(doc_id, [line for line in text.split("\n") if line.split()]) for doc_id, text in sorted(rows)]
    gone = {doc_id: set() for doc_id, _ in docs}
    for doc_id, lines in docs:
        for at in range(len(lines)):
            for n in range(1, len(lines) - at + 1):
                window = tuple(lines[at : at + n])
                if window in seen and sum(len(line.split()) for line in window) >= min_words:
                    gone[doc_id].update(range(at, at + n))
                seen.add(window)
        out[doc_id] = len(gone[doc_id])
    return out


def test_runs_of_any_length(spark):
    rows = [(0, "a b c\nd e f\ng h i\nown"), (1, "other\na b c\n\nd e f\ng h i")]
    for n, words in ((3, "p q r"), (5, "s t"), (6, "u v"), (7, "w x")):
        run = "\n".join(f"{words} {i}" if n == 3 else f"{words[0]}{n}{i} {words[2]}" if n == 5 else f"{words[0]}{n}{i}" for i in range(n))
        long = run + ("" if n < 6 else " and more")
        rows += [(10 * n, long + "\nfirst"), (10 * n + 1, f"second {n}\n{long}")]
    pick = random.Random(9)
    pool = [" ".join(pick.choice("abcdefgh") for _ in range(pick.choice([1, 1, 2, 3, 4]))) for _ in range(12)]
    rows += [(200 + i, "\n".join(pick.choice(pool) for _ in range(pick.randrange(20)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for min_words in (8, 5, 1):
        assert {r.doc_id: r.n_removed for r in line_report(docs, min_words).collect()} == all_lengths(rows, min_words)
    assert {r.doc_id: r.n_removed for r in line_report(docs).collect()}[1] == 3


def test_no_query_holds_all_lengths(spark, monkeypatch):
    """The driver plans, compiles and runs all branches of a query side by side; those of all lengths in one took it the
    most memory of the pipeline. A query names the runs of one length at most, or unites what is named."""
    sizes = []

    def watched(df, name, write=operator.written):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        sizes.append((plan.count("Window") + plan.count("Join"), name))
        return write(df, name)

    monkeypatch.setattr(operator, "written", watched)
    without_repeats(spark.createDataFrame(corpus()[:20], "doc_id long, text string"))
    assert len(sizes) > 5 and max(sizes)[0] <= 6
