import random
from collections import defaultdict

import duckdb

from stayledger.llm.mixing import mix, mixed_documents
from stayledger.llm.oracle_book import OP6


def rows_of(seed=1):
    pick = random.Random(seed)
    rows = []
    for i in range(300):
        source = pick.choice(["b", "a", "ä", None, "tiny"] + ["hot"] * 5)
        n = pick.randrange(40) if source != "tiny" else 1
        rows.append((i, " ".join("w" * pick.randrange(1, 9) for _ in range(n)), source, "x", 7))
    return rows + [(None, "no id here", "a", "x", 1), (None, None, "a", "x", 1), (7, rows[7][1], rows[7][2], "x", 7), (500, "", "empty", "x", 0), (501, " \n", "empty", "x", 0)]


SCHEMA = "doc_id long, text string, source string, taken string, size int"


def targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s) + [s for s in sizes if s is None]
    weights = {s: 1 + i % 3 for i, s in enumerate(names)}
    rest, open_, out = float(sum(sizes.values())), set(names), {}
    while open_:
        level = rest / sum(weights[s] for s in open_)
        over = {s for s in open_ if level * weights[s] > 3 * sizes[s]}
        for s in over or open_:
            out[s] = 3.0 * sizes[s] if s in over else level * weights[s]
        rest -= sum(out[s] for s in over)
        open_ = open_ - over if over else set()
    return out


def test_targets_and_takes(spark):
    rows = rows_of()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    found = mix(docs).collect()
    assert len(found) == len(rows)
    sizes, source_of = defaultdict(int), defaultdict(list)
    for doc_id, text, source, *_ in rows:
        sizes[source] += len((text or "").split())
    expected = targets(sizes)
    by_size = {size: source for source, size in sizes.items()}
    assert len(by_size) == len(sizes)  # so that a source can be told by its size
    for row in found:
        source = by_size[row.source_size]
        assert abs(row.target - expected[source]) < 1e-6 and 0 <= row.taken <= 3 * row.size
        source_of[source].append(row.taken)
    assert all(abs(sum(source_of[s]) - expected[s]) < 1 for s in sizes)
    again = mix(spark.createDataFrame(random.Random(2).sample(rows, len(rows)), SCHEMA)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, found))


def test_against_sql(spark):
    rows = [(i, text, source, 1) for i, (_, text, source, *_) in enumerate(rows_of(3))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n int")
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"text": "string", "source": "string"}))
    expected = con.execute(OP6).fetchall()
    got = [(r.doc_id, r.size, r.source_size, r.target, r.taken) for r in mix(docs).collect()]
    assert sorted(got) == sorted(tuple(row) for row in expected)


def test_documents_of_the_mix(spark):
    rows = rows_of()
    docs = spark.createDataFrame(rows, SCHEMA)
    taken = defaultdict(int)
    for row in mix(docs).collect():
        taken[row.doc_id] += row.taken
    found, texts = defaultdict(int), {}
    for doc_id, text, *_ in rows:
        texts.setdefault(doc_id, set()).add(text)
    for row in mixed_documents(docs).collect():
        found[row.doc_id] += len(row.text.split())
        assert any(text and text.startswith(row.text) for text in texts[row.doc_id])
        assert (row.taken, len(row)) == ("x", 5)
    assert found == {doc_id: n for doc_id, n in taken.items() if n}


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mix(docs).collect() == [] and mixed_documents(docs).collect() == []
