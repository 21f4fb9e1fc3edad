import math
import random
import re
from collections import Counter

import duckdb

from stayledger.llm import lexical_search
from stayledger.llm.lexical_search import best_documents, terms
from stayledger.llm.oracle_book import OP13

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_force(docs, items, most=20):
    found = [(doc_id, Counter(split(text))) for doc_id, text in docs]
    found = [(doc_id, bag, bag.total()) for doc_id, bag in found if bag]
    n_docs, n_terms = len(found), sum(n for _, _, n in found)
    df = Counter(term for _, bag, _ in found for term in bag)
    out = []
    wanted = {}
    for item_id, text in items:
        wanted.setdefault(item_id, Counter()).update(split(text))
    for item_id, bag in wanted.items():
        scored = []
        for doc_id, own, n in found:
            m = 75 + 25 * n * n_docs // n_terms
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * own[t] // (1000 * own[t] + 12 * m)) for t, times in bag.items() if own[t])
            if score > 0:
                scored.append((-score, math.inf if doc_id is None else doc_id, doc_id))
        out += [(item_id, rank, doc_id, -score) for rank, (score, _, doc_id) in enumerate(sorted(scored)[:most], 1)]
    return sorted(out, key=repr)


def corpus(seed, copies=60):
    pick = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdé漢" for b in "xyzXY0"]
    text = lambda n: pick.choice([" ", ", ", "\n", "-"]).join(pick.choice(words[: pick.choice([6, 20, 36])]) for _ in range(n))
    docs = [(i, text(pick.randrange(30))) for i in range(300)]
    docs += [(1000 + i, docs[7][1]) for i in range(copies)] + [(500 - i, docs[7][1].upper() + " none") for i in range(copies)]
    docs += [(2000, None), (2001, ""), (2002, "?!"), (3, docs[3][1]), (3, docs[4][1]), (None, docs[5][1]), (2003, " ax" * 400_000)]
    items = [(i, text(pick.randrange(12))) for i in range(30)] + [(90, None), (91, "nowhere else"), (92, docs[7][1]), (92, "ax Ax")]
    return docs, items


def table(spark, rows, name):
    return spark.createDataFrame(rows, f"{name} long, text string")


def test_against_all_pairs(spark):
    docs, items = corpus(1)
    found = best_documents(table(spark, docs, "doc_id").repartition(6), table(spark, items, "item_id"))
    assert found.schema.simpleString() == "struct<item_id:bigint,rank:int,doc_id:bigint,score:bigint>"
    assert sorted(map(tuple, found.collect()), key=repr) == brute_force(docs, items)


def test_blocks_of_items_and_parts(spark, monkeypatch):
    """Items in several blocks, texts in several parts: the same rows. Fewer wanted documents: the first of them."""
    docs, items = corpus(2)
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", 7)
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 40)
    found = best_documents(table(spark, docs, "doc_id"), table(spark, items, "item_id"), 3)
    assert sorted(map(tuple, found.collect()), key=repr) == brute_force(docs, items, 3)


def test_parts_of_a_text(monkeypatch):
    docs, _ = corpus(3)
    monkeypatch.setattr(lexical_search, "CHUNK", 5)
    for _, text in docs[:200]:
        assert [t.decode() for part in terms(text or "") for t in part] == split(text)


def test_against_sql(spark):
    docs, items = corpus(4)
    docs, items = [row for row in {r[0]: r for r in docs}.values() if row[0] is not None], [row for row in {r[0]: r for r in items}.values()]
    con = duckdb.connect()
    con.register("documents", table(spark, docs, "doc_id").toPandas().astype({"text": "string"}))
    con.register("benchmark", table(spark, items, "item_id").toPandas().astype({"text": "string"}))
    expected = sorted(map(tuple, con.execute(OP13).fetchall()))
    assert sorted(map(tuple, best_documents(table(spark, docs, "doc_id"), table(spark, items, "item_id")).collect())) == expected


def test_empty_tables_and_other_columns(spark):
    docs, items = corpus(5, 3)
    none = lambda name: spark.createDataFrame([], f"{name} long, text string")
    assert best_documents(none("doc_id"), table(spark, items, "item_id")).collect() == []
    assert best_documents(table(spark, docs, "doc_id"), none("item_id")).collect() == []
    more = spark.createDataFrame([(i, t, "b", 5, 6.0) for i, t in docs], "doc_id long, text string, bag string, n int, `hash.m` double")
    wide = spark.createDataFrame([(i, t, 1, "k") for i, t in items], "item_id long, text string, item int, key string")
    assert sorted(map(tuple, best_documents(more, wide).collect()), key=repr) == brute_force(docs, items)
