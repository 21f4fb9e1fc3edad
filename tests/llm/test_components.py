import random

import pytest

from stayledger.llm import components as operator
from stayledger.llm.components import components


def _expected(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {(x, root(x)) for x in list(parent)}


CASES = {
    "path": [(i, i + 1) for i in range(150)],
    "shuffled path": [(a, b) for path in [random.Random(1).sample(range(200), 200)] for a, b in zip(path, path[1:])],
    "hub": [(7, i) for i in range(500)],
    "random": [(pick.randrange(300), pick.randrange(300)) for pick in [random.Random(2)] for _ in range(200)],
    "loops, copies and nulls": [(1, 1), (2, 3), (3, 2), (2, 3), (None, 5), (6, None), (-4, 2)],
    "none": [],
}


@pytest.mark.parametrize("name", CASES)
def test_components(spark, name):
    edges = spark.createDataFrame(CASES[name], "u long, v long")
    found = components(edges).collect()
    assert {tuple(row) for row in found} == _expected(CASES[name])
    assert len(found) == len({row.node for row in found})


def test_a_round_reads_a_table_twice_at_most_in_a_query(spark, monkeypatch):
    """The driver plans and compiles every reading; one query for a whole round had sixteen."""
    scans = []

    def watched(df, name, write=operator.written):
        scans.append(df._jdf.queryExecution().sparkPlan().toString().count("FileScan"))
        return write(df, name)

    monkeypatch.setattr(operator, "written", watched)
    components(spark.createDataFrame(CASES["random"], "u long, v long"))
    assert len(scans) > 3 and max(scans) <= 2
