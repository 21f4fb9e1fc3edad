import math
import random
from pathlib import Path

import numpy as np
import pytest

from stayledger.llm import cells
from stayledger.llm import posting_lists
from stayledger.llm.cells import near_vectors
from stayledger.llm.posting_lists import nearest
from stayledger.llm.storage import written


def rows_of(n=700, d=8, seed=1):
    pick = np.random.default_rng(seed)
    near = pick.normal(size=(12, d))
    rows = [(pick.normal(size=d) if i % 3 else near[i % 12] + pick.normal(size=d) * 0.25).tolist() for i in range(n)]
    rows += [near[0].tolist()] * 30 + [(near[0] * 7).tolist(), (near[1] * 1e-200).tolist(), (near[1] * 1e200).tolist()]
    rows += [None, [], [0.0] * d, [math.nan] + [1.0] * (d - 1), [math.inf] + [1.0] * (d - 1), [None] + [1.0] * (d - 1), [1.0] * (d + 1)]
    out = [(i, v, "x", 0) for i, v in enumerate(rows)]
    random.Random(3).shuffle(out)
    return out + [(None, None, "x", 0), (5, out[0][1], "x", 0), (None, near[2].tolist(), "x", 0)]


def good(v, d=8):
    return v is not None and len(v) == d and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute_force(rows, cosine=0.9):
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    usable = [i for i, r in enumerate(rows) if good(r[1])]
    unit = cells._unit(np.array([rows[i][1] for i in usable]))
    for a, b in np.argwhere(np.triu(unit @ unit.T >= cosine, 1)).tolist():
        i, j = usable[a], usable[b]
        links[i] += 1
        links[j] += 1
        x, y = root(i), root(j)
        parent[max(x, y)] = min(x, y)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return sorted(((r[0], links[i], least.get(root(i)), r[0] == least.get(root(i))) for i, r in enumerate(rows)), key=repr)


@pytest.mark.parametrize("block", [4096, 64])
def test_near_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(cells, "CELL", 60)
    monkeypatch.setattr(cells, "BLOCK", block)
    rows = rows_of()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node string, cell int")
    assert sorted(map(tuple, near_vectors(table.repartition(5)).collect()), key=repr) == brute_force(rows)


def test_linked_pairs_meet_once():
    """Near the borders of eleven cells, with blocks of 50: every pair of links shares one task, where it is compared."""
    pick = np.random.default_rng(4)
    rows = pick.normal(size=(900, 6))
    centres = cells.spherical_means(rows, 11)
    home, visits = cells.homes_and_visits(rows, centres, cells._apart(centres), 0.9)
    h, v = cells._blocks(np.bincount(home, minlength=11), visits.sum(axis=0), 50)
    node = pick.integers(-(2**62), 2**62, 900)
    met = np.zeros((900, 900), int)
    groups = {}
    for row, *task, side in cells._tasks(node, home, visits, h, v).T.tolist():
        groups.setdefault(tuple(task), ([], []))[side].append(row)
    for (cell, kind, i, j), (left, right) in groups.items():
        if kind == 0 and i == j:
            met[np.ix_(left, left)] += 1
        else:
            met[np.ix_(left, right)] += 1
            met[np.ix_(right, left)] += 1
    unit = cells._unit(rows)
    linked = np.triu(unit @ unit.T >= 0.9, 1)
    assert linked.sum() > 500 and (home[:, None] != home)[linked].any() and (met[linked] == 1).all()


def _shuffle_bytes(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(f.stat().st_size for folder in folders for f in Path(folder).rglob("shuffle_*.data"))


def test_vectors_without_clusters_stay_off_the_disk(spark, monkeypatch):
    """A few copies of each vector lie in shuffle files at a time, and none after."""
    pick = np.random.default_rng(6)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(pick.normal(size=(3000, 32)))], "vec_id long, embedding array<float>").repartition(4)
    for name, size in (("CELL", 200), ("BLOCK", 200)):
        monkeypatch.setattr(cells, name, size)
    sizes = [_shuffle_bytes(spark)]
    monkeypatch.setattr(cells, "written", lambda df, name: (written(df, name), sizes.append(_shuffle_bytes(spark)))[0])
    assert near_vectors(table).filter("n_links = 0 AND kept").count() == 3000
    assert max(sizes) - sizes[0] < 4 * 3000 * 32 * 4


def test_nothing_to_compare(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert near_vectors(table).collect() == []
    table = spark.createDataFrame([(1, None), (2, [])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, near_vectors(table).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


def exact_nearest(rows, every=20, k=20):
    usable = [r for r in rows if r[0] is not None and good(r[1])]
    out = {}
    for query in usable:
        if query[0] % every == 0:
            scored = sorted((-math.fsum(x * y for x, y in zip(query[1], r[1])), r[0]) for r in usable if r[0] != query[0])
            out[query[0]] = [(i, -s) for s, i in scored[:k]]
    return out


def _answers(found):
    out = {}
    for row in sorted(found, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(row.query_id, []).append((row.vec_id, row.score))
        assert row.rank == len(out[row.query_id])
    return out


def test_nearest_is_exact_where_all_lists_are_searched(spark, monkeypatch):
    monkeypatch.setattr(posting_lists, "BLOCK", 200)
    monkeypatch.setattr(posting_lists, "ASKERS", 9)
    rows = [r for r in rows_of() if r[0] != 5 and not (r[1] and any(abs(x or 0) > 1e100 for x in r[1] if x and math.isfinite(x)))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node string, cell int")
    got, want = _answers(nearest(table.repartition(4)).collect()), exact_nearest(rows)
    assert got.keys() == want.keys()
    right = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert right >= 0.97 * sum(map(len, want.values()))
    for q in want:
        for (i, s), (j, t) in zip(got[q], want[q]):
            assert s <= t + 1e-9
            if i == j:
                assert s == pytest.approx(t)


def test_few_candidates_and_ties(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (40, [0.0, 2.0]), (7, None)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert _answers(nearest(table).collect()) == {0: [(1, 1.0), (2, 1.0), (40, 0.0)], 40: [(0, 0.0), (1, 0.0), (2, 0.0)]}
    assert nearest(table.limit(0)).collect() == []
    many = spark.createDataFrame([(i, [3.0, 4.0]) for i in range(500)], "vec_id long, embedding array<float>")
    found = _answers(nearest(many).collect())
    assert found[0] == [(i, 25.0) for i in range(1, 21)] and found[480] == [(i, 25.0) for i in range(20)]


def test_recall(spark):
    pick = np.random.default_rng(9)
    rows = [(i, v.tolist()) for i, v in enumerate(pick.normal(size=(6000, 24)))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, want = _answers(nearest(table, every=100).collect()), exact_nearest(rows, 100)
    right = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert right >= 0.9 * 20 * len(want)


@pytest.mark.parametrize("share", [1.0, 0.5])
@pytest.mark.parametrize("clusters", [1, 300, 800])
def test_recall_through_the_walk(clusters, share):
    pick = np.random.default_rng(clusters)
    centres = pick.normal(size=(clusters, 32))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    rows = centres[pick.integers(0, clusters, 12_000)] + pick.normal(size=(12_000, 32)) * (0.05 if clusters > 1 else 1.0)
    sample = rows[pick.permutation(len(rows))[: int(len(rows) * share)]]
    made = posting_lists.fit(sample, len(rows) // posting_lists.LIST, np.linalg.norm(rows, axis=1).max(), 20)
    homes = np.zeros((len(rows), len(made.centroids)), bool)
    for row, own in enumerate(made.assign(rows)):
        homes[row, own] = True
    asked = np.arange(0, len(rows), 20)
    scores = rows[asked] @ rows.T
    scores[np.arange(len(asked)), asked] = -np.inf
    best = np.argpartition(-scores, 19, axis=1)[:, :20]
    found = sum(homes[row][:, own].any(axis=1).sum() for row, own in zip(best, made.probe(rows[asked])))
    assert found >= 0.95 * best.size
