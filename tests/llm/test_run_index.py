import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from stayledger.llm import run_index
from stayledger.llm.run_index import repeated_windows, suffix_array, without_repeats


def brute_force(rows):
    """What is left of each text, from counts of all strings of 400 bytes."""
    data = [(doc_id, (text or "").encode()) for doc_id, text in rows]
    counts = Counter(text[i : i + 400] for _, text in data for i in range(len(text) - 399))
    out = []
    for doc_id, text in data:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - 399):
            if counts[text[i : i + 400]] > 1:
                gone[i : i + 400] = True
        runs = int((np.diff(np.append(False, gone).astype(int)) == 1).sum())
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out.append((doc_id, len(text), int(gone.sum()), runs, kept, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed=1):
    pick = random.Random(seed)
    letters = "abcdefghij éß\n"

    def noise(n):
        return "".join(pick.choice(letters) for _ in range(n))

    passages = [noise(n) for n in (399, 400, 401, 700, 2500)]
    texts = [noise(pick.randrange(2000)) for _ in range(20)]
    for _ in range(40):
        texts.append(noise(pick.randrange(300)) + pick.choice(passages) + noise(pick.randrange(300)) + pick.choice(passages)[: pick.randrange(2500)])
    long = noise(6000)
    for _ in range(25):  # near copies: edits at random places
        edited = list(long)
        for _ in range(4):
            edited[pick.randrange(6000)] = "!"
        texts.append("".join(edited))
    texts += [long, long, "a" * 399, "a" * 400, "a" * 1000, "ab" * 400, "xyz" * 133 + "q" + "xyz" * 133, "", None, " " * 405, noise(400) * 2]
    rows = list(enumerate(texts))
    return rows + [(None, passages[3]), (3, texts[3]), (3, texts[3]), (70, "other text, same id")]


@pytest.mark.parametrize("most", [4096, 3])
def test_against_all_strings(spark, monkeypatch, most):
    monkeypatch.setattr(run_index, "MOST_CONTEXTS", most)
    rows = corpus()
    docs = spark.createDataFrame([(i, text, 1, "x") for i, text in rows], "doc_id long, text string, start int, anchor string")
    found = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept), r.kept_sha256) for r in without_repeats(docs.repartition(5)).collect()]
    assert sorted(found, key=repr) == brute_force(rows)


def test_long_texts_are_cut_into_chunks(spark, monkeypatch):
    monkeypatch.setattr(run_index, "CHUNK", 1000)
    rows = corpus(2)[:40] + [(100, "long " * 3000), (101, "".join(random.Random(5).choice("abcdef") for _ in range(20_000)))]
    rows.append((102, rows[-1][1][7_123:15_456]))
    found = [contexts for text in rows for contexts in run_index.contexts([(text[1] or "").encode()])]
    assert sum(int(count.sum()) for _, _, count, *_ in found) == sum(max(0, len((t or "").encode()) - 399) for _, t in rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept), r.kept_sha256) for r in without_repeats(docs).collect()]
    assert sorted(left, key=repr) == brute_force(rows)


def test_suffix_order_and_statistics():
    pick = random.Random(3)
    for _ in range(30):
        texts = ["".join(pick.choice("ab") for _ in range(pick.randrange(60))).encode() for _ in range(pick.randrange(1, 6))]
        index = run_index.RunLengthIndex(texts)
        joined = []
        for k, text in enumerate(texts):
            joined += [b + len(texts) for b in text] + [k]
        assert suffix_array(np.array(joined)).tolist() == sorted(range(len(joined)), key=lambda i: joined[i:])

        def common(i, j):
            n = 0
            while i + n < len(joined) and j + n < len(joined) and joined[i + n] == joined[j + n]:
                n += 1
            return n

        expected = [max((common(i, j) for j in range(len(joined)) if j != i), default=0) for i in range(len(joined))]
        assert index.matching_statistics().tolist() == expected
        assert len(index.heads) <= len(joined)


def test_windows_of_one_text():
    assert [x.tolist() for x in repeated_windows([b"q" * 402, b"z" * 10])] == [[0, 1, 2], []]


def test_empty(spark):
    assert without_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
