import random

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from test_near_text import shingle_set

from stayledger.llm.bpe import read_ranks
from stayledger.llm.query_book import BYTE_RANKS

SYLLABLES = {"en": "the and ing tion er ly wh sh th".split(), "fr": "eau que ou é è ment tion la".split()}


def prose(pick, lang, words):
    return " ".join("".join(pick.choice(SYLLABLES[lang]) for _ in range(pick.randrange(1, 4))) for _ in range(words))


def documents():
    pick = random.Random(8)
    rows = []
    for i in range(60):
        lang = "en" if i % 3 else "fr"
        text = "\n".join(prose(pick, lang, pick.randrange(9, 20)) for _ in range(pick.randrange(1, 8)))
        rows.append([i, text, lang, f"s{i % 3}", len(text)])
    rows.append([60, rows[4][1], "en", "s0", 1])  # exact copy
    near = rows[10][1].split(" ")
    near[len(near) // 2] = "changed"
    rows.append([61, " ".join(near), "en", "s1", 1])
    rows += [[62, "12 34 !!", "en", "s1", 8], [63, None, None, None, None], [64, "", "en", None, 0], [65, "дом мир лес сад", None, "s2", 15]]
    rows.append([66, "line of its own that many share\n" + rows[1][1].split("\n")[0] + " and more", "en", "s2", 50])
    return rows


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.createDataFrame(documents(), "doc_id long, text string, lang string, source string, n_chars long")
    found = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        found.append(docs.collect())
        docs = spark.createDataFrame(found[-1], docs.schema)
    return found


def test_columns(stages):
    assert [len(rows) > 0 for rows in stages] == [True] * 6
    for rows in stages[:5]:
        assert rows[0].__fields__ == ["doc_id", "text", "lang", "source", "n_chars"]
    assert stages[5][0].__fields__ == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_language_stage_keeps_prose(stages):
    assert {r.doc_id for r in stages[0]} - {r.doc_id for r in stages[1]} == {62, 63, 64, 65}


def test_line_stage_deletes_later_copies(stages):
    before, after = ({r.doc_id: r.text for r in rows} for rows in stages[1:3])
    lines, seen = {}, set()
    for doc_id in sorted(before):
        parts = before[doc_id].split("\n")
        lines[doc_id] = [line for line in parts if not (line in seen and len(line.split()) >= 8)]
        seen.update(parts)
    assert after == {doc_id: "\n".join(parts) for doc_id, parts in lines.items() if parts}
    assert 60 not in after


def test_near_stage_keeps_one_of_each(stages):
    before, after = ({r.doc_id: r.text for r in rows} for rows in stages[2:4])
    sets = {doc_id: shingle_set(text) for doc_id, text in before.items()}

    def near(a, b):
        return 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])

    assert all(any(near(gone, kept) for kept in after) for gone in before.keys() - after.keys())
    assert not any(near(a, b) for a in after for b in after if a < b)


def test_mix_stage_meets_its_targets(stages):
    sizes, taken = {}, {}
    for r in stages[3]:
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
    for r in stages[4]:
        taken[r.source] = taken.get(r.source, 0) + len(r.text.split())
    total, names = sum(sizes.values()), sorted(sizes)
    weights, open_, target = {s: 1 + i % 3 for i, s in enumerate(names)}, set(names), {}
    rest = total
    while open_:
        level = rest / sum(weights[s] for s in open_)
        over = {s for s in open_ if level * weights[s] > 3 * sizes[s]}
        for s in over or open_:
            target[s] = 3 * sizes[s] if s in over else level * weights[s]
        rest -= sum(target[s] for s in over)
        open_ = open_ - over if over else set()
    assert all(abs(taken[s] - target[s]) < 1 for s in names)


def test_last_stage_encodes_the_mix(stages):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(BYTE_RANKS), special_tokens={})
    expected = sorted((r.doc_id, len(library.encode_ordinary(r.text))) for r in stages[4])
    assert sorted((r.doc_id, r.n_tokens) for r in stages[5]) == expected
    assert np.sum([r.n_tokens for r in stages[5]]) > 0


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.collect() == []
