import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from test_pipeline import prose

from stayledger.llm.context_mixing import CONTEXTS, HEAD, SLOTS, Mixer, Spelled, Starts, score, starts_of
from stayledger.llm.shingles import words_of


def rows_of():
    pick = random.Random(6)
    rows = [(i, prose(pick, "en", pick.randrange(60)), 1, "x") for i in range(250)]
    rows += [(300, None, 1, "x"), (301, "", 1, "x"), (302, "The  the\tTHE\n", 1, "x"), (303, "É é \x1c", 1, "x"), (None, "no id", 1, "x"), (3, rows[3][1], 1, "x")]
    return rows + [(304, "w" * 30_000 + " the", 1, "x")]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def tokens(text):
    data = (text or "").encode()
    return bytes(c + 32 if 65 <= c <= 90 else c for c in data).split()


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.createDataFrame(rows_of(), "doc_id long, text string, count int, word string").repartition(5)
    return score(docs).collect()


def test_counts_and_base(scored):
    rows = rows_of()
    counts = Counter(w for doc_id, text, *_ in rows if not held(doc_id) for w in [*tokens(text), None])
    n, v = sum(counts.values()), len(counts)
    expected = []
    for doc_id, text, *_ in rows:
        own = [*tokens(text), None]
        expected.append((doc_id, held(doc_id), len(own), sum(counts[w] > 0 for w in own), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own), 6)))
    found = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in scored]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_scores_are_probabilities_that_follow_the_text(scored):
    assert all(r.score < 0 and math.isfinite(r.score) and r.bits_per_byte > 0 for r in scored)
    prose_bits = [r.bits_per_byte for r in scored if r.held_out and r.n_tokens > 20]
    assert np.mean(prose_bits) < 3
    assert len({r.score for r in scored if r.doc_id == 3}) == 1
    assert {r.score for r in scored if r.doc_id == 300} == {r.score for r in scored if r.doc_id == 301}


def test_probabilities_of_all_next_bytes_add_up():
    pick = np.random.default_rng(2)
    mixer = Mixer(pick.integers(0, 50, (CONTEXTS, SLOTS, 2)).astype(np.float32), 2)
    mixer.refined = pick.random((len(mixer.weights), 33))
    for prefix in (b"", b"th"):
        total = 0.0
        for byte in range(256):
            spelled = Spelled([prefix + bytes([byte])], np.ones(1))
            p = 1.0
            for k, bit, slots in spelled.decisions():
                one = mixer.probability(*mixer.inputs(k, bit, slots, None))[len(prefix)]
                p *= one if bit[len(prefix)] else 1 - one
            total += p
        assert total == pytest.approx(1.0)


def test_no_training_text(spark):
    only_held = [i for i in range(60) if held(i)][:2]
    docs = spark.createDataFrame([(i, "some words") for i in only_held], "doc_id long, text string")
    found = score(docs).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found] == [(3, 0, 0, 0.0)] * 2
    assert all(r.score < 0 for r in found)
    assert score(docs.limit(0)).collect() == []


def test_starts_hold_the_bytes_before_the_word():
    texts = ["The cat of a  b c de\tI", "", None, "x", "a", "é ö another abc", "a b"]
    expected = []
    for i, text in enumerate(texts):
        before = b""
        for word in [*(w + b" " for w in tokens(text)), b"\n"]:
            for place in range(min(HEAD, len(word))):
                seen = before[:-1][-(HEAD - place) :].rjust(HEAD - place, b"\0") + word[: place + 1]
                expected.append((i, place << 8 * (HEAD + 1) | int.from_bytes(seen, "big")))
            before += word
    starts, owner = starts_of(*words_of(pa.array(texts, pa.string())))
    assert sorted(zip(owner.tolist(), starts.tolist())) == sorted(expected)


def test_a_word_without_text_before_it_costs_the_same_in_parts():
    pick = np.random.default_rng(4)
    mixer = Mixer(pick.integers(0, 50, (CONTEXTS, SLOTS, 2)).astype(np.float32), 2)
    for word in (b"a", b"abc", b"there", b"\n"):
        spelled = Spelled([word], np.ones(1))
        whole = sum(math.log10(p if b else 1 - p) for k, bit, slots in spelled.decisions() for b, p in zip(bit, mixer.probability(*mixer.inputs(k, bit, slots, None))))
        closed = word if word == b"\n" else word + b" "
        starts = np.array([i << 8 * (HEAD + 1) | int.from_bytes(closed[: i + 1], "big") for i in range(min(HEAD, len(closed)))])
        assert mixer.log10([word])[0] + mixer.log10_starts(starts).sum() == pytest.approx(whole)
        for (_, bit, slots), (_, same_bit, same_slots) in zip(spelled.decisions(), Starts(starts, np.ones(len(starts))).decisions()):
            assert (bit[: len(starts)] == same_bit).all() and (slots[:, : len(starts)] == same_slots).all()


def test_the_order_of_words_counts(spark):
    pick = random.Random(8)
    after = {f"{a}{b}ra": f"{b}{a}no" for a in "bdfgklm" for b in "aeiou"}

    def text(n):
        return [w for first in pick.choices(list(after), k=n) for w in (first, after[first])]

    rows = [(i, " ".join(text(20))) for i in range(300)]
    in_order = text(20)
    shuffled = pick.sample(in_order, len(in_order))
    held_ids = [i for i in range(1000, 1100) if held(i)][:2]
    rows += [(held_ids[0], " ".join(in_order)), (held_ids[1], " ".join(shuffled))]
    found = {r.doc_id: r for r in score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    one, two = (found[i] for i in held_ids)
    assert one.base_score == pytest.approx(two.base_score)
    assert one.score > two.score + 1
