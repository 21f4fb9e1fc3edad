import random
import zlib

import corpus_pipeline
import numpy as np
from test_pipeline import prose

from stayledger.llm import language
from stayledger.llm.language import Model, SuffixAutomaton, identify, learn, symbols

TEXTS = {"en": ["the thing and the other", "sharing"], "fr": ["l'eau que voilà", "la que"]}


def by_hand(model, text, name):
    """Phrases of a greedy parse by searching the labelled text itself."""
    known = [symbols(language._codes(t), model.alphabet).tolist() for t in TEXTS[name]]
    part = symbols(language._codes(text), model.alphabet).tolist()
    phrases, at = 0, 0
    while at < len(part):
        n = 1
        lane_end = (at // language.LANE + 1) * language.LANE
        while at + n <= min(len(part), lane_end) and part[at] != 0 and any(part[at : at + n] == k[i : i + n] for k in known for i in range(len(k))):
            n += 1
        at += max(1, n - 1)
        phrases += 1
    return phrases


def test_phrases(monkeypatch):
    monkeypatch.setattr(language, "LANE", 7)
    model, pick = Model(TEXTS), random.Random(1)
    texts = ["", "the", "que l'eau", "ж the ж", *("".join(pick.choice("aehtqul 'à1") for _ in range(pick.randrange(40))) for _ in range(200))]
    parts = [symbols(language._codes(t), model.alphabet) for t in texts]
    expected = [[by_hand(model, t, name) for name in model.languages] for t in texts]
    assert model.phrases(parts).tolist() == expected


def test_automaton_accepts_exactly_the_substrings():
    pick = random.Random(2)
    for _ in range(20):
        text = [pick.randrange(3) for _ in range(pick.randrange(25))]
        edges, words = SuffixAutomaton(text).edges, set()
        stack = [(0, ())]
        while stack:
            state, word = stack.pop()
            words.add(word)
            stack += [(to, (*word, symbol)) for symbol, to in edges[state].items()]
        assert words == {tuple(text[i:j]) for i in range(len(text) + 1) for j in range(i, len(text) + 1)}


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_held_out_accuracy_and_odd_rows(spark):
    pick = random.Random(3)
    rows = [(i, prose(pick, lang, 40), lang, "s", 0.0) for i in range(200) for lang in [("en", "fr")[i % 2]]]
    odd = [(900, None, "en"), (901, "", "fr"), (902, "12 + 3", "fr"), (903, "жжж", None), (None, "the and the", "en"), (1, "the and ing", "en"), (904, "the ing " * 60_000, None)]
    rows += [(*r, "s", 0.0) for r in odd]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double").repartition(4)
    found = identify(docs, learn(docs)).collect()
    assert len(found) == len(rows)
    test = [r for r in found if r.held_out and r.doc_id < 200]
    assert len(test) > 40 and np.mean([r.lang_pred == r.lang for r in test]) == 1.0
    assert all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 for r in found)
    by_id = {r.doc_id: r for r in found}
    assert [by_id[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and by_id[903].mean_match == 1.0
    assert by_id[904].lang_pred == "en" and by_id[None].lang_pred == "en"


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(5, "some text", None)], "doc_id long, text string, lang string")
    model = learn(docs)
    assert [(r.lang_pred, r.score) for r in identify(docs, model).collect()] == [("und", 0.0)]
    assert identify(docs.limit(0), model).collect() == []


SCRIPTS = {"zh": [chr(0x4E00 + 7 * i) for i in range(400)], "ru": "что дом мир лес сад ение ость при жить щука".split(), "el": "και το λόγος ψυχή θεός ξένος".split()}


def written_in(pick, lang):
    if lang == "en":
        return prose(pick, "en", 30)
    end = "" if lang == "zh" else " "
    return end.join("".join(pick.choice(SCRIPTS[lang]) for _ in range(pick.randrange(1, 4))) for _ in range(30))


def test_phrases_of_letters_without_a_column(monkeypatch):
    pick = random.Random(4)
    texts = [*(written_in(pick, lang) for lang in ["en", *SCRIPTS] * 4), "the 丅 ж q", ""]
    samples = {lang: [written_in(pick, lang) for _ in range(5)] for lang in ["en", *SCRIPTS]}
    found = []
    for letters in (0, 5, 60, 5000):  # 5000: all have a column
        monkeypatch.setattr(language, "LETTERS", letters)
        model = Model(samples)
        found.append(model.phrases([symbols(language._codes(t), model.alphabet) for t in texts]).tolist())
    assert found[0] == found[1] == found[2] == found[3]


def test_scripts_of_many_letters(spark):
    pick = random.Random(5)
    langs = ["en", *SCRIPTS]
    rows = [(i, written_in(pick, langs[i % 4]), langs[i % 4], "s", 0) for i in range(400)]
    odd = [(900, "ქართული ენა", None, "s", 0), (901, "t", "en", "s", 0), (902, SCRIPTS["zh"][3], "zh", "s", 0), (903, "ქ", None, "s", 0)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    found = identify(docs, learn(docs)).filter("held_out AND doc_id < 400").collect()
    assert len(found) > 100 and all(r.lang_pred == r.lang for r in found)
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in corpus_pipeline.known_language(spark, docs, "").collect()} == {900, 903}


def test_whole_texts_teach_and_names_may_hold_dots(spark):
    """A shared opening decides nothing, since texts are learned whole; overlong ones do not teach."""
    pick = random.Random(6)
    opening = prose(pick, "en", 200)
    rows = [(i, opening * (lang == "fr") + prose(pick, lang, 300), lang, 1) for i in range(60) for lang in [("en", "fr")[i % 2]]]
    rows += [(700, prose(pick, "en", 30_000), "fr", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, `a.b` int").repartition(3)
    model = learn(docs)
    mine = spark.createDataFrame([(i, prose(pick, ("en", "fr")[i % 2], 40), 2) for i in range(40)], "doc_id long, text string, `x.y` int")
    assert all(r.lang_pred == ("en", "fr")[r.doc_id % 2] for r in identify(mine, model).collect())
    assert corpus_pipeline.known_language(spark, docs, "").columns == docs.columns and identify(docs, model).count() == 61
