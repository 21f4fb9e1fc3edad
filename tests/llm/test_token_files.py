import random
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from stayledger.llm import simple8b, token_files
from stayledger.llm.query_book import WORD_TOKENIZER
from stayledger.llm.token_files import WordEncoder, read_token_files, write_token_files
from stayledger.session import shared_folder

ODD = ["", " ", "a", "\x00", "don't GO'S  now.", "<|endoftext|> <|ENDOFTEXT|>x", "é É ﬀ ² ½ ΣΑΣ. Σ", "a\x0bb\x0cc\x1cd\x85e\xa0f", "a̸ ≮", "日本 語，x"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 2**64 - 1), st.integers(0, 70000), st.integers(0, 1)), max_size=400))
def test_round_trip(values):
    words = simple8b.pack(np.array(values, np.uint64))
    assert simple8b.unpack(words, len(values)).tolist() == values
    assert simple8b.values_per_word(words).sum() >= len(values)


def test_long_round_trip_is_compact():
    values = np.random.default_rng(3).integers(0, 1 << 15, 200_000).astype(np.uint64)
    words = simple8b.pack(values)
    assert (simple8b.unpack(words, len(values)) == values).all()
    assert len(words) <= len(values) / 4 + 1


def test_words_equal_whole_texts():
    library = Tokenizer.from_file(WORD_TOKENIZER)
    own, pick = WordEncoder(WORD_TOKENIZER), random.Random(5)
    letters = "abT .,!\n\t'sréßΣ²1<|>\x0b\x1c̸\xa0"
    texts = ODD + ["".join(pick.choice(letters) for _ in range(pick.randrange(50))) for _ in range(3000)]
    for text, ids in zip(texts, own.encode_many(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def _written(spark, rows, extra=""):
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, part int")
    folder = f"{shared_folder(spark)}/tokens-{random.random()}"
    write_token_files(docs.repartition(5), WORD_TOKENIZER, 1, folder)
    return read_token_files(spark, folder).orderBy("start").collect()


def test_files_give_back_every_document(spark):
    long = " ".join(f"w{i} straße," for i in range(60_000))
    rows = [(i, text, "x", 1) for i, text in enumerate([*ODD, None, long, *(f"copy {k % 3}" for k in range(300))])]
    rows += [(None, "no id", None, None), (4, "same id", "x", 2), (4, "same id", "x", 2)]
    library = Tokenizer.from_file(WORD_TOKENIZER)
    found = _written(spark, rows)
    expected = {}
    for doc_id, text, *_ in rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4").tobytes()
        expected.setdefault(doc_id, []).append(ids)
    assert len(found) == len(rows)
    assert [r.doc_id for r in found] == sorted((r.doc_id for r in found), key=lambda x: (x is None, x))
    start = 0
    for row in found:
        assert row.start == start and row.n_tokens == len(row.ids) // 4 and row.ids_crc32 == zlib.crc32(row.ids)
        assert bytes(row.ids) in expected[row.doc_id]
        start += row.n_tokens


def test_no_documents(spark):
    assert _written(spark, []) == []




def test_different_words_are_looked_up_once(monkeypatch):
    own, library = WordEncoder(WORD_TOKENIZER), Tokenizer.from_file(WORD_TOKENIZER)
    pick = random.Random(12)
    letters = ["a", "É", "ß", "x", "日", "ª", "İ", "क़", "'", "1", ".", "?!", ",", "_", "\x1c"]
    words = ["".join(pick.choice(letters) for _ in range(pick.randrange(1, 6))) for _ in range(400)]
    texts = [pick.choice([" ", "\n", "\t "]).join(pick.choices(words, k=pick.randrange(40))) for _ in range(300)]
    expected = [library.encode(text, add_special_tokens=False).ids for text in texts]
    asked = []

    class Counting:
        def encode_batch_fast(self, some, **more):
            asked.extend(word for text in some for word in text.split(" "))
            return library.encode_batch_fast(some, **more)

    own._library = Counting()
    assert [ids.tolist() for ids in own.encode_many(pa.array(texts))] == expected
    once = len(asked)
    assert [ids.tolist() for ids in own.encode_many(pa.array([*texts, None]))] == [*expected, []] and len(asked) == once
    monkeypatch.setattr(token_files, "KEPT_PARTS", 50)
    monkeypatch.setattr(token_files, "TEXTS_TOGETHER", 500)
    assert [ids.tolist() for ids in own.encode_many(texts)] == expected


def test_letters_and_any_ascii_punctuation_are_looked_up_apart():
    own, library = WordEncoder(WORD_TOKENIZER), Tokenizer.from_file(WORD_TOKENIZER)
    ends = ["***", "'", "'.", "_", "%%%", "@", "<|", "|>", "\\", "`]", "^-", '"}', "#&$~"]
    letters = [f"{a}{b}{c}" for a in "asÉд" for b in "TLß日" for c in ["", "ll", "d", "endoftext"]]
    texts = [" ".join(word + end for end in ends) for word in letters] + ["a's. <|endoftext|>*** x<|endoftext|>' ***b* I'LL'"]
    expected = [library.encode(text, add_special_tokens=False).ids for text in texts]
    asked = []

    class Counting:
        def encode_batch_fast(self, some, **more):
            asked.extend(word for text in some for word in text.split(" "))
            return library.encode_batch_fast(some, **more)

    own._library = Counting()
    assert [ids.tolist() for ids in own.encode_many(texts)] == expected
    assert len(asked) <= len(letters) + len(ends) + len(texts[-1].split())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 2**64 - 1), st.integers(0, 70000), st.integers(0, 1)), max_size=200))
def test_words_hold_as_many_values_as_fit(values):
    words, at = simple8b.pack(np.array(values, np.uint64)), 0
    for held in simple8b.values_per_word(words).tolist():
        fits = [n for n, bits in simple8b.LAYOUTS.values() if all(int(float(v)).bit_length() <= bits for v in values[at : at + n])]
        assert held in (0, max(fits, default=1))
        at += held
