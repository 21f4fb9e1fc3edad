import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from stayledger.llm import bpe
from stayledger.llm.bpe import Encoder, RankQueue, decode_ids, encode_texts, merge_all, rank_table, token_digests
from stayledger.llm.query_book import BYTE_RANKS

ODD = ["", "a", " ", "  ", "\n", "\n\n", "a\nb", "a \nb", " a", "a ", "\x1ca\x1d b", "a\x85b", "x\xa0y", "don't  go 's", "aaaa" * 50, "日本語 12 345",
       "a\n", "\na", "a\x00b", "a\tb", "<|endoftext|>", "ß²½ ٣٤", "🙂🙂 ok", "a b", "\x1f", "b\x1e\n"]


@pytest.fixture(scope="module")
def own():
    return Encoder(BYTE_RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(own):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


def test_same_ids_as_the_library(own, library):
    pick = random.Random(1)
    letters = "ab .,\n\t 'stréß1２\x1c\x85　"
    texts = ODD + ["".join(pick.choice(letters) for _ in range(pick.randrange(60))) for _ in range(5000)]
    for text, ids in zip(texts, own.encode_many(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), repr(text)
        assert own.decode(ids) == text.encode()


def test_very_long_pre_token(own, library):
    pick = random.Random(2)
    text = "".join(pick.choice("etaoinshr") for _ in range(30_000))
    assert np.frombuffer(next(own.encode_many([text])), "<u4").tolist() == library.encode_ordinary(text)


def _by_hand(piece, ranks):
    """Merge the lowest-ranked pair, leftmost first, again and again."""
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[part] for part in parts]
        _, i = min(found)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_merges_that_make_a_lower_rank():
    tokens = [b"a", b"b", b"c", b"aba", b"bc", b"abab", b"ab", b"cab", b"abc", b"ca", b"aa"]
    ranks = {token: rank for rank, token in enumerate(tokens)}
    pick = random.Random(7)
    pieces = ["".join(pick.choice("abc") for _ in range(pick.randrange(1, 14))).encode() for _ in range(3000)]
    assert merge_all(pieces, ranks, rank_table(ranks)) == [_by_hand(piece, ranks) for piece in pieces]


def test_queue_gives_ranks_in_order():
    queue, pick = RankQueue(), random.Random(3)
    ranks = pick.sample(range(1 << 18), 500)
    for rank in ranks:
        queue.open(rank, [rank + 1])
    assert [queue.take() for _ in ranks] == [(rank, [rank + 1]) for rank in sorted(ranks)]
    assert queue.take() is None


def test_table(spark, library):
    rows = [(i, text, b"old") for i, text in enumerate([*ODD, None])] + [(None, "no id", None), (1, "a", b"old")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids binary")
    back = decode_ids(encode_texts(docs, BYTE_RANKS, public_tokenizers.PATTERN), BYTE_RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(bytes(r.decoded) for r in back) == sorted((text or "").encode() for _, text, _ in rows)
    found = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in token_digests(docs, BYTE_RANKS, public_tokenizers.PATTERN).collect()}
    for doc_id, text, _ in rows:
        ids = np.array(library.encode_ordinary(text or ""), "<u4")
        assert (doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()) in found
    assert token_digests(docs.limit(0), BYTE_RANKS, public_tokenizers.PATTERN).count() == 0


def test_plain_words_are_cut_without_the_pattern(own, library):
    pick = random.Random(9)
    units = ["".join(pick.choice([" ", ""]) + pick.choice("abÉßšªº'²x") + pick.choice(["", "don", "ữ", ".", "?!", "_", "'s"]) for _ in range(pick.randrange(1, 4))) for _ in range(3000)]
    asked = []
    fresh = Encoder(BYTE_RANKS, public_tokenizers.PATTERN)
    find = fresh._find
    fresh._find = lambda text: asked.append(text) or find(text)
    texts = ["Straße, école. Words!?", " and these;", *units]
    for text, ids in zip(texts, fresh.encode_many(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), repr(text)
    assert not {"Straße,", " école.", " Words!?", " and", " these;"} & set(asked)


def test_pieces_share_small_queues(monkeypatch):
    sizes = []
    merged = bpe.merge_flat
    monkeypatch.setattr(bpe, "merge_flat", lambda pieces, *rest: sizes.append([len(p) for p in pieces]) or merged(pieces, *rest))
    pick = random.Random(10)
    text = " ".join("".join(pick.choice("abcdefgh") for _ in range(9)) for _ in range(20_000))
    made = list(Encoder(BYTE_RANKS, public_tokenizers.PATTERN).encode_many([text, "x" * 100_000]))
    assert len(made) == 2 and max(sum(s) for s in sizes if len(s) > 1) <= bpe.MERGED_TOGETHER + 100_000 and len(sizes) > 10


def test_a_byte_without_a_rank_is_an_error():
    ranks = {b"a": 0, b"ab": 1}
    assert merge_all([b"ab", b"aab"], ranks, rank_table(ranks)) == [[1], [0, 1]]
    with pytest.raises(KeyError):
        merge_all([b"aba", b"ba"], ranks, rank_table(ranks))
