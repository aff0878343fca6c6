import random

import public_tokenizers
import pytest
import sentencepiece

from webwinnow.llm.token_counts import Merges, read_pieces, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["▁", " ", "  ", "    ", "\n", "\r", "\t", "a", "b", "the", "ing", "é", "漢", "😀", "<s>", "<0x41>", "\xa0", ".", "==", "aaaa", "\x00", "́"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def merges():
    return Merges(tuple(read_pieces(MODEL)))


def test_counts_equal_the_library(merges, library):
    r = random.Random(3)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randrange(60))) for _ in range(3000)]
    texts += [" " * 5000, "x" * 5000, "ab" * 3000, "▁ " * 50, " a" * 3000, "".join(chr(r.randrange(32, 0x3000)) for _ in range(5000))]
    assert [merges.count(x) for x in texts] == [len(x) for x in library.encode(texts, num_threads=1)]


def test_slices_do_not_change_the_count(merges, library, monkeypatch):
    monkeypatch.setattr("webwinnow.llm.token_counts._CHUNK", 7)
    r = random.Random(4)
    texts = ["".join(r.choice(PARTS) for _ in range(60)) for _ in range(500)]
    assert [merges.count(x) for x in texts] == [len(x) for x in library.encode(texts, num_threads=1)]


def test_a_long_run_is_merged_in_one_heap(merges, library):
    text = "".join(random.Random(5).choice("abcdefgh0123456789+/") for _ in range(1_000_000))
    assert merges.count(text) == len(library.encode(text))


def test_a_small_vocabulary_by_hand():
    pieces = tuple((p, -float(i)) for i, p in enumerate(["ab", "bc", "abc", "a", "b", "c", "▁"]))
    counted = Merges(pieces)
    assert counted.tokens("abc") == 1 and counted.tokens("bcab") == 2 and counted.tokens("abbc") == 2
    assert counted.tokens("aß") == 3  # an unknown character counts as its bytes


def test_awkward_rows(spark, awkward, library):
    rows = {(x.doc_id, x.text): x for x in awkward.collect()}
    got = token_counts(awkward, MODEL, limit=10).collect()
    assert len(got) == 12
    want = sorted((str(i), len((t or "").encode()), len(library.encode(t or ""))) for i, t in rows for _ in range(2 if i == 1 else 1))
    assert sorted((str(x.doc_id), x.n_bytes, x.n_tokens) for x in got) == want
    assert all(x.over_limit == (x.n_tokens > 10) for x in got)
    assert token_counts(awkward.where("false"), MODEL).count() == 0
