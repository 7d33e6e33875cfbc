"""Splitting, merging and round trips of the BPE operator against the reference libraries."""

import hashlib
import tracemalloc

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetzone.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
ENC = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
SPLIT = regex.compile(P.PATTERN)

HARD = ["", " ", "  ", "\n", " \n a", "don't we'll I'd they've 's''s 'S a'b '", "it's\n'tis  'twas", "x'", "''re",
        "é 1½² Ⅷ 一二 ", "a b　 c ", "end  ", "tab\t\tx", " 'll", "!'s", "5's", "\x1c\x1d a", "😀 😀😀!",
        "<|endoftext|>", "a" * 300, "ab" * 500, "\r\n\r\n x", "'l", "'ll'll've", "n't’t"]


def split(texts):
    block = bpe.Block(texts)
    words = [block.words[c].decode() for c in block.codes]
    out, at = [], 0
    for n in block.counts:
        out.append(words[at:at + n])
        at += n
    return out


def test_split_equals_pattern():
    assert split(HARD) == [SPLIT.findall(t) for t in HARD]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab's tredlmv'\n\t 1½é一!?  😀\x1c"), max_size=30), max_size=6))
def test_split_equals_pattern_random(texts):
    assert split(texts) == [SPLIT.findall(t) for t in texts]


def test_split_of_a_long_text_in_pieces(monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 50)
    text = "It's a  long\n\n text 'll we've " * 20 + "x" * 200 + "  end "
    assert split([text, "b", text]) == [SPLIT.findall(t) for t in (text, "b", text)]


def test_repeats_over_many_chunks_share_their_words(monkeypatch):
    """A word seen in an earlier chunk keeps its code; the words stay in the order of their hashes."""
    texts = ["the cat sat on the mat", "", "the dog é sat", "mat the 😀 cat " * 9, "new words", "the"]
    whole = bpe.Block(texts)
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 7)
    parts = bpe.Block(texts)
    assert parts.words == whole.words and len(set(parts.words)) == len(parts.words)
    assert parts.hashes.tolist() == sorted(parts.hashes.tolist()) == whole.hashes.tolist()
    assert parts.codes.tolist() == whole.codes.tolist() and parts.counts.tolist() == whole.counts.tolist()
    assert parts.name == whole.name and split(texts) == [SPLIT.findall(t) for t in texts]


def test_memory_of_a_block():
    """A block needs a few times its own text, not its pre-tokens' offsets and hashes all at once."""
    rng = np.random.RandomState(5)
    words = np.array(["w%x" % i for i in range(20_000)])
    texts = [" ".join(words[rng.randint(0, len(words), 400)]) for _ in range(3000)]
    size = sum(map(len, texts))
    bpe.Block(texts[:10])                                    # tables that stay
    tracemalloc.start()
    try:
        bpe.Block(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 10 * size, (peak, size)


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=80))
def test_merge_equals_library(word):
    assert bpe.merge(word, RANKS) == ENC._encode_single_piece(word)


def test_merge_of_long_words():
    rng = np.random.RandomState(3)
    for n in (25, 200, 3000):
        for alphabet in (b"ab", b"thenre ", bytes(range(256))):
            word = bytes(rng.choice(list(alphabet), n).astype(np.uint8))
            assert bpe.merge(word, RANKS) == ENC._encode_single_piece(word)


ROWS = [(i, t) for i, t in enumerate(HARD)] + [(100, None), (None, "null id"), (3, "\n"), (101, "the " * 3000)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(t, i, "x") for i, t in ROWS], "text string, doc_id long, block string").repartition(3).cache()


def key(r):
    return (r.doc_id is None, r.doc_id, r.n_tokens)


def test_encode_and_decode(spark, docs):
    got = sorted(bpe.encode(docs).collect(), key=key)
    want = sorted(((i, ENC.encode_ordinary(t or "")) for i, t in ROWS), key=lambda x: (x[0] is None, x[0], len(x[1])))
    assert [(r.doc_id, r.n_tokens, list(r.ids)) for r in got] == [(i, len(x), x) for i, x in want]
    back = bpe.decode(bpe.encode(docs)).collect()
    assert sorted((r.doc_id or -1, bytes(r.data)) for r in back) == sorted((i or -1, (t or "").encode()) for i, t in ROWS)


def test_digests(spark, docs):
    got = bpe.encode(docs, emit=bpe.emit_digests, schema=bpe.DIGESTS).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = [(i, len(x), sha(" ".join(map(str, x)).encode()), sha((t or "").encode()))
            for i, t in ROWS for x in [ENC.encode_ordinary(t or "")]]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_empty_table_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(empty).collect() == []
    rows = spark.createDataFrame([(1, None)], "k int, ids array<int>")
    assert bpe.decode(rows).collect()[0].data is None
