"""Byte-level BPE and token counts against the tokenizer libraries."""
import random
import struct

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from movegrid.llm import bpe, encode, token_counts
from tests.llm.helpers import docs, rows, sha

RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
DATA = open(RANKS, "rb").read()
REF = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(DATA), special_tokens={})
TOK = Tokenizer.from_file(JSON)
BITS = ["a", "b", " ", "  ", "'", "s", "re", "'re", "\n", "1", "é", "日", "!", "\u3000", "\u200b", "th", "ing", "aaaa", "😀", "\t", "\x1c", "\x85", "\xa0", "²", "ª", "ll"]
AWKWARD = [None, "", " ", "   ", "a", "'", "x'", "it's 've", "\x00\x01", "ab" * 5000, "a" * 3000, " " * 5000, "é" * 4000, "日本語 " * 900,
           "<|endoftext|>", "a<|endoftext|>b<|endoftext|><|endof", "thing " * 4000, "line\n\n\nline  ", "thing " * 4000]


def ids(text):
    data = encode.encode_bytes(text, encode._worker(DATA)[1])
    return list(struct.unpack(f"<{len(data) // 4}I", data))


def test_pattern_is_the_vocabulary_s():
    assert bpe.PATTERN == P.PATTERN


@pytest.mark.parametrize("text_leaf,token_leaf", [(1 << 14, 8), (7, 3), (2, 2)])
def test_encoding_matches_library_for_any_leaf_size(monkeypatch, text_leaf, token_leaf):
    monkeypatch.setattr(bpe, "TEXT_LEAF", text_leaf)
    monkeypatch.setattr(bpe, "TOKEN_LEAF", token_leaf)
    enc, packed = encode._worker(DATA)
    packed.clear(), enc.leaves.clear()
    rng = random.Random(text_leaf)
    for _ in range(1500):
        text = "".join(rng.choice(BITS) for _ in range(rng.randrange(60)))
        assert ids(text) == REF.encode_ordinary(text)
    packed.clear(), enc.leaves.clear()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_encoding_and_counts_match_libraries(text):
    assert ids(text) == REF.encode_ordinary(text)
    counts, cut = token_counts._worker(open(JSON, "rb").read())
    assert token_counts.count_text(text, counts, cut) == len(TOK.encode(text, add_special_tokens=False).ids)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab'se \n1é", max_size=40), st.integers(0, 40))
def test_join_of_any_two_halves_is_the_split_of_the_whole(text, at):
    at = min(at, len(text))
    split = lambda t: bpe.split_leaf(t)
    assert bpe.join_parts(split(text[:at]), split(text[at:])) == split(text)


def test_all_vocabulary_strings_are_proved_whole():
    enc, special = token_counts.read_merges(open(JSON, "rb").read())
    whole = token_counts.whole_tokens(enc)
    assert special == ["<|endoftext|>"]
    assert all(len(TOK.encode(t, add_special_tokens=False).ids) == 1 for t in sorted(whole)[::500])


def test_digests_over_awkward_rows(spark):
    df = docs(spark, [*AWKWARD, "dup", "dup"], [*range(len(AWKWARD)), None, None])
    got = rows(encode.digests(df, RANKS))
    want = []
    for i, t in [*enumerate(AWKWARD), (None, "dup"), (None, "dup")]:
        x = REF.encode_ordinary(t or "")
        want.append((i, len(x), sha(struct.pack(f"<{len(x)}I", *x)), sha(t or "")))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_encode_and_decode_apart_give_the_same(spark):
    df = docs(spark, AWKWARD)
    apart = encode.decode(encode.encode(df, RANKS), RANKS).select("doc_id", "ids", "decoded")
    assert sorted(map(repr, rows(apart))) == sorted(map(repr, rows(encode.round_trip(df, RANKS))))


def test_counts_over_awkward_rows(spark):
    got = rows(token_counts.token_counts(docs(spark, AWKWARD), JSON, limit=1))
    want = [(i, len((t or "").encode()), n := len(TOK.encode(t or "", add_special_tokens=False).ids), n > 1) for i, t in enumerate(AWKWARD)]
    assert sorted(got) == want


def test_empty_tables_and_clashing_columns(spark):
    empty = docs(spark, [])
    assert rows(encode.digests(empty, RANKS)) == [] and rows(token_counts.token_counts(empty, JSON)) == []
    clash = spark.createDataFrame([(1, "abc", 5, 6, "x")], "doc_id long, text string, ids int, n_tokens int, decoded string")
    assert rows(encode.digests(clash, RANKS)) == rows(encode.digests(clash.select("doc_id", "text"), RANKS))
    assert rows(token_counts.token_counts(clash, JSON))[0][:2] == (1, 3)


def test_other_file_kinds_are_refused():
    with pytest.raises(ValueError):
        token_counts.read_merges(open(P.path("word_bpe_49k.json"), "rb").read())


def test_decoding_up_the_tree_is_concatenation():
    tokens = [bytes([65 + i % 26]) * (i % 5) for i in range(300)]
    for n in (0, 1, 2, encode.LEAF - 1, encode.LEAF, encode.LEAF + 1, 5 * encode.LEAF + 3):
        ids = np.random.default_rng(n).integers(0, 300, n).astype("<u4")
        assert encode.decode_bytes(ids.tobytes(), tokens) == b"".join(tokens[i] for i in ids)
    assert encode.decode_bytes(None, tokens) == b""


def test_proof_is_made_once_and_is_that_of_merging(monkeypatch):
    data = open(P.path("byte_bpe_50k.json"), "rb").read()
    made = []
    monkeypatch.setattr(token_counts, "whole_tokens", lambda enc, f=token_counts.whole_tokens: made.append(1) or f(enc))
    monkeypatch.setattr(token_counts, "_proofs", {})
    first = token_counts.proof(data)
    assert token_counts.proof(data) is first and made == [1]
    enc, _ = token_counts.read_merges(data)
    bits = np.unpackbits(np.frombuffer(first, np.uint8))
    for t in ["the", " the", "a", "zzzz", " antidis"]:
        rank = enc.ranks.get(t.encode())
        assert rank is None or bool(bits[rank]) == (enc.merge(t.encode()) == [rank])
    assert bits.sum() > 40_000


def test_cache_keeps_what_is_asked_for_again(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 100)
    made = []
    cache = bpe.Cache(lambda part: made.append(part) or len(part))
    for i in range(1000):
        assert cache["often"] == 5 and cache[f"x{i}"] == len(f"x{i}") and len(cache) + len(cache.older) <= 100
    assert made.count("often") == 1
