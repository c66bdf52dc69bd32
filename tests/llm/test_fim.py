import hashlib
import random

import numpy as np
import pytest

from movegrid.llm import fim
from tests.llm import helpers

KINDS = {fim.Runs, fim.Array, fim.Bitmap}


def by_hand(doc_id, text):
    """The contract, on a Python string."""
    t = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(t) + 1), h[1] % (len(t) + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(t), "plain", None, None, t
    p, m, s = t[:a], t[a:b], t[b:]
    out = f"<S>{s}<P>{p}<M>{m}" if h[3] % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
    return len(t), "spm" if h[3] % 100 < 20 else "psm", a, b - a, out


TEXTS = [None, "", "a", "<", "<P", "x<P>y", "one <S> two", "<M>", "äöü€😀", "é́ \x00 \r\n", "<<S" * 30, "S><P" * 9, "word " * 40_000, "日本語" * 30_000, "a😀" * 20_000]


def test_documents_match_the_contract(spark):
    texts = TEXTS * 12
    docs = helpers.docs(spark, texts)
    got = {r["doc_id"]: r for r in fim.restore(fim.fill_in_middle(docs)).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == by_hand(i, t) and r["restored"] == (t or "")
    assert {r["form"] for r in got.values()} == {"plain", "psm", "spm"}


def test_null_ids_repeats_empty_tables_and_clashing_columns(spark):
    docs = helpers.docs(spark, ["some text here"] * 3 + [None], [None, 4, 4, 5]).selectExpr("*", "1 AS __text", "2 AS __h1", "3 AS n", "4 AS restored")
    rows = sorted(map(tuple, fim.digests(docs).collect()), key=repr)
    want = sorted([(i, *by_hand(i, t)[:4], helpers.sha(by_hand(i, t)[4]), helpers.sha(t or "")) for i, t in [(None, "some text here"), (4, "some text here"), (4, "some text here"), (5, None)]], key=repr)
    assert rows == want
    assert fim.digests(docs.limit(0)).collect() == []
    kept = fim.fill_in_middle(docs, keep=("doc_id", "__text", "__h1")).collect()
    assert {(r["__text"], r["__h1"]) for r in kept} == {(1, 2)}
    with pytest.raises(ValueError):
        fim.fill_in_middle(docs, keep=("n",))


def test_select_over_every_kind_of_container():
    rnd, kinds = random.Random(5), set()
    ascii_, mixed, wide_ = "x" * 200_000, "".join(rnd.choice("aé€😀") for _ in range(90_000)), "😀" * 40_000
    for text in (ascii_, mixed, wide_, "a", "é", ascii_ + mixed + ascii_, "é" * 32_768, "x" * 65_535, "x" * 65_536, "x" * 65_537):
        data = text.encode()
        ends = fim.Boundaries(data)
        kinds |= {type(p) for p in ends.parts}
        assert len(ends) == len(text)
        for k in {0, 1, len(text), len(text) - 1, *(rnd.randrange(len(text) + 1) for _ in range(200))}:
            assert data[:ends.select(k)].decode() == text[:k]
    for gap, kind in ((40, fim.Array), (3, fim.Bitmap)):
        words = [w for i in range(60_000) for w in ["y" * (gap + i % 2)]]
        data = " ".join(words).encode()
        ends = fim.Boundaries(data, "word")
        kinds |= {type(p) for p in ends.parts}
        assert len(ends) == len(words) and any(isinstance(p, kind) for p in ends.parts)
        for k in (1, 2, 1_000, 59_999, 60_000):
            assert data[:ends.select(k)] == (" ".join(words[:k]) + (" " if k < len(words) else "")).encode()
    assert kinds == KINDS


def test_container_is_the_smallest():
    assert isinstance(fim.container(np.arange(10, 60_000)), fim.Runs)
    assert isinstance(fim.container(np.arange(0, 65_536, 40)), fim.Array)
    assert isinstance(fim.container(np.arange(0, 65_536, 2)), fim.Bitmap)


def test_other_units_and_marks(spark):
    text = "one two\nthree  four\n\nfive"
    docs = helpers.docs(spark, [text] * 200)
    for unit, parts in (("word", ["one ", "two\n", "three  ", "four\n\n", "five"]), ("line", ["one two\n", "three  four\n", "\n", "five"])):
        cut = fim.restore(fim.fill_in_middle(docs, unit=unit, seed="7", rate=100, marks=("[[", "]]", "||")), ("[[", "]]", "||")).collect()
        starts = {len("".join(parts[:i])) for i in range(len(parts) + 1)}
        for r in cut:
            assert r["n"] == len(parts) and r["restored"] == text
            assert r["prefix_chars"] in starts and r["prefix_chars"] + r["middle_chars"] in starts
        assert len({r["prefix_chars"] for r in cut}) == len(starts)
