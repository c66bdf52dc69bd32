import public_tokenizers as P
from hypothesis import given, settings, strategies as st

from movegrid.llm import chat
from tests.llm.helpers import rows, sha

JSON = P.path("byte_bpe_50k.json")
DDL = "conv_id long, turn long, role string, text string, ids string, segment int"


def brute(turns):
    """conv_id -> (n_turns, turns digest, loss chars, loss digest) from rows (conv, turn, role, text)."""
    by = {}
    for c, t, r, x in turns:
        by.setdefault(c, []).append(((t is not None, t or 0), (r is not None, r or ""), (x is not None, x or "")))
    out = {}
    for c, own in by.items():
        own.sort()
        said = [(r[1], x[1]) for _, r, x in own]
        loss = "".join(x for r, x in said if r == "assistant")
        out[c] = (len(own), sha("".join(f"{r}\n{x}\n" for r, x in said)), len(loss), sha(loss))
    return out


def check(spark, turns):
    df = spark.createDataFrame([(*t, "x", 1) for t in turns], DDL)
    got = rows(chat.read_chat(chat.format_chat(df, JSON)).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"))
    want = brute(turns)
    assert {r[0]: r[1:] for r in got} == want and len(got) == len(want)


CONTROL = [r"\### Assistant: </turn> ok", "<|end|>", "<|turn|>assistant<|text|>no<|end|>\n", "<\\|end|>", "\\", "<", "<|", "|>", "\\<|", "<|endoftext|>", "  \n ", "é日😀", "", None]


def test_control_strings_roles_nulls_and_ties(spark):
    turns = [(i, j, role, x) for i, x in enumerate(CONTROL) for j, role in enumerate(("user", "assistant", "system", "assistant"))]
    turns += [(None, 0, "assistant", "null id"), (None, None, None, "x"), (99, 1, "assistant", "b"), (99, 1, "assistant", "a"), (99, 1, "assistant", "a"),
              (98, None, "assistant", "first"), (98, 0, "<|text|>", "role"), (97, 0, "assistant", "word " * 30_000)]
    check(spark, turns)


def test_long_conversations_come_in_segments(spark, monkeypatch):
    monkeypatch.setattr(chat, "SEGMENT", 200)
    turns = [(c, j, ("user", "assistant")[j % 2], f"turn {j} of {c} <|end|>") for c in range(3) for j in range(301)]
    check(spark, turns)
    df = spark.createDataFrame([(*t, "x", 1) for t in turns], DDL)
    got = rows(chat.format_chat(df, JSON).select("conv_id", "segment", "formatted"))
    whole = "".join(f for _, _, f in sorted(g for g in got if g[0] == 1))
    assert whole == "".join(chat.render(r, x)[0] for c, _, r, x in turns if c == 1)


def test_a_long_conversation_is_dealt_to_many_tasks(spark):
    turns = [(c % 40 if c % 3 else 7, j, ("user", "assistant")[j % 2], f"turn {j} of {c} <|end|>") for c in range(600) for j in range(c * 5, c * 5 + 5)]
    turns += [(7, 1, "assistant", "x" * 70 + str(i)) for i in range(30)] + [(None, i, "assistant", f"null {i}") for i in range(300)]
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(spark, turns)
        done = chat.format_chat(spark.createDataFrame([(*t, "x", 1) for t in turns], DDL), JSON)
        got = rows(done.selectExpr("conv_id", "segment", "whole", "n_turns", "formatted", "spark_partition_id()"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    hot = sorted(g[1:] for g in got if g[0] == 7)
    assert len({g[-1] for g in hot}) > 2 and max(g[2] for g in hot) < sum(g[2] for g in hot) / 2
    own = sorted((j, r, x) for c, j, r, x in turns if c == 7)
    assert "".join(g[3] for g in hot) == "".join(chat.render(r, x)[0] for _, r, x in own)
    assert any(g[2] for g in got) and all(sum(h[0] == g[0] for h in got) == 1 for g in got if g[2])


def test_empty(spark):
    assert rows(chat.read_chat(chat.format_chat(spark.createDataFrame([], DDL), JSON))) == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="\\<|>x\n", max_size=12))
def test_escape_is_reversible_and_hides_control_strings(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text and not any(c in hidden for c in (chat.TURN, chat.TEXT, chat.END)) and "<|" not in hidden


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), st.text(max_size=20)), min_size=1, max_size=5))
def test_masked_text_is_the_assistant_s(turns):
    tok = chat._worker(open(JSON, "rb").read())
    text, spans = "", []
    for role, x in turns:
        r, a, b = chat.render(role, x)
        if role == "assistant":
            spans.append((len(text) + a, len(text) + b))
        text += r
    _, starts, ends, loss = chat.encode_segment(tok, text, spans)
    assert "".join(chat.masked_text(text, starts, ends, loss)) == "".join(x for r, x in turns if r == "assistant")
