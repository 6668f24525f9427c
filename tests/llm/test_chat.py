"""Event-sourced chat formatting against a plain fold."""

import hashlib

from hypothesis import given
from hypothesis import strategies as st

from spendlink.llm import chat
from spendlink.llm.common import table

EVENTS = "conv_id bigint, seq bigint, message string, kind string, role string, text string, segment string"


def expected(turns):
    out = {}
    for conv, _, role, text in sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1])):
        out.setdefault(conv, []).append((role or "", text or ""))
    rows = {}
    for conv, items in out.items():
        loss = "".join(t for r, t in items if r == "assistant")
        rows[conv] = (
            len(items), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in items).encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
        )
    return rows


def test_fold(spark):
    log = [
        (1, 1, "a", "start", "user", None), (1, 2, "a", "delta", None, "Hel"), (1, 3, "a", "delta", None, "lo"),
        (1, 4, "b", "start", "assistant", ""), (1, 5, "b", "delta", None, "bad"), (1, 6, "b", "regenerate", None, "x"),
        (1, 7, "b", "delta", None, "go"), (1, 9, "b", "delta", None, "d"), (1, 8, "b", "delta", None, "o"),
        (1, 10, "a", "edit", None, "Hi"), (1, 11, "a", "delta", None, "!"),
        (1, 12, "c", "start", "user", ""), (1, 13, "c", "delta", None, "gone"), (1, 14, "c", "retract", None, None),
        (2, 1, "d", "start", None, None),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in log[::-1]], EVENTS)
    got = sorted((r.conv_id, r.seq, r.role, r.text) for r in chat.fold(df).collect())
    assert got == [(1, 1, "user", "Hi!"), (1, 4, "assistant", "good"), (2, 1, "", "")]


def test_round_trip_of_odd_rows(spark):
    trap = "\\### Assistant: </turn> ok"
    turns = [
        (1, 0, "user", trap), (1, 1, "assistant", trap), (1, 2, "assistant", "\\t \\h### \\\\</turn></turn>\n#### "),
        (2, 5, None, None), (2, 3, "a: b\\c", "x"), (3, 0, "assistant", "\U0001f600é" * 2000), (None, 1, "user", "n"),
        (4, 1, "user", "same"), (4, 1, "user", "same"), (5, None, "assistant", ""),
    ]
    df = spark.createDataFrame([(*t, "clash") for t in turns], "conv_id bigint, turn bigint, role string, text string, seq string")
    out = chat.digests(chat.render(chat.fold(chat.log_of_turns(df)))).collect()
    plain = [(c, -1 if t is None else t, r, x) for c, t, r, x in turns]
    assert {r.conv_id: tuple(r[1:5]) for r in out} == expected(plain)
    assert len(out) == 6 and all(r.formatted_chars > 0 for r in out)


def test_very_long_turn(spark):
    """Linear in the text: seconds, not minutes."""
    text = "a\U0001f600\n### </turn>\\" * 500_000
    turns = [(1, 0, "user", text), (1, 1, "assistant", text[: 3 * chat.PIECE]), (1, 2, "user", "z" * chat.PIECE)]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    assert chat.log_of_turns(df).count() == 3 + -(-len(text) // chat.PIECE) + 3 + 1
    out = chat.digests(chat.render(chat.fold(chat.log_of_turns(df)))).collect()
    assert {r.conv_id: tuple(r[1:5]) for r in out} == expected(turns)


@given(st.text(alphabet="\\thc</turn>#: é\n", max_size=30))
def test_unescape(text):
    escaped = text.replace("\\", "\\\\").replace("</turn>", "\\t").replace("### ", "\\h")
    assert "</turn>" not in escaped and "### " not in escaped and chat.unescape(escaped) == text


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.digests(chat.render(chat.fold(chat.log_of_turns(df)))).collect() == []


def test_query(spark):
    rows = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "conversations").select("conv_id", "turn", "role", "text").collect()]
    trap = "\\### Assistant: </turn> ok"
    want = expected([*rows, (-7, 0, "user", trap), (-7, 1, "assistant", trap)])
    got = {r.conv_id: tuple(r[1:5]) for r in chat.query(spark, "/root/testdata/sf0.001").collect()}
    assert got == want
