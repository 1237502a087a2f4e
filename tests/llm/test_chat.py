import hashlib

import pytest

from postloom.llm import chat

LOG = "conv_id LONG, turn LONG, seq LONG, kind STRING, role STRING, text STRING"
HARD = [r"\### Assistant: </turn> ok", "", "###", "a\\", "\\</turn>", "<</turn></turn>", "x\n### user: y</turn>\n", "####\\#", "é\U0001f600"]


def test_escapes_are_reversible():
    for text in HARD:
        for role in ["user", "a:b\\", "", "###", "</turn>"]:
            shown = f"### {chat.escape(role, True)}: {chat.escape(text)}</turn>\n"
            assert list(chat.parse(shown * 2)) == [(role, text)] * 2
            assert "</turn>" not in chat.escape(text).replace("\\</turn>", "")
    with pytest.raises(ValueError):
        list(chat.parse("### user x"))


def folded(spark, rows):
    return [(r.conv_id, r.role, list(chat.parse(r.formatted))[0][1]) for r in chat.format_chats(spark.createDataFrame(rows, LOG)).collect()]


def test_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 0, 0, "message", "user", "hi"), (1, 1, 1, "delta", "assistant", "one "), (1, 1, 2, "delta", "assistant", "two"),
        (1, 2, 3, "message", "user", "lost"), (1, 1, 4, "regenerate", "assistant", None), (1, 1, 5, "delta", "assistant", "three"),
        (1, 2, 6, "message", "user", "kept"), (1, 2, 7, "edit", "user", "Kept"), (1, 3, 8, "edit", "assistant", "alone"),
    ]
    want = [(1, "user", "hi"), (1, "assistant", "three"), (1, "user", "Kept"), (1, "assistant", "alone")]
    assert folded(spark, rows) == want
    assert folded(spark, rows[::-1]) == want


def test_nulls_ties_and_repeats(spark):
    rows = [(None, None, None, None, None, None), (2, 0, 0, "message", "user", "b"), (2, 0, 0, "message", "user", "a"), (2, 0, 0, "message", "user", "a")]
    assert sorted(folded(spark, rows), key=str) == [(2, "user", "a"), (2, "user", "a"), (2, "user", "b"), (None, "", "")]
    assert chat.format_chats(spark.createDataFrame([], LOG)).count() == 0


def test_read_back(spark):
    turns = [(c, i, "assistant" if i % 2 else "user", t) for c in (3, 4) for i, t in enumerate(HARD)]
    df = spark.createDataFrame(turns, "conv_id LONG, turn LONG, role STRING, text STRING").selectExpr("*", "1 AS seq", "2 AS position", "3 AS kind")
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(chat.turn_events(df))).collect()}
    marks = "\\#"
    shown = lambda t, marks: "".join("\\" + x if x in marks else x for x in t).replace("</turn>", "\\</turn>")
    for c in (3, 4):
        mine = [t for t in turns if t[0] == c]
        loss = "".join(t[3] for t in mine if t[2] == "assistant")
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        r = got[c]
        assert (r.n_turns, r.turns_sha256) == (len(mine), digest("".join(f"{t[2]}\n{t[3]}\n" for t in mine)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), digest(loss))
        assert r.formatted_chars == len("".join(f"### {shown(t[2], '#:')}: {shown(t[3], marks)}</turn>\n" for t in mine))
