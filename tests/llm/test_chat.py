"""Chat formatting: the grammar's round trip, and the operator against plain Python."""

import hashlib

import oracle
import pytest
from helpers import sha
from hypothesis import example, given, settings
from hypothesis import strategies as st

from fieldloom.llm import chat

SF = "/root/testdata/sf0.001"
BITS = ["<", "[", "s>", "</s>", "<s>", "[INST]", " [/INST]", "<<SYS>>", "\n<</SYS>>\n", "[ROLE] ", " [TEXT] ", "[/ROLE]", "\\", " ", "\n", "a", "é", "TEXT]", "/", ">", "]"]
text = st.lists(st.sampled_from(BITS), max_size=8).map("".join)
role = st.one_of(st.sampled_from(["user", "assistant", "system", "tool", ""]), text)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(role, text), max_size=6))
@example([("user", chat.CONFLICT), ("assistant", chat.CONFLICT)])
@example([("[TEXT]", " [TEXT] "), ("assistant", "\\"), ("assistant", "")])
def test_round_trip(turns):
    done = [chat.render_checked(*t) for t in turns]
    whole = "".join(d[0] for d in done)
    assert [(t.role, chat.unescape(whole[t.start : t.end])) for t in chat.parse(whole)] == turns
    assert [chat.unescape(d[0][d[1] : d[1] + d[2]]) for d in done] == [t for _, t in turns]


@settings(max_examples=500, deadline=None)
@given(text)
def test_escape_is_taken_back(t):
    assert chat.unescape(chat.escape(t)) == t and not chat.CONTROL.search(chat.escape(t))


def test_only_conflicts_are_escaped():
    assert chat.render_checked("user", "a < b [x] \\ <b>")[0] == "[INST] a < b [x] \\ <b> [/INST]"
    assert chat.render_checked("assistant", "x</s>")[0] == " x<\\/s> </s>"
    assert chat.render_checked("assistant", "[\\INST]")[0] == " [\\\\INST] </s>"


@pytest.mark.parametrize("bad", ["x", "[INST] a", "[INST] a </s>", " a [/INST]", "[ROLE] user [TEXT] x [/ROLE]", "[INST] a[/INST]", "<<SYS>>\nx <</SYS>>\n", "[ROLE] a [/ROLE]", " a </s>b", "[INST] [/INST]"])
def test_other_texts_are_refused(bad):
    with pytest.raises(chat.GrammarError):
        list(chat.parse(bad))


def plain_digests(rows):
    """{conv: (n_turns, turns_sha256, loss_chars, loss_sha256)}"""
    out = {}
    for c in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", chat.escape(r[3] or "")))
        said = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        out[c] = len(mine), sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)), len(said), sha(said)
    return out


CASES = [
    (1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 2, "user", ""), (1, 3, "assistant", " é\n"), (2, 5, None, "x"), (2, 5, "", "y"), (2, 5, "", "y"), (2, None, "tool </s>", "[TEXT]"),
    (None, 1, "assistant", "a"), (None, 0, "user", chat.CONFLICT), (3, 0, "assistant", "z" * 300_000 + "</s>"), (3, 0, "assistant", "a"), (4, 0, None, None), (-1, 0, "system", "\\<<SYS>>"),
]


@pytest.mark.parametrize("part", [1, 40, 1_000_000])
def test_formatted_and_read_back(spark, monkeypatch, part):
    monkeypatch.setattr(chat, "PART", part)
    rows = [*CASES, *[(9, k, ("user", "assistant")[k % 2], f"turn {k} [INST]") for k in range(800)]]  # most rows in one conversation
    turns = spark.createDataFrame([(*r, "p", 1, "c") for r in rows], "conv_id long, turn long, role string, text string, part string, start int, conv string").repartition(6)
    formatted = chat.format_chats(turns).cache()
    found = {r.conv: r for r in chat.read_back(formatted).collect()}
    want = plain_digests(rows)
    assert {c: tuple(r[1:5]) for c, r in found.items()} == want
    assert {c: tuple(r) for c, r in found.items()} == {r.conv: tuple(r) for r in chat.read_back(formatted, together=True).collect()}
    for c, r in found.items():
        mine = sorted((f for f in formatted.collect() if f.conv == c), key=lambda f: f.part)
        assert [f.part for f in mine] == list(range(len(mine))) and sum(f.turns for f in mine) == r.n_turns
        assert sum(len(f.text) for f in mine) == r.formatted_chars and mine[0].text.startswith("<s>")
        assert all(len(f.text) < part + 300_100 for f in mine)
        assert len(mine) > 1 or c != 9 or part > 10_000


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    formatted = chat.format_chats(none)
    assert formatted.collect() == [] and chat.read_back(formatted).collect() == []


def test_query_by_plain_python(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", chat.CONFLICT), (-1, 1, "assistant", chat.CONFLICT)]
    assert {r.conv_id: tuple(r[1:5]) for r in chat.op13_chat_format(spark, SF).collect()} == plain_digests(rows)


def test_statement_on_odd_rows(spark, tmp_path):
    spark.createDataFrame([r for r in CASES if r[0] != -1], "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert oracle.compare(chat.op13_chat_format(spark, str(tmp_path)), con, chat.OP13_SQL) is None
    assert hashlib.sha256(b"").hexdigest() == sha("")
