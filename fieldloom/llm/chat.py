"""Chat formatting by a grammar that is parsed back.

Method: each turn is rendered by the template, the rendered text is parsed by a deterministic
parser (one look at how a turn begins tells its form; within a turn the next control string must be
its end), and the turn recovered is compared with the source. Where they differ, the text, then
the role's name too, is escaped and the turn rendered anew, until they are identical. Turns are
rendered and checked wherever their rows lie; conversations are then put together by one shuffle on
their id, sorted by turn, and streamed: a row a conversation, or several rows where it is longer than
``PART`` characters, with the loss mask as spans of the row's text.

    conversation = "<s>" turn*
    turn  = "[INST] " text " [/INST]"              role user
          | " " text " </s>"                        role assistant
          | "<<SYS>>\\n" text "\\n<</SYS>>\\n"        role system
          | "[ROLE] " name " [TEXT] " text " [/ROLE]"   any other role

An escape puts one backslash after the first character of a control string, or of one that has
backslashes there already; taking it back removes one. No text then holds a control string.

One conversation is one stream, since its digest is one sequential hash: a task holds a part and the
state of a hash, whatever the number of turns; sorting spills to disk. Rendering and checking, which
is most of the work, is spread before that.

Results in odd cases: null texts are empty; a null role is a role with an empty name; turns are
sorted by turn (null first), then role, then text as escaped, so ties and repeated rows have one
order and each is a turn; rows of a null id are one conversation; a text of any length is one turn of one part; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm.shared import cut, map_arrow, read, ship

#: Characters after which a conversation goes on in a new row.
PART = 1_000_000

# Fixed values of the template: how a conversation begins, (before, after) a text by role, any other role.
BEGIN = "<s>"
FORMS = {"user": ("[INST] ", " [/INST]"), "assistant": (" ", " </s>"), "system": ("<<SYS>>\n", "\n<</SYS>>\n")}
OTHER = ("[ROLE] ", " [TEXT] ", " [/ROLE]")
# The control strings, as first character and rest.
_SQUARE, _ANGLE = r"(?:/?INST\]|/?ROLE\]|TEXT\])", r"(?:/?s>|</?SYS>>)"

CONTROL = re.compile(rf"[\[<](?:(?<=\[){_SQUARE}|(?<=<){_ANGLE})")
_ESCAPABLE = re.compile(rf"[\[<](?:(?<=\[)(?=\\*{_SQUARE})|(?<=<)(?=\\*{_ANGLE}))")
_ESCAPED = re.compile(rf"([\[<])(?:(?<=\[)\\(?=\\*{_SQUARE})|(?<=<)\\(?=\\*{_ANGLE}))")


class GrammarError(ValueError):
    """A text that the grammar does not make."""


class Turn(NamedTuple):
    role: str
    start: int  # of the text, escaped, in what was parsed
    end: int


def escape(text: str) -> str:
    return _ESCAPABLE.sub(r"\g<0>\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def render(role: str, text: str) -> tuple[str, int]:
    """A turn as the template writes it, and where its text begins."""
    if role in FORMS:
        before, after = FORMS[role]
    else:
        before, after = f"{OTHER[0]}{role}{OTHER[1]}", OTHER[2]
    return f"{before}{text}{after}", len(before)


def _upto(rendered: str, at: int, close: str) -> int:
    """Where the text from ``at`` ends: before ``close``, which holds the next control string."""
    found = CONTROL.search(rendered, at)
    end = found.start() - close.index(found[0]) if found and found[0] in close else -1
    if end < at or not rendered.startswith(close, end):
        raise GrammarError(f"no {close!r} after {at}")
    return end


def parse(rendered: str, at: int = 0) -> Iterator[Turn]:
    """The turns from ``at`` on."""
    forms = [(before, role, after) for role, (before, after) in FORMS.items()]
    while at < len(rendered):
        for before, role, after in forms:
            if rendered.startswith(before, at):
                start = at + len(before)
                break
        else:
            if not rendered.startswith(OTHER[0], at):
                raise GrammarError(f"no turn begins at {at}")
            name = at + len(OTHER[0])
            stop = _upto(rendered, name, OTHER[1])
            role, start, after = unescape(rendered[name:stop]), stop + len(OTHER[1]), OTHER[2]
            if role in FORMS:
                raise GrammarError(f"role {role!r} has a form of its own")
        end = _upto(rendered, start, after)
        yield Turn(role, start, end)
        at = end + len(after)


def _same(rendered: str, role: str, text: str) -> bool:
    """Whether ``rendered`` is parsed to that one turn."""
    try:
        turns = list(parse(rendered))
    except GrammarError:
        return False
    return len(turns) == 1 and turns[0].role == role and unescape(rendered[turns[0].start : turns[0].end]) == text


def render_checked(role: str, text: str) -> tuple[str, int, int]:
    """(rendered turn, start and length of its text), parsed back to the same role and text."""
    for name, body in ((role, text), (role, escape(text)), (escape(role), escape(text))):
        rendered, start = render(name, body)
        if _same(rendered, role, text):
            return rendered, start, len(body)
    raise GrammarError(f"a turn of role {role!r} is not recovered")


def rendered_turns(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, rendered, start, length) of each row."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [render_checked(r or "", t or "") for r, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        done, starts, lengths = zip(*found, strict=True) if found else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(done, pa.string()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64())],
            names=["conv", "turn", "role", "rendered", "start", "length"],
        )

    kind = {c: turns.schema[c].dataType.simpleString() for c in (conv, turn)}
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))
    return map_arrow(rows, each, f"conv {kind[conv]}, turn {kind[turn]}, role string, rendered string, start long, length long")


_FORMATTED = "part int, text string, turns long, loss array<struct<start:long,length:long>>"
_LOSS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, part, text, turns, loss): the formatted conversations, a row each (part 0), or several
    where one is longer than ``PART``; ``loss`` are the spans of assistants' texts in ``text``, in
    code points. The rows of a conversation lie together, by part."""
    kind = turns.schema[conv].dataType
    rows = rendered_turns(turns, conv, turn, role, text)
    rows = rows.repartition("conv").sortWithinPartitions(
        "conv", "turn", F.coalesce("role", F.lit("")), F.expr("substr(rendered, start + 1, length)")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: object = None
        part, size, held, loss = -1, 0, [], []  # part -1: no conversation yet
        done: list[tuple] = []

        def close() -> None:
            done.append((now, part, "".join(held), len(held) - (part == 0), list(loss)))

        for batch in batches:
            for c, r, rendered, start, length in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4, 5)), strict=True):
                if part < 0 or c != now:
                    if part >= 0:
                        close()
                    now, part, held, loss, size = c, 0, [BEGIN], [], len(BEGIN)
                elif size >= limit:
                    close()
                    part, held, loss, size = part + 1, [], [], 0
                if r == "assistant":
                    loss.append({"start": size + start, "length": length})
                held.append(rendered)
                size += len(rendered)
                if len(done) >= 512 or done and sum(len(x[2]) for x in done[-8:]) >= limit:
                    yield _rows(done)
                    done.clear()
        if part >= 0:
            close()
        if done:
            yield _rows(done)

    def _rows(found: list[tuple]) -> pa.RecordBatch:
        c, part, text, n, loss = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, key), pa.array(part, pa.int32()), pa.array(text, pa.string()), pa.array(n, pa.int64()), pa.array(loss, _LOSS)], names=["conv", "part", "text", "turns", "loss"])

    limit = PART
    key = _arrow(turns, conv)
    ship(turns.sparkSession)
    return rows.mapInArrow(run, f"conv {kind.simpleString()}, {_FORMATTED}")


def _arrow(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)


class _Digest:
    """What is read back of one conversation."""

    def __init__(self) -> None:
        self.turns, self.chars, self.masked = 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def take(self, part: int, text: str, loss: list[dict]) -> None:
        if part == 0 and not text.startswith(BEGIN):
            raise GrammarError(f"a conversation begins without {BEGIN!r}")
        self.chars += len(text)
        for t in parse(text, len(BEGIN) if part == 0 else 0):
            self.turns += 1
            self.all.update(f"{t.role}\n{unescape(text[t.start : t.end])}\n".encode())
        for span in loss:
            said = unescape(text[span["start"] : span["start"] + span["length"]])
            self.masked += len(said)
            self.loss.update(said.encode())


def read_back(formatted: DataFrame, together: bool = False) -> DataFrame:
    """(conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of formatted
    conversations, from their text and mask alone. ``together``: the rows of a conversation lie in
    one partition by part, as ``format_chats`` leaves them."""
    if not together:
        formatted = formatted.repartition("conv").sortWithinPartitions("conv", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, done = None, None, []

        def rows() -> pa.RecordBatch:
            c, n, a, m, b, k = zip(*done, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, key), pa.array(n, pa.int64()), pa.array(a), pa.array(m, pa.int64()), pa.array(b), pa.array(k, pa.int64())],
                names=["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

        def close() -> None:
            done.append((now, digest.turns, digest.all.hexdigest(), digest.masked, digest.loss.hexdigest(), digest.chars))

        for batch in batches:
            for c, part, text, loss in zip(*(batch.column(k) for k in range(4)), strict=True):
                part = part.as_py()
                if part == 0:
                    if digest:
                        close()
                    now, digest = c.as_py(), _Digest()
                digest.take(part, text.as_py(), loss.as_py())
            if done:
                yield rows()
                done.clear()
        if digest:
            close()
            yield rows()

    key = _arrow(formatted, "conv")
    ship(formatted.sparkSession)
    kind = formatted.schema["conv"].dataType.simpleString()
    return formatted.select("conv", "part", "text", "loss").mapInArrow(run, f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


#: A conversation whose texts are made of control strings.
CONFLICT = "</s>[INST] ok [/INST]"


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is read back of every conversation and of conversation -1."""
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", CONFLICT), (-1, 1, "assistant", CONFLICT)], "conv_id long, turn long, role string, text string")
    formatted = cut(format_chats(turns.unionByName(extra)))
    return read_back(formatted, together=True).withColumnRenamed("conv", "conv_id")


OP13_SQL = r"""
WITH all_turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
    SELECT *,
        regexp_replace(regexp_replace(text, '(\[)(\\*(?:/?INST\]|/?ROLE\]|TEXT\]))', '\1\\\2', 'g'), '(<)(\\*(?:/?s>|</?SYS>>))', '\1\\\2', 'g') AS body,
        regexp_replace(regexp_replace(role, '(\[)(\\*(?:/?INST\]|/?ROLE\]|TEXT\]))', '\1\\\2', 'g'), '(<)(\\*(?:/?s>|</?SYS>>))', '\1\\\2', 'g') AS name
    FROM all_turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, body)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, body) FILTER (role = 'assistant'), '')) AS loss_sha256,
    (3 + sum(length(body) + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 6 WHEN 'system' THEN 18 ELSE 23 + length(name) END))::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""
