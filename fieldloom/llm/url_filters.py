"""URL filters: many wildcard rules at once by a bit-parallel automaton.

Method: a rule is one or more globs over the canonical url, ``host + path``. All globs are
packed into one row of 64-bit words, one bit per literal plus a start bit each (Shift-And).
One step per character shifts the whole row, keeps the bits whose literal fits, and keeps the
bits that stand before a wildcard which accepts the character; this moves all globs at once,
for a whole batch of urls. A glob's ``*`` takes any run without ``/``, ``**`` any run, ``?``
one character but ``/``. A url is finished as soon as only ended globs with a tail ``**`` are
left, so most urls need only their first characters.

No shuffle and no join: the rules travel with the task (their size is that of a configuration).

Results in odd cases: a null url, or one without ``://``, has empty host and path and matches
no host rule; empty and very long urls are judged whole; repeated rows are judged each; an
empty table gives no rows; input columns other than the id and the url are not carried along,
so names cannot clash. Two rules of one length that both fit: block wins, then the smaller
string.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm.shared import lower_ascii, map_arrow, read

U = np.uint64
#: Words of state that the urls matched at once have together (4 MB).
STATE = 1 << 19
ONE = U(1)


class Rule(NamedTuple):
    """``host`` and all its subdomains, where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def globs(self) -> tuple[str, str]:
        return (f"{escape(self.text)}**", f"*.{escape(self.text)}**")


def escape(literal: str) -> str:
    return "".join("\\" + c if c in "*?\\" else c for c in literal)


def parse_glob(glob: str) -> tuple[list[str | None], dict[int, bool]]:
    """Its literals (None: any character but ``/``), and after how many of them a wildcard
    stands (True: one that also takes ``/``)."""
    literals: list[str | None] = []
    gaps: dict[int, bool] = {}
    i = 0
    while i < len(glob):
        c = glob[i]
        if c == "*":
            wide = glob[i : i + 2] == "**"
            gaps[len(literals)] = gaps.get(len(literals), False) or wide
            i += 2 if wide else 1
            continue
        if c == "\\" and i + 1 < len(glob):
            i += 1
            c = glob[i]
            literals.append(c)
        else:
            literals.append(None if c == "?" else c)
        i += 1
    return literals, gaps


class Automaton:
    """The globs of all rules in one row of bits, best rule first."""

    def __init__(self, rules: Iterable[tuple[int, str]]):
        """``rules``: (rule number, glob), in falling priority."""
        parsed = [(number, *parse_glob(glob)) for number, glob in rules]
        letters = sorted({c for _, literals, _ in parsed for c in literals if c is not None} | {"/"})
        self.alphabet = np.array([ord(c) for c in letters], np.uint32)
        slash = letters.index("/")
        other = len(letters)  # any character that no rule names
        size = sum(len(literals) + 1 for _, literals, _ in parsed)
        words = max(1, -(-size // 64))
        step = np.zeros((other + 1, words * 64), bool)
        loop = np.zeros((other + 1, words * 64), bool)
        start, accept, tail = (np.zeros(words * 64, bool) for _ in range(3))
        self.owner = np.full(words * 64, -1, np.int64)
        at = 0
        for number, literals, gaps in parsed:
            start[at] = True
            for k, c in enumerate(literals, 1):
                if c is None:
                    step[:, at + k] = True
                    step[slash, at + k] = False
                else:
                    step[letters.index(c), at + k] = True
            for k, wide in gaps.items():
                loop[:, at + k] = True
                if not wide:
                    loop[slash, at + k] = False
            end = at + len(literals)
            accept[end] = True
            tail[end] = gaps.get(len(literals), False)
            self.owner[end] = number
            at = end + 1
        pack = lambda bits: np.packbits(bits, axis=-1, bitorder="little").view(U)
        self.step, self.loop = pack(step), pack(loop)
        self.start, self.accept, self.tail = pack(start), pack(accept), pack(tail)

    def match(self, urls: list[str]) -> np.ndarray:
        """The number of the first rule that fits each url, else -1; so many urls at once that their
        states are ``STATE`` words at most, whatever the number of rules."""
        some = max(1, STATE // len(self.start))
        parts = [self._match(urls[at : at + some]) for at in range(0, len(urls), some)]
        return np.concatenate([np.zeros(0, np.int64), *parts])

    def _match(self, urls: list[str]) -> np.ndarray:
        lengths = np.array([len(u) for u in urls], np.int64)
        order = np.argsort(-lengths, kind="stable")
        state = np.tile(self.start, (len(urls), 1))
        marks = np.frombuffer("".join(urls).encode("utf-32-le", "surrogatepass"), np.uint32)
        begins = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(urls) else lengths
        live = order
        place = 0
        while True:
            live = live[: np.searchsorted(-lengths[live], -place, "left")]  # longer than place
            if not len(live):
                break
            seen = marks[begins[live] + place]
            symbol = np.searchsorted(self.alphabet, seen)
            symbol[symbol == len(self.alphabet)] = 0
            symbol = np.where(self.alphabet[symbol] == seen, symbol, len(self.alphabet))
            now = state[live]
            moved = now << ONE
            moved[:, 1:] |= now[:, :-1] >> U(63)
            now = (moved & self.step[symbol]) | (now & self.loop[symbol])
            state[live] = now
            place += 1
            # What can still change: a bit that is not an ended glob with an open tail.
            live = live[((now & ~self.tail) != 0).any(axis=1)]
        return self._first(state & self.accept)

    def _first(self, ended: np.ndarray) -> np.ndarray:
        out = np.full(len(ended), -1, np.int64)
        for word in range(ended.shape[1] - 1, -1, -1):
            hit = np.flatnonzero(ended[:, word])
            lowest = ended[hit, word] & (~ended[hit, word] + ONE)
            out[hit] = self.owner[word * 64 + np.log2(lowest.astype(np.float64)).astype(np.int64)]
        return out


def canonical(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url: host after the first ``://`` up to ``/``, ``?``, ``#``, A-Z
    lower-cased; path then up to ``?`` or ``#``. Empty strings for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def filter_urls(pages: DataFrame, rules: Iterable[Rule], key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """(key, host, path, rule, verdict) of each row; ``default`` where no rule fits."""
    ranked = sorted(rules, key=lambda r: (-len(r.text), r.verdict != "block", r.text))
    automaton = Automaton((number, glob) for number, rule in enumerate(ranked) for glob in rule.globs())
    held = pages.sparkSession.sparkContext.broadcast(automaton)  # as large as the rules' text, some 10 bytes a character
    texts = pa.array([r.text for r in ranked] + [None], pa.string())
    verdicts = pa.array([r.verdict for r in ranked] + [default], pa.string())
    host, path = canonical(F.col(url))
    parts = pages.select(F.col(key), host.alias("host"), path.alias("path"))

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        automaton = held.value
        urls = [h + p for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
        found = automaton.match(urls)
        pick = pa.array(np.where(found < 0, len(ranked), found))
        return pa.RecordBatch.from_arrays(
            [*batch.columns, texts.take(pick), verdicts.take(pick)], names=[key, "host", "path", "rule", "verdict"]
        )

    kind = pages.schema[key].dataType.simpleString()
    return map_arrow(parts, judge, f"`{key}` {kind}, host string, path string, rule string, verdict string")


#: The rules of the registered query.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every url of ``pages`` judged by the rules; what no rule fits is allowed."""
    return filter_urls(read(spark, sf_dir, "pages"), RULES)


_RULE_ROWS = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in RULES)
OP1_SQL = rf"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES {_RULE_ROWS}),
parts AS (
  SELECT page_id,
         CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages
),
split AS (
  SELECT row_number() OVER () AS n, page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
),
best AS (
  SELECT n, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         max_by(verdict, length(rule_host || rule_path)) AS verdict
  FROM split JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY n
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM split LEFT JOIN best USING (n)
"""
