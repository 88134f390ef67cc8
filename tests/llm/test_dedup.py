"""Line, near and substring dedup against plain forms on awkward tables."""

import itertools
from collections import Counter

import numpy as np
import pytest
from pyspark.sql.functions import col as spark_col
from helpers import LOW, WORD, documents, got, prose, sha

import corpus_pipeline
from fieldloom.llm import line_dedup, near_dedup, substring_dedup
from fieldloom.llm.components import components

LONG = prose(1, 4000)
ODD = [None, "", " ", "\n\n", LONG, LONG, "one two", "one two", "One  TWO", "a b c d e", "a b c d e f"]


def plain_lines(rows):
    first = {}
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOW)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                first[key(line)] = min(first.get(key(line), i), i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or first[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


LINES = [
    (7, "a common long line\nmine alone is here\nshort"), (3, "A common LONG line \nshort\nA common long line"), (5, None), (6, ""),
    (9, "éééééééééé\n" + "short\n" * 30 + "a common long line"), (11, "é" * 10), (12, "x" * 50_000 + "\n" + "x" * 50_000), (13, "x" * 50_000),
]


@pytest.mark.parametrize("partitions", [1, 7])
def test_line_dedup(spark, partitions):
    rows = LINES + [(100 + i, "a common long line\r\nnumber %d of many lines" % (i % 5)) for i in range(60)]
    docs = documents(spark, rows)
    marked = line_dedup.with_bitmaps(docs.select("doc_id", "text"), line_dedup.keep_bitmaps(docs, partitions=partitions))
    found = sorted((r.doc_id, *reversed(line_dedup.apply_bitmap(r.text, r.bitmap)), r.n_dropped or 0) for r in marked.collect())
    assert [(i, n, d, t) for i, n, t, d in found] == sorted(plain_lines(rows))


def test_line_dedup_of_repeated_ids(spark):
    old = "a line of the first\nanother old long line"
    rows = [(1, old), (5, f"{old}\nonly here, in the one"), (5, "only here, in the other\nand this line as well\na line of the first")]
    rows += [(5, f"{old}\nonly here, in the one"), (None, "lone line without id\nshared of no id"), (None, "shared of no id\nsecond line without id"), (8, "x\nshared of no id\nlone line without id")]
    docs = documents(spark, rows)
    marked = line_dedup.with_bitmaps(docs.select("doc_id", "text"), line_dedup.keep_bitmaps(docs))
    least = -(2**63)
    found = ((least if r.doc_id is None else r.doc_id, *reversed(line_dedup.apply_bitmap(r.text, r.bitmap)), r.n_dropped or 0) for r in marked.collect())
    want = sorted(plain_lines([(least if i is None else i, t) for i, t in rows]))
    assert sorted((i, n, d, t) for i, n, t, d in found) == want
    assert sorted((least if i is None else i, t) for i, t in got(line_dedup.dedup_lines(docs), "doc_id", "text")) == sorted((i, t) for i, _, _, t in want)


def test_line_dedup_keeps_columns(spark):
    docs = documents(spark, LINES)
    kept = line_dedup.dedup_lines(docs)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    want = {i: t if t is not None or n else None for i, _, n, t in plain_lines(LINES)}
    found = {r.doc_id: r for r in kept.collect()}
    assert {i: r.text or "" for i, r in found.items()} == want and found[5].text is None
    assert all(r.n_chars == (None if r.text is None else len(r.text)) and r.bitmap == "b" for r in found.values())
    assert line_dedup.dedup_lines(docs.limit(0)).collect() == []


def plain_near(rows, percent=85):
    def shingles(text):
        w = WORD.findall((text or "").translate(LOW))
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    return sorted(((i, len(sets[i]), find(i)) for i in sets), key=repr)


def edited(seed, words, n):
    draw = np.random.default_rng(seed)
    words = list(words)
    for k in draw.choice(len(words), n, replace=False):
        words[k] = f"e{seed}x{k}"
    return " ".join(words)


def near_rows():
    base = prose(5, 300).split()
    chain = [edited(k, base, e) for k, e in enumerate([0, 1, 2, 3, 5, 8, 12] * 12)]
    shared = prose(6, 120)
    passage = [f"{shared} {prose(50 + k, 60)}" for k in range(40)]
    return list(enumerate(ODD + chain + passage + [prose(9, 30)] * 50))


@pytest.mark.parametrize(("block", "long"), [(512, 128), (8, 128), (512, 4), (8, 4), (3, 0)])
def test_near_dedup(spark, monkeypatch, block, long):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "LONG_LIST", long)
    rows = near_rows()
    found = near_dedup.near_duplicates(documents(spark, rows))
    assert got(found, "doc", "n_shingles", "component") == plain_near(rows)


def counted_pairs(monkeypatch):
    """The numbers of pairs that each step writes to be confirmed."""
    written = []

    def links(docs, doc, text, width, bundles, percent, f=near_dedup._links):
        written.append(sum(len(r.a) for r in bundles.select("a").collect()))
        return f(docs, doc, text, width, bundles, percent)

    monkeypatch.setattr(near_dedup, "_links", links)
    return written


def test_a_large_group_of_near_copies_writes_few_pairs(spark, monkeypatch):
    written = counted_pairs(monkeypatch)
    base = prose(61, 300).split()
    rows = list(enumerate(edited(k, base, 1) for k in range(4000))) + [(5000 + k, prose(62 + k, 40)) for k in range(20)]
    found = got(near_dedup.near_duplicates(documents(spark, rows)), "doc", "component")
    assert found == sorted([(i, 0 if i < 4000 else i) for i, _ in rows], key=repr)
    assert len(written) >= 2 and sum(written) <= 4 * 4000


def test_groups_that_hubs_do_not_join(spark, monkeypatch):
    """Two families that share many tokens but not enough shingles, and strays between them."""
    monkeypatch.setattr(near_dedup, "LONG_LIST", 10)
    one = prose(71, 200).split()
    other = edited(1, one, 9).split()
    rows = list(enumerate([edited(10 + k, one, k % 3) for k in range(60)] + [edited(100 + k, other, k % 3) for k in range(60)] + [edited(200 + k, one, 5) for k in range(8)]))
    assert got(near_dedup.near_duplicates(documents(spark, rows)), "doc", "n_shingles", "component") == plain_near(rows)


def test_copies_that_only_their_source_joins_write_few_pairs(spark, monkeypatch):
    """Copies of one text with edits of their own: each is near that text, no two are near each other."""
    monkeypatch.setattr(near_dedup, "LONG_LIST", 10)
    written, named = counted_pairs(monkeypatch), []

    def parted(docs, key, ids, id_, f=near_dedup.parted):
        named.append((ids.count(), ids.distinct().count()))
        return f(docs, key, ids, id_)

    monkeypatch.setattr(near_dedup, "parted", parted)
    base = prose(91, 300).split()
    rows = [(1000, " ".join(base)), *enumerate(edited(k, base, 4) for k in range(120))]
    found = near_dedup.near_duplicates(documents(spark, rows))
    assert got(found, "doc", "n_shingles", "component") == plain_near(rows)
    assert {c for _, _, c in plain_near(rows)} == {0} and len({c for _, _, c in plain_near(rows[1:])}) == 120
    assert sum(written) <= 4 * 120
    assert all(n == distinct for n, distinct in named)


def test_labels_meet_each_class_once_not_each_of_its_postings(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "LONG_LIST", 10)
    met = []

    def with_labels(rows, labels, f=near_dedup._with_labels):
        met.append((rows.count(), rows.select("node").distinct().count()))
        return f(rows, labels)

    monkeypatch.setattr(near_dedup, "_with_labels", with_labels)
    base = prose(81, 200).split()
    rows = list(enumerate(edited(k, base, 1) for k in range(200)))
    found = got(near_dedup.near_duplicates(documents(spark, rows)), "doc", "component")
    assert found == sorted([(i, 0) for i, _ in rows], key=repr)
    assert len(met) >= 4 and all(n == classes for n, classes in met)


def test_near_dedup_from_80(spark):
    base = prose(15, 300).split()
    rows = list(enumerate(edited(k, base[::-1] if k % 2 else base, e) for k, e in enumerate([0, 0, 5, 6, 5, 6, 9, 9])))
    spaced = [base[:], base[:]]
    for k, n in enumerate((5, 6)):  # far from each other: 5 shingles a word
        for at in range(n):
            spaced[k][20 + 45 * at] = f"s{k}x{at}"
    rows += [(20 + k, " ".join(w)) for k, w in enumerate(spaced)]
    docs = documents(spark, rows)
    assert got(near_dedup.near_duplicates(docs, percent=80), "doc", "n_shingles", "component") == plain_near(rows, 80)
    assert plain_near(rows, 80) != plain_near(rows)
    assert got(corpus_pipeline.keep_one_of_near_copies(spark, docs, ""), "doc_id") == sorted([(i,) for i, _, c in plain_near(rows, 80) if i == c], key=repr)
    assert (near_dedup.matches(85), near_dedup.matches(80)) == (42, 38)


def test_one_of_each(spark):
    rows = near_rows()
    docs = documents(spark, rows)
    kept = near_dedup.one_of_each(docs)
    assert kept.columns == docs.columns
    assert got(kept, "doc_id") == sorted([(i,) for i, _, c in plain_near(rows) if i == c], key=repr)
    assert near_dedup.near_duplicates(docs.limit(0)).collect() == []
    with pytest.raises(ValueError, match="0.85"):
        near_dedup.near_duplicates(docs, percent=70)


def test_one_of_each_without_ids(spark):
    base, other = prose(41, 300).split(), prose(42, 300).split()
    alone, text, last = prose(43, 60), " ".join(base), " ".join(other)
    rows = [(7, text), (None, edited(1, base, 2)), (None, last), (None, last), (None, edited(2, other, 2)), (None, alone), (None, None), (None, ""), (None, ""), (9, None), (-5, "x y")]
    docs = documents(spark, rows)
    kept = near_dedup.one_of_each(docs)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    found = got(kept, "doc_id", "text")
    assert len(found) == 8 and found.count((None, "")) == 2 and {(7, text), (-5, "x y"), (9, None), (None, None), (None, alone)} < set(found)
    assert sum(t in (last, edited(2, other, 2)) for _, t in found) == 1


def test_repeated_rows_are_copies(spark):
    found = near_dedup.near_duplicates(documents(spark, [(4, "a b c d e f"), (4, "a b c d e f"), (2, "a B c d e f")]))
    assert got(found, "doc", "component") == [(2, 2), (4, 2), (4, 2)]


def test_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    star = [(1000, k) for k in range(1001, 1100)]
    found = dict(got(components(spark.createDataFrame(chain + star, "a long, b long")), "node", "component"))
    assert {found[k] for k in range(41)} == {0} and {found[k] for k in range(100, 103)} == {100}
    assert {found[k] for k in range(1000, 1100)} == {1000} and len(found) == 41 + 3 + 100
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def plain_substring(rows, length):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    seen = Counter(tuple(w[p : p + length]) for _, w in words for p in range(len(w) - length + 1))
    out = []
    for i, w in words:
        gone = set()
        for p in range(len(w) - length + 1):
            if seen[tuple(w[p : p + length])] > 1:
                gone.update(range(p, p + length))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), " ".join(kept)))
    return sorted(out, key=repr)


def substring_rows():
    passage = prose(20, 90)
    around = [f"{prose(100 + k, 20 + k)} {passage} {prose(200 + k, 30)}" for k in range(30)]
    part = [" ".join(passage.split()[10 + k : 60]) + " " + prose(300 + k, 15) for k in range(20)]
    periodic = ["a b " * 60, "p q r " * 13 + "end", "same " * 40, "lone " * 36, "lone2 " * 34]
    return list(enumerate([*ODD, *around, *part, *periodic, "Mixed Case " + passage.upper()]))


@pytest.mark.parametrize("limits", [(8192, 16384), (16, 4)])
def test_substring_dedup(spark, monkeypatch, limits):
    monkeypatch.setattr(substring_dedup, "PHRASES", limits[0])
    monkeypatch.setattr(substring_dedup, "CONTEXTS", limits[1])
    rows = substring_rows()
    from pyspark.sql import functions as F

    found = substring_dedup._kept(documents(spark, rows), [F.col("doc_id")], "doc_id", "text", 35)
    assert got(found, "keys.doc_id", "n_words", "n_removed", "kept") == plain_substring(rows, 35)


def test_hot_anchors_are_dealt_over_tasks(spark, monkeypatch):
    """Half of all documents hold one passage."""
    monkeypatch.setattr(substring_dedup, "HOT_ROWS", 20)
    passage = prose(81, 50)
    rows = [(k, f"{prose(300 + k, 30)} {passage}" if k % 2 else prose(300 + k, 60)) for k in range(300)]
    dealt = []
    monkeypatch.setattr(substring_dedup, "skew_join", lambda *a, f=substring_dedup.skew_join, **k: dealt.append(j := f(*a, **k)) or j)
    found = substring_dedup._kept(documents(spark, rows), [spark_col("doc_id")], "doc_id", "text", 35)
    assert got(found, "keys.doc_id", "n_words", "n_removed", "kept") == plain_substring(rows, 35)
    assert "__salt" in dealt[0]._jdf.queryExecution().optimizedPlan().toString()


def test_substring_repeated_rows_and_columns(spark):
    text = prose(31, 50)
    docs = documents(spark, [(1, text), (1, text), (1, prose(32, 50)), (2, None), (None, prose(33, 40))])
    kept = substring_dedup.remove_repeated(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, len((r.text or "").split())) for r in kept.collect()) == [(0, 40), (1, 0), (1, 0), (1, 50), (2, 0)]
    assert substring_dedup.remove_repeated(docs.limit(0)).collect() == []


def test_sha_of_nothing():
    assert sha("").startswith("e3b0c442")
