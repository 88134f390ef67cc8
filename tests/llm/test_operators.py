"""Filters, archives, search, models, decontamination and packing on awkward tables."""

import base64
import hashlib
import json
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from helpers import LOW, documents, got, prose, sha
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from fieldloom.llm import decontamination, language_id, packing, top_k, toxicity, url_filters, warc

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.01"


# Url filters


def plain_glob(glob):
    out = ""
    for literal, wide, one, other in re.findall(r"\\(.)|(\*\*)|(\*)|(.)", glob, re.S):
        out += re.escape(literal) if literal else ".*" if wide else "[^/]*" if one else "[^/]" if other == "?" else re.escape(other)
    return re.compile(out, re.S)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab/*?\\", min_size=0, max_size=9), min_size=1, max_size=14), st.lists(st.text(alphabet="ab/é", max_size=12), max_size=10))
def test_automaton_matches_globs(globs, urls):
    found = url_filters.Automaton(enumerate(globs)).match(urls).tolist()
    want = [next((k for k, g in enumerate(globs) if plain_glob(g).fullmatch(u)), -1) for u in urls]
    assert found == want


def test_url_rules(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://Example.ORG/es/x?q", "https://a.example.org/en/12#f", "x://example.org", "x://org/", "x://forg/", "a://b.com/fr/c.org/",
        "a://b.com/de/", "a://b.com?x/de/", "a://b.com/es", "://q.org/", "a://b://c.org/", "a://ÉX.org/", "a://x.org:80/", "a://" + "z" * 5000 + ".org/" + "y" * 200_000, "a://b.org/\n\x00",
    ]
    pages = spark.createDataFrame([(i, u, "h", "p", "r") for i, u in enumerate(urls)], "page_id long, url string, host string, path string, rule string")
    rows = {r.page_id: r for r in url_filters.filter_urls(pages, url_filters.RULES).collect()}
    assert [rows[i].rule for i in range(len(urls))] == [None, None, None, None, "example.org/es/", "example.org/en/1", None, "org/", None, "com/fr/", "com/de/", None, None, "org/", None, "org/", None, "org/", "org/"]
    assert (rows[4].host, rows[4].path, rows[4].verdict) == ("example.org", "/es/x", "block")
    assert (rows[0].host, rows[0].path, rows[0].verdict) == ("", "", "allow") and rows[15].host == "Éx.org"
    assert len(rows) == len(urls) and url_filters.filter_urls(pages.limit(0), url_filters.RULES).collect() == []


def test_ties_and_repeated_pages(spark):
    rules = [url_filters.Rule("a.org", "/x", "block"), url_filters.Rule("a.org", "/x", "allow")]
    pages = spark.createDataFrame([(1, "http://a.org/x1"), (1, "http://a.org/x1"), (None, "http://b.a.org/x"), (2, "http://a.org/y")], "page_id long, url string")
    found = got(url_filters.filter_urls(pages, rules), "page_id", "rule", "verdict")
    assert found == sorted([(1, "a.org/x", "block"), (1, "a.org/x", "block"), (None, "a.org/x", "block"), (2, None, "allow")], key=repr)


def test_twenty_thousand_rules_in_bounded_memory():
    import tracemalloc

    hosts = [f"site{k}.example" for k in range(20_000)]
    automaton = url_filters.Automaton((k, g) for k, h in enumerate(hosts) for g in url_filters.Rule(h, "/", "block").globs())
    urls = [f"{'www.' * (k % 2)}{hosts[k * 97 % 20_000]}/p" for k in range(150)] + ["other.example/", "xsite1.example/p"]
    tracemalloc.start()
    found = automaton.match(urls).tolist()
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert found == [k * 97 % 20_000 for k in range(150)] + [-1, -1]
    assert peak < 12 * 8 * url_filters.STATE


# Archives


def test_hot_payloads_are_dealt_over_tasks(spark, monkeypatch):
    """Half of the pages have one payload; no task takes more than twice its share of them."""
    monkeypatch.setattr(warc, "HOT_ROWS", 100)
    pages = spark.range(4000).selectExpr("id AS page_id", "'u' AS url", "CASE WHEN id % 2 = 0 THEN 'same' ELSE concat('p', id) END AS html")
    decided = warc.decide(pages)
    conf = {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        per_task = [r["n"] for r in decided.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(per_task) == 4000 and max(per_task) <= 2 * 4000 / 8
    found = {r.page_id: r.refers_to for r in decided.collect()}
    assert all(found[i] == (3998 if i % 2 == 0 and i < 3998 else None) for i in range(4000))


def test_archives_round_trip(spark):
    html = ["<p>a</p>", "<p>a</p>", None, "", "é" * 100_000, "<p>a</p>", "line\r\n\r\nline", "x", "x"]
    urls = ["http://a/\r\nX: y", None, "", "u", "u", "u", "http://é", "d", "d"]
    ids = [3, 9, 1, 2, 4, 7, 5, 8, 8]
    pages = spark.createDataFrame(list(zip(ids, urls, html, ["z"] * 9, strict=True)), "page_id long, url string, html string, digest string")
    folder = warc.own_folder(spark, "warc")
    index = warc.write_archives(warc.decide(pages), folder)
    found = warc.read_records(index, folder)
    best = {}
    for i, h in zip(ids, html, strict=True):
        best[h or ""] = max(best.get(h or "", i), i)
    want = []
    for i, h in zip(ids, html, strict=True):
        data, kept = (h or "").encode(), best[h or ""]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((i, len(data), digest, *(("response", None, data) if i == kept else ("revisit", kept, None))))
    rows = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in found.collect()]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    some = index.where(F.col("url") == "u")
    assert got(warc.read_records(some, folder), "page_id") == [(2,), (4,), (7,)]
    assert {r.url for r in warc.read_records(index.where("url like 'http://a%'"), folder).collect()} == {"http://a/%0D%0AX: y"}
    kinds = {r.record_type for r in warc.read_records(warc.write_archives(warc.decide(pages, min_bytes=5), folder + "-2"), folder + "-2").where("page_id in (1, 2, 8)").collect()}
    assert kinds == {"response"}
    empty = warc.write_archives(warc.decide(pages.limit(0)), folder + "-3")
    assert warc.read_records(empty, folder + "-3").collect() == []


def test_ranges_are_coalesced(monkeypatch):
    monkeypatch.setattr(warc, "GAP", 10)
    monkeypatch.setattr(warc, "READ", 90)
    found = list(warc.coalesced([(0, 5), (9, 5), (30, 5), (36, 60), (97, 30), (127, 200)]))
    assert [(a, b, len(r)) for a, b, r in found] == [(0, 14, 2), (30, 96, 2), (97, 127, 1), (127, 327, 1)]


# Top k


@pytest.mark.parametrize("sizes", [(8192, 1024, 2048, 1024), (40, 3, 5, 16)])
def test_top_k(spark, monkeypatch, sizes):
    for name, n in zip(("CANDIDATES", "QUERIES", "SEED", "STRIP"), sizes, strict=True):
        monkeypatch.setattr(top_k, name, n)
    draw = np.random.default_rng(3)
    vectors = [(i, [float(x) for x in draw.normal(size=12) * draw.exponential()]) for i in range(400)]
    vectors += [(1000 + i, [0.5] * 12) for i in range(120)] + [(2000, None), (2100, [1.0, None]), (2200, [float("nan")]), (2300, [float("inf")] * 12), (2400, []), (2500, [3.0, 1.0])]
    rows = spark.createDataFrame([(*v, 1, "x") for v in vectors], "vec_id long, embedding array<float>, label int, x string")
    found = top_k.top_k(rows, "vec_id", "embedding", 10, F.col("id") % 100 == 0)
    f32 = lambda v: [int(np.floor(1024 * float(np.float32(x)))) for x in v]
    good = {i: f32(v) + [0] * (12 - len(v)) for i, v in vectors if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in sorted(good):
        if q % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(good[q], good[c], strict=True)), c) for c in good if c != q)
            want += [(q, k, c, -s) for k, (s, c) in enumerate(scores[:10], 1)]
    assert got(found, "query_id", "rank", "id", "score") == sorted(want, key=repr)
    assert got(top_k.top_k(rows.where("vec_id in (0, 1)"), "vec_id", "embedding", 10, F.col("id") % 100 == 0), "query_id", "id") == [(0, 1)]
    assert top_k.top_k(rows.limit(0), "vec_id", "embedding", 10, F.col("id") % 100 == 0).collect() == []


def test_scores_beyond_doubles_are_exact():
    q, c = np.array([[3e12, 7.0]]), np.array([[5e12, 1.0], [1e140, 0.0]])
    assert top_k.exact_scores(q, c).tolist() == [[15 * 10**24 + 7 if 15 * 10**24 < 2**63 else 2**63 - 1, 2**63 - 1]]
    assert top_k.exact_scores(np.array([[2.0**27 + 1]]), np.array([[2.0**27 + 1]])).tolist() == [[(2**27 + 1) ** 2]]


# Language


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {r.doc_id: r for r in language_id.op5_language_id(spark, SF).collect()}
    rows = docs.collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(found[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([found[r.doc_id].lang_pred == r.lang for r in held if r.lang]) > 0.95
    assert all(0 <= r.score <= 1 for r in found.values())


def test_language_odd_texts(spark):
    texts = [None, "", "123 !!", "the cat sat on the mat", "der Hund und die Katze", "日本語の文", "THE " * 3000, "the cat"]
    docs = documents(spark, texts, [None, "en", "en", "en", "de", None, None, "en"])
    names, profiles = language_id.prototypes(docs)
    assert names == ["de", "en"] and profiles.shape == (2, language_id.DIMENSIONS)
    found = {r.doc_id: r for r in language_id.identify(docs, names, profiles, ["doc_id"]).collect()}
    assert [found[k].lang_pred for k in range(5)] == ["und", "und", "und", "en", "de"] and found[6].lang_pred == "en"
    assert found[0].score == 0 and found[5].lang_pred in names
    nothing = language_id.prototypes(docs.limit(0))
    assert {r.lang_pred for r in language_id.identify(docs, *nothing, ["doc_id"]).collect()} == {"und"}


# Toxicity


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = {r.doc_id: r for r in toxicity.op2_toxicity(spark, sf).collect()}
    held = [(found[i], y) for i, y in labels.items() if i in found and found[i].held_out]
    good, bad = [r.score for r, y in held if y == 1], [r.score for r, y in held if y == 0]
    assert np.mean(np.array(good)[:, None] > np.array(bad)) > 0.93
    assert np.mean(np.array(good) >= 0.5) > 0.8 and np.mean(np.array(bad) >= 0.5) < 0.05
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found.values())


def test_toxicity_odd_tables(spark):
    draw = random.Random(4)
    clean = [prose(k, 30) for k in range(80)]
    bad = [" ".join([prose(500 + k, 20), *draw.sample(["idiot", "moron", "scumbag", "scummy", "scumlike", "pathetic"], 3)]) for k in range(30)]
    texts = [None, "", *clean, *bad]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, 1, int(i >= 82), "x") for i in range(len(texts))] + [(9999, 0, 1, "x"), (5, 0, None, "x"), (6, 1, 0, "x")], "doc_id long, quality int, toxic int, text string")
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and got(kept, "doc_id") == sorted([(i,) for i in range(82)], key=repr)
    nothing = toxicity.drop_toxic(docs, labels.limit(0))
    assert {i for (i,) in got(nothing, "doc_id")} >= set(range(82))
    assert toxicity.drop_toxic(docs.limit(0), labels).collect() == []


# Decontamination


def plain_overlaps(rows, items, window):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    windows = {}
    for i, t in items:
        w = words(t)
        for p in range(max(0, len(w) - min(window, len(w)) + 1) if w else 0):
            windows.setdefault(tuple(w[p : p + min(window, len(w))]), set()).add(str(i))
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in windows}:
            for p in range(len(w) - n + 1):
                if (names := windows.get(tuple(w[p : p + n]))) is not None:
                    hit.update(range(p, p + n))
                    found |= names
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard", [200_000, 40])
def test_overlaps(spark, monkeypatch, shard):
    monkeypatch.setattr(decontamination, "SHARD_WORDS", shard)
    items = [(k, prose(k, 40, 30)) for k in range(12)] + [(20, None), (21, "..."), (22, "Short ITEM"), (23, prose(0, 40, 30)), (24, "w1 " * 15), (25, "one")]
    rows = [(0, None), (1, ""), (2, "quite a short item here ok."), (3, prose(0, 40, 30)), (4, f"{prose(91, 25, 30)} {' '.join(prose(3, 40, 30).split()[5:22]).upper()} {prose(92, 2000, 30)}"), (5, "w1 " * 400), (6, "short-item one"), (7, prose(93, 5000, 6))]
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, words string")
    docs = documents(spark, rows)
    found = decontamination.overlaps(docs, bench).withColumn("n_hit", decontamination.hit_words())
    assert got(found, "doc", "n_words", "n_hit", "items") == plain_overlaps(rows, items, 10)
    dirty = {i for i, _, n, _ in plain_overlaps(rows, items, 10) if n}
    clean = decontamination.decontaminate(docs, bench)
    assert clean.columns == docs.columns and {i for (i,) in got(clean, "doc_id")} == {i for i, _ in rows} - dirty
    cut = {r.doc_id: r.text for r in decontamination.decontaminate(docs, bench, max_length=9, max_coverage=0.5).collect()}
    left = plain_overlaps([(4, cut[4])], [i for i in items if i[0] != 22 and i[0] != 25], 10)
    assert 3 not in cut and left[0][2] == 0 and cut[2] == "quite a short item here ok." and cut[1] == "" and cut[0] is None
    assert decontamination.overlaps(docs.limit(0), bench).collect() == []
    assert {r.n_hit for r in decontamination.overlaps(docs, bench.limit(0)).withColumn("n_hit", decontamination.hit_words()).collect()} == {0}


@pytest.mark.parametrize("shard", [200_000, 40])
def test_overlaps_of_repeated_ids(spark, monkeypatch, shard):
    monkeypatch.setattr(decontamination, "SHARD_WORDS", shard)
    items = [(k, prose(k, 40, 30)) for k in range(12)]
    half = f"{prose(91, 60)} {prose(3, 40, 30)}"
    rows = [(1, half), (1, half), (1, f"{prose(4, 40, 30)} x"), (1, "clean"), (None, prose(5, 40, 30)), (None, "clean too"), (None, None), (2, "other")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(spark, rows)
    found = decontamination.overlaps(docs, bench).withColumn("n_hit", decontamination.hit_words())
    assert got(found, "doc", "n_words", "n_hit", "items") == plain_overlaps(rows, items, 10)
    assert got(decontamination.decontaminate(docs, bench), "doc_id", "text") == sorted([(1, "clean"), (None, "clean too"), (None, None), (2, "other")], key=repr)
    left = got(decontamination.decontaminate(docs, bench, max_coverage=0.5), "doc_id", "text")
    assert len(left) == 6 and sum(i == 1 and len(t.split()) == 60 for i, t in left) == 2


# Packing


def test_packing(spark):
    from tokenizers import Tokenizer

    texts = [None, "", "The cat, don't. <|endoftext|> é Straße ŉ", prose(3, 9000), "x", "x"] + [prose(k, 50) for k in range(40)]
    docs = documents(spark, texts).repartition(5)
    pieces = packing.pack(docs, TOKENIZER, 2, length=256).collect()
    plain = Tokenizer.from_file(TOKENIZER)
    ids = {i: plain.encode(t or "", add_special_tokens=False).ids + [2] for i, t in enumerate(texts)}
    for i, want in ids.items():
        mine = sorted((p for p in pieces if p.doc == i), key=lambda p: p.start)
        assert [x for p in mine for x in p.ids] == want and all(p.length == len(p.ids) and p.doc_tokens == len(want) for p in mine)
        assert [p.start for p in mine] == np.cumsum([0, *[p.length for p in mine]])[:-1].tolist()
    sequences = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert sequences.get(p.sequence_id, 0) == p.offset
        sequences[p.sequence_id] = p.offset + p.length
    assert sorted(sequences) == list(range(len(sequences))) and [sequences[k] for k in sorted(sequences)][:-1] == [256] * (len(sequences) - 1)
    assert packing.pack(docs.limit(0), TOKENIZER, 2).collect() == []
    sums = {(p.doc, p.start): p for p in packing.pack_digests(docs, TOKENIZER, 2, length=256).collect()}
    assert len(sums) == len(pieces)
    for i, want in ids.items():
        for (_, start), p in sums.items():
            if p.doc == i:
                assert p.ids_crc32 == zlib.crc32(np.array(want[start : start + p.length], "<u4").tobytes())


def test_packing_of_repeated_ids(spark):
    docs = documents(spark, [(1, "a b c"), (1, "a b c"), (None, "d"), (None, None)])
    found = sorted((len(p.ids), p.offset) for p in packing.pack(docs.coalesce(1), TOKENIZER, 2).collect())
    assert sum(n for n, _ in found) == 4 + 4 + 2 + 1 and len({o for _, o in found}) == 4


def test_tokenizers_that_words_do_not_fit_take_whole_texts(spark):
    other = public_tokenizers.path("byte_bpe_50k.json")
    words = packing.WordEncoder(other)
    text = "Two  spaces, and \n\n lines <|endoftext|> é"
    assert not words.by_word and packing.WordEncoder(TOKENIZER).by_word
    assert np.frombuffer(words.encode(text), words.kind).tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids
    (piece,) = packing.pack(documents(spark, [text]), other, 7).collect()
    assert piece.ids == [*words.tokenizer.encode(text, add_special_tokens=False).ids, 7]


def test_cache_generations(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 5)
    words = packing.WordEncoder(TOKENIZER)
    for k in range(30):
        text = prose(k, 12, 15) + " Straße, x! Straße,%%%"
        assert np.frombuffer(words.encode(text), words.kind).tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids
        assert len(words.older) < 60


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aAzZ019.,!?;:' \t\n\x1c\x85\xa0éÉßİŉǅﬁΣς日"), st.characters()), max_size=25))
def test_words_are_encoded_as_texts_are(text):
    words = packing.encoder(TOKENIZER)
    found = np.frombuffer(words.encode(text.encode("utf-8", "replace").decode()), words.kind).tolist()
    assert found == words.tokenizer.encode(text.encode("utf-8", "replace").decode(), add_special_tokens=False).ids


# The pipeline


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = {r.doc_id for r in docs.collect()}
    final = corpus_pipeline.run(spark, SF).collect()
    left = {r.doc_id for r in final}
    assert left < held and len(left) > 0.8 * len(held)
    toxic = {r.doc_id for r in toxicity.drop_toxic(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert left <= toxic
    items = pq.read_table(f"{SF}/benchmark.parquet").to_pylist()
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in left]
    assert not [i for i, _, n, _ in plain_overlaps(rows, [(x["item_id"], x["text"]) for x in items], 10) if n > 40]
    assert json.dumps(sorted(left)) and sha("")


def test_pipeline_against_plain_stages(spark, tmp_path):
    from test_dedup import edited, plain_lines, plain_near
    from tokenizers import Tokenizer

    items = [(k, prose(900 + k, 30)) for k in range(4)]
    base = prose(700, 300).split()
    texts = [None, "", " ".join(base), edited(1, base, 5), edited(2, base, 12), f"{prose(701, 40)} {items[1][1]}", "a line of many documents\n" + prose(702, 40), "A line of many documents\n" + prose(703, 5000)]
    docs = documents(spark, texts + [prose(710 + k, 40) for k in range(8)])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(8, 12)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = toxicity.drop_toxic(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet"))
    rows = [(i, t) for i, _, _, t in plain_lines([(r.doc_id, r.text) for r in kept.collect()])]
    alone = {i for i, _, c in plain_near(rows, 80) if i == c}
    rows = [(i, t) for i, t in rows if i in alone]
    clean = {i for i, _, n, _ in plain_overlaps(rows, items, 10) if not n}
    plain = Tokenizer.from_file(TOKENIZER)
    want = {i: plain.encode(t, add_special_tokens=False).ids + [2] for i, t in rows if i in clean}
    found = sorted(corpus_pipeline.run(spark, str(tmp_path)).collect(), key=lambda r: (r.sequence_id, r.offset))
    assert {r.doc_id for r in found} == set(want) and len(want) < len(texts) + 8
    at, seen = 0, dict.fromkeys(want, 0)
    for r in found:
        ids = want[r.doc_id][r.start : r.start + r.length]
        assert (r.sequence_id, r.offset, r.start) == (at // 4096, at % 4096, seen[r.doc_id])
        assert (len(ids), len(want[r.doc_id]), zlib.crc32(np.array(ids, "<u4").tobytes())) == (r.length, r.doc_tokens, r.ids_crc32)
        at, seen[r.doc_id] = at + r.length, seen[r.doc_id] + r.length
    assert seen == {i: len(x) for i, x in want.items()}
