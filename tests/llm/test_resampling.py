"""Importance resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import LOW, documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldloom.llm import resampling

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text, buckets=10_000):
    words = WORD.findall((text or "").translate(LOW))
    return [zlib.crc32(f.encode()) % buckets for f in words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]]


def plain_resample(rows, target, percent=25, min_words=20, seed=7):
    """Sorted (doc, n_features, weight, score, rank)."""
    s, t = np.zeros(10_000, int), np.zeros(10_000, int)
    for _, x in rows:
        np.add.at(s, plain_features(x), 1)
    for x in target:
        np.add.at(t, plain_features(x), 1)
    total_s, total_t = s.sum(), t.sum()
    gain = [math.floor(1000 * math.log((b + 1) * (total_s + 10000) / ((a + 1) * (total_t + 10000)))) for a, b in zip(s.tolist(), t.tolist(), strict=True)]
    out = []
    for i, x in rows:
        found = plain_features(x)
        weight = sum(gain[f] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = [r for r in out if (r[1] + 1) // 2 >= min_words]
    fit.sort(key=lambda r: (-r[3], 2**63 if r[0] is None else r[0], r[1]))
    for k, r in enumerate(fit[: percent * len(fit) // 100]):
        r[4] = k + 1
    return sorted(map(tuple, out), key=repr)


def mine(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("aB9é日 \n.-_ſK\x7f"), max_size=40)), max_size=8), st.integers(1, 30))
def test_features(texts, piece):
    found = {}
    before = resampling.PIECE
    resampling.PIECE = piece
    try:
        for rows, buckets in resampling.features(pa.array(texts, pa.string()), 10_000):
            for r, b in zip(rows.tolist(), buckets.tolist(), strict=True):
                found.setdefault(r, []).append(b)
    finally:
        resampling.PIECE = before
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(f) for k, t in enumerate(texts) if (f := plain_features(t))}


def test_long_words():
    texts = ["x" * 63 + " " + "Y" * 64 + " " + "é" * 40 + " " + "z" * 65 + " b", "q" * 2_000_000 + " " + "w " * 400_000, " " * 1_500_000 + "end"]
    for k, t in enumerate(texts):
        got = [b for _, buckets in resampling.features(pa.array([None] * k + [t]), 10_000) for b in buckets.tolist()]
        assert sorted(got) == sorted(plain_features(t))


def test_resample(spark):
    target = [prose(900 + k, 40, 50) for k in range(6)]
    texts = [None, "", ". ,", "Word", prose(1, 3000), prose(2, 19), prose(2, 20), prose(3, 60, 50).upper()] + [prose(k, 25 + k % 30) for k in range(150)] + [prose(7, 30)] * 20
    rows = list(enumerate(texts)) + [(3, prose(8, 30)), (3, prose(8, 30)), (None, prose(9, 40)), (None, prose(10, 40)), (2**63 - 1, prose(11, 30)), (-5, prose(12, 33))]
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    docs = documents(spark, rows).repartition(5)
    for direct in (1, 7, 4096):
        assert mine(resampling.resample(docs, bench, direct=direct)) == plain_resample(rows, target)
    want = {(r[0], t) for r in plain_resample(rows, target) if r[4] for i, t in rows if i == r[0]}
    drawn = resampling.draw(docs, bench)
    assert drawn.columns == docs.columns
    unique = {i for i, _ in rows if [x for x, _ in rows].count(i) == 1}
    assert sorted(r.doc_id for r in drawn.collect() if r.doc_id in unique) == sorted(i for i, _ in want if i in unique)
    assert mine(resampling.resample(docs.limit(0), bench)) == [] and resampling.draw(docs.limit(0), bench).collect() == []
    for percent in (0, 100):
        assert mine(resampling.resample(docs, bench.limit(0), percent=percent)) == plain_resample(rows, [], percent)


@pytest.mark.parametrize("k", [1, 2, 150, 299, 300])
def test_cutoff_with_one_score_for_a_third(spark, monkeypatch, k):
    draw = random.Random(4)
    rows = [(draw.randrange(50) if i % 3 else 7, draw.randrange(9), draw.randrange(3), i) for i in range(300)]
    keys = spark.createDataFrame(rows, "place long, tie long, n_features long, row long").repartition(7).cache()
    seen = []
    monkeypatch.setattr(resampling, "weighted_median", lambda found, f=resampling.weighted_median: seen.append(sum(n for _, n in found)) or f(found))
    assert resampling.cutoff(keys, k, direct=1) == sorted(rows)[k - 1]
    assert all(after <= 0.76 * before + 7 for before, after in zip(seen, seen[1:], strict=False))  # a quarter goes each round
    assert resampling.cutoff(keys, 0) is None
    with pytest.raises(ValueError):
        resampling.cutoff(keys, 301)


def test_query(spark):
    docs, bench = (pq.read_table(f"{SF}/{t}.parquet").to_pylist() for t in ("documents", "benchmark"))
    want = plain_resample([(d["doc_id"], d["text"]) for d in docs], [b["text"] for b in bench])
    assert mine(resampling.op12_resampling(spark, SF)) == want
