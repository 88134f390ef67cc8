"""The trained models' parts against plain forms: language profiles, label model, classifier."""

import tracemalloc
from collections import Counter

import numpy as np
import pytest
from helpers import documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldloom.llm import language_id, toxicity

# Language profiles


def plain_trigrams(text):
    """Each letter with what stands beside it; whatever is no letter is a blank."""
    padded = f" {(text or '').lower()} "
    blank = lambda c: c if c.isalpha() else " "
    return Counter((blank(padded[i - 1]), padded[i], blank(padded[i + 1])) for i in range(1, len(padded) - 1) if padded[i].isalpha())


def plain_bundle(text):
    def vector(c):
        number, _ = language_id.letters().numbers(np.array([ord(c)], np.uint32))
        return language_id.letters().vectors[number[0]].astype(float)

    out = np.zeros(language_id.DIMENSIONS)
    for (a, b, c), n in plain_trigrams(text).items():
        out += n * np.roll(vector(a), 2) * np.roll(vector(b), 1) * vector(c)
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="abÄİΣς日本 1.\n", max_size=12)), min_size=1, max_size=6), st.integers(1, 9), st.integers(1, 5))
def test_bundles_by_a_loop_over_trigrams(texts, group, block):
    held = language_id.GROUP, language_id.BLOCK
    language_id.GROUP, language_id.BLOCK = group, block
    try:
        found, seen = language_id.bundles(texts, list(range(len(texts))), len(texts))
        together, _ = language_id.bundles(texts, [0] * len(texts), 1)
    finally:
        language_id.GROUP, language_id.BLOCK = held
    want = np.array([plain_bundle(t) for t in texts])
    assert (found == want).all() and (together[0] == want.sum(axis=0)).all()
    assert seen.tolist() == [bool(plain_trigrams(t)) for t in texts]


def test_trigrams_do_not_span_words():
    assert sum(plain_trigrams("ab, cd").values()) == 4
    found, _ = language_id.bundles(["ab, cd", "ab", "cd"], [0, 1, 2], 3)
    assert (found[0] == found[1] + found[2]).all()


def test_two_million_letters_of_a_large_script():
    text = "".join(map(chr, np.random.default_rng(1).integers(0x4E00, 0x9FFF, 2_000_000)))
    language_id.bundles([text[:200_000]], [0], 1)  # the letters' own vectors are kept
    tracemalloc.start()
    found, seen = language_id.bundles([text], [0], 1)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert seen[0] and peak < 400e6
    assert np.abs(found).sum() > 0


def test_prototypes_by_a_loop(spark):
    rows = [("the cat sat", "en"), ("on the mat", "en"), ("der Hund", "de"), (None, "de"), ("日本", None), ("12", "xx"), ("the cat sat", "en")]
    docs = documents(spark, [t for t, _ in rows], [x for _, x in rows]).repartition(3)
    names, profiles = language_id.prototypes(docs)
    assert names == ["de", "en"]
    for name, profile in zip(names, profiles, strict=True):
        want = sum(plain_bundle(t) for t, x in rows if x == name)
        assert np.allclose(profile, want / np.linalg.norm(want), atol=1e-6)


def test_languages_that_tie_repeated_rows_and_no_rows(spark):
    docs = documents(spark, [(1, "same words"), (2, "same words"), (3, "same words"), (3, "same words"), (3, None)], ["nl", "af", None, None, None])
    names, profiles = language_id.prototypes(docs)
    assert names == ["af", "nl"]
    found = sorted((r.doc_id, r.lang_pred, round(r.score, 5)) for r in language_id.identify(docs, names, profiles, ["doc_id"]).collect())
    assert found == [(1, "af", 1.0), (2, "af", 1.0), (3, "af", 1.0), (3, "af", 1.0), (3, "und", 0.0)]
    assert language_id.identify(docs.limit(0), names, profiles, ["doc_id"]).collect() == []


# The label model


def drawn(rates, share, n=60_000, copies=()):
    """(truth, votes): independent voters by (P(toxic vote | toxic), P(toxic vote | clean)), a last
    one that says clean where no other speaks, and copies of voters."""
    draw = np.random.default_rng(5)
    truth = draw.random(n) < share
    toxic = np.stack([np.where(truth, draw.random(n) < a, draw.random(n) < b) for a, b in rates] , axis=1)
    toxic = np.concatenate([toxic, *(toxic[:, [k]] for k in copies)], axis=1)
    clean = ~toxic.any(axis=1, keepdims=True)
    votes = np.concatenate([toxic.astype(np.int8), -clean.astype(np.int8)], axis=1)
    both = np.concatenate([votes > 0, votes < 0], axis=1).astype(float)
    return truth, votes, toxicity.fit_label_model(n, both.sum(axis=0), both.T @ both, share)


RATES = [(0.7, 0.01), (0.6, 0.02), (0.5, 0.05), (0.4, 0.01)]


def test_label_model_finds_how_far_voters_can_be_trusted():
    truth, votes, model = drawn(RATES, 0.2)
    want = [np.log(a / b) for a, b in RATES]
    assert np.argsort(model.toxic[:4])[0] == np.argsort(want)[0] == 2
    assert (model.toxic[:4] > 0.4 * np.array(want)).all() and (model.toxic[:4] < 1.6 * np.array(want)).all()
    posterior = model.posterior(votes)
    # The best that can be done knows the rates and that voters are independent.
    odds = np.log(0.2 / 0.8) + sum(np.where(votes[:, k] > 0, np.log(a / b), np.log((1 - a) / (1 - b))) for k, (a, b) in enumerate(RATES))
    assert ((posterior > 0.5) == truth).mean() > ((odds > 0) == truth).mean() - 0.05
    speaks = (votes[:, :4] > 0).sum(axis=1)
    means = [posterior[speaks == k].mean() for k in range(4)]
    assert means == sorted(means) and means[0] < 0.1 and means[3] > 0.9


def test_a_copied_voter_counts_for_less():
    _, _, alone = drawn(RATES, 0.2)
    _, _, model = drawn(RATES, 0.2, copies=[2])
    both = model.toxic[2] + model.toxic[4]
    assert np.isclose(model.toxic[2], model.toxic[4], rtol=1e-6)
    assert model.toxic[2] < 0.8 * alone.toxic[2] and both < 1.6 * alone.toxic[2]


def test_voters_that_never_speak():
    n = 1000
    model = toxicity.fit_label_model(n, np.zeros(6), np.zeros((6, 6)), 0.1)
    assert np.isfinite(model.posterior(np.zeros((2, 3), np.int8))).all()


# The classifier


def plain_descent(rows, votes, target, width, ridge=(5e-3, 1e-4), steps=60_000):
    """The same loss by plain gradient steps over a dense matrix."""
    x = np.zeros((len(rows), width + votes.shape[1] + 1))
    for k, r in enumerate(rows):
        x[k, r] = 1
    x[:, width:-1] = votes > 0
    x[:, -1] = 1
    weight = np.where(target > 0.5, 0.5 / (target > 0.5).mean(), 0.5 / (target <= 0.5).mean()) / len(rows)
    hold = np.r_[np.full(width, ridge[0]), np.full(votes.shape[1], ridge[1]), 0]
    theta = np.zeros(x.shape[1])
    rate = 1 / (0.25 * np.linalg.eigvalsh(x.T @ (x * weight[:, None])).max() + max(ridge))
    for _ in range(steps):
        theta -= rate * (x.T @ (weight * (1 / (1 + np.exp(-x @ theta)) - target)) + hold * theta)
    return x, theta


def test_classifier_against_plain_descent():
    draw = np.random.default_rng(9)
    rows = [np.sort(draw.choice(12, draw.integers(0, 5), replace=False)) for _ in range(80)]
    votes = (draw.random((80, 3)) < 0.3).astype(np.int8)
    truth = np.array([0.9 if 3 in r or v[0] else 0.1 for r, v in zip(rows, votes, strict=True)])
    x, theta = plain_descent(rows, votes, truth, 12)
    found = toxicity.fit_classifier(rows, votes, truth, 12, rounds=3000)
    mine = x @ np.r_[found.weights, found.votes, found.bias]
    assert np.abs(1 / (1 + np.exp(-mine)) - 1 / (1 + np.exp(-x @ theta))).max() < 0.01
    assert ((mine > 0) == (truth > 0.5)).mean() > 0.95


# Mined voters


def test_mined_features_cover_toxic_rows_and_are_pure():
    toxic = np.array([1] * 40 + [0] * 200)
    rows = [np.array(sorted({0, 1 + k % 4, 5})) for k in range(40)] + [np.array([5] if k % 2 else []) for k in range(200)]
    picked = toxicity.mine(rows, toxic, 6)
    assert picked[0] == 0 and set(picked) <= {0, 1, 2, 3, 4}  # 5 is as often in clean rows
    assert toxicity.mine(rows, np.zeros(240, int), 6) == [] and toxicity.mine([], np.zeros(0, int), 6) == []


def test_scores_of_long_and_repeated_documents(spark):
    texts = [(1, prose(1, 30)), (1, prose(1, 30)), (2, "idiot moron " + prose(2, 60_000)), (3, "x" * 300_000), (None, "idiot scum")]
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    docs = documents(spark, texts)
    found = [(r.doc_id, r.score) for r in toxicity.score(docs, toxicity.learn(docs, labels), ["doc_id"]).collect()]
    assert len(found) == 5 and all(0 <= s <= 1 for _, s in found)
    same = [s for i, s in found if i == 1]
    assert same[0] == same[1] and pytest.approx(same[0]) == same[1]
