"""Toxicity by weak supervision.

Method: many voters look at each text: lexicon voters (given words, and features mined from
labelled rows) and pattern voters; each says toxic, clean or nothing. A feature is a word
or the beginning of a word (``PREFIXES`` bytes), since insults are inflected and compounded. A
generative label model is fitted to the votes alone: a voter's accuracy comes from its agreement
with pairs of others (the triplet identity: for voters independent given the truth, the product of
two agreements over the third is the square of an accuracy), and voters that agree more than their
accuracies explain are correlated and share their weight. The model's posterior, not the label, is
what a linear classifier over features and votes is then trained on; its logistic output is the
score.

What is counted: the votes' first and second moments over all documents that may be learned from
(voters x voters numbers), in one pass with partial sums. Features are mined and the classifier is
fitted on at most ``SAMPLE`` labelled rows, the first in hash order; that bound is the operator's
parameter ``sample``. Only this sample of ids, the ``FEATURES`` features kept and the model's
numbers are broadcast. Scoring is one pass without a shuffle, over whole texts.

Results in odd cases: null and empty texts get the score of a text without words; without labelled
rows (or only one kind) no word is mined and the posterior itself is the score; a row whose label is
null is not learned from; of repeated labels of one document the largest counts; repeated documents
are scored each; an empty table gives no rows; extra columns are not read by the scores and pass
through ``drop_toxic`` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm.language_id import held_out
from fieldloom.llm.shared import cut, map_arrow, read, ship
from fieldloom.llm.words import ALPHANUMERIC, FOLDED, U, chunks, prefix_hashes, words_of

#: Labelled rows at most; features kept for the classifier; mined features that vote; labelled rows
#: with a feature at least; bytes of the beginnings of words; share of toxic rows of a mined feature;
#: mined voters on a toxic row.
SAMPLE, FEATURES, MINED, LEAST_ROWS, PREFIXES, PRECISION, DEPTH = 20_000, 4096, 96, 4, (4, 5, 6, 7, 8), 0.75, 5

# Words whose presence is a vote for toxic.
INSULTS = "idiot moron loser scum clown trash imbecile fool jerk creep dimwit halfwit vermin parasite".split()
CONTEMPT = "stupid pathetic worthless disgusting useless dumb ugly repulsive vile filthy despicable contemptible".split()
HOSTILE = "hate kill destroy punch strangle exterminate".split()
# Patterns that vote for toxic where they match.
PATTERNS = (
    r"(?i)\b(?:you|he|she|they)(?:'re| are|'s| is) (?:an? )?(?:\w+ )?(?:idiot|moron|loser|fool|stupid|pathetic|worthless|disgusting)",
    r"(?:\b[A-Z]{4,}\b[^A-Za-z]+){4}",
    r"[!?]{4}",
    r"(?i)\b(?:shut up|go away|drop dead|get lost)\b",
)


def word_hashes(words: list[str]) -> np.ndarray:
    """The hash of each (one-word) string, as the texts' words are hashed."""
    if not words:
        return np.zeros(0, U)
    data = " ".join(words).encode()
    return words_of(np.frombuffer(data, np.uint8), np.array([0, len(data)]), ALPHANUMERIC, FOLDED).hashes


class Features:
    """Known features in order, with a sieve that most others do not pass."""

    BITS = 20

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)
        self.sieve = np.zeros(1 << self.BITS, bool)
        self.sieve[self.hashes >> U(64 - self.BITS)] = True

    def places(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``found``, place in ``hashes``) of those that are known."""
        maybe = np.flatnonzero(self.sieve[found >> U(64 - self.BITS)])
        if not len(maybe) or not len(self.hashes):
            return maybe[:0], maybe[:0]
        at = np.minimum(np.searchsorted(self.hashes, found[maybe]), len(self.hashes) - 1)
        good = self.hashes[at] == found[maybe]
        return maybe[good], at[good]


def feature_chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, features, row of each less the first) of groups of texts."""
    for first, stop, words, data in chunks(texts, ALPHANUMERIC, FOLDED):
        owner = np.repeat(np.arange(stop - first), np.diff(words.bounds))
        parts = [(words.hashes, owner)]
        for length in PREFIXES:
            hashes, which = prefix_hashes(data, words, FOLDED, length)
            parts.append((hashes, owner[which]))
        yield first, stop, np.concatenate([h for h, _ in parts]), np.concatenate([o for _, o in parts])


def known_features(texts: pa.Array, known: Features) -> Iterator[np.ndarray]:
    """The places of each text's known features, in order, each once."""
    width = max(1, len(known.hashes))
    for first, stop, found, owner in feature_chunks(texts):
        index, at = known.places(found)
        pairs = np.unique(owner[index] * width + at)
        rows, at = pairs // width, pairs % width
        bounds = np.searchsorted(rows, np.arange(stop - first + 1))
        for p, q in zip(bounds[:-1], bounds[1:], strict=True):
            yield at[p:q]


class Voters:
    """Lexicon voters by their features, then one voter a pattern, then the voter that says clean
    where no lexicon voter speaks. A vote is 1 (toxic), -1 (clean) or 0 (nothing)."""

    def __init__(self, groups: list[np.ndarray], known: Features):
        self.lexicons = len(groups)
        self.count = len(groups) + len(PATTERNS) + 1
        pairs = [(int(known.places(group)[1][k]), g) for g, group in enumerate(groups) for k in range(len(known.places(group)[1]))]
        self.member = np.zeros((len(known.hashes), len(groups)), bool)  # feature, voter
        for place, g in pairs:
            self.member[place, g] = True

    def of(self, at: np.ndarray, text: str) -> np.ndarray:
        """The votes on a text with the known features ``at``."""
        out = np.zeros(self.count, np.int8)
        out[: self.lexicons] = self.member[at].any(axis=0)
        for k, pattern in enumerate(_patterns(), self.lexicons):
            out[k] = pattern.search(text) is not None
        out[-1] = 0 if out[: self.lexicons].any() else -1
        return out


_COMPILED: list = []


def _patterns() -> list:
    if not _COMPILED:
        _COMPILED.extend(regex.compile(p) for p in PATTERNS)
    return _COMPILED


class LabelModel(NamedTuple):
    """Of each voter the log-odds it adds when it says toxic and when it says clean."""

    prior: float
    toxic: np.ndarray
    clean: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        odds = self.prior + (votes > 0) @ self.toxic + (votes < 0) @ self.clean
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def fit_label_model(n: float, first: np.ndarray, second: np.ndarray, share: float) -> LabelModel:
    """From ``n`` documents: ``first`` the sums of the indicators [toxic votes, clean votes],
    ``second`` the sums of their products, ``share`` the expected share of toxic documents.

    Voters of different languages never speak together, so only agreements count, not their lack.

    Votes as 1, 0, -1 have covariances a_i a_j s, with a_i the voter's covariance with the truth (s
    its variance) where voters are independent given the truth. So a_i^2 s = C_ij C_ik / C_jk; the
    median over pairs (j, k) is robust against the pairs that are dependent. What remains of C
    beyond a_i a_j s, relative to the voters' own deviations, is their correlation.
    """
    v = len(first) // 2
    mean = (first[:v] - first[v:]) / n
    moments = (second[:v, :v] - second[:v, v:] - second[v:, :v] + second[v:, v:]) / n
    cov = moments - np.outer(mean, mean)
    deviation = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    variance = max(1e-4, share * (1 - share))
    root = np.zeros(v)
    for i in range(v):
        near = [j for j in range(v) if j != i and cov[i, j] > 0.05 * deviation[i] * deviation[j]]
        found = [cov[i, j] * cov[i, k] / cov[j, k] for j in near for k in near if k < j and cov[j, k] > 0.05 * deviation[j] * deviation[k]]
        root[i] = np.sqrt(max(0.0, float(np.median(found)))) if found else 0.0
    root = np.minimum(root, 0.98 * deviation)
    # Voters are built so that their votes lean the right way; covariance with the truth is positive.
    left = (cov - np.outer(root, root)) / np.outer(deviation, deviation)
    np.fill_diagonal(left, 0.0)
    shared = 1 + np.maximum(0.0, left).sum(axis=1)
    rate = (first / n).clip(1e-9, 1 - 1e-9)
    # Covariance with the truth (0 or 1): P(vote, toxic) - P(vote) * share, split over both kinds of vote.
    with_truth = root * np.sqrt(variance)
    one_sided = with_truth * rate[:v] / np.maximum(rate[:v] + rate[v:], 1e-12)
    other = with_truth - one_sided

    def odds(covariance: np.ndarray, p: np.ndarray) -> np.ndarray:
        given = np.clip((covariance + p * share) / max(share, 1e-6), 1e-4 * p + 1e-9, p / max(share, 1e-6))  # P(vote | toxic)
        rest = np.clip((p - given * share) / max(1 - share, 1e-6), 1e-3 * p + 1e-9, 1 - 1e-6)
        return np.log(given / rest)

    toxic, clean = odds(one_sided, rate[:v]) / shared, odds(-other, rate[v:]) / shared
    return LabelModel(float(np.log(share / (1 - share))), np.maximum(toxic, 0), np.minimum(clean, 0))


class Classifier(NamedTuple):
    """Logistic weights of the known features and of toxic votes, and the bias."""

    weights: np.ndarray
    votes: np.ndarray
    bias: float


def fit_classifier(rows: list[np.ndarray], votes: np.ndarray, target: np.ndarray, width: int, rounds: int = 300, ridge: tuple[float, float] = (5e-3, 1e-4)) -> Classifier:
    """Logistic regression on soft targets by accelerated gradient steps. ``rows``: each text's features;
    ``ridge``: of the features' and of the votes' weights, which are fewer and better known."""
    flat = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    strong = (votes > 0).astype(np.float64)
    norm = np.bincount(owner, minlength=len(rows)) + strong.sum(axis=1) + 1
    weight = np.where(target > 0.5, 0.5 / max(1e-9, (target > 0.5).mean()), 0.5 / max(1e-9, (target <= 0.5).mean())) / len(rows)
    # A diagonal bound on the curvature: each place's share of the rows' lengths.
    bound = 0.25 * np.concatenate([np.bincount(flat, (weight * norm)[owner], minlength=width), strong.T @ (weight * norm), [float(weight @ norm)]])
    hold = np.concatenate([np.full(width, ridge[0]), np.full(strong.shape[1], ridge[1]), [0.0]])
    bound += hold + 1e-9
    theta = ahead = np.zeros(width + strong.shape[1] + 1)
    for step in range(1, rounds + 1):
        score = np.bincount(owner, ahead[flat], minlength=len(rows)) + strong @ ahead[width:-1] + ahead[-1]
        gap = weight * (1 / (1 + np.exp(-np.clip(score, -30, 30))) - target)
        gradient = np.concatenate([np.bincount(flat, gap[owner], minlength=width), strong.T @ gap, [gap.sum()]])
        gradient += hold * ahead
        moved = ahead - gradient / bound
        ahead = moved + (step - 1) / (step + 2) * (moved - theta)
        theta = moved
    return Classifier(theta[:width], theta[width:-1], float(theta[-1]))


class Model(NamedTuple):
    known: Features
    voters: Voters
    labels: LabelModel
    linear: Classifier | None

    def score(self, at: np.ndarray, text: str) -> float:
        votes = self.voters.of(at, text)
        if self.linear is None:
            return float(self.labels.posterior(votes[None])[0])
        c = self.linear
        odds = c.bias + c.weights[at].sum() + c.votes[votes > 0].sum()
        return float(1 / (1 + np.exp(-np.clip(odds, -30, 30))))


def mine(rows: list[np.ndarray], toxic: np.ndarray, width: int) -> list[int]:
    """Features that vote: one after the other that which most toxic rows hold which fewer than
    ``DEPTH`` so far cover (a label model needs several voters
    on a text), the purer the better,
    among those whose rows are toxic by ``PRECISION`` or more."""
    flat = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    n, t = np.bincount(flat, minlength=width), np.bincount(flat, toxic[owner], minlength=width)
    purity = np.where((n >= LEAST_ROWS) & (t >= PRECISION * n), t / np.maximum(n, 1), 0.0) ** 6
    need = toxic.astype(np.int64) * DEPTH
    picked: list[int] = []
    while len(picked) < MINED:
        gain = np.bincount(flat, need[owner] > 0, minlength=width) * purity
        best = int(np.argmax(gain))
        if gain[best] < 2:
            break
        picked.append(best)
        need[owner[flat == best]] -= 1
        purity[best] = 0
    return picked


def _sample(docs: DataFrame, labels: DataFrame, doc: str, text: str, sample: int) -> DataFrame:
    """(toxic, text) of the sampled labelled rows."""
    chosen = labels.where(F.col("toxic").isNotNull()).groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").cast("int").alias("toxic"))
    allowed = chosen.join(docs.select(F.col(doc).alias("__id")), "__id", "left_semi")
    drawn = allowed.orderBy(F.xxhash64("__id"), "__id").limit(sample)
    return cut(docs.join(F.broadcast(drawn), docs[doc] == F.col("__id")).select("toxic", F.col(text).cast("string").alias("text")))


def _common_features(rows: DataFrame, toxic: int, n: int) -> np.ndarray:
    """The ``FEATURES`` features of the sample that tell most about the label."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        y = batch.column(0).to_numpy()
        parts = []
        for first, _, found, owner in feature_chunks(batch.column(1)):
            order = np.lexsort((owner, found))
            f, o = found[order], owner[order]
            new = np.ones(len(f), bool)
            new[1:] = (f[1:] != f[:-1]) | (o[1:] != o[:-1])
            parts.append((f[new], y[first + o[new]]))
        values, inverse = np.unique(np.concatenate([f for f, _ in parts]), return_inverse=True)
        t = np.bincount(inverse, np.concatenate([x for _, x in parts]), minlength=len(values)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(t), pa.array(np.bincount(inverse, minlength=len(values)))], names=["feature", "t", "n"])

    counts = map_arrow(rows, each, "feature long, t long, n long").groupBy("feature").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
    rate = lambda c, m: (c + 0.5) / (m + 1.0)
    lean = F.log(rate(F.col("t"), F.lit(toxic)) / rate(F.col("n") - F.col("t"), F.lit(n - toxic)))
    common = counts.where(F.col("n") >= LEAST_ROWS).select("feature", (lean * F.sqrt(F.col("n").cast("double"))).alias("lean"))
    found = common.orderBy(F.col("lean").desc(), "feature").limit(FEATURES).toPandas()
    return found["feature"].to_numpy(np.int64).view(U)


def _moments(docs: DataFrame, text: str, known: Features, voters: Voters) -> tuple[float, np.ndarray, np.ndarray]:
    width = 2 * voters.count
    held = docs.sparkSession.sparkContext.broadcast((known, voters))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 1))
        for batch in batches:
            votes = _votes(batch.column(0), *held.value)
            if len(votes):
                both = np.concatenate([votes > 0, votes < 0, np.ones((len(votes), 1), bool)], axis=1).astype(np.float64)
                total += both.T @ both
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["place", "n"])

    ship(docs.sparkSession)
    sums = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "place long, n double").groupBy("place").agg(F.sum("n").alias("n")).toPandas().sort_values("place")
    total = sums["n"].to_numpy().reshape(width + 1, width + 1) if len(sums) else np.zeros((width + 1, width + 1))
    return float(total[-1, -1]), total[:-1, -1], total[:-1, :-1]


def _votes(texts: pa.Array, known: Features, voters: Voters) -> np.ndarray:
    return np.array([voters.of(at, t.as_py() or "") for at, t in zip(known_features(texts, known), texts, strict=True)], np.int8).reshape(len(texts), voters.count)


def _fetch(rows: DataFrame, known: Features) -> tuple[np.ndarray, list[np.ndarray]]:
    """(labels, known features) of the sampled rows, in the order of their content."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = [x.tolist() for x in known_features(batch.column(1), known)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(at, pa.list_(pa.int32()))], names=["toxic", "at"])

    found = map_arrow(rows, each, "toxic int, at array<int>").toArrow()
    return found.column("toxic").to_numpy(), [np.array(x, np.int64) for x in found.column("at").to_pylist()]


def learn(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model:
    """A model from ``docs`` (all of them may be learned from) and the ``labels`` (doc_id, toxic)."""
    rows = _sample(docs, labels, doc, text, sample)
    n, toxic = rows.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    toxic = toxic or 0
    given = [h[None] for h in word_hashes([*INSULTS, *CONTEMPT, *HOSTILE])]
    labelled = 0 < toxic < n
    known = Features(np.concatenate([*given, *([_common_features(rows, toxic, n)] if labelled else [])]))
    width = len(known.hashes)
    y, features = _fetch(rows, known) if labelled else (np.zeros(0), [])
    picked = mine(features, y, width) if labelled else []
    voters = Voters(given + [known.hashes[k : k + 1] for k in picked], known)
    total, first, second = _moments(docs, text, known, voters)
    share = min(0.5, max(0.005, toxic / n if n else 0.05))
    model = LabelModel(float(np.log(share / (1 - share))), np.zeros(voters.count), np.zeros(voters.count))
    if total:
        model = fit_label_model(total, first, second, share)
    if not labelled:
        return Model(known, voters, model, None)
    # The patterns need the text, so the votes are made where it lies; the rows come in the same order.
    held = docs.sparkSession.sparkContext.broadcast((known, voters))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v.tolist() for v in _votes(batch.column(0), *held.value)], pa.list_(pa.int8()))], names=["votes"])

    votes = np.array(map_arrow(rows.select("text"), each, "votes array<byte>").toArrow().column("votes").to_pylist(), np.int8)
    return Model(known, voters, model, fit_classifier(features, votes, model.posterior(votes), width))


def _scores(texts: pa.Array, model: Model) -> list[float]:
    return [model.score(at, t.as_py() or "") for at, t in zip(known_features(texts, model.known), texts, strict=True)]


def score(docs: DataFrame, model: Model, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, score) of each row."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(len(keys))
        scores = _scores(texts, held.value)
        return pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], pa.array(scores, pa.float64())], names=[*keys, "score"])

    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    return map_arrow(docs.select(*keys, F.col(text).cast("string").alias("__text")), each, f"{kinds}, score double")


def drop_toxic(docs: DataFrame, labels: DataFrame, learn_from: F.Column | None = None, doc: str = "doc_id", text: str = "text", limit: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose score reaches ``limit``; all columns as they are."""
    model = learn(docs if learn_from is None else docs.where(learn_from), labels, doc, text)
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = _scores(batch.column(at), held.value)
        return batch.filter(pa.array([x < limit for x in scores], pa.bool_()))

    return map_arrow(docs, each, docs.schema)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, learned from those not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", held_out(F.col("doc_id"), 5, 0).alias("held_out"))
    model = learn(docs.where(~F.col("held_out")), read(spark, sf_dir, "labels"))
    return score(docs, model, ["doc_id", "held_out"]).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
