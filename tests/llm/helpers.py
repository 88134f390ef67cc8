"""Awkward small tables and plain forms of the operators for comparison."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: Extra columns have names that the operators use inside.
DOCS = (
    "doc_id long, text string, lang string, source string, n_chars long, doc string, score double, "
    "node int, words string, `key` string, a string, `check` string, bitmap string"
)


def documents(spark, texts, langs=None):
    """Texts, or rows (id, text); the other columns are null or hold something odd."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    langs = langs or [None] * len(rows)
    extra = (None, None, "x", 0.5, 1, "w", "k", None, "c", "b")
    return spark.createDataFrame([(i, t, lang, *extra) for (i, t), lang in zip(rows, langs, strict=True)], DOCS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def prose(seed, n, vocabulary=500):
    import random

    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))
