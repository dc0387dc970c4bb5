"""Small frames with the awkward rows every operator must take."""

import random

LONG = "long text with many words that goes on and on " * 3000

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "id string, n_tokens string, hits string, bucket string, w string"
)


def rows(texts, first=0):
    """(doc_id, text) pairs as rows with columns whose names clash with the operators' own."""
    out = []
    for k, t in enumerate(texts, first):
        ident, text = t if isinstance(t, tuple) else (k, t)
        out.append((ident, text, "en", "s", None if text is None else len(text), "x", "x", "x", "x", None))
    return out


def docs(spark, texts, slices=3):
    data = rows(texts)
    return spark.createDataFrame(data, SCHEMA).repartition(slices) if data else spark.createDataFrame([], SCHEMA)


WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "ré", "sö") for b in ("ban", "der", "fil", "gos", "hut", "Jam", "kél")]


def prose(seed, n, words=WORDS):
    r = random.Random(seed)
    return " ".join(r.choice(words) for _ in range(n))


AWKWARD = [None, "", " \n\t ", "one", "Two words", LONG, (None, "no id here"), (None, None), (7, "same id"), (7, "same id")]
