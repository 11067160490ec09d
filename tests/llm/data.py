"""Small documents with the awkward cases: NULLs, empty and long texts, ties, repeats, clashing columns."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def documents(seed=3, n=60):
    import random

    rng = random.Random(seed)
    vocab = ["alpha", "Beta", "gämma", "delta.", "eps", "zeta eta", "theta", "iota", "kappa", "la", "mu", "nu"]
    texts = [None, "", " \n\t ", "one", "a b c d", "é" * 3000 + " x", "\n\n\n", "same line\nsame line\nsame line\n"]
    texts += [" ".join(rng.choice(vocab) for _ in range(rng.randrange(1, 120))) for _ in range(n)]
    texts += [texts[-1], texts[-1], texts[-2] + "\nextra words here", "x y z " * 2000]
    texts += ["#$% " * 20 + t for t in texts[10:16]]
    rows = []
    for i, t in enumerate(texts):
        source = None if i % 11 == 0 else ["a", "b", "", "é"][i % 4]
        rows.append((i * 3, t, "en", source, len(t or "")))
    return rows


def frame(spark, rows=None, schema=SCHEMA):
    return spark.createDataFrame(documents() if rows is None else rows, schema)
