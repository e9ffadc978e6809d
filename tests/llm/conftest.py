import random

import pytest

CLASHES = ("key", "bucket", "kind", "node", "score", "predicted", "component", "block", "y", "held_out", "fingerprint", "size", "slice", "n", "s")


def frame(spark, rows, more=True):
    """documents of (doc_id, text[, lang]), with further columns whose names the operators use themselves."""
    extra = "".join(f", {c} string" for c in _extra(more))
    return spark.createDataFrame([(i, t, (r[0] if r else "en"), "src", None if t is None else len(t), *["x"] * len(_extra(more))) for i, t, *r in rows], f"doc_id long, text string, lang string, source string, n_chars long{extra}")


def _extra(more):
    return CLASHES if more else ()


@pytest.fixture
def make(spark):
    return lambda rows, more=True: frame(spark, rows, more)


def prose(r, n, vocabulary=400):
    return " ".join(f"w{int(r.random() ** 2 * vocabulary)}" + ("." if r.random() < 0.1 else "") for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Texts with exact and near copies, shared passages, nulls, empty and long texts, repeated rows."""
    r = random.Random(5)
    texts = [prose(r, r.choice([1, 3, 4, 5, 12, 13, 14, 40, 120, 300])) for _ in range(120)]
    passage = prose(r, 60)
    for i in range(0, 120, 6):
        w = texts[i].split()
        k = r.randrange(len(w) + 1)
        texts[i] = " ".join(w[:k]) + " " + passage + " " + " ".join(w[k:])
    for _ in range(25):  # near copies, some of near copies
        w = texts[r.randrange(len(texts))].split()
        for _ in range(max(1, len(w) // r.choice([30, 60, 200]))):
            w[r.randrange(len(w))] = "edited"
        texts.append(" ".join(w))
    texts += [texts[3]] * 9 + [None, None, "", " \t\n", "a", "a", "A", "é é", prose(r, 30000), "same " * 500, "\x1c x\x0b y"]
    rows = list(enumerate(texts))
    r.shuffle(rows)
    return rows
