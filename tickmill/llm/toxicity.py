"""Toxicity by maximum-scoring segments.

A word's score is its log-odds ratio between toxic and clean documents under
Dirichlet priors that back off from the word to its first six and four bytes and on to
the corpus, less a drift that makes clean text score below zero. A linear-time scan finds all
maximal-scoring segments of a text (Ruzzo and Tompa's, over runs of positive words). Extreme-value
theory calibrates them: with the root lambda of the clean words' score distribution and K
fitted on the clean documents, a segment's expected number of equals in a text of n words
is K n exp(-lambda S). The evidence of all significant segments is summed, and a logistic curve of its
logarithm, fitted on the same sums over the labelled documents, turns it into a probability.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Bytes of a word that count, level by level: all, and its beginnings.
LEVELS = (None, 6, 4)
#: Most labelled documents that it is fitted on, and bytes of their texts, which bound the table of words. All words of these count.
SAMPLE, SAMPLE_BYTES = 100_000, 64 << 20
PRIOR = (4.0, 8.0, 16.0)
DRIFT, FLOOR = 2.0, -3.0
#: Segments with fewer expected equals than this in a clean text of the same length are significant.
SIGNIFICANT = 0.05
#: Histogram bins: of words' scores, segments' scores, texts' lengths (in each doubling), and evidence.
WORD, BEST, SIZE, STRENGTH = 0.05, 0.25, 8, 0.05
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def keys(parts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """(hash of each word at each level, first word of each text and the total); ASCII punctuation counts as white space."""
    buf = np.frombuffer(b"\n".join(p.translate(_LOWER) for p in parts) + b"\n", np.uint8)
    starts, ends = common.spans(buf)
    at = np.searchsorted(starts, np.cumsum([0, *(len(p) + 1 for p in parts)]))
    return [common.hash_spans(buf, starts, ends, cut) for cut in LEVELS], at


def counts(labelled: DataFrame) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """(Hashes, ascending, and the clean and toxic labelled documents that hold them) of each level, and the number of clean and toxic documents; a document counts once, however often it repeats a word."""

    def run(batches):
        docs = np.zeros(2, np.int64)
        for batch in batches:
            parts, y = common.texts(batch), np.array(batch.column("y").to_pylist(), np.int64) > 0
            docs += np.bincount(y, minlength=2)
            for i, j in common.groups([len(p) for p in parts], 1 << 22):
                found, at = keys(parts[i:j])
                doc = np.repeat(np.arange(i, j), np.diff(at))
                for level, h in enumerate(found):
                    order = np.lexsort((doc, h))
                    h, of = h[order], doc[order]
                    once = common.first_of_runs(h, of)
                    h, toxic = h[once], y[of[once]].astype(np.int64)
                    first = np.flatnonzero(common.first_of_runs(h))
                    if len(first):
                        bad = np.add.reduceat(toxic, first)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(first), level, np.int32)), pa.array(h[first].view(np.int64)), pa.array(np.diff(np.r_[first, len(h)]) - bad), pa.array(bad)], ["level", "word", "clean", "toxic"])
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([0], pa.int64()), pa.array(docs[:1]), pa.array(docs[1:])], ["level", "word", "clean", "toxic"])

    rows = common.settled(labelled.mapInArrow(run, "level int, word long, clean long, toxic long").groupBy("level", "word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    out = []
    for level in range(len(LEVELS)):
        got = rows.where(F.col("level") == level).select("word", "clean", "toxic").toArrow()  # the words of SAMPLE_BYTES at most
        word = got["word"].to_numpy().view(np.uint64)
        order = np.argsort(word)
        out.append((word[order], np.stack([got[c].to_numpy()[order] for c in ("clean", "toxic")]).astype(np.float32)))
    whole = rows.where("level = -1").first()
    return out, np.array([whole.clean, whole.toxic] if whole else [0, 0])


class Lexicon:
    """Scores of words, and what calibrates segments of them."""

    def __init__(self, found: list[tuple[np.ndarray, np.ndarray]], docs: np.ndarray):
        self.found, self.docs = found, docs
        clean, toxic = (max(1.0, float(found[0][1][v].sum())) for v in (0, 1))
        self.share = toxic / (clean + toxic)
        self.rate, self.k = 1.0, 0.1
        self.curve = (math.log(docs[1] + 1) - math.log(docs[0] + 1), 0.0)

    def scores(self, asked: list[np.ndarray]) -> np.ndarray:
        """Each word's log-odds: the expected toxic share of the documents that hold it, backed off level by level, against the corpus."""
        p = np.full(len(asked[0]), self.share)
        for (word, held), h, a in reversed(list(zip(self.found, asked, PRIOR))):
            if not len(word):
                continue
            at = np.minimum(np.searchsorted(word, h), len(word) - 1)
            known = word[at] == h
            toxic, both = np.where(known, held[1][at], 0), np.where(known, held[0][at] + held[1][at], 0)
            p = (toxic + a * p) / (both + a)
        p = np.clip(p, 1e-6, 1 - 1e-6)
        return np.clip(np.log(p / (1 - p)) - math.log(self.share / (1 - self.share)) - DRIFT, FLOOR, None)

    def segments(self, s: np.ndarray) -> list[tuple[int, int, float]]:
        """All maximal-scoring segments (start, end, score) in one pass."""
        up = s > 0
        if not up.any():
            return []
        cum = np.r_[0.0, np.cumsum(s)]
        edge = np.diff(np.r_[False, up, False].astype(np.int8))
        begins, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        stack: list[list] = []  # start, end, cumulative before it and after it
        for b, e in zip(begins.tolist(), stops.tolist()):
            item = [b, e, cum[b], cum[e]]
            while stack:
                # the nearest segment before it that begins lower; those between stay apart from it
                j = len(stack) - 1
                while j >= 0 and stack[j][2] >= item[2]:
                    j = stack[j][4]
                if j < 0 or stack[j][3] >= item[3]:
                    break
                item = [stack[j][0], item[1], stack[j][2], item[3]]
                del stack[j:]
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= item[2]:
                j = stack[j][4]
            stack.append([*item[:4], j])
        return [(b, e, float(after - before)) for b, e, before, after, _ in stack]

    def significant(self, found: list[tuple[int, int, float]], n: int) -> list[tuple[int, int, float]]:
        """The segments with (start, end, -ln of the chance of such a one in a clean text of n words) that are too good for chance."""
        out = []
        for b, e, score in found:
            log_expected = math.log(self.k * n) - self.rate * score
            if log_expected < math.log(SIGNIFICANT):
                out.append((b, e, -math.log(-math.expm1(-math.exp(log_expected))) if log_expected > -30 else -log_expected))
        return out

    def probability(self, evidence: float) -> float:
        z = self.curve[0] + self.curve[1] * math.log1p(evidence)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

    def texts(self, parts: list[bytes]):
        """(scores of the words, segments) of each text."""
        for i, j in common.groups([len(p) for p in parts], 1 << 20):
            found, at = keys(parts[i:j])
            s = self.scores(found)
            for a, b in zip(at[:-1], at[1:]):
                yield s[a:b], self.segments(s[a:b])


def _histogram(labelled: DataFrame, made: Lexicon, bins) -> list:
    """(kind, size, bin, n) over the labelled documents; bins(lexicon, scores, segments, toxic) yields the first three and a count. A fixed number of rows."""
    shared = labelled.sparkSession.sparkContext.broadcast(made)

    def run(batches):
        lex = shared.value
        for batch in batches:
            rows: Counter = Counter()
            for (s, found), toxic in zip(lex.texts(common.texts(batch)), batch.column("y").to_pylist()):
                for *row, n in bins(lex, s, found, int(toxic > 0)):
                    rows[tuple(row)] += int(n)
            cols = list(zip(*((*k, n) for k, n in rows.items()))) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int32(), pa.int64()))], ["kind", "size", "bin", "n"])

    return labelled.mapInArrow(run, "kind int, size int, bin int, n long").groupBy("kind", "size", "bin").agg(F.sum("n").alias("n")).collect()


def _calibrating(lex: Lexicon, s: np.ndarray, found: list, toxic: int):
    """Of a clean text: its words' scores, its length and best segment."""
    if not toxic and len(s):
        where, n = np.unique(((s - FLOOR) / WORD).astype(int), return_counts=True)
        yield from ((0, 0, int(i), k) for i, k in zip(where, n))
        yield 1, int(SIZE * math.log2(len(s))), int(max((x for *_, x in found), default=0.0) / BEST), 1


def _strengths(lex: Lexicon, s: np.ndarray, found: list, toxic: int):
    """A text's class and the logarithm of its evidence."""
    yield toxic, 0, int(math.log1p(sum(x for *_, x in lex.significant(found, len(s)))) / STRENGTH), 1


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1) -> Lexicon:
    """Counts, calibration and curve from the labelled documents outside the held-out remainder, at most SAMPLE of them and SAMPLE_BYTES, those of smallest id hash, of either class as they come.

    Of repeated labels of an id the largest counts. If only one class is labelled, or none, every text has the
    same probability: that of its class among the labels, with one label of either class added.
    """
    labelled = common.with_labels(docs.where(F.col("doc_id").isNotNull()), labels, "toxic", modulus, held)
    labelled = common.settled(common.bounded_sample(labelled, SAMPLE, SAMPLE_BYTES).select("y", "text"))
    made = Lexicon(*counts(labelled))
    if not made.docs.all() or not made.found[0][1].sum(1).all():
        return made
    # lambda: the positive root of sum over words of p * exp(lambda * score) = 1, by the words of clean documents
    got = _histogram(labelled, made, _calibrating)
    s = np.array([FLOOR + WORD * (r.bin + 0.5) for r in got if r.kind == 0])
    p = np.array([r.n for r in got if r.kind == 0], float)
    p /= p.sum()
    low, high = 0.0, 1.0
    while (p * np.exp(np.minimum(high * s, 50))).sum() < 1 and high < 64:
        high *= 2
    if (p * s).sum() < 0:
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if (p * np.exp(np.minimum(mid * s, 50))).sum() < 1 else (low, mid)
    made.rate = max(high, 0.05)
    # K: maximum likelihood of the Gumbel law of clean texts' best segments
    best = [(2.0 ** ((r.size + 0.5) / SIZE), (r.bin + 0.5) * BEST if r.bin else 0.0, r.n) for r in got if r.kind == 1]
    made.k = min(1.0, max(1e-6, sum(n for *_, n in best) / max(1e-9, sum(n * size * math.exp(-made.rate * x) for size, x, n in best))))
    got = _histogram(labelled, made, _strengths)
    made.curve = logistic(*(np.array(c, float) for c in zip(*(((r.bin + 0.5) * STRENGTH if r.bin else 0.0, r.kind, r.n) for r in got))))
    return made


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Intercept and slope by Newton's method with a slight ridge; the slope is at least 0."""
    b = np.array([math.log((w * y).sum() + 1) - math.log((w * (1 - y)).sum() + 1), 0.0])
    design = np.stack([np.ones_like(x), x], 1)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(design @ b, -30, 30)))
        g = design.T @ (w * (p - y)) + 1e-2 * b
        h = design.T @ (design * (w * p * (1 - p))[:, None]) + 1e-2 * np.eye(2)
        step = np.linalg.solve(h, g)
        b -= np.clip(step, -2, 2)
        if abs(step).max() < 1e-8:
            break
    return float(b[0]), max(0.0, float(b[1]))


def score(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.7, modulus: int = 3, held: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence, and the significant segments (first word, end, evidence), of every row.

    Null and empty texts have no segment and the score of no evidence.
    """
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    segment = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("evidence", pa.float64())]))

    def run(batches):
        lex = shared.value
        for batch in batches:
            out = []
            for s, found in lex.texts(common.texts(batch)):
                found = lex.significant(found, len(s))
                x = sum(e for *_, e in found)
                p = lex.probability(x)
                out.append((p, int(p >= threshold), x, [dict(zip(("first", "end", "evidence"), f)) for f in found]))
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), *(pa.array(c, t) for c, t in zip(cols, (pa.float64(), pa.int32(), pa.float64(), segment)))], ["doc_id", "held_out", "score", "predicted", "evidence", "segments"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", common.held_out(modulus, held).alias("held_out")).mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int, evidence double, segments array<struct<first: int, end: int, evidence: double>>")


def op8(spark, sf_dir):
    """Toxicity of every document by the lexicon fitted on the labelled ones outside the held-out third, with the number of its toxic segments.

    Null and empty texts share the score of no evidence; rows of equal or null doc_id have a row each, those of null id aren't held out. Equal texts have equal
    scores, a score at the threshold is predicted 1. An empty table gives no rows. Other columns are not read.
    """
    docs = common.table(spark, sf_dir, "documents")
    return score(docs, fit(docs, common.table(spark, sf_dir, "labels"))).select("doc_id", "held_out", "score", "predicted", "evidence", F.size("segments").alias("n_segments"))
