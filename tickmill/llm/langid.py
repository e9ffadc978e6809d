"""Language identification by a string kernel.

A text is the set of its byte n-grams of length 1 to SPECTRUM (blended spectrum,
presence only), hashed into BUCKETS coordinates, which n-grams may share. The kernel of two texts is the
number of coordinates that both hold over the geometric mean of their numbers of them.
Landmarks from a bounded sample of labelled texts give Nystrom features;
one-versus-rest kernel ridge regression is solved in that space, and texts are
scored in batches by two matrix products.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

SPECTRUM = 3
BUCKETS = 1 << 13
#: Labelled texts per language that the model is fitted on, and those of them that are landmarks.
SAMPLE, LANDMARKS = 400, 24
#: Landmarks of all languages together: with more languages each has fewer of them, one at least.
ALL_LANDMARKS = 4800
RIDGE = 1e-2


def presence(parts: list[bytes]) -> np.ndarray:
    """One row of 0 and 1 for each text: which hashed n-grams it holds. ASCII letters are lower-cased."""
    out = np.zeros((len(parts), BUCKETS), np.float32)
    for row, text in zip(out, parts):
        b = np.frombuffer(b" " + text.lower() + b" ", np.uint8).astype(np.uint32)
        h = b
        row[(h * np.uint32(2654435761)) >> np.uint32(32 - 13)] = 1
        for n in range(2, SPECTRUM + 1):
            h = h[:-1] * np.uint32(257) + b[n - 1 :]
            row[((h + np.uint32(n << 27)) * np.uint32(2654435761)) >> np.uint32(32 - 13)] = 1
    return out


def packed(parts: list[bytes]) -> np.ndarray:
    return np.packbits(presence(parts).astype(bool), axis=1)


def unpacked(bits: list[bytes]) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b"".join(bits), np.uint8).reshape(len(bits), -1), axis=1).astype(np.float32)


def has_letter(text: bytes) -> bool:
    return any(map(str.isalpha, text.decode("utf-8", "replace")))


class Model:
    def __init__(self, languages: list[str], landmarks: np.ndarray, weights: np.ndarray, bias: np.ndarray):
        self.languages, self.weights, self.bias = languages, weights, bias
        self.landmarks = np.ascontiguousarray((landmarks / np.sqrt(np.maximum(landmarks.sum(1, keepdims=True), 1))).T)

    @classmethod
    def fit(cls, parts: list[bytes], languages: list[str]) -> Model:
        return cls.fit_packed([r.tobytes() for r in packed(parts)], languages)

    @classmethod
    def fit_packed(cls, bits: list[bytes], languages: list[str]) -> Model:
        """Fitted on packed presence rows, a block at a time."""
        names = sorted(set(languages))
        number = {v: i for i, v in enumerate(names)}
        most = max(1, min(LANDMARKS, ALL_LANDMARKS // len(names)))
        seen: dict[str, list[int]] = {n: [] for n in names}
        for i, v in enumerate(languages):
            if len(seen[v]) < most:
                seen[v].append(i)
        x = unpacked([bits[i] for n in names for i in seen[n]])
        model = cls(names, x, np.zeros(0), np.zeros(0))
        marks = model.kernel(x)
        value, vector = np.linalg.eigh((marks + marks.T) / 2)
        keep = value > 1e-6 * value.max()
        root = vector[:, keep] / np.sqrt(value[keep])  # Nystrom: K_mm^-1/2
        size = Counter(languages)
        mean, mid = np.zeros(root.shape[1]), np.zeros(len(names))
        square, cross = np.zeros((root.shape[1], root.shape[1])), np.zeros((root.shape[1], len(names)))
        for i in range(0, len(bits), 1024):
            of = languages[i : i + 1024]
            phi = (model.kernel(unpacked(bits[i : i + 1024])) @ root).astype(np.float64)
            y = np.full((len(of), len(names)), -1.0)
            y[np.arange(len(of)), [number[v] for v in of]] = 1
            weight = np.array([1 / size[v] for v in of])[:, None] / len(names)  # each language counts alike
            mean += (weight * phi).sum(0)
            mid += (weight * y).sum(0)
            square += phi.T @ (weight * phi)
            cross += phi.T @ (weight * y)
        a = square - np.outer(mean, mean) + RIDGE / len(names) * np.eye(len(mean))
        w = np.linalg.solve(a, cross - np.outer(mean, mid))
        model.weights, model.bias = (root @ w).astype(np.float32), (mid - mean @ w).astype(np.float32)
        return model

    def kernel(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.landmarks) / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))

    def scores(self, x: np.ndarray) -> np.ndarray:
        return self.kernel(x) @ self.weights + self.bias


def sample(docs: DataFrame, modulus: int, held: int) -> list:
    """At most SAMPLE labelled (doc_id, lang, packed presence) rows of every language, those of smallest id hash among texts that aren't null; of any length.

    Each language's distinct ids are counted by ranges of the hash first, and only those up to the range that the SAMPLE-th is in
    are ranked: exact on any data, and a language's ids never meet in one task.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % modulus != held))
    place = F.xxhash64("doc_id")
    ids = rows.select("doc_id", "lang").distinct().select("doc_id", "lang", place.alias("place"), F.shiftright(place, 52).alias("part"))
    counts = common.settled(ids.groupBy("lang", "part").agg(F.count("*").alias("n")))
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy("part"))
    last = counts.withColumn("upto", upto).groupBy("lang").agg(F.coalesce(F.min(F.when(F.col("upto") >= SAMPLE, F.col("part"))), F.max("part")).alias("last"))
    few = ids.join(common.maybe_broadcast(common.settled(last)), "lang").where(F.col("part") <= F.col("last")).select("doc_id", "lang", "place")
    order = Window.partitionBy("lang").orderBy("place", "doc_id")
    picked = common.settled(few.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= SAMPLE).select("doc_id", "lang"))

    def reduce(batches):
        for batch in batches:
            texts = common.texts(batch)
            for i in range(0, len(texts), 256):
                bits = [r.tobytes() for r in packed(texts[i : i + 256])]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, len(bits)), batch.column("lang").slice(i, len(bits)), pa.array(bits, pa.binary())], ["doc_id", "lang", "bits"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = rows.select("doc_id", "lang", "text").join(common.maybe_broadcast(picked), ["doc_id", "lang"]).select("doc_id", "lang", "text")
    once = found.mapInArrow(reduce, f"doc_id {kind}, lang string, bits binary").groupBy("doc_id", "lang").agg(F.min("bits").alias("bits"))  # an id counts once
    return sorted(tuple(r) for r in once.collect())


def identify(docs: DataFrame, modulus: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of docs.

    `und` with score 0 for null texts, texts without a letter, and everything if
    no row is labelled. Every language that labels a text outside the held-out part is learned.
    The score is the winner's share of the languages' softmax over scores. Ties go to
    the first language in order of name.
    """
    learned = sample(docs, modulus, held)
    model = Model.fit_packed([bytes(x) for _, _, x in learned], [v for _, v, _ in learned]) if learned else None
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        made = shared.value
        for batch in batches:
            parts = common.texts(batch)
            pred, score = [], []
            for i in range(0, len(parts), 256):
                part = parts[i : i + 256]
                if made is None:
                    pred += ["und"] * len(part)
                    score += [0.0] * len(part)
                    continue
                s = made.scores(presence(part))
                best = s.argmax(1)
                e = np.exp(4 * (s - s.max(1, keepdims=True)))
                p = 1 / e.sum(1)
                for text, b, q in zip(part, best, p):
                    ok = has_letter(text)
                    pred.append(made.languages[b] if ok else "und")
                    score.append(float(q) if ok else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", common.held_out(modulus, held).alias("held_out")).mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def op9(spark, sf_dir):
    """Language of every document, learned from the labelled ones outside the held-out fifth.

    Null texts and texts without a letter are `und` with score 0. Rows of equal or null doc_id have a row each; null ids are neither learned from nor held
    out. Equal scores go to the first language by name. An empty table gives no rows. Other columns are not read.
    """
    return identify(common.table(spark, sf_dir, "documents"))
