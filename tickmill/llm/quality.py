"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are read two at a time; FILTERS learned filters, each over
WIDTH pairs of embedded bytes, slide over every pair. Overlapping chunks of CHUNK pairs
(half a chunk apart) cover the whole text. Each filter is max-pooled in every chunk, and
the mean and the maximum over chunks go through one logistic unit. Training follows
the maxima back to the filters and to the byte embedding.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

DIM, FILTERS, WIDTH, CHUNK = 6, 16, 4, 256
HOP = CHUNK // 2
#: Labelled documents of each class that the network is fitted on, and bytes of them: whole texts, in order of their ids' hashes, as both allow.
SAMPLE, SAMPLE_BYTES = 1000, 16 << 20
STEPS, BATCH, RATE = 400, 48, 0.02
_LOW = np.float32(-1e9)


def layout(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(byte pairs of all texts, each padded to whole hops; which pairs are padding; first hop of each text; its hops).

    A text is followed by WIDTH pairs of padding at least, so that no filter reaches into the next text.
    """
    hops = np.array([-(-(len(p) + 2 * WIDTH) // (2 * HOP)) for p in parts])
    buf = b"".join(p.ljust(2 * HOP * int(h), b"\0") for p, h in zip(parts, hops)) + b"\0" * (2 * WIDTH)
    first = np.cumsum(np.r_[0, hops[:-1]])
    pad = np.zeros(int(hops.sum()) * HOP, bool)
    for p, f, h in zip(parts, first, hops):
        pad[f * HOP + max(1, -(-len(p) // 2)) : (f + h) * HOP] = True
    return np.frombuffer(buf, np.uint16), pad, first, hops


class Network:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.embed = r.normal(0, 0.5, (256, DIM)).astype(np.float32)
        self.filters = r.normal(0, 1 / np.sqrt(DIM * 2 * WIDTH), (2 * WIDTH, DIM, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = r.normal(0, 0.1, 2 * FILTERS).astype(np.float32)
        self.base = np.zeros(1, np.float32)

    def params(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.out, self.base]

    def tables(self) -> list[np.ndarray]:
        """What each pair of bytes adds to every filter at each of its places: the convolution becomes a sum of rows."""
        at = [self.embed @ self.filters[i] for i in range(2 * WIDTH)]
        # a little-endian pair holds the first byte low
        return [(at[2 * j + 1][:, None, :] + at[2 * j][None, :, :]).reshape(65536, FILTERS) for j in range(WIDTH)]

    def convolve(self, pairs: np.ndarray, pad: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        n = len(pad)
        out = tables[0][pairs[:n]]
        for j in range(1, WIDTH):
            out += tables[j][pairs[j : j + n]]
        out[pad] = _LOW
        return out.reshape(-1, HOP, FILTERS)

    @staticmethod
    def chunks(hop_max: np.ndarray, first: np.ndarray, hops: np.ndarray) -> np.ndarray:
        """A chunk is a hop and the next one of the same text; the last hop of a longer text begins none."""
        following = np.r_[hop_max[1:], hop_max[-1:]]
        last = first + hops - 1
        following[last] = hop_max[last]
        return np.maximum(hop_max, following)

    def pooled(self, chunk: np.ndarray, first: np.ndarray, hops: np.ndarray) -> np.ndarray:
        x = np.maximum(chunk + self.bias, 0)
        return np.hstack([np.add.reduceat(x, first) / hops[:, None], np.maximum.reduceat(x, first)])

    def maxima(self, pairs: np.ndarray, pad: np.ndarray, tables: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(greatest value, its place) of each filter in each hop; long texts are convolved piece by piece."""
        top, place, step = [], [], 256 * HOP
        for i in range(0, len(pad), step):
            conv = self.convolve(pairs[i : i + step + WIDTH], pad[i : i + step], tables)
            place.append(conv.argmax(1))
            top.append(np.take_along_axis(conv, place[-1][:, None, :], 1)[:, 0])
        return np.concatenate(top), np.concatenate(place)

    def score(self, parts: list[bytes], tables: list[np.ndarray]) -> np.ndarray:
        """Probability of each text, whatever the others are."""
        pairs, pad, first, hops = layout(parts)
        step = 256 * HOP
        hop_max = np.concatenate([self.convolve(pairs[i : i + step + WIDTH], pad[i : i + step], tables).max(1) for i in range(0, len(pad), step)])
        x = self.pooled(self.chunks(hop_max, first, hops), first, hops)
        z = (x * self.out).sum(1, dtype=np.float64) + float(self.base[0])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def gradients(self, parts: list[bytes], y: np.ndarray, weight: np.ndarray, tables: list[np.ndarray]) -> list[np.ndarray]:
        pairs, pad, first, hops = layout(parts)
        hop_max, best = self.maxima(pairs, pad, tables)
        chunk = self.chunks(hop_max, first, hops)
        pooled = self.pooled(chunk, first, hops)
        p = 1 / (1 + np.exp(-np.clip(pooled @ self.out + self.base, -30, 30)))
        d = ((p - y) * weight).astype(np.float32)
        back = d[:, None] * self.out  # text, feature
        of = np.repeat(np.arange(len(parts)), hops)
        active = chunk + self.bias > 0
        g = back[of, :FILTERS] / hops[of, None]
        top = np.maximum.reduceat(np.maximum(chunk + self.bias, 0), first)
        is_top = np.maximum(chunk + self.bias, 0) >= top[of]
        ties = np.add.reduceat(is_top.astype(np.float32), first)
        g = (g + is_top * (back[:, FILTERS:] / ties)[of]) * active
        # a chunk's maximum is its own hop's or the next one's
        own = hop_max >= chunk
        source = np.where(own, np.arange(len(hop_max))[:, None], np.minimum(np.arange(len(hop_max))[:, None] + 1, len(hop_max) - 1))
        position = source * HOP + np.take_along_axis(best, source, 0)
        hop_i, filt = np.nonzero(g)
        grad, at = g[hop_i, filt], position[hop_i, filt]
        g_filters, g_embed = np.zeros_like(self.filters), np.zeros_like(self.embed)
        raw = pairs.view(np.uint8)
        for j in range(2 * WIDTH):
            byte = raw[2 * at + j].astype(np.int64)
            flat = np.bincount(byte * FILTERS + filt, grad, 256 * FILTERS).reshape(256, FILTERS).astype(np.float32)  # by byte and filter
            g_filters[j] = self.embed.T @ flat
            g_embed += flat @ self.filters[j].T
        return [g_embed, g_filters, g.sum(0), (d[:, None] * pooled).sum(0), np.array([d.sum()], np.float32)]

    def fit(self, parts: list[bytes], y: np.ndarray, seed: int = 11) -> Network:
        """STEPS steps of Adam over batches with as many texts of either class."""
        r = np.random.default_rng(seed)
        side = [np.flatnonzero(y == v) for v in (0, 1)]
        if not len(side[0]) or not len(side[1]):
            self.out[:] = 0
            self.base[:] = 0 if not len(y) else (4 if len(side[1]) else -4)
            return self
        m = [np.zeros_like(p) for p in self.params()]
        v = [np.zeros_like(p) for p in self.params()]
        for t in range(1, STEPS + 1):
            pick = np.concatenate([r.choice(s, BATCH // 2) for s in side])
            rate = RATE * (1 - t / (STEPS + 1))
            grads = self.gradients([parts[i] for i in pick], y[pick], np.full(BATCH, 1 / BATCH, np.float32), self.tables())
            for p, g, a, b in zip(self.params(), grads, m, v):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p -= rate * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.99**t)) + 1e-6) + rate * 1e-3 * p
        return self


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0) -> Network:
    """The network fitted on whole texts of at most SAMPLE labelled documents and SAMPLE_BYTES of each class, those of smallest id hash; the others' labels aren't read. A text that would exceed SAMPLE_BYTES is passed over, and the next one taken.

    Of repeated labels of an id the largest counts, of repeated ids the least text; null texts are empty. If
    only one class is labelled every score is near that class, without labels it is a half.
    """
    spark = docs.sparkSession
    labelled = common.with_labels(docs.where(F.col("doc_id").isNotNull()), labels, "quality", modulus, held)
    sizes = common.settled(labelled.groupBy("doc_id", F.when(F.col("y") > 0, 1).otherwise(0).alias("y")).agg(F.max(F.coalesce(F.octet_length("text"), F.lit(0))).cast("long").alias("size")))
    picked = []
    for v in (0, 1):
        total = 0
        fitting = sizes.where((F.col("y") == v) & (F.col("size") <= SAMPLE_BYTES))
        for key, size in fitting.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).select("doc_id", "size").collect():
            if total + size <= SAMPLE_BYTES:
                total += size
                picked.append((key, v))
    wanted = spark.createDataFrame(picked, f"doc_id {labels.schema['doc_id'].dataType.simpleString()}, y int")
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(wanted), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))  # an id counts once
    got = sorted((r.doc_id, r.y, r.text.encode()) for r in found.collect())  # 2 x SAMPLE texts, 2 x SAMPLE_BYTES at most
    return Network().fit([r[2] for r in got], np.array([r[1] for r in got], np.float32))


def classify(docs: DataFrame, network: Network, columns: list[str], threshold: float = 0.3, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """`columns` of every row with the probability of label 1 and whether it reaches the threshold, under `names`; null and empty texts get the score of an empty text."""
    shared = docs.sparkSession.sparkContext.broadcast(network)
    keep = docs.select(*columns, *["text"] * ("text" not in columns))
    from pyspark.sql import types as T

    schema = T.StructType([*(keep.schema[c] for c in columns), T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())])

    def run(batches):
        made = shared.value
        tables = made.tables()
        for batch in batches:
            parts, out = common.texts(batch), []
            for i, j in common.groups([len(p) for p in parts], 1 << 20):
                out.append(made.score(parts[i:j], tables))
            score = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(score.astype(np.float64)), pa.array((score >= threshold).astype(np.int32))], [*columns, *names])

    return keep.mapInArrow(common.lean(run), schema)


def op5(spark, sf_dir):
    """Quality score of every document by the network fitted on the labelled ones outside the held-out fifth.

    Null and empty texts share the score of an empty text; rows of equal or null doc_id have a row each, those of null id aren't held out. Equal texts have equal
    scores, a score at the threshold is predicted 1. An empty table gives no rows. Other columns are not read.
    """
    docs = common.table(spark, sf_dir, "documents")
    network = fit(docs, common.table(spark, sf_dir, "labels"))
    return classify(docs, network, ["doc_id"]).select("doc_id", common.held_out(5, 0).alias("held_out"), "score", "predicted")
