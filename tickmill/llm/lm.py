"""Masked pseudo-likelihood scoring by a bidirectional window network in numpy.

Every word is predicted from the SIDE words on either side of it. The OWN most frequent words
have slots of their own; the others share slots by their last ENDING bytes. The probability of a
word is that of its slot's class, times that of the slot within the class (both exact softmaxes
of the network, so the conditionals are normalised), times the word's share of its slot: all of it for a word
with a slot of its own, else (count + 1) of the slot's count + words + 1, where one stands for
the words that were never seen. Counts are of all words of the corpus, in a distributed
table that grows with it.

The network starts as the corpus' slot frequencies, so that training can only add what contexts
tell. Documents are dealt by a hash of id and text to pieces of about PIECE words; a piece is learned from the
round's common weights by Adam steps over all of its words, and the pieces' weights are averaged. Every
word of the corpus is predicted in one of ROUNDS rounds. Pieces depend on the rows alone, so the
model doesn't depend on how the input is partitioned.

Words with at least one in FREQUENT of all occurrences (so at most FREQUENT words) are
broadcast with their counts; the occurrences of others go to the counts' buckets
and come back as one sum for each document and bucket.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

CLASSES, MEMBERS, HIDDEN, SIDE = 24, 24, 12, 2
SLOTS = CLASSES * MEMBERS
#: Slots of single words; the rest are shared by the words that end alike.
OWN, ENDING = 384, 3
#: Rounds of averaging, words of a piece, and of a step (fewer in a small corpus, so that a round has about 200 steps).
ROUNDS, PIECE, STEP = 4, 1 << 20, 8192
RATE, SLICES = 0.05, 16
_PAD = SLOTS  # stands beyond either end of a text
FREQUENT = 1 << 16
#: Distinct words that a task holds before it sends their counts, and words in a row of the table.
HELD, ROW = 1 << 20, 1 << 17


# --- counts of the corpus ---


class Counts(NamedTuple):
    """Counts of the words of a corpus; the table (bucket, words, counts) stays distributed."""

    table: DataFrame
    buckets: int
    total: int
    words: np.ndarray  # the frequent words' hashes, ascending
    counts: np.ndarray
    slots: np.ndarray  # their slots
    log_total: np.ndarray  # of each shared slot: log(occurrences + distinct words + 1); 0 for slots of single words
    found: np.ndarray  # occurrences of each slot


def hashed(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, shared slot of its ending, first word of each part and the total)."""
    buf, starts, ends, h, at = common.word_table(parts)
    ending = np.zeros(len(h), np.uint32)
    for k in range(1, ENDING + 1):
        ending = ending * np.uint32(257) + np.where(ends - k >= starts, buf[ends - k], 0)
    return h, (OWN + (ending * np.uint32(2654435761) >> np.uint32(8)) % np.uint32(SLOTS - OWN)).astype(np.uint16), at


def _summed(words: list[np.ndarray], counts: list[np.ndarray], shared: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, ascending, their summed counts and their shared slots."""
    w, c, s = np.concatenate([*words, np.empty(0, np.uint64)]), np.concatenate([*counts, np.empty(0, np.int64)]), np.concatenate([*shared, np.empty(0, np.uint16)])
    order = np.argsort(w, kind="stable")
    w = w[order]
    first = np.flatnonzero(common.first_of_runs(w))
    return w[first], np.add.reduceat(c[order], first) if len(first) else c, s[order][first]


_WORDS = ["words", "counts", "shared"]
_TABLE = "bucket int, words binary, counts binary, shared binary"


def _entries(rows) -> pa.RecordBatch:
    rows = list(rows)
    return pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), *(pa.array([x[k] for _, x in rows], pa.binary()) for k in _WORDS)], ["bucket", *_WORDS])


def _read(batch) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    return [(np.frombuffer(w, np.uint64), np.frombuffer(c, np.int64), np.frombuffer(s, np.uint16)) for w, c, s in zip(*(batch.column(k).to_pylist() for k in _WORDS))]


def word_counts(docs: DataFrame) -> Counts:
    """Counts of every word of all documents. Null and empty texts have none."""
    spark = docs.sparkSession
    n = common.partitions(spark)

    def tally(batches):
        held = [], [], []

        def sent(w, c, s):
            return _entries(common.blobs((w % np.uint64(n)).astype(np.int64), dict(zip(_WORDS, (w, c, s)))))

        for batch in batches:
            parts = common.texts(batch)
            for i, j in common.groups([len(p) for p in parts], 1 << 20):
                h, shared, _ = hashed(parts[i:j])
                w, at, c = np.unique(h, return_index=True, return_counts=True)
                for x, new in zip(held, (w, c.astype(np.int64), shared[at])):
                    x.append(new)
                if sum(map(len, held[0])) > 2 * HELD:
                    held = tuple([x] for x in _summed(*held))
                    if len(held[0][0]) > HELD:
                        yield sent(*(x[0] for x in held))
                        held = [], [], []
        if held[0]:
            yield sent(*_summed(*held))

    def total(batches):
        got = common.gathered(batches, words=np.uint64, counts=np.int64, shared=np.uint16)
        w, c, s = _summed([got["words"]], [got["counts"]], [got["shared"]])
        for i in range(0, len(w), ROW):
            yield _entries([(int(w[i] % np.uint64(n)), {k: x[i : i + ROW].tobytes() for k, x in zip(_WORDS, (w, c, s))})])

    table = common.settled(docs.select("text").mapInArrow(tally, _TABLE).repartitionById(n, F.col("bucket")).mapInArrow(total, _TABLE))

    def slots(batches):
        found, distinct = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
        for batch in batches:
            for _, c, s in _read(batch):
                found += np.bincount(s, c, SLOTS).astype(np.int64)
                distinct += np.bincount(s, minlength=SLOTS)
        some = np.flatnonzero(distinct)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(found[some]), pa.array(distinct[some])], ["slot", "found", "words"])

    found, distinct = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
    for r in table.mapInArrow(slots, "slot long, found long, words long").groupBy("slot").agg(F.sum("found").alias("found"), F.sum("words").alias("words")).collect():  # SLOTS rows
        found[r.slot], distinct[r.slot] = r.found, r.words
    whole = int(found.sum())

    def frequent(batches):
        for batch in batches:
            for w, c, s in _read(batch):
                often = c >= max(1, -(-whole // FREQUENT))
                yield _entries([(0, dict(zip(_WORDS, (x[often].tobytes() for x in (w, c, s)))))])

    rows = table.mapInArrow(frequent, _TABLE).select(*_WORDS).collect()  # at most FREQUENT words
    words, counts, shared = _summed(*([np.frombuffer(bytes(r[k]), t) for r in rows] for k, t in zip(_WORDS, (np.uint64, np.int64, np.uint16))))
    own = np.lexsort((words, -counts))[:OWN]
    at = shared.copy()
    at[own] = np.arange(len(own))
    np.subtract.at(found, shared[own], counts[own])
    np.subtract.at(distinct, shared[own], 1)
    found[: len(own)] = counts[own]
    log_total = np.where(np.arange(SLOTS) < OWN, 0.0, np.log(found + distinct + 1.0))
    return Counts(table, n, whole, words, counts, at, log_total, found)


def log_counts(words: np.ndarray, counts: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """log(count + 1) of each word asked for, 0 for words that aren't among the (ascending) words."""
    if not len(words):
        return np.zeros(len(asked))
    at = np.minimum(np.searchsorted(words, asked), len(words) - 1)
    return np.where(words[at] == asked, np.log(counts[at] + 1.0), 0.0)


# --- the network ---


class Weights:
    """Input rows of each place of the window, hidden bias, classes, members of each class; the last hidden unit is always 1."""

    SHAPES = ((2 * SIDE, SLOTS + 1, HIDDEN), (HIDDEN,), (HIDDEN + 1, CLASSES), (CLASSES, HIDDEN + 1, MEMBERS))

    def __init__(self, flat: np.ndarray):
        self.flat = flat.astype(np.float32)
        at = np.cumsum([0, *(int(np.prod(s)) for s in self.SHAPES)])
        self.enter, self.bias, self.wc, self.wm = (self.flat[a:b].reshape(s) for a, b, s in zip(at, at[1:], self.SHAPES))

    @classmethod
    def size(cls) -> int:
        return sum(int(np.prod(s)) for s in cls.SHAPES)

    @classmethod
    def initial(cls, found: np.ndarray) -> Weights:
        """The slots' frequencies, whatever the context; half an occurrence is added to each."""
        w = cls(np.zeros(cls.size()))
        w.enter[:] = np.random.default_rng(5).normal(0, 0.3, w.enter.shape)
        by = found.reshape(MEMBERS, CLASSES).T + 0.5
        w.wc[-1] = np.log(by.sum(1) / by.sum())
        w.wm[:, -1] = np.log(by / by.sum(1, keepdims=True))
        return w


def _parts_of(slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class, member): neighbouring slots are of different classes, so that classes weigh alike."""
    return slot % CLASSES, slot // CLASSES


def context(slots: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    return [slots[place + d] for d in (*range(-SIDE, 0), *range(1, SIDE + 1))]


def hidden(w: Weights, ctx: list[np.ndarray]) -> np.ndarray:
    a = w.enter[0][ctx[0]]
    for rows, x in zip(w.enter[1:], ctx[1:]):
        a += rows[x]
    a += w.bias
    out = np.ones((len(a), HIDDEN + 1), np.float32)
    np.divide(a, 1 + np.abs(a), out=out[:, :-1])
    return out


def _by_class(c: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """(an order by class, (class, first, end) of each class that occurs)."""
    order = np.argsort(c.astype(np.uint8), kind="stable")
    cut = np.searchsorted(c[order], np.arange(CLASSES + 1)).tolist()
    return order, [(k, i, j) for k, (i, j) in enumerate(zip(cut, cut[1:])) if i < j]


def _outputs(w: Weights, h: np.ndarray, cut: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Exponents of the classes, and of the members of each row's class."""
    y = np.empty((len(h), MEMBERS), np.float32)
    for k, i, j in cut:
        np.matmul(h[i:j], w.wm[k], out=y[i:j])
    return h @ w.wc, y


def log_probs(w: Weights, ctx: list[np.ndarray], target: np.ndarray) -> np.ndarray:
    """Log-probability of each target slot given its context."""
    c, m = _parts_of(target)
    order, cut = _by_class(c)
    z, y = _outputs(w, hidden(w, [x[order] for x in ctx]), cut)
    at = np.arange(len(c))
    top = z[at, c[order]] + y[at, m[order]]
    out = np.empty(len(c), np.float32)
    out[order] = top - np.log((np.exp(z, out=z) @ np.ones(CLASSES, np.float32)) * (np.exp(y, out=y) @ np.ones(MEMBERS, np.float32)))
    return out


def gradient(w: Weights, ctx: list[np.ndarray], target: np.ndarray, places=range(2 * SIDE)) -> np.ndarray:
    """Gradient of the mean of -log_probs; of the input rows, only those of `places` of the window."""
    n = len(target)
    g = Weights(np.zeros(Weights.size(), np.float32))
    c, m = _parts_of(target)
    order, cut = _by_class(c)
    ctx = [x[order] for x in ctx]
    h = hidden(w, ctx)
    p, q = _outputs(w, h, cut)
    for x, of in ((p, c[order]), (q, m[order])):
        np.exp(x, out=x)
        x *= (1 / n / (x @ np.ones(x.shape[1], np.float32)))[:, None]
        x[np.arange(n), of] -= 1 / n
    np.matmul(h.T, p, out=g.wc)
    dh = p @ w.wc.T
    for k, i, j in cut:
        np.matmul(h[i:j].T, q[i:j], out=g.wm[k])
        dh[i:j] += q[i:j] @ w.wm[k].T
    back = np.ascontiguousarray((dh[:, :-1] * (1 - np.abs(h[:, :-1])) ** 2).T)  # of a / (1 + |a|)
    g.bias[:] = back.sum(1)
    back = back.astype(np.float64)
    for j in places:
        for d in range(HIDDEN):
            g.enter[j, :, d] = np.bincount(ctx[j], back[d], SLOTS + 1)
    return g.flat


def learn(w: Weights, slots: np.ndarray, place: np.ndarray, step: int, rate: float) -> None:
    """Adam steps over all places, `step` of them at a time; changes w. The places of the window take turns in learning their input rows."""
    m, v = np.zeros(w.size(), np.float32), np.zeros(w.size(), np.float32)
    one, rest = w.enter[0].size, w.enter.size
    for t, i in enumerate(range(0, len(place), step)):
        at = place[i : i + step]
        turn, own = t % (2 * SIDE), t // (2 * SIDE) + 1
        g = gradient(w, context(slots, at), slots[at], (turn,))
        for part, age in ((slice(turn * one, (turn + 1) * one), own), (slice(rest, None), t + 1)):
            x, a, b = g[part], m[part], v[part]
            a += 0.1 * (x - a)
            b += 0.01 * (x * x - b)
            w.flat[part] -= rate / np.sqrt(1 + t / 50) * (a / (1 - 0.9**age)) / (np.sqrt(b / (1 - 0.99**age)) + 1e-6)
        for x in (w.wc[:-1], w.wm[:, :-1]):  # so that exponentials of the outputs stay finite
            np.clip(x, -4, 4, out=x)


# --- documents as slots ---


def padded(slots: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slots of texts of n words with SIDE pads before and after each, places of the words)."""
    place = np.arange(len(slots)) + np.repeat(2 * SIDE * np.arange(len(n)) + SIDE, n)
    out = np.full(len(slots) + 2 * SIDE * len(n), _PAD, np.int64)
    out[place] = slots
    return out, place


def _packed(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as f:
        f.write_batch(batch)
    return out.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


def coded(docs: DataFrame, counts: Counts) -> DataFrame:
    """(part, piece, docs, n, slots, rare): documents as slots, a row for each piece, kept in the shared folder.

    docs holds doc_id and the known part of its log-likelihood as an Arrow stream; rare the hashes of the
    words that aren't frequent, with the number of each document's.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((counts.words, counts.counts, counts.slots, counts.log_total))
    pieces = ROUNDS * max(1, counts.total // (ROUNDS * PIECE))

    def code(batches):
        words, found, slot_of, log_total = shared.value
        for batch in batches:
            parts = common.texts(batch)
            n, known, out, rare = np.zeros(len(parts), np.int32), np.zeros(len(parts)), [], []
            for i, j in common.groups([len(p) for p in parts], 1 << 20):
                h, slot, at = hashed(parts[i:j])
                of = np.repeat(np.arange(i, j), np.diff(at))
                near = np.minimum(np.searchsorted(words, h), max(0, len(words) - 1))
                often = words[near] == h if len(words) else np.zeros(len(h), bool)
                slot[often] = slot_of[near[often]]
                lc = np.zeros(len(h))
                lc[often] = np.log(found[near[often]] + 1.0)
                lc[slot < OWN] = 0  # a slot of its own
                n[i:j] = np.diff(at)
                known += np.bincount(of, lc - log_total[slot], len(parts))
                out += [slot[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
                left = np.flatnonzero(~often)
                cut = np.searchsorted(of[left], np.arange(i, j + 1))
                rare += [h[left[a:b]].tobytes() for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("piece"), batch.column("key"), batch.column("doc_id"), pa.array(n), pa.array(known), pa.array(out, pa.binary()), pa.array(rare, pa.binary())], ["piece", "key", "doc_id", "n", "known", "slots", "rare"])

    def pack(batches):
        held, size = [], 0
        piece = None

        def row():
            if not held:
                return
            cols = list(zip(*held))
            ids = pa.RecordBatch.from_arrays([pa.array(cols[0], kind), pa.array(cols[2], pa.float64())], ["doc_id", "known"])
            yield pa.RecordBatch.from_arrays([pa.array([piece % ROUNDS], pa.int32()), pa.array([piece], pa.int64()), *(pa.array([x], pa.binary()) for x in (_packed(ids), np.array(cols[1], np.int32).tobytes(), b"".join(cols[3]), np.array([len(x) // 8 for x in cols[4]], np.int32).tobytes(), b"".join(cols[4])))], PIECES)

        for batch in batches:
            kind = batch.column("doc_id").type
            for p, *rest in zip(*(batch.column(c).to_pylist() for c in ("piece", "doc_id", "n", "known", "slots", "rare"))):
                # a piece that holds far more than PIECE words (one long text, many empty ones) goes on in another row
                if p != piece or size > 4 * PIECE:
                    yield from row()
                    held, size, piece = [], 0, p
                held.append(rest)
                size += rest[1] + 8
        yield from row()

    kind = docs.schema["doc_id"].dataType.simpleString()
    key = F.xxhash64("doc_id", "text")
    # texts without words are of no use to a piece, so they may go to any
    piece = F.pmod(F.when(F.coalesce(F.trim("text"), F.lit("")) == "", (F.rand(7) * (1 << 40)).cast("long")).otherwise(key), F.lit(pieces))
    rows = docs.select("doc_id", "text", key.alias("key"), piece.alias("piece")).mapInArrow(code, f"piece long, key long, doc_id {kind}, n int, known double, slots binary, rare binary")
    rows = rows.repartition(common.partitions(spark), "piece").sortWithinPartitions("piece", "key").mapInArrow(pack, "part int, piece long, docs binary, n binary, slots binary, rares binary, rare binary")
    folder = f"{common.shared_dir(spark)}/pieces-{uuid.uuid4().hex}"
    rows.write.partitionBy("part").parquet(folder)
    return spark.read.schema("piece long, docs binary, n binary, slots binary, rares binary, rare binary, part int").parquet(folder)


PIECES = ["part", "piece", "docs", "n", "slots", "rares", "rare"]


def train(pieces: DataFrame, counts: Counts, rounds: int = ROUNDS) -> np.ndarray:
    """Weights after `rounds` rounds; round r learns the pieces of part r, so that ROUNDS rounds predict every word once."""
    spark = pieces.sparkSession
    size, step = Weights.size(), max(256, min(STEP, counts.total // (200 * ROUNDS)))
    flat = Weights.initial(counts.found).flat
    cut = -(-size // SLICES)
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(flat)

        def run(batches, shared=shared, turn=turn):
            total, seen = np.zeros(size), 0
            for batch in batches:
                for n, slots in zip(batch.column("n").to_pylist(), batch.column("slots").to_pylist()):
                    slots, place = padded(np.frombuffer(slots, np.uint16), np.frombuffer(n, np.int32))
                    if len(place):
                        w = Weights(shared.value.copy())
                        learn(w, slots, place, step, RATE / (1 + turn))
                        total += len(place) * w.flat.astype(np.float64)
                        seen += len(place)
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([seen] * SLICES, pa.int64()), pa.array([total[k * cut : (k + 1) * cut].tobytes() for k in range(SLICES)], pa.binary())], ["slice", "seen", "part"])

        def mean(batches):
            """The average of each slice, weighted by words; one slice's parts stream through."""
            total, weight = {}, {}
            for batch in batches:
                for k, n, part in zip(*(batch.column(c).to_pylist() for c in ("slice", "seen", "part"))):
                    x = np.frombuffer(part)
                    total[k] = total[k] + x if k in total else x
                    weight[k] = weight.get(k, 0) + n
            for k in total:
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([(total[k] / weight[k]).astype(np.float32).tobytes()], pa.binary())], ["slice", "part"])

        sent = pieces.where(F.col("part") == turn % ROUNDS).select("n", "slots").mapInArrow(run, "slice int, seen long, part binary")
        got = sent.repartitionById(SLICES, F.col("slice")).mapInArrow(mean, "slice int, part binary").collect()  # one model
        shared.unpersist()
        if got:
            flat = np.concatenate([np.frombuffer(bytes(r["part"]), np.float32) for r in sorted(got, key=lambda r: r["slice"])])
    return flat


# --- scores ---

_FIELDS = ["bucket", "chunk", "base", "words", "counts"]
_KIND = "bucket int, chunk long, base binary, words binary, counts binary"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))], _FIELDS)


def score(pieces: DataFrame, flat: np.ndarray, counts: Counts, kind: str = "long") -> DataFrame:
    """doc_id, n_tokens, log_likelihood (summed conditional log-probabilities of the words), mean_log_prob of every document of the pieces.

    Texts without words, null ones among them, have 0 and null. Repeated rows have a
    row each. `kind` is the type of doc_id.
    """
    shared = pieces.sparkSession.sparkContext.broadcast(flat)
    buckets = counts.buckets

    def run(batches):
        w, chunk = Weights(shared.value.copy()), TaskContext.get().partitionId() << 32
        for batch in batches:
            for docs, n, slots, rares, rare in zip(*(batch.column(c).to_pylist() for c in ("docs", "n", "slots", "rares", "rare"))):
                docs, n = _unpacked(docs), np.frombuffer(n, np.int32)
                slots, place = padded(np.frombuffer(slots, np.uint16), n)
                of, total = np.repeat(np.arange(len(n)), n), np.array(docs.column("known"))
                for i in range(0, len(place), 16384):
                    at = place[i : i + 16384]
                    total += np.bincount(of[i : i + 16384], log_probs(w, context(slots, at), slots[at]), len(n))
                base = pa.RecordBatch.from_arrays([docs.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(total)], ["doc_id", "n_tokens", "log_likelihood"])
                rare, rows = np.frombuffer(rare, np.uint64), np.repeat(np.arange(len(n), dtype=np.uint32), np.frombuffer(rares, np.int32))
                out = [(chunk % buckets, chunk, _packed(base), None, None)]
                out += [(b, chunk, None, x["words"], x["counts"]) for b, x in common.blobs((rare % np.uint64(buckets)).astype(np.int64), {"words": rare, "counts": rows})]
                yield _batch(out)
                chunk += 1

    def answer(batches):
        """The sums of log(count + 1) of each chunk's documents over this bucket's words; unseen words have 0. Base rows pass."""
        words, found, asked = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], []
        for batch in batches:
            for _, chunk, base, w, c in zip(*(batch.column(x).to_pylist() for x in _FIELDS)):
                if base is not None:
                    yield _batch([(chunk % buckets, chunk, base, None, None)])
                elif chunk < 0:
                    words.append(np.frombuffer(w, np.uint64))
                    found.append(np.frombuffer(c, np.int64))
                else:
                    asked.append((chunk, w, c))
        words, found = np.concatenate(words), np.concatenate(found)  # of one bucket: rows that follow each other, or any order
        order = np.argsort(words, kind="stable")
        words, found = words[order], found[order]
        for chunk, w, c in asked:
            rows = np.frombuffer(c, np.uint32)  # ascending
            begin = np.flatnonzero(common.first_of_runs(rows))
            sums = np.add.reduceat(log_counts(words, found, np.frombuffer(w, np.uint64)), begin)
            yield _batch([(chunk % buckets, chunk, None, sums.astype(np.float32).tobytes(), rows[begin].tobytes())])

    def finish(batches):
        bases, sums = {}, {}
        for batch in batches:
            for _, chunk, base, w, c in zip(*(batch.column(x).to_pylist() for x in _FIELDS)):
                if base is not None:
                    bases[chunk] = base
                else:
                    sums.setdefault(chunk, []).append((w, c))
        for chunk, packed in bases.items():
            base = _unpacked(packed)
            total, n = np.array(base.column("log_likelihood")), np.array(base.column("n_tokens"))
            for w, c in sums.pop(chunk, []):
                total[np.frombuffer(c, np.uint32)] += np.frombuffer(w, np.float32)
            mean = pa.array(total / np.maximum(n, 1), pa.float64(), mask=n == 0)
            yield pa.RecordBatch.from_arrays([base.column("doc_id"), base.column("n_tokens"), pa.array(total), mean], ["doc_id", "n_tokens", "log_likelihood", "mean_log_prob"])

    sent = pieces.select(*PIECES[2:]).mapInArrow(run, _KIND)
    table = counts.table.select("bucket", F.lit(-1).cast("long").alias("chunk"), F.lit(None).cast("binary").alias("base"), "words", "counts")
    back = sent.unionByName(table).repartitionById(buckets, F.col("bucket")).mapInArrow(answer, _KIND)
    return back.repartitionById(buckets, F.col("bucket")).mapInArrow(finish, f"doc_id {kind}, n_tokens long, log_likelihood double, mean_log_prob double")


def op7(spark, sf_dir):
    """Pseudo-likelihood of every document under a model of all documents.

    Null and empty texts have no words: 0, and a null mean. Rows of equal or null doc_id have a row each.
    Equal texts have equal scores, so there are no ties to break. An empty table gives no rows. Other columns are not read.
    """
    docs = common.table(spark, sf_dir, "documents")
    counts = word_counts(docs)
    pieces = coded(docs, counts)
    return score(pieces, train(pieces, counts), counts, docs.schema["doc_id"].dataType.simpleString())
