"""What the operators share: scratch space, labels, words as hashes, blob shuffles."""

from __future__ import annotations

import ctypes
import tempfile

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most bytes that are broadcast, as rows take them in memory; beyond it the join shuffles.
BROADCAST_BYTES = 64 << 20


#: Bytes of an Arrow batch sent to Python: a worker holds a batch several times over.
BATCH_BYTES = 16 << 20


def bounded_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Arrow batches of at most `most` bytes from here on, unless the session asks for smaller ones."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).rstrip("b")
    if not now.isdigit() or int(now) > most:
        spark.conf.set(key, str(most))


#: What steps keep in a Python worker for their next tasks.
kept_in_worker: list[dict] = []


def trim() -> None:
    """Hands memory that this worker has freed back to the system."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):  # glibc's
        libc.malloc_trim(0)


def lean(run):
    """run, as an Arrow step that first drops what other steps have kept in this worker, and trims it at the end: Spark uses a worker again, for steps of all kinds."""

    def call(batches):
        for kept in kept_in_worker:
            kept.clear()
        trim()
        yield from run(batches)
        trim()

    return call


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """Buckets of a shuffle: the session's shuffle partitions, which the deployment sizes to its data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's; without one, a temporary folder, which only a local master may use."""
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not given:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: executors need a folder that they share with the driver")
        given = tempfile.mkdtemp(prefix="tickmill-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(given)
    return given.rstrip("/")


def settled(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared checkpoint folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def maybe_broadcast(df: DataFrame) -> DataFrame:
    """df with a broadcast hint if its rows, measured, take at most BROADCAST_BYTES, else df as it is; df should be settled, since measuring computes it."""
    wide = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if f.dataType.simpleString() in ("string", "binary")]
    row = F.lit(32 + 8 * len(df.columns)).cast("long")
    for w in wide:
        row = row + w
    return F.broadcast(df) if (df.agg(F.sum(row)).first()[0] or 0) <= BROADCAST_BYTES else df


def with_labels(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int) -> DataFrame:
    """(doc_id, text, y) of the labelled documents whose crc32 remainder isn't the held-out one.

    Null labels and ids are dropped; of repeated labels of one id the largest counts.
    """
    y = (
        labels.select("doc_id", F.col(label).cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % modulus != held))
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
    )
    return docs.select("doc_id", "text").join(maybe_broadcast(settled(y)), "doc_id")


def bounded_sample(labelled: DataFrame, rows: int, most: int) -> DataFrame:
    """The rows of labelled (doc_id, text, ...) of at most `rows` documents and `most` bytes of text together, those of smallest id hash. Texts are whole; a document that would exceed the bytes is passed over, and the next one taken."""
    sizes = labelled.groupBy("doc_id").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(1)).alias("size")).where(F.col("size") <= most)
    picked, total = [], 0
    for key, size in sizes.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect():
        if total + size <= most:
            total += size
            picked.append((key,))
    return labelled.join(F.broadcast(labelled.sparkSession.createDataFrame(picked, f"doc_id {labelled.schema['doc_id'].dataType.simpleString()}")), "doc_id")


def held_out(modulus: int, held: int) -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == held, F.lit(False))


# --- texts of Arrow batches ---


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def groups(sizes: list[int], most: int = 4 << 20):
    """Ranges (i, j) of consecutive items of at most `most` bytes together; a larger item stands alone."""
    i, total = 0, 0
    for j, n in enumerate(sizes):
        if j > i and total + n > most:
            yield i, j
            i, total = j, 0
        total += n
    if i < len(sizes):
        yield i, len(sizes)


# --- words as 64-bit hashes ---

_M64 = (1 << 64) - 1
_P = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = []
_WHITE = np.zeros(256, bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^i and P^-i modulo 2^64 for i < n at least."""
    if not _powers or len(_powers[0]) < n:
        size = 1 << max(10, (n - 1).bit_length())
        _powers[:] = []
        for base in (_P, pow(_P, -1, 1 << 64)):
            t = np.full(size, base, np.uint64)
            t[0] = 1
            _powers.append(np.cumprod(t, dtype=np.uint64))
    return _powers[0], _powers[1]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ np.uint64(salt * 0x9E3779B97F4A7C15 & _M64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words [^\\x20\\x09-\\x0D]+ of a byte array."""
    w = np.empty(len(buf) + 2, bool)
    w[0] = w[-1] = False
    np.logical_not(_WHITE[buf], out=w[1:-1])
    edge = np.flatnonzero(w[1:] != w[:-1])
    return edge[0::2], edge[1::2]


#: Words of more bytes are hashed one by one, by xxh3.
_SHORT = 64


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, longest: int | None = None) -> np.ndarray:
    """64-bit hashes of the spans, or of their first `longest` bytes.

    Eight bytes at a time go through a bijective scramble that begins with the length, all words side by side: words of at most eight
    bytes never share a hash, and there is no structure for longer ones to collide by, as sums of powers of a base have.
    """
    n = ends - starts if longest is None else np.minimum(ends - starts, longest)
    out = mix(n.astype(np.uint64), 1)
    eights = np.ndarray(len(buf) + 1, "<u8", np.concatenate([buf, np.zeros(8, np.uint8)]), 0, (1,))  # the eight bytes from every byte on
    here = np.flatnonzero((n > 0) & (n <= _SHORT))
    for at in range(0, _SHORT, 8):
        here = here[n[here] > at]
        if not len(here):
            break
        left = n[here] - at
        part = eights[starts[here] + at] & np.where(left >= 8, np.uint64(_M64), (np.uint64(1) << (8 * np.minimum(left, 7)).astype(np.uint64)) - np.uint64(1))
        out[here] = mix(out[here] ^ part, 2)
    long = np.flatnonzero(n > _SHORT)
    if len(long):
        whole = memoryview(buf)
        out[long] = [xxhash.xxh3_64_intdigest(whole[i:j]) for i, j in zip(starts[long].tolist(), (starts + n)[long].tolist())]
    return out


def word_table(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, word starts, word ends, word hashes, first word of each part and the total) of parts joined by line feeds."""
    buf = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    starts, ends = spans(buf)
    at = np.cumsum([0, *(len(p) + 1 for p in parts)])
    return buf, starts, ends, hash_spans(buf, starts, ends), np.searchsorted(starts, at)


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every k consecutive values."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = np.full(n, k, np.uint64)
    for j in range(k):
        acc = acc * np.uint64(0xD6E8FEB86659FD93) + h[j : j + n]
    return mix(acc)


# --- blob shuffles: entries of 64-bit arrays travel as one binary row for each bucket and batch ---


def blobs(bucket: np.ndarray, columns: dict[str, np.ndarray]):
    """(bucket, {name: bytes}) for each bucket that has entries, in bucket order; entries keep their order."""
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    cut = np.flatnonzero(np.r_[True, b[1:] != b[:-1]]) if len(b) else np.empty(0, int)
    sorted_ = {k: v[order] for k, v in columns.items()}
    for i, j in zip(cut, np.r_[cut[1:], len(b)]):
        yield int(b[i]), {k: v[i:j].tobytes() for k, v in sorted_.items()}


def gathered(batches, **kinds) -> dict[str, np.ndarray]:
    """The entries of all blob rows of a partition."""
    parts: dict[str, list[bytes]] = {k: [] for k in kinds}
    for batch in batches:
        for k in kinds:
            parts[k] += batch.column(k).to_pylist()
    return {k: np.frombuffer(b"".join(parts[k]), kind) for k, kind in kinds.items()}


def first_of_runs(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal (keys) begins, in sorted arrays."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    if n:
        new[0] = True
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return new
