"""Substring dedup: seed and extend on winnowed anchors.

Seeds: of every WINDOW consecutive words, the SEED-word sequence with the least hash (the first of equals) is
the window's anchor (winnowing), so documents that share WINDOW words share an anchor there. Anchors are
counted across documents; only those of two documents or more go on, through a bit table that is
broadcast (a false positive costs work, never a result).

Extension: the occurrences of an anchor meet in one bucket, each with the words around it that its
windows cover. The match is extended from the anchor word by word to the left and to the right; occurrences that
agree on enough words on both sides hold the same window, which is then compared word by word (64 bits each).
A window that stands in a document of smaller id too is a repeat. Matches around neighbouring anchors overlap;
they merge into maximal repeats of WINDOW words or more, whose words go.

Hot anchors: within a slab of documents repeats are found at once, and only the smallest
document of each window is sent. The windows of an anchor that many slabs hold are dealt by their
own words instead of the anchor's, and a task sends such a window again only for a smaller
document. So a passage that stands in every document sends about one entry from each task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WINDOW, SEED = 13, 5
#: Bits of the table for each repeated anchor, and in all.
BITS, MOST_BITS = 8, 1 << 30
#: Entries of an anchor (two of each slab that holds it, at most) from which on its windows are dealt by themselves, and such windows that a task remembers.
HOT, REMEMBERED = 64, 1 << 16
_SLAB = 4 << 20


def anchors(h: np.ndarray, at: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, place of the window, words before the anchor in it, part) of every window that lies in one part."""
    n = len(h) - window + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    g = common.grams(h, seed)
    least, before = g[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, window - seed + 1):
        less = g[j : j + n] < least
        np.copyto(least, g[j : j + n], where=less)
        before[less] = j
    part = np.repeat(np.arange(len(at) - 1), np.diff(at))
    place = np.flatnonzero(part[:n] == part[window - 1 :])
    return least[place], place, before[place], part[place]


def _key(docs: DataFrame) -> DataFrame:
    """doc_id as long, text, and a key that rows of one id share only if their texts are equal."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("doc_id", "text").alias("key"))


def _slabs(batches, columns):
    for batch in batches:
        parts = common.texts(batch)
        for i, j in common.groups([len(p) for p in parts], _SLAB):
            yield parts[i:j], *(batch.column(c).slice(i, j - i) for c in columns)


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values with 0 for null, which aren't null)."""
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), np.array(column.is_valid().to_numpy(zero_copy_only=False))


def _rows(found, names):
    rows = list(found)
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), *(pa.array([c[k] for _, c in rows], pa.binary()) for k in names)], ["bucket", *names])


def _bits(x: np.ndarray, bits: int) -> np.ndarray:
    return (common.mix(x, 2) % np.uint64(bits)).astype(np.int64)


def _bucket(x: np.ndarray, buckets: int, salt: int = 1) -> np.ndarray:
    return (common.mix(x, salt) % np.uint64(buckets)).astype(np.int64)


def repeated_anchors(docs: DataFrame, window: int, seed: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bit tables, in `buckets` slices, of anchors that stand in two documents or more, and of hot ones."""

    def run(batches):
        for parts, ids in _slabs(batches, ["doc_id"]):
            _, _, _, h, at = common.word_table(parts)
            a, _, _, part = anchors(h, at, window, seed)
            doc, valid = _numbers(ids)
            a, doc = a[valid[part]], doc[part][valid[part]]
            new = common.first_of_runs(a, doc)  # neighbouring windows share anchors
            a, doc = a[new], doc[new]
            order = np.lexsort((doc, a))
            a, doc = a[order], doc[order]
            first = common.first_of_runs(a)
            last = np.r_[first[1:], True] if len(a) else first
            keep = first | last  # the smallest and the largest document of each anchor say whether there are two
            a, doc = a[keep], doc[keep]
            order = np.argsort(doc, kind="stable")  # runs of equal ids compress
            a, doc = a[order], doc[order]
            yield from _rows(common.blobs(_bucket(a, buckets), {"a": a, "doc": doc}), ("a", "doc"))

    def reduce(batches):
        got = common.gathered(batches, a=np.uint64, doc=np.int64)
        if not len(got["a"]):
            return
        order = np.lexsort((got["doc"], got["a"]))
        a, doc = got["a"][order], got["doc"][order]
        begins = np.flatnonzero(common.first_of_runs(a))
        ends = np.r_[begins[1:], len(a)]
        some = doc[begins] != doc[ends - 1]
        a, hot = a[begins[some]], (ends - begins)[some] >= HOT
        yield pa.RecordBatch.from_arrays([pa.array([int(_bucket(got["a"][:1], buckets)[0])], pa.int32()), pa.array([len(a)], pa.int64()), pa.array([a.tobytes()], pa.binary()), pa.array([a[hot].tobytes()], pa.binary())], ["bucket", "n", "a", "hot"])

    sent = docs.mapInArrow(common.lean(run), "bucket int, a binary, doc binary").repartitionById(buckets, F.col("bucket"))
    found = common.settled(sent.mapInArrow(common.lean(reduce), "bucket int, n long, a binary, hot binary"))
    bits = max(64, min(MOST_BITS, BITS * (found.agg(F.sum("n")).first()[0] or 0)) // buckets // 8 * 8)

    def tables(batches):
        for batch in batches:
            out = []
            for column in ("a", "hot"):
                for x in batch.column(column).to_pylist():
                    table = np.zeros(bits, bool)
                    table[_bits(np.frombuffer(x, np.uint64), bits)] = True
                    out.append(np.packbits(table).tobytes())
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column("bucket"), pa.array(out[:n], pa.binary()), pa.array(out[n:], pa.binary())], ["bucket", "a", "hot"])

    both = np.zeros((2, buckets, bits // 8), np.uint8)
    for r in found.mapInArrow(common.lean(tables), "bucket int, a binary, hot binary").collect():  # MOST_BITS of each at most
        for t, x in zip(both, (r["a"], r["hot"])):
            t[r["bucket"]] = np.frombuffer(bytes(x), np.uint8)
    return both[0], both[1]


def _is_set(table: np.ndarray, bucket: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return (table.reshape(-1)[bucket * table.shape[1] + (bit >> 3)] >> (7 - (bit & 7)).astype(np.uint8)) & 1 > 0


def extended(words: np.ndarray, start: np.ndarray, window: int) -> np.ndarray:
    """A hash of the `window` words from each start on, a word at a time."""
    acc = np.full(len(start), 977, np.uint64)
    for j in range(window):
        acc = acc * np.uint64(0xD6E8FEB86659FD93) + words[start + j]
    return common.mix(acc)


def same_as_first(words: np.ndarray, start: np.ndarray, window: int, doc: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which windows stand in a smaller document too, among windows of equal words; hashes bring them together, words decide."""
    again = np.zeros(len(start), bool)
    left = np.arange(len(start))
    while len(left):
        order = left[np.lexsort((doc[left], hashes[left]))]
        new = common.first_of_runs(hashes[order])
        first = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        equal = np.ones(len(order), bool)
        for j in range(window):
            equal &= words[start[order] + j] == words[start[first] + j]
        again[order] = equal & (doc[order] > doc[first])
        left = order[~equal]  # other words of the same hash meet each other
    return again


RUN = ("key", "doc", "first", "length")


def _runs(key: np.ndarray, doc: np.ndarray, place: np.ndarray, buckets: int):
    """Rows of runs of neighbouring places, dealt by key."""
    order = np.lexsort((place, doc, key))
    key, doc, place = key[order], doc[order], place[order]
    new = common.first_of_runs(key, doc)
    if len(key):
        new[1:] |= place[1:] > place[:-1] + 1
    begin = np.flatnonzero(new)
    length = (place[np.r_[begin[1:], len(key)] - 1] - place[begin] + 1).astype(np.int32) if len(key) else np.empty(0, np.int32)
    return common.blobs(key[begin] % buckets, dict(zip(RUN, (key[begin], doc[begin], place[begin].astype(np.int32), length))))


def repeats(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """(bucket, key, doc, first, length): runs of places, counted in words, of windows that also stand in a document of smaller id; a row of blobs for each bucket of keys."""
    spark = docs.sparkSession
    buckets = common.partitions(spark)
    shared = spark.sparkContext.broadcast(repeated_anchors(docs, window, seed, buckets))
    reach = window - seed
    entry = ("a", "doc", "key", "place", "mask", "words")
    kind = ", ".join(f"{c} binary" for c in (*entry, *(c for c in RUN if c not in entry)))

    def packed(rows):
        """Rows of entries or of runs, with the other's columns null."""
        rows = list(rows)
        if rows:
            names = [x.split()[0] for x in kind.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), *(pa.array([c.get(k) for _, c in rows], pa.binary()) for k in names)], ["bucket", *names])

    def run(batches):
        table, hots = shared.value
        remembered: dict[int, tuple[int, bytes]] = {}
        for parts, ids, keys in _slabs(batches, ["doc_id", "key"]):
            _, _, _, h, at = common.word_table(parts)
            a, place, before, part = anchors(h, at, window, seed)
            doc, valid = _numbers(ids)
            bucket, bit = _bucket(a, buckets), _bits(a, table.shape[1] * 8)
            some = _is_set(table, bucket, bit) & valid[part]
            a, place, before, part, bucket, bit = (x[some] for x in (a, place, before, part, bucket, bit))
            doc, key = doc[part], keys.to_numpy()[part].astype(np.int64)
            hashes = extended(h, place, window)
            known = same_as_first(h, place, window, doc, hashes)
            hot = np.flatnonzero(_is_set(hots, bucket, bit) & ~known)
            order = hot[np.lexsort((doc[hot], hashes[hot]))]
            for i in order[common.first_of_runs(hashes[order])].tolist():
                text, seen = h[place[i] : place[i] + window].tobytes(), remembered.get(int(hashes[i]))
                if seen is None:
                    if len(remembered) < REMEMBERED:
                        remembered[int(hashes[i])] = int(doc[i]), text
                elif seen[1] == text:
                    if seen[0] < doc[i]:
                        known[i] = True
                    else:
                        remembered[int(hashes[i])] = int(doc[i]), text
            yield from packed(_runs(key[known], doc[known], (place - at[part])[known], buckets))
            # what is left: an entry for each anchor's place with a bit for each of its windows, or for each window of a hot anchor
            is_hot = np.zeros(len(a), bool)
            is_hot[hot] = True
            own = ~known
            a, place, before, part, bucket, doc, key, hashes, is_hot = (x[own] for x in (a, place, before, part, bucket, doc, key, hashes, is_hot))
            if not len(a):
                continue
            centre = place + before
            new = common.first_of_runs(centre) | is_hot | np.r_[False, is_hot[:-1]]
            begin = np.flatnonzero(new)
            mask = np.bitwise_or.reduceat(1 << before, begin).astype(np.int32)
            bucket = np.where(is_hot, _bucket(hashes, buckets, 5), bucket)[begin]
            # the words from the first window's beginning to the last one's end
            n = place[np.r_[begin[1:], len(a)] - 1] - place[begin] + window
            yield from packed(entries(a[begin], doc[begin], key[begin], (centre - at[part])[begin], mask, h, place[begin], n, bucket))

    def entries(a, doc, key, centre, mask, h, start, n, bucket):
        order = np.argsort(bucket, kind="stable")
        words = h[np.repeat(start[order], n[order]) + _within(n[order])]
        end = np.cumsum(n[order])
        edge = np.flatnonzero(common.first_of_runs(bucket[order]))
        fixed = dict(zip(entry, (a, doc, key, centre.astype(np.int32), mask)))
        for k, (b, x) in enumerate(common.blobs(bucket, fixed)):
            lo = end[edge[k] - 1] if edge[k] else 0
            hi = end[edge[k + 1] - 1] if k + 1 < len(edge) else len(words)
            yield b, {**x, "words": words[lo:hi].tobytes()}

    def reduce(batches):
        parts: dict[str, list[bytes]] = {c: [] for c in entry}
        for batch in batches:
            runs = np.array(batch.column("a").is_null().to_numpy(zero_copy_only=False))
            if runs.any():  # known already
                yield batch.filter(pa.array(runs)).select(["bucket", *RUN])
            for c in entry:
                parts[c] += batch.column(c).filter(pa.array(~runs)).to_pylist()
        a, doc, key, centre, mask, words = (np.frombuffer(b"".join(parts.pop(c)), t) for c, t in zip(entry, (np.uint64, np.int64, np.int64, np.int32, np.int32, np.uint64)))
        if not len(a):
            return
        widest = np.floor(np.log2(mask)).astype(np.int64)  # the first window begins that many words before the anchor
        narrowest = np.floor(np.log2(mask & -mask)).astype(np.int64)
        start = np.cumsum(np.r_[0, (widest - narrowest + window)[:-1]])
        found = []
        for before in range(reach + 1):
            has = np.flatnonzero(mask >> before & 1)
            begin = start[has] + widest[has] - before
            again = has[same_as_first(words, begin, window, doc[has], common.mix(extended(words, begin, window) ^ a[has], 3))]
            found.append((key[again], doc[again], centre[again] - before))
        key, doc, place = (np.concatenate(x) for x in zip(*found))
        yield from _rows(_runs(key, doc, place, buckets), RUN)

    def merged(batches):
        """All runs of a bucket in one row, in order of their keys."""
        got = common.gathered(batches, **dict(zip(RUN, (np.int64, np.int64, np.int32, np.int32))))
        order = np.lexsort((got["first"], got["doc"], got["key"]))
        if len(order):
            yield from _rows([(int(got["key"][0] % buckets), {k: got[k][order].tobytes() for k in RUN})], RUN)

    sent = docs.mapInArrow(common.lean(run), f"bucket int, {kind}").repartitionById(buckets, F.col("bucket"))
    runs = "bucket int, " + ", ".join(f"{c} binary" for c in RUN)
    return sent.mapInArrow(common.lean(reduce), runs).repartitionById(buckets, F.col("bucket")).mapInArrow(common.lean(merged), runs)


def _within(n: np.ndarray) -> np.ndarray:
    """0, 1, ... n - 1 for each n."""
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


def without_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED, carry: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, n_repeats (maximal ones), kept (the words left, joined by single spaces; a text without removals also in that form); with `carry` also carried, all columns of docs as a struct.

    A word goes if a window that covers it also stands in a document of smaller doc_id. Null texts have no
    words. A row of null doc_id is compared with nothing. Rows of equal doc_id don't
    count as smaller to each other, whatever their texts. doc_id is taken as a long.
    """
    spark = docs.sparkSession
    buckets = common.partitions(spark)
    found = common.settled(repeats(_key(docs), window, seed))
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("key"), "text", *([F.struct(*docs.columns).alias("carried")] if carry else []))
    out = [*whole.columns[3:], "doc_id", "n_words", "n_removed", "n_repeats", "kept"]
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in whole.select(*whole.columns[3:]).schema) + ", " * carry + "doc_id long, n_words long, n_removed long, n_repeats long, kept string"

    def finished(batch, rows):
        cols = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in out[:-4]), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string())))], out)

    def untouched(batches):
        for batch in batches:
            words = [x.split() for x in common.texts(batch)]
            yield finished(batch, [(len(w), 0, 0, b" ".join(w).decode()) for w in words])

    def cut(batches):
        runs = {k: [] for k in RUN}
        table = None
        for batch in batches:
            kinds = np.array(batch.column("kind").to_pylist())
            n = int((kinds == 0).sum())
            for k in RUN:
                runs[k] += batch.column("run_" + k).slice(0, n).to_pylist()
            if n == batch.num_rows:
                continue
            if table is None:
                table = [np.frombuffer(b"".join(runs[k]), t) for k, t in zip(RUN, (np.int64, np.int64, np.int32, np.int32))]
                order = np.lexsort((table[1], table[0]))
                table, runs = [x[order] for x in table], {k: [] for k in RUN}
            batch = batch.slice(n)
            rows = []
            for text, key, doc in zip(common.texts(batch), batch.column("key").to_pylist(), batch.column("doc_id").to_pylist()):
                words = text.split()
                lo, hi = np.searchsorted(table[0], key, "left"), np.searchsorted(table[0], key, "right")
                mine = lo + np.flatnonzero(table[1][lo:hi] == doc) if doc is not None else ()
                if not len(mine):
                    rows.append((len(words), 0, 0, b" ".join(words).decode()))
                    continue
                change = np.zeros(len(words) + 1, np.int64)
                np.add.at(change, table[2][mine], 1)
                np.add.at(change, table[2][mine] + table[3][mine] + window - 1, -1)
                gone = np.cumsum(change[:-1]) > 0
                rows.append((len(words), int(gone.sum()), int((np.diff(np.r_[False, gone].astype(np.int8)) == 1).sum()), b" ".join([x for x, g in zip(words, gone.tolist()) if not g]).decode()))
            yield finished(batch, rows)

    def keys(batches):
        for batch in batches:
            for x in batch.column("key").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.frombuffer(x, np.int64)))], ["key"])

    # texts without a repeat need no shuffle, as long as the keys of those with one can be broadcast
    touched = common.settled(found.mapInArrow(common.lean(keys), "key long"))  # a key is in one row
    small = touched.count() * 48 <= common.BROADCAST_BYTES
    some = whole.join(F.broadcast(touched), "key", "left_semi") if small else whole
    rows = some.select(F.pmod("key", F.lit(buckets)).cast("int").alias("bucket"), F.lit(1).alias("kind"), *whole.columns, *(F.lit(None).cast("binary").alias("run_" + k) for k in RUN))
    places = found.select("bucket", F.lit(0).alias("kind"), *(F.lit(None).cast(f.dataType).alias(f.name) for f in whole.schema), *(F.col(k).alias("run_" + k) for k in RUN))
    rows = rows.unionByName(places).repartitionById(buckets, F.col("bucket")).sortWithinPartitions("kind")  # the places first, then the texts one batch after the other
    done = rows.mapInArrow(common.lean(cut), kind)
    if small:
        done = done.unionByName(whole.join(F.broadcast(touched), "key", "left_anti").mapInArrow(common.lean(untouched), kind))
    return done


def op6(spark, sf_dir):
    """Words of every document that repeat a passage of a document of smaller id, and a digest of the others.

    Null and empty texts have no words. Rows of equal doc_id have a row each and aren't smaller than each other; rows of
    null doc_id are compared with nothing. Ties: of equal windows those of the smallest doc_id stay. An empty table gives
    no rows. Other columns are not read.
    """
    got = without_repeats(common.table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), "n_repeats")
