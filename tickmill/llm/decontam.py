"""Benchmark decontamination by greedy string tiling.

Words are runs of bytes without white space, ASCII letters lower-cased and ASCII punctuation dropped. Documents
and benchmark items are joined on shared SEED-word sequences. For each pair, greedy string
tiling marks the longest common word sequences that overlap no earlier tile, found by
Karp-Rabin hashes at falling lengths, until none of SEED words is left. An item whose tiles cover at
least `coverage` of its words is in the document, in whatever order its passages stand.

The benchmark is taken in blocks of a fixed size, each broadcast and held against all
documents, so it may be of any size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SEED, COVERAGE = 5, 0.6
#: Fewest words of an item, and the most items that may hold a seed before it counts as a template's.
LEAST, TEMPLATE = 3, 20
#: Bytes of benchmark text that are broadcast at once.
BLOCK = 16 << 20
_BITS = 22
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 if c in (9, 10, 11, 12, 13, 32) else 32 for c in range(256))


def words(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, first word of each part and the total)."""
    _, _, _, h, at = common.word_table([p.translate(_WORDS) for p in parts])
    return h, at


def _window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes (modulo 2^64) of all windows, by prefix sums."""
    power, inverse = common.powers(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * power[: len(words)], out=sums[1:])
    n = len(words) - length + 1
    return (sums[length:] - sums[:n]) * inverse[:n]


def _unmarked(free: np.ndarray, length: int) -> np.ndarray:
    """Where windows of unmarked words begin."""
    marked = np.r_[0, np.cumsum(~free)]
    return np.flatnonzero(marked[length:] == marked[:-length])


def tiles(item, runs: list[tuple[int, object]], least: int) -> list[tuple[int, int, int]]:
    """(start in the item, start in the document, length) of the tiles of an item and the runs (start, words) of a document.

    Longest first; of equal lengths the one that begins first in the item, then in the
    document. Runs are stretches of the document that can hold tiles. The longest length that still has a
    common unmarked window is searched by halving, since every part of a common window is common; all
    its tiles are marked, and the search goes on below it.
    """
    item = np.asarray(item, np.uint64)
    doc = np.concatenate([np.empty(0, np.uint64), *(np.r_[np.asarray(r, np.uint64), np.uint64(0)] for _, r in runs)])
    place = np.concatenate([np.empty(0, np.int64), *(np.r_[at + np.arange(len(r)), -1] for at, r in runs)])
    free, open_ = np.ones(len(item), bool), place >= 0  # a barrier stands after each run

    def common_windows(length: int):
        """(hash, start) of unmarked windows, of those of the item that the document may hold, and of the document's."""
        i, j = _unmarked(free, length), _unmarked(open_, length)
        hi, hj = _window_hashes(item, length)[i], _window_hashes(doc, length)[j]
        some = np.isin(hi, hj)
        return hi[some], i[some], hj, j

    found = []
    low, high = least, min(len(item), max((len(r) for _, r in runs), default=0))
    while low <= high:
        length, above = low - 1, high
        while length < above:  # the longest common length in low .. high, low - 1 if there is none
            mid = (length + above + 1) // 2
            if len(common_windows(mid)[0]):
                length = mid
            else:
                above = mid - 1
        if length < low:
            break
        hi, i, hj, j = common_windows(length)
        order = np.argsort(hj, kind="stable")
        hj, j = hj[order], j[order]
        pointer = dict(zip(hi.tolist(), np.searchsorted(hj, hi).tolist()))
        for h, a in zip(hi.tolist(), i.tolist()):
            if not free[a : a + length].all():
                continue
            p = pointer[h]
            while p < len(hj) and hj[p] == h and not (open_[j[p] : j[p] + length].all() and (doc[j[p] : j[p] + length] == item[a : a + length]).all()):
                p += 1
            pointer[h] = p
            if p < len(hj) and hj[p] == h:
                b = int(j[p])
                free[a : a + length] = open_[b : b + length] = False
                found.append((a, int(place[b]), length))
        high = length - 1
    return found


class Items:
    """A block of the benchmark: words of its items, which of them count, and where each seed occurs. rows: (item, text, where its template seeds begin)."""

    def __init__(self, rows: list[tuple[object, bytes, list[int]]], seed: int = SEED):
        h, at = words([t for _, t, _ in rows])
        self.ids = [i for i, _, _ in rows]
        self.words = [h[a:b] for a, b in zip(at[:-1], at[1:])]
        self.least = [min(seed, len(w)) for w in self.words]
        self.counts = []
        rare = []
        for w, n, (_, _, marks) in zip(self.words, self.least, rows):
            own, seeds = np.ones(len(w), bool), np.ones(max(0, len(w) - n + 1), bool)
            for m in marks or ():
                own[m : m + n] = False
                seeds[m] = False
            if not own.any():  # nothing but template: judged by all its words
                own[:], seeds[:] = True, True
            self.counts.append(own)
            rare.append(seeds)
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for k in sorted({n for n in self.least if n}):
            of, hashes = [], []
            for i, (w, n) in enumerate(zip(self.words, self.least)):
                if n == k:
                    g = common.grams(w, k)[rare[i]]
                    hashes.append(g)
                    of.append(np.full(len(g), i))
            g, o = np.concatenate(hashes), np.concatenate(of)
            order = np.argsort(g, kind="stable")
            bits = np.zeros(1 << _BITS, bool)
            bits[(g >> np.uint64(64 - _BITS)).astype(np.int64)] = True
            self.seeds[k] = (g[order], o[order], bits)

    def hits(self, h: np.ndarray, k: int) -> np.ndarray:
        """Where in the words a seed of k words begins."""
        g = common.grams(h, k)
        if not len(self.seeds[k][0]):
            return np.empty(0, np.int64)
        some = np.flatnonzero(self.seeds[k][2][(g >> np.uint64(64 - _BITS)).astype(np.int64)])
        sorted_ = self.seeds[k][0]
        at = np.minimum(np.searchsorted(sorted_, g[some]), len(sorted_) - 1)
        return some[sorted_[at] == g[some]]

    def contained(self, h: np.ndarray, hits: dict[int, np.ndarray], coverage: float):
        """(item, matched words, words that count, tiles, longest tile) of the items whose tiles cover enough of them."""
        for k, at in hits.items():
            if not len(at):
                continue
            sorted_, of, _ = self.seeds[k]
            g = np.array([common.grams(h[i : i + k], k)[0] for i in at.tolist()], np.uint64)
            lo, hi = np.searchsorted(sorted_, g, "left"), np.searchsorted(sorted_, g, "right")
            pair: dict[int, list[int]] = {}
            for p, a, b in zip(at.tolist(), lo, hi):
                for i in set(of[a:b].tolist()):
                    pair.setdefault(i, []).append(p)
            for i, places in pair.items():
                item = self.words[i]
                runs, begin, end = [], places[0], places[0] + k
                for p in places[1:]:
                    if p > end:
                        runs.append((begin, end))
                        begin = p
                    end = p + k
                runs.append((begin, end))
                own = self.counts[i]
                size = int(own.sum())
                if sum(b - a for a, b in runs) < coverage * size:
                    continue  # even whole runs could not cover enough
                got = tiles(item, [(a, h[a:b]) for a, b in runs], k)
                matched = sum(int(own[a : a + n].sum()) for a, _, n in got)
                if got and matched >= coverage * size:
                    yield i, matched, size, len(got), max(n for _, _, n in got)


def _marked(benchmark: DataFrame, seed: int, least: int) -> DataFrame:
    """(item_id, t, marks): the distinct items of enough words, and where their template seeds begin. Seeds are counted by a shuffle of their hashes."""
    rows = benchmark.select("item_id", F.coalesce("text", F.lit("")).cast("binary").alias("t")).where(F.col("item_id").isNotNull()).distinct()

    def run(batches):
        for batch in batches:
            texts = batch.column("t").to_pylist()
            h, at = words(texts)
            n = np.diff(at)
            for i, t in enumerate(texts):
                g = common.grams(h[at[i] : at[i + 1]], seed).view(np.int64) if n[i] >= least else np.empty(0, np.int64)
                if n[i] >= least:
                    one = batch.slice(i, 1)
                    take = pa.array(np.zeros(max(1, len(g)), np.int64))
                    yield pa.RecordBatch.from_arrays([one.column("item_id").take(take), one.column("t").take(take), pa.array(np.arange(len(take), dtype=np.int32)), pa.array(g if len(g) else [None], pa.int64())], ["item_id", "t", "at", "seed"])

    kind = benchmark.schema["item_id"].dataType.simpleString()
    seeds = common.settled(rows.mapInArrow(common.lean(run), f"item_id {kind}, t binary, at int, seed long").select("item_id", F.xxhash64("t").alias("text"), "t", "at", "seed"))
    frequent = seeds.where("seed is not null").groupBy("seed").agg(F.count_distinct("text").alias("n")).where(F.col("n") > TEMPLATE).select("seed", F.lit(True).alias("template"))
    return seeds.join(frequent, "seed", "left").groupBy("item_id", "t").agg(F.sort_array(F.collect_list(F.when(F.col("template"), F.col("at")))).alias("marks"))


def _blocks(benchmark: DataFrame, seed: int = SEED, least: int = LEAST):
    """Lists of (item_id, text, marks) of at most BLOCK bytes; null or short items match nothing."""
    block, held = [], 0
    for r in _marked(benchmark, seed, least).orderBy("item_id", "t").toLocalIterator():
        if block and held + len(r["t"]) > BLOCK:
            yield block
            block, held = [], 0
        block.append((r["item_id"], bytes(r["t"]), r["marks"]))
        held += len(r["t"])
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, seed: int = SEED, least: int = LEAST) -> DataFrame:
    """doc_id, item_id, coverage, matched_words, item_words, n_tiles, longest_tile of each pair whose tiles cover enough of the item.

    Null and empty texts hold nothing, items of fewer than `least` words are in nothing. Words of templates count neither as matched nor as the
    item's, unless it has no others. Repeated rows of docs give repeated results; equal benchmark rows count once.
    """
    spark = docs.sparkSession
    kind, item_kind = (d.schema[c].dataType.simpleString() for d, c in ((docs, "doc_id"), (benchmark, "item_id")))
    schema = f"doc_id {kind}, item_id {item_kind}, coverage double, matched_words int, item_words int, n_tiles int, longest_tile int"
    out = None
    for block in _blocks(benchmark, seed, least):
        shared = spark.sparkContext.broadcast(Items(block, seed))

        def run(batches, shared=shared):
            items = shared.value
            for batch in batches:
                parts, ids, rows = common.texts(batch), batch.column("doc_id"), []
                for i, j in common.groups([len(p) for p in parts], 1 << 21):
                    h, at = words(parts[i:j])
                    hits = {k: items.hits(h, k) for k in items.seeds}
                    some = np.unique(np.concatenate([np.searchsorted(at, x, "right") - 1 for x in hits.values()])) if hits else []
                    for d in some:
                        a, b = int(at[d]), int(at[d + 1])
                        own = {k: x[(x >= a) & (x + k <= b)] - a for k, x in hits.items()}
                        rows += [(i + int(d), items.ids[t], m / n, m, n, c, longest) for t, m, n, c, longest in items.contained(h[a:b], own, coverage)]
                if rows:
                    cols = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(cols[0])), *(pa.array(c, t) for c, t in zip(cols[1:], (ITEM[item_kind], pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.int32())))], NAMES)

        part = docs.select("doc_id", "text").mapInArrow(common.lean(run), schema)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


NAMES = ["doc_id", "item_id", "coverage", "matched_words", "item_words", "n_tiles", "longest_tile"]
ITEM = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def clean(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, least: int = LEAST) -> DataFrame:
    """docs without the rows that hold a benchmark item; rows of null doc_id stay only if clean."""
    spark = docs.sparkSession
    marked = docs
    for block in _blocks(benchmark, least=least):
        shared = spark.sparkContext.broadcast(Items(block))
        columns = marked.columns

        def run(batches, shared=shared):
            items = shared.value
            for batch in batches:
                parts, keep = common.texts(batch), np.ones(batch.num_rows, bool)
                for i, j in common.groups([len(p) for p in parts], 1 << 21):
                    h, at = words(parts[i:j])
                    hits = {k: items.hits(h, k) for k in items.seeds}
                    for d in np.unique(np.concatenate([np.searchsorted(at, x, "right") - 1 for x in hits.values()])) if hits else []:
                        a, b = int(at[d]), int(at[d + 1])
                        own = {k: x[(x >= a) & (x + k <= b)] - a for k, x in hits.items()}
                        keep[i + int(d)] = next(items.contained(h[a:b], own, coverage), None) is None
                yield batch.filter(pa.array(keep))

        marked = marked.select(*columns).mapInArrow(common.lean(run), marked.schema)
    return marked


def op2(spark, sf_dir):
    """Benchmark items that documents hold, with the share of each item's words that its tiles cover.

    Null and empty texts hold nothing, null items and items of fewer than three words are in nothing; words of a template that more than twenty items share don't count. Repeated documents have rows each, equal benchmark
    rows count once; rows of null doc_id are reported with a null id. Ties: of tiles of equal length the first in the item,
    then in the document. Empty tables give no rows. Other columns are not read.
    """
    return contaminated(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
