"""N-gram Jaccard join with a count-vector R-tree.

A text's set is its distinct 5-word shingles as 64-bit hashes. Texts of equal sets are one
node, named by a hash of the set. Two nodes link when 100 * |intersection| >= 75 * |union|.

Linked sets differ by few shingles, so they share many of their least-hashed ones (prefix principle). The
least-hashed shingles of every set are counted exactly across nodes; a node whose own are too
seldom shared links with nothing. The others take their rarest shared
shingles, enough of them that linked nodes have one in common, and nodes with a common one are
put in one block: the transitive closure, so no link crosses blocks.

In a block, each set is a point: its tokens are hashed into groups, and the point holds
the number in each group. Points are packed into an R-tree; the summed coordinate
minima of a point and of a box's upper corner bound every overlap below it. Pairs that survive and aren't in
one component yet are verified on their sets. Blocks larger than BLOCK_TOKENS are
dealt over tasks: first in parts that share a pivot, then, for the nodes that did not join the
largest component, against every part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, graph

SHINGLE, SHARE = 5, 75
#: Shingles of a block, in all, that one task joins.
BLOCK_TOKENS = 2_000_000
#: Points of a box, and boxes of a larger one.
LEAF = 4
#: Cells of the matrix of points that are worked on at once.
_CELLS = 1 << 18
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SLAB = 2 << 20


# --- sets ---


def shingle_sets(parts: list[bytes], k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's k-word shingles; of fewer words, of the whole sequence; none without words."""
    _, _, _, h, at = common.word_table([p.translate(_LOWER) for p in parts])
    g = common.grams(h, k)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= k:
            x = np.sort(g[a : b - k + 1])
            out.append(x[common.first_of_runs(x)])
        else:
            out.append(common.grams(h[a:b], b - a) if b > a else np.empty(0, np.uint64))
    return out


def node_of(x: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(x.tobytes()) - (1 << 63)


def overlap_needed(n: int, m: int, share: int = SHARE) -> int:
    """The least intersection of linked sets of n and m elements."""
    return -(-share * (n + m) // (100 + share))


#: How much longer prefixes are than the prefix principle needs, in per cent of the set: linked sets then share as many of its shingles.
REACH = 25


def _prefix(n: np.ndarray, share: int) -> np.ndarray:
    """How many least-hashed shingles of a set of n are its prefix."""
    return np.minimum(n, n - -(-share * n // 100) + np.maximum(1, REACH * n // 100))


def _common(n: np.ndarray, share: int) -> np.ndarray:
    """The least number of prefix shingles that a set of n has in common with the prefix of any linked set.

    Of two linked sets of n and m with overlap o, the prefix that ends first holds all but n - o (or m - o) common
    shingles, and they are in the other prefix too. Both bounds are linear in m but for rounding, so the
    smallest and the largest m that can link decide; 2 is taken off for rounding.
    """
    least = None
    for m in (-(-share * n // 100), 100 * n // share):
        o = -(-share * (n + m) // (100 + share))
        for bound in (_prefix(n, share) - (n - o), _prefix(m, share) - (m - o)):
            least = bound if least is None else np.minimum(least, bound)
    return np.maximum(1, least - 2)


def described(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, node (null for empty sets) of every row."""

    def run(batches):
        for batch in batches:
            n, node = [], []
            parts = common.texts(batch)
            for i, j in common.groups([len(p) for p in parts], _SLAB):
                for x in shingle_sets(parts[i:j], k):
                    n.append(len(x))
                    node.append(node_of(x) if len(x) else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(node, pa.int64())], ["doc_id", "n_shingles", "node"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(common.lean(run), f"doc_id {kind}, n_shingles long, node long")


# --- candidate blocks ---


def _rows(found, names):
    rows = list(found)
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), *(pa.array([c[k] for _, c in rows], pa.binary()) for k in names)], ["bucket", *names])


def _deal(x: np.ndarray, salt: int, buckets: int) -> np.ndarray:
    return (common.mix(x.view(np.uint64), salt) % np.uint64(buckets)).astype(np.int64)


def candidate_edges(docs: DataFrame, k: int = SHINGLE, share: int = SHARE) -> DataFrame:
    """(a, b): node pairs that span each group of nodes with a common rare shingle."""
    buckets = common.partitions(docs.sparkSession)

    def prefixes(batches):
        seen: set[int] = set()  # nodes of this task: copies send nothing more
        for batch in batches:
            parts = common.texts(batch)
            for i, j in common.groups([len(p) for p in parts], 4 * _SLAB):
                keys, nodes, sizes = [], [], []
                for a, b in common.groups([len(p) for p in parts[i:j]], _SLAB):
                    for x in shingle_sets(parts[i + a : i + b], k):
                        if len(x) and (node := node_of(x)) not in seen:
                            seen.add(node)
                            keys.append(x[: int(_prefix(np.array(len(x)), share))])
                            nodes.append(node)
                            sizes.append(len(x))
                if keys:
                    n = [len(x) for x in keys]
                    key = np.concatenate(keys)
                    which = np.repeat(np.arange(len(n)), n)
                    node, size = np.array(nodes, np.int64), np.array(sizes, np.int32)
                    out = []
                    for bucket, c in common.blobs(_deal(key, 1, buckets), {"key": key, "which": which}):
                        w = np.frombuffer(c["which"], np.int64)
                        own = np.flatnonzero(common.first_of_runs(w))
                        out.append((bucket, {"key": c["key"], "node": node[w[own]].tobytes(), "size": size[w[own]].tobytes(), "n": np.diff(np.r_[own, len(w)]).astype(np.int32).tobytes()}))
                    yield from _rows(out, ("key", "node", "size", "n"))

    def shared(batches):
        """Of each key that two nodes have: (key, node, size, nodes that have it), dealt by node."""
        got = common.gathered(batches, key=np.uint64, node=np.int64, size=np.int32, n=np.int32)
        key, node, size = got["key"], np.repeat(got["node"], got["n"]), np.repeat(got["size"], got["n"])
        order = np.lexsort((node, key))
        key, node, size = key[order], node[order], size[order]
        new = common.first_of_runs(key, node)
        key, node, size = key[new], node[new], size[new]
        begin = np.flatnonzero(common.first_of_runs(key))
        df = np.diff(np.r_[begin, len(key)])
        df = np.repeat(df, df)
        some = df > 1
        key, node, size, df = key[some], node[some], size[some], np.minimum(df[some], 65535).astype(np.uint16)
        yield from _rows(common.blobs(_deal(node, 2, buckets), {"key": key, "node": node, "size": size, "df": df}), ("key", "node", "size", "df"))

    def rarest(batches):
        """Of nodes with enough shared keys, the rarest that a linked node can't all miss: (key, node), dealt by key."""
        got = common.gathered(batches, key=np.uint64, node=np.int64, size=np.int32, df=np.uint16)
        if not len(got["key"]):
            return
        order = np.lexsort((got["key"], got["df"], got["node"]))
        key, node, size = (got[c][order] for c in ("key", "node", "size"))
        begin = np.flatnonzero(common.first_of_runs(node))
        count = np.diff(np.r_[begin, len(node)])
        n = size[begin].astype(np.int64)
        keep = np.maximum(0, count - _common(n, share) + 1)
        rank = np.arange(len(node)) - np.repeat(begin, count)
        some = rank < np.repeat(keep, count)
        key, node = key[some], node[some]
        yield from _rows(common.blobs(_deal(key, 3, buckets), {"key": key, "node": node}), ("key", "node"))

    def stars(batches):
        got = common.gathered(batches, key=np.uint64, node=np.int64)
        if not len(got["key"]):
            return
        order = np.lexsort((got["node"], got["key"]))
        key, node = got["key"][order], got["node"][order]
        new = common.first_of_runs(key)
        a = node[np.flatnonzero(new)][np.cumsum(new) - 1]
        a, b = a[a != node], node[a != node]
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = common.first_of_runs(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(a[new]), pa.array(b[new])], ["a", "b"])

    deal = lambda df: df.repartitionById(buckets, F.col("bucket"))
    one = deal(docs.select("text").mapInArrow(common.lean(prefixes), "bucket int, key binary, node binary, size binary, n binary"))
    two = deal(one.mapInArrow(common.lean(shared), "bucket int, key binary, node binary, size binary, df binary"))
    three = deal(two.mapInArrow(common.lean(rarest), "bucket int, key binary, node binary"))
    return three.mapInArrow(common.lean(stars), "a long, b long")


# --- the R-tree ---


class Tree:
    """Points packed by halving on the coordinate of greatest variance, so that near ones share boxes; upper corners of boxes of LEAF, LEAF^2, ... of them."""

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        todo = [(0, len(points))]
        while todo:
            i, j = todo.pop()
            if j - i <= LEAF:
                continue
            mine = self.order[i:j]
            by = points[mine, self._widest(points, mine)]
            mine[:] = mine[np.argsort(by, kind="stable")]
            half = i + LEAF * -(-(j - i) // (2 * LEAF))
            todo += [(i, half), (half, j)]
        self.levels = [points[self.order]]
        self.least = [self.levels[0].sum(1, dtype=np.int64)]  # of each box: tokens of its smallest point
        while len(self.levels[-1]) > LEAF:
            x, at = self.levels[-1], np.arange(0, len(self.levels[-1]), LEAF)
            self.levels.append(np.maximum.reduceat(x, at))
            self.least.append(np.minimum.reduceat(self.least[-1], at))

    @staticmethod
    def _widest(points: np.ndarray, mine: np.ndarray) -> int:
        """The coordinate of greatest variance among some points, a piece of them at a time."""
        step, total, square = max(1, _CELLS // points.shape[1]), 0.0, 0.0
        for i in range(0, len(mine), step):
            x = points[mine[i : i + step]].astype(np.float32)
            total = total + x.sum(0)
            square = square + np.square(x, out=x).sum(0)
        return int((square - np.square(total) / len(mine)).argmax())

    def search(self, q: np.ndarray, share: int = SHARE, tally: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(points, bounds) whose summed minima with q reach the overlap that a link needs (of a box: with its smallest point); tally counts points, those in boxes that are opened, and those whose bound allows a link."""
        own = int(q.sum(dtype=np.int64))
        at = np.arange(len(self.levels[-1]))
        for depth in range(len(self.levels) - 1, 0, -1):
            box = self.levels[depth][at]
            at = at[np.minimum(box, q).sum(1, dtype=np.int64) * (100 + share) >= share * (self.least[depth][at] + own)]
            if not len(at):
                break
            at = (at[:, None] * LEAF + np.arange(LEAF)).ravel()
            at = at[at < len(self.levels[depth - 1])]
        bound = np.minimum(self.levels[0][at], q).sum(1, dtype=np.int64)
        found = self.order[at]
        ok = bound * (100 + share) >= share * (self.least[0][at] + own)
        if tally is not None:
            for k, n in (("points", len(self.order)), ("opened", len(at)), ("bounded", int(ok.sum()))):
                tally[k] = tally.get(k, 0) + n
        return found[ok], bound[ok]


def points(sets: list[np.ndarray]) -> np.ndarray:
    """Counts of each set's tokens in groups: a power of two, at least twice the largest set but 16 at least and 4096 at most, so that few tokens share a group and a box of a few points leaves many groups empty."""
    largest = max(map(len, sets))
    bits = int(np.clip(np.ceil(np.log2(max(1, largest) * 2)), 4, 12))
    g = 1 << bits
    out = np.empty((len(sets), g), np.int32 if largest > 65535 else np.uint16)
    step = max(1, _CELLS // g)
    for i in range(0, len(sets), step):
        part = sets[i : i + step]
        at = np.concatenate([(x >> np.uint64(20)) & np.uint64(g - 1) for x in part]).astype(np.int64)
        row = np.repeat(np.arange(len(part)), [len(x) for x in part])
        out[i : i + step] = np.bincount(row * g + at, minlength=len(part) * g).reshape(len(part), g)
    return out


def spanning_links(sets: list[np.ndarray], share: int = SHARE, tally: dict | None = None) -> tuple[list[tuple[int, int]], np.ndarray]:
    """(links that span the components of the sets, component of each set); exact.

    Sets are taken by size, in windows of sizes that can link. A pair is verified only if its bound allows
    a link and no chain of links joins it already; of another component, the pairs of
    largest bound come first.
    """
    n = len(sets)
    size = np.array([len(x) for x in sets])
    root = np.arange(n)  # flat: the component of each set

    members = {i: [i] for i in range(n)}
    links: list[tuple[int, int]] = []

    def join(i: int, j: int) -> None:
        links.append((i, j))
        a, b = root[i], root[j]
        if len(members[a]) < len(members[b]):
            a, b = b, a
        root[members[b]] = a
        members[a] += members.pop(b)

    by = np.argsort(size, kind="stable")
    # bands of sizes, the largest first: points have few groups where sets are small
    lo = 0
    while lo < n:
        # sets of this band, and the larger ones that they can link with
        first = size[by[lo]]
        hi = int(np.searchsorted(size[by], max(first + 1, first * 5 // 4), "left"))
        end = int(np.searchsorted(size[by], size[by[hi - 1]] * 100 // share, "right"))
        band = by[lo:end]
        if len(band) > 1:
            x = points([sets[i] for i in band])
            tree = Tree(x)
            for q in range(hi - lo):
                i = band[q]
                found, bound = tree.search(x[q], share, tally)
                other = band[found]
                ok = (root[other] != root[i]) & (size[other] * share <= 100 * size[i])
                # the smaller of a pair asks; of equal sizes both do
                other, bound = other[ok], bound[ok]
                for j in other[np.argsort(-bound, kind="stable")].tolist():
                    if root[j] == root[i]:
                        continue
                    if tally is not None:
                        tally["verified"] = tally.get("verified", 0) + 1
                    both = np.intersect1d(sets[i], sets[j], assume_unique=True).size
                    if 100 * both >= share * (size[i] + size[j] - both):
                        join(i, j)
        lo = hi
    return links, root


def block_links(rows: DataFrame, share: int = SHARE) -> DataFrame:
    """rows (task, node, shingles binary) -> (a, b) links that span the components within each task."""

    def run(batches):
        task, nodes, sets = None, [], []

        def solved():
            if len(nodes) < 2:
                return
            links, _ = spanning_links(sets, share)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([nodes[i] for i, _ in links], pa.int64()), pa.array([nodes[j] for _, j in links], pa.int64())], ["a", "b"])

        for batch in batches:
            for t, node, x in zip(*(batch.column(c).to_pylist() for c in ("task", "node", "shingles"))):
                if t != task:
                    yield from solved()
                    task, nodes, sets = t, [], []
                if not nodes or nodes[-1] != node:
                    nodes.append(node)
                    sets.append(np.frombuffer(x, np.uint64))
        yield from solved()

    n = 4 * common.partitions(rows.sparkSession)
    return rows.repartition(n, "task").sortWithinPartitions("task", "node").mapInArrow(common.lean(run), "a long, b long")


def links(docs: DataFrame, facts: DataFrame, k: int = SHINGLE, share: int = SHARE) -> DataFrame:
    """(a, b): node links that span every component of the link graph."""
    blocks = common.settled(graph.components(candidate_edges(docs, k, share)))
    reps = facts.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n"))
    members = common.settled(blocks.join(reps, "node").select("doc_id", "node", F.col("component").alias("block"), "n"))
    weight = members.groupBy("block").agg(F.sum("n").alias("tokens"), F.count("*").alias("nodes"))
    hot = common.settled(weight.where(F.col("tokens") > BLOCK_TOKENS).select("block", F.ceil(F.col("tokens") / F.lit(BLOCK_TOKENS / 2)).cast("int").alias("parts")))
    wanted = members.select("doc_id", "node", "block")

    def sets_of(batches):
        seen: set[int] = set()
        for batch in batches:
            parts = common.texts(batch)
            out = []
            for i, j in common.groups([len(p) for p in parts], _SLAB):
                out += shingle_sets(parts[i:j], k)
            node = batch.column("node").to_pylist() if "node" in batch.schema.names else [node_of(x) for x in out]
            block = batch.column("block") if "block" in batch.schema.names else pa.nulls(len(out), pa.int64())
            keep = []
            for i, x in enumerate(out):  # rows of equal id may differ, or be the same again
                if len(x) and node[i] not in seen and node_of(x) == node[i]:
                    seen.add(node[i])
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([block.take(pa.array(keep, pa.int64())), pa.array([node[i] for i in keep], pa.int64()), pa.array([out[i].tobytes() for i in keep], pa.binary())], ["block", "node", "shingles"])

    texts = docs.select("doc_id", "text").join(common.maybe_broadcast(wanted), "doc_id").select("block", "node", "text")
    sets = texts.mapInArrow(common.lean(sets_of), "block long, node long, shingles binary")
    if facts.where("doc_id is null and node is not null").limit(1).count():  # texts that only rows of null id have are found by their node
        nameless = docs.where("doc_id is null").select("text").mapInArrow(common.lean(sets_of), "block long, node long, shingles binary").drop("block")
        sets = sets.unionByName(nameless.join(wanted.where("doc_id is null").select("block", "node"), "node"))
    if not hot.count():
        return block_links(sets.select(F.col("block").alias("task"), "node", "shingles"), share)
    sets = common.settled(sets)
    cold = block_links(sets.join(hot, "block", "left_anti").select(F.col("block").alias("task"), "node", "shingles"), share)
    big = sets.join(common.maybe_broadcast(hot), "block").withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    # the block's least node stands in every part, so that parts of one cluster meet
    pivot = F.when(F.col("node") == F.col("block"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("part"))
    near = common.settled(block_links(big.withColumn("p", F.explode(pivot)).select(F.xxhash64("block", "p").alias("task"), "node", "shingles"), share))
    own = big.select("block", "node", "part", "parts").join(graph.components(near), "node", "left").withColumn("component", F.coalesce("component", "node"))
    groups = own.groupBy("block", "component").agg(F.count("*").alias("n"))
    main = groups.groupBy("block").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("groups")).where("groups > 1")
    # nodes outside the main component meet every part of their block, in slices
    rest = own.join(common.maybe_broadcast(main), "block").where("component <> main").select("block", "node", "parts")
    slices = F.greatest(F.lit(1), F.ceil(F.col("others") / F.lit(2000))).cast("int")
    others = rest.groupBy("block").agg(F.count("*").alias("others"))
    rest = rest.join(common.maybe_broadcast(others), "block").withColumn("slice", F.pmod(F.xxhash64("node", F.lit(1)), slices).cast("int"))
    asking = rest.join(sets.drop("block"), "node").select("block", "slice", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "node", "shingles")
    asked = big.join(common.maybe_broadcast(others), "block").select("block", F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"), "part", "node", "shingles")
    far = block_links(asking.unionByName(asked).select(F.xxhash64("block", "slice", "part").alias("task"), "node", "shingles"), share)
    return cold.unionByName(near).unionByName(far)


def clusters(docs: DataFrame, k: int = SHINGLE, share: int = SHARE) -> DataFrame:
    """doc_id, n_shingles, component_id of every row: the least doc_id that links lead to, its own included.

    Null and empty texts have an empty set and no link. Rows of null doc_id have a null component
    if nothing else is in it. Repeated rows are copies like any others.
    """
    docs = docs.select("doc_id", "text")
    facts = common.settled(described(docs, k))
    found = common.settled(links(docs, facts, k, share))
    parts = graph.components(found)
    nodes = facts.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("first"), F.count("*").alias("docs")).join(parts, "node", "left").where("docs > 1 or component is not null")
    nodes = nodes.withColumn("component", F.coalesce("component", "node"))
    least = nodes.groupBy("component").agg(F.min("first").alias("component_id"))
    of = nodes.select("node", "component").join(least, "component").select("node", "component_id")
    return facts.join(of, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def representatives(docs: DataFrame, k: int = SHINGLE, share: int = SHARE) -> DataFrame:
    """The rows of docs whose doc_id is the least of its component; of repeated ids, all rows of that id."""
    gone = clusters(docs, k, share).where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct()
    return docs.join(common.maybe_broadcast(common.settled(gone)), "doc_id", "left_anti").select(*docs.columns)


def op4(spark, sf_dir):
    """Shingles of every document and the least doc_id that links lead to.

    Null and empty texts have an empty set and no link. Rows of equal doc_id have a row each and share a component only through links; rows
    of null doc_id have a null component if nothing else is in it. A link of exactly the threshold counts. An empty table
    gives no rows. Other columns are not read. Raises should 60 rounds of the component search, which halve paths, not be enough.
    """
    return clusters(common.table(spark, sf_dir, "documents"))
