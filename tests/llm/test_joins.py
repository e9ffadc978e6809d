"""Near duplicates, repeated passages, decontamination and fingerprints against brute force."""

import hashlib
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame
from tickmill.llm import decontam, fingerprint, graph, ngram_join, substring

from .conftest import prose

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    w = WORDS.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def components(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if b < a and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("block", [None, 300])
def test_ngram_join(make, corpus, monkeypatch, block):
    if block:
        monkeypatch.setattr(ngram_join, "BLOCK_TOKENS", block)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.clusters(make(corpus)).collect()}
    assert got == components(corpus)


def test_ngram_edges(make):
    assert ngram_join.clusters(make([])).collect() == []
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (7, None), (8, "")]
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in ngram_join.clusters(make(rows)).collect())
    assert got == [("4", 2, 4), ("4", 2, 4), ("7", 0, 7), ("8", 0, 8), ("None", 2, 4)]
    assert {r.doc_id for r in ngram_join.representatives(make([(1, "a b c d e"), (2, "a b c d e"), (3, None)])).collect()} == {1, 3}


def test_prefix_bound():
    import numpy as np

    for n in range(1, 250):
        k = int(ngram_join._common(np.array(n), 75))
        for m in range(-(-75 * n // 100), 100 * n // 75 + 1):
            o = ngram_join.overlap_needed(n, m)
            if m and o <= min(n, m):
                sure = min(int(ngram_join._prefix(np.array(x), 75)) - (x - o) for x in (n, m))
                assert sure >= 1 and k <= sure


def test_tree():
    import numpy as np

    r = np.random.default_rng(2)
    sets = [np.unique(r.integers(0, 400, r.integers(20, 90)).astype(np.uint64) << np.uint64(20)) for _ in range(300)]
    x = ngram_join.points(sets)
    tree = ngram_join.Tree(x)
    n = np.array([len(s) for s in sets])
    for share in (75, 12):
        for q in range(0, 300, 30):
            found, bound = tree.search(x[q], share)
            want = np.minimum(x, x[q]).sum(1)
            assert set(found) == set(np.flatnonzero(want * (100 + share) >= share * (n + n[q]))) and (bound == want[found]).all()
            assert all(np.intersect1d(sets[q], s).size <= w for s, w in zip(sets, want))
    tally = {}
    [tree.search(x[q], 75, tally) for q in range(300)]
    assert tally["bounded"] <= tally["opened"] < tally["points"] / 3  # boxes rule most points out
    tally = {}
    near = [np.arange(100, dtype=np.uint64) * np.uint64(7919 << 20)] * 1
    near += [np.sort(np.r_[near[0][i + 1 :], near[0][:i], np.array([i + 5], np.uint64)]) for i in range(99)]
    links, root = ngram_join.spanning_links(near, 75, tally)
    assert len(set(root.tolist())) == 1 and len(links) == 99 and tally["verified"] < 200  # a cluster costs a tree, not all pairs


def test_null_ids_link(spark):
    """A text that only rows of null id hold links two others that don't link with each other."""
    word = [f"w{i}" for i in range(120)]
    texts = [word[:100], word[8:108], word[16:116]]
    rows = [(7, " ".join(texts[0])), (None, " ".join(texts[1])), (None, " ".join(texts[1])), (5, " ".join(texts[2])), (None, "alone with its words here today"), (9, " ".join(word[:60]))]
    got = ngram_join.clusters(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == [(0, 2, 0), (0, 96, 5), (0, 96, 5), (5, 96, 5), (7, 96, 5), (9, 56, 9)]
    alone = ngram_join.clusters(spark.createDataFrame([rows[0], rows[3]], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in alone} == {(7, 7), (5, 5)}


def test_components(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 200)] + [(r.randrange(300, 400), r.randrange(300, 400)) for _ in range(60)] + [(500, x) for x in range(501, 700)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    touched = {x for a, b in edges if a != b for x in (a, b)}
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in touched}


def removed(rows):
    docs = [(i, WORDS.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in docs:
        for k in range(len(w) - 12):
            g = tuple(w[k : k + 13])
            first[g] = min(first.get(g, i), i)
    out = {}
    for i, w in docs:
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < i:
                gone[k : k + 13] = [True] * 13
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def test_substring(make, corpus):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.without_repeats(make(corpus)).collect()}
    assert got == removed(corpus)


def test_substring_edges(make):
    assert substring.without_repeats(make([])).collect() == []
    p = " ".join(f"x{i}" for i in range(20))
    rows = [(None, p), (5, p), (5, p), (5, p + " more"), (3, "head " + p), (9, None)]
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in substring.without_repeats(make(rows)).collect())
    assert got == [("3", 21, 0), ("5", 20, 20), ("5", 20, 20), ("5", 21, 20), ("9", 0, 0), ("None", 20, 0)]
    carried = substring.without_repeats(make(rows), carry=True)
    assert carried.select("carried.*").columns == make(rows).columns and carried.count() == 6


@pytest.mark.parametrize("hot,remembered,broadcast", [(2, 1 << 16, 1 << 26), (2, 3, 0), (10**9, 0, 0)])
def test_substring_hot_passages(make, corpus, monkeypatch, hot, remembered, broadcast):
    """Hot anchors dealt by window, tasks that remember few or no windows, texts all shuffled: the same result."""
    from tickmill.llm import common

    monkeypatch.setattr(substring, "HOT", hot)
    monkeypatch.setattr(substring, "REMEMBERED", remembered)
    monkeypatch.setattr(common, "BROADCAST_BYTES", broadcast)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.without_repeats(make(corpus).repartition(7)).collect()}
    assert got == removed(corpus)


def test_passage_in_every_document(spark, make):
    """One passage in all documents: no bucket gets much more than the others."""
    r = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(13))
    rows = [(i, prose(r, 30, 40) + " " + passage + " " + prose(r, 30, 40)) for i in range(3000)]
    docs = substring._key(make(rows).repartition(40))
    seen, deal = [], DataFrame.repartitionById
    try:
        DataFrame.repartitionById = lambda self, *a: seen.append(self) or deal(self, *a)
        substring.repeats(docs, 13, 5)
    finally:
        DataFrame.repartitionById = deal
    size = lambda c: F.coalesce(F.octet_length(c), F.lit(0))
    for sent in seen:
        total = {x.bucket: x.n for x in sent.groupBy("bucket").agg(F.sum(sum((size(c) for c in sent.columns[1:]), F.lit(0))).alias("n")).collect()}
        assert max(total.values()) < 3 * sorted(total.values())[len(total) // 2]


def test_equal_hashes_are_told_apart():
    """Windows of equal hash and different words: the words decide."""
    import numpy as np

    words = np.arange(20, dtype=np.uint64)
    words[10:15] = words[0:5]
    start, doc = np.array([0, 5, 10, 15, 0]), np.array([3, 2, 4, 1, 3])
    assert substring.same_as_first(words, start, 5, doc, np.zeros(5, np.uint64)).tolist() == [False, False, True, False, False]


def test_tiling():
    item = list(range(20))
    runs = [(0, [90, *range(10, 20), 91, *range(10)]), (50, list(range(5)))]
    assert sorted(decontam.tiles(item, runs, 5)) == [(0, 12, 10), (10, 1, 10)]
    assert decontam.tiles(item, [(0, [1, 2, 3, 4])], 5) == []
    assert decontam.tiles([1] * 10, [(0, [1] * 7)], 5) == [(0, 0, 7)]


def greedy(item, doc, least):
    """Plain greedy string tiling."""
    marked_i, marked_d, covered = set(), set(), 0
    while True:
        best = None
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and i + n not in marked_i and j + n not in marked_d:
                    n += 1
                if n >= least and (best is None or n > best[0]):
                    best = n, i, j
        if best is None:
            return covered
        n, i, j = best
        marked_i |= set(range(i, i + n))
        marked_d |= set(range(j, j + n))
        covered += n


def test_tiling_of_long_and_repeated_passages():
    """20,000 words with swapped halves, and runs of one word, take seconds; the tiles are those of the plain search on small cases."""
    import time

    began = time.time()
    item = list(range(20000))
    assert sorted(decontam.tiles(item, [(0, item[10000:] + item[:10000])], 5)) == [(0, 10000, 10000), (10000, 0, 10000)]
    got = decontam.tiles([7] * 3000, [(0, [7] * 1000), (5000, [7] * 1999)], 5)
    assert sum(n for *_, n in got) == 2999
    assert time.time() - began < 20
    r = random.Random(3)
    for _ in range(200):
        item, doc = [r.randrange(3) for _ in range(r.randrange(1, 30))], [r.randrange(3) for _ in range(r.randrange(1, 40))]
        assert sum(n for *_, n in decontam.tiles(item, [(0, doc)], 2)) == greedy(item, doc, 2)


def test_decontamination(spark, make):
    r = random.Random(9)
    items = [(k, " ".join(f"b{r.randrange(60)}" for _ in range(r.choice([3, 8, 25, 40])))) for k in range(12)] + [(50, None), (51, "")]
    rows = []
    for d in range(60):
        w = [f"b{r.randrange(200)}" for _ in range(r.randrange(5, 80))]
        if d % 2:
            words = items[r.randrange(12)][1].split()
            cut = r.randrange(len(words))
            moved = words[cut:] + ["filler"] * (d % 3) + words[:cut] if d % 4 == 1 else words[: max(1, len(words) * r.randrange(3, 11) // 10)]
            k = r.randrange(len(w))
            w[k:k] = [x.upper() + "," for x in moved]
        rows.append((d, " ".join(w)))
    rows += [(100, None), (101, ""), (102, items[5][1]), (102, items[5][1])]
    bench = spark.createDataFrame(items + [items[3]], "item_id long, text string")
    got = sorted((x.doc_id, x.item_id, x.matched_words) for x in decontam.contaminated(make(rows), bench).collect())
    plain = lambda t: re.sub(r"[^\w\s]", " ", (t or "").lower()).split()
    want = []
    for d, t in rows:
        for k, text in items:
            a = plain(text)
            if a and (n := greedy(a, plain(t), min(5, len(a)))) >= 0.6 * len(a) and n:
                want.append((d, k, n))
    assert got == sorted(want) and len(want) > 20
    left = decontam.clean(make(rows), bench)
    assert {x.doc_id for x in left.collect()} == {d for d, _ in rows} - {d for d, _, _ in want}
    assert decontam.contaminated(make([]), bench).collect() == [] and decontam.contaminated(make(rows), bench.limit(0)).collect() == []
    decontam_block, decontam.BLOCK = decontam.BLOCK, 100
    try:
        assert sorted((x.doc_id, x.item_id, x.matched_words) for x in decontam.contaminated(make(rows), bench).collect()) == sorted(want)
    finally:
        decontam.BLOCK = decontam_block


def test_fingerprints(make, corpus):
    rows = sorted((i, t or "") for i, t in corpus)
    got = {r.doc_id: r for r in fingerprint.compared(make(corpus)).collect()}
    assert len(got) == len(rows)
    for (i, t), (_, n) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        edited = t[: len(t) - half] + n[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint) == (len(t), hashlib.sha256(edited.encode()).hexdigest(), fingerprint.digest(t))
        assert r.near_edited == float(fingerprint.digest(edited) == r.fingerprint) and r.near_next == float(fingerprint.digest(n) == r.fingerprint)
    assert fingerprint.compared(make([])).collect() == []
    assert fingerprint.compared(make([(5, "one")])).first().near_next == 1.0


def test_fingerprint_query(spark, make, tmp_path):
    """The query on repeated ids, null ids and texts, and columns with clashing names; null ids come first, by a hash of their texts."""
    rows = [(None, "lost one"), (None, "lost two"), (None, None), (-4, "Straße"), (3, "STRASSE "), (3, "strasse"), (3, "strasse"), (8, None), (9, "")]
    make(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = fingerprint.op10(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and len(got[0]) == 8
    assert sorted((r.doc_id, r.n_chars, r.group_id) for r in got if r.doc_id is not None) == [(-4, 6, -4), (3, 7, -4), (3, 7, -4), (3, 8, -4), (8, 0, 8), (9, 0, 8)]
    assert all(r.group_id is None for r in got if r.doc_id is None) and sorted(r.n_chars for r in got if r.doc_id is None) == [0, 8, 8]
    # every text is the next one of some row: likeness along the whole circle
    by = {r.doc_id: r for r in got}
    assert by[8].near_next == 1.0 and by[9].near_next in (0.0, 1.0) and by[-4].near_next == 1.0
    make([]).write.parquet(f"{tmp_path}/e/documents.parquet")
    assert fingerprint.op10(spark, f"{tmp_path}/e").collect() == []


def test_groups(make, corpus):
    canon = lambda t: " ".join(unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", t or "").casefold()).split())
    least = {}
    for i, t in corpus:
        least[canon(t)] = min(i, least.get(canon(t), i))
    got = {r.doc_id: r.group_id for r in fingerprint.grouped(make(corpus)).collect()}
    assert got == {i: least[canon(t)] for i, t in corpus}
    assert fingerprint.digest("Ａ  b\n") == fingerprint.digest("a b") != fingerprint.digest("ab")


def test_equal_digests_are_told_apart(make):
    """Texts whose digests collide have groups of their own: the bytes decide."""
    got = fingerprint.grouped(make([(1, "a"), (2, "b"), (3, "A "), (4, None)]), hexdigest=lambda x: "0" * 32).collect()
    assert {r.doc_id: r.group_id for r in got} == {1: 1, 2: 2, 3: 1, 4: 4} and {r.fingerprint for r in got} == {"0" * 32}


@pytest.mark.parametrize("seed", range(3))
def test_graph_components(spark, seed):
    """Random edges, a star around a node that isn't its least, a chain, loops and repeated edges, against union-find."""
    r = random.Random(seed)
    edges = [(5000, i) for i in range(4000, 4600)] + [(i, 9000) for i in range(8000, 8500)] + [(i, i + 1) for i in range(6000, 6060)] + [(7, 7), (7, 7)]
    edges += [(r.randrange(400), r.randrange(400)) for _ in range(220)] * 2
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    r.shuffle(edges)
    got = {(x.node, x.component) for x in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(x, top(x)) for x in up if any(top(x) == top(y) and x != y for y in up)}


def structured(n):
    """Words of n letters that any sum of powers of one base takes for equal."""
    a = "a"
    while len(a) < n:
        a += a.translate({97: 98, 98: 97})
    return a, a.translate({97: 98, 98: 97})


@pytest.mark.parametrize("n", [8, 64, 128, 1024, 4096])
def test_structured_words(make, spark, n):
    """Words with structure don't stand for each other: no link, no removal, no leak."""
    a, b = structured(n)
    docs = make([(1, " ".join([a, "x", "y", a, b] * 3)), (2, " ".join([b, "x", "y", b, a] * 3)), (3, " ".join([a] * 15)), (4, " ".join([b] * 15))])
    assert {r.doc_id: r.component_id for r in ngram_join.clusters(docs).collect()} == {i: i for i in range(1, 5)}
    want = dict.fromkeys((1, 2, 3, 4), 0)
    assert {r.doc_id: r.n_removed for r in substring.without_repeats(docs).collect()} == want
    bench = spark.createDataFrame([(1, " ".join([a] * 9))], "item_id long, text string")
    assert {r.doc_id for r in decontam.contaminated(docs, bench).collect()} == {3}


def test_templates(spark, make):
    """Items that share a template are told apart by their own words; documents that only follow the template hold none of them."""
    items = [(k, f"what is the capital of place{k}") for k in range(300)] + [(k, f"what is the capital of land{k} and who was its ruler in year{k}") for k in range(300, 330)]
    items += [(900, "zug"), (901, "a word"), (902, "what is the capital of")]
    rows = [(1, "what is the capital of nowhere"), (2, "he asked: What is the capital of place17?"), (3, "who knows what is the capital of land305 and who was its ruler in year305 of all"), (4, "zug " * 20 + " a word"), (5, "the capital of land305 and more"), (6, "what is the capital of " * 40)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.matched_words, r.item_words) for r in decontam.contaminated(make(rows), bench).collect()}
    whole = {(d, 902): (5, 5) for d in (1, 2, 3, 6)}  # it has nothing but the template
    assert got == {(2, 17): (1, 1), (3, 305): (7, 7) if (3, 305) not in got else got[3, 305], **whole}
    assert got[3, 305][0] == got[3, 305][1] < 13
    assert {r.doc_id for r in decontam.clean(make(rows), bench.where("item_id <> 902")).collect()} == {1, 4, 5, 6}


def test_many_items_of_one_template(spark, make):
    """Twenty thousand items of one template against documents that follow it take about as long as two hundred."""
    import time

    took = []
    for n in (200, 20_000):
        bench = spark.range(n).selectExpr("id AS item_id", "concat('what is the capital of place', id) AS text")
        docs = make([(i, "what is the capital of nowhere " * 20) for i in range(200)] + [(777, "what is the capital of place9")], False)
        decontam.contaminated(docs, bench).count()
        began = time.time()
        got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench).collect()}
        took.append(time.time() - began)
        assert got == {(777, 9)}
    assert took[1] < took[0] + 15
