"""Classifiers, language models, tokenisation and archives: held-out accuracy, exact round trips, edge cases."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tickmill.llm import bpe, langid, lm, quality, toxicity, warc

from .conftest import prose

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = bpe.read_ranks(f.read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), bpe.Codec(ranks)


def test_pieces_and_merges(library):
    enc, codec = library
    r = random.Random(4)
    letters = "aab's'll'reétN12  \n\t.,!?'’中é½²\x00\x1c\x85 🙂vemdſ"
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(60))) for _ in range(3000)] + ["", " ", "\n\n", "a" * 5000, " " * 700, "'" * 50, "don't we'll 'sss 's'sx I'M", "<|endoftext|>"]
    for text, (ids, starts) in zip(texts, codec.encode_batch([t.encode() for t in texts])):
        assert ids == enc.encode_ordinary(text), text
        assert codec.decode(ids) == text.encode()
        assert list(starts) == sorted(starts) and (not len(text) or starts[0] == 0)


def test_every_code_point(library):
    enc, codec = library
    points = [c for c in range(1, 0x3000) if not 0xD800 <= c < 0xE000] + list(range(0xFE00, 0x11000)) + list(range(0x1F000, 0x1F700))
    texts = ["x" + chr(c) + " " + chr(c) + "1" for c in points]
    wrong = [c for c, t, (ids, _) in zip(points, texts, codec.encode_batch([t.encode() for t in texts])) if ids != enc.encode_ordinary(t)]
    assert wrong == []


def test_scan_equals_step_by_step():
    r = np.random.default_rng(1)
    symbols = r.integers(0, 9, 5000).astype(np.uint8)
    state, want = bpe.sW, []
    for y in symbols:
        want.append(state)
        state = bpe._step(state, int(y))[0]
    assert bpe.states_before(symbols).tolist() == want


def test_encode(make, corpus, library):
    enc, _ = library
    got = {r.doc_id: r for r in bpe.encode(make(corpus), RANKS).collect()}
    for i, t in corpus:
        ids = enc.encode_ordinary(t or "")
        r = got[i]
        assert (r.ids, r.n_tokens, r.round_trip) == (ids, len(ids), True)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest() and r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.encode(make([]), RANKS).collect() == [] and bpe.encode(make([(None, "x"), (None, "x")]), RANKS).count() == 2


def kept_out(i, modulus, held):
    return zlib.crc32(str(i).encode()) % modulus == held


def labelled(n, seed):
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad, toxic = r.random() < 0.3, r.random() < 0.3
        words = prose(r, r.randrange(30, 200)).split()
        if bad:
            words = [w + "%%%" for w in words]
        if toxic:
            k = r.randrange(len(words))
            words[k:k] = [r.choice(["vile", "vilest", "nasty", "nastiest"]) for _ in range(6)]
        rows.append((i, " ".join(words)))
        labels.append((i, int(not bad), int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def marked():
    return labelled(400, 8)


EDGE = [(9001, None), (9002, ""), (9002, ""), (None, "plain"), (9003, "é" * 40000)]


def test_quality(spark, make, marked):
    rows, labels = marked
    lab = spark.createDataFrame(labels + [(None, 1, 0), (5000, None, None), labels[0]], "doc_id long, quality int, toxic int")
    network = quality.fit(make(rows), lab)
    got = quality.classify(make(rows + EDGE), network, ["doc_id"]).collect()
    truth = {i: q for i, q, _ in labels}
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.doc_id in truth and kept_out(r.doc_id, 5, 0)]
    assert len(got) == len(rows) + len(EDGE) and all(0 <= r.score <= 1 for r in got)
    assert len(held) > 40 and sum(a == b for a, b in held) / len(held) > 0.95
    again = quality.fit(make(rows), lab)
    assert all((a == b).all() for a, b in zip(network.params(), again.params()))
    empty = quality.fit(make([]), lab.limit(0))
    assert [r.predicted for r in quality.classify(make([(1, "x")]), empty, ["doc_id"]).collect()] == [1] and quality.classify(make([]), empty, ["doc_id"]).collect() == []


def test_quality_gradients():
    network = quality.Network()
    for p in network.params():
        p += np.random.default_rng(3).normal(0, 0.1, p.shape).astype(np.float32)
    parts, y, w = [b"some text " * 90, b"", b"other words here"], np.array([1.0, 0, 0], np.float32), np.ones(3, np.float32)

    def loss():
        p = np.clip(network.score(parts, network.tables()), 1e-7, 1 - 1e-7)
        return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).sum())

    grads = network.gradients(parts, y, w, network.tables())
    r = np.random.default_rng(0)
    for p, g in zip(network.params(), grads):
        flat, fg = p.reshape(-1), g.reshape(-1)
        for i in r.choice(np.flatnonzero(abs(fg) > 1e-3) if (abs(fg) > 1e-3).any() else np.arange(len(fg)), min(6, len(fg))):
            old = flat[i]
            flat[i] = old + 2e-3
            up = loss()
            flat[i] = old - 2e-3
            down = loss()
            flat[i] = old
            assert (up - down) / 4e-3 == pytest.approx(float(fg[i]), rel=0.25, abs=3e-2)


def quality_brute(net, text):
    """The network's definition, a place at a time."""
    pairs = (text + b"\0" * (2 * quality.WIDTH + 1))[: 2 * (-(-len(text) // 2) + quality.WIDTH)]
    values = []
    for i in range(max(1, -(-len(text) // 2))):
        raw = pairs[2 * i : 2 * i + 2 * quality.WIDTH]
        raw += b"\0" * (2 * quality.WIDTH - len(raw))
        values.append(sum(net.embed[b] @ net.filters[j] for j, b in enumerate(raw)))
    hops = -(-(len(text) + 2 * quality.WIDTH) // (2 * quality.HOP))
    top = [np.max(values[k * quality.HOP : (k + 1) * quality.HOP] or [np.full(quality.FILTERS, -1e9)], axis=0) for k in range(hops)]
    chunk = [np.maximum(top[k], top[min(k + 1, hops - 1)]) for k in range(hops)]
    x = np.maximum(np.array(chunk) + net.bias, 0)
    return 1 / (1 + math.exp(-float(np.r_[x.mean(0), x.max(0)] @ net.out + net.base[0])))


def test_quality_scores_stand_alone():
    """Brute force; and no score depends on the texts beside it, at lengths around whole hops too."""
    r = random.Random(4)
    net = quality.Network()
    for p in net.params():
        p += np.random.default_rng(3).normal(0, 0.3, p.shape).astype(np.float32)
    parts = [bytes(r.randrange(32, 127) for _ in range(n)) for n in (0, 1, 2, 7, 247, 248, 249, 250, 254, 255, 256, 257, 511, 512, 700, 2000)]
    alone = [float(net.score([p], net.tables())[0]) for p in parts]
    assert alone == pytest.approx([quality_brute(net, p) for p in parts], abs=1e-4)
    for _ in range(5):
        mixed = list(range(len(parts)))
        r.shuffle(mixed)
        assert net.score([parts[i] for i in mixed], net.tables()).tolist() == [alone[i] for i in mixed]


def test_quality_learns_from_whole_texts(spark, make, monkeypatch):
    """Junk that stands at one place of long texts is learned; a small bound on bytes leaves one text of each class at least."""
    r = random.Random(5)
    ids = [i for i in range(200) if not kept_out(i, 5, 0)]
    rows = []
    for i in ids:
        w = prose(r, 3000).split()
        if i % 2:
            w[777:790] = ["%%%~~~"] * 13
        rows.append((i, " ".join(w)))
    lab = spark.createDataFrame([(i, 1 - i % 2) for i in ids], "doc_id long, quality int")
    got = quality.classify(make(rows), quality.fit(make(rows), lab), ["doc_id"]).collect()
    assert sum(x.predicted == 1 - x.doc_id % 2 for x in got) > 0.95 * len(ids)
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 10)
    assert np.isfinite(quality.fit(make(rows), lab).out).all()


def test_whole_text_counts():
    network = quality.Network()
    tables = network.tables()
    base = b"abcd " * 4000
    assert network.score([base], tables)[0] != network.score([base + b"%%%%%%%%"], tables)[0]


def segments_brute(s):
    """All maximal-scoring segments by their recursive definition: the best segment, then left and right of it."""
    best = None
    for i in range(len(s)):
        total = 0.0
        for j in range(i, len(s)):
            total += s[j]
            if total > 0 and (best is None or total > best[2] + 1e-12 or abs(total - best[2]) <= 1e-12 and j - i < best[1] - 1 - best[0]):
                best = (i, j + 1, total)
    if best is None:
        return []
    i, j, x = best
    return segments_brute(s[:i]) + [best] + [(a + j, b + j, c) for a, b, c in segments_brute(s[j:])]


def test_segments():
    lex = toxicity.Lexicon([(np.arange(4, dtype=np.uint64), np.ones((2, 4)))] * 3, np.ones(2))
    r = random.Random(2)
    for _ in range(300):
        s = np.array([r.choice([-3.1, -1.07, -0.53, 0.61, 1.29, 2.83]) + r.random() * 1e-3 for _ in range(r.randrange(0, 25))])
        got = lex.segments(s)
        want = segments_brute(list(s))
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert [c for *_, c in got] == pytest.approx([c for *_, c in want])


def test_toxicity(spark, make, marked):
    rows, labels = marked
    lab = spark.createDataFrame(labels + [(None, 1, 1), (5000, None, None)], "doc_id long, quality int, toxic int")
    lexicon = toxicity.fit(make(rows), lab)
    got = toxicity.score(make(rows + EDGE), lexicon).collect()
    truth = {i: t for i, _, t in labels}
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.doc_id in truth and r.held_out]
    assert len(got) == len(rows) + len(EDGE) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == kept_out(r.doc_id, 3, 1) for r in got if r.doc_id is not None)
    assert sum(a == b for a, b in held) / len(held) > 0.95
    empty = toxicity.fit(make([]), lab.limit(0))
    assert [r.predicted for r in toxicity.score(make([(1, "x")]), empty).collect()] == [0]


def toxicity_brute(rows, labels, modulus, held):
    """Word scores by their definition from dictionaries of documents."""
    plain = lambda t: re.sub(r"[^a-z0-9\x80-\U0010ffff]", " ", (t or "").translate({c: c + 32 for c in range(65, 91)})).split()
    y = {i: t for i, _, t in labels if t is not None and not kept_out(i, modulus, held)}
    cuts = (None, 6, 4)
    tables = [{}, {}, {}]
    for i, text in rows:
        if i in y:
            for level, c in enumerate(cuts):
                for w in {x.encode()[:c] for x in plain(text)}:
                    tables[level].setdefault(w, [0, 0])[y[i]] += 1
    clean, toxic = (max(1, sum(v[k] for v in tables[0].values())) for k in (0, 1))
    share = toxic / (clean + toxic)

    def score(word):
        p = share
        for level in (2, 1, 0):
            c, t = tables[level].get(word.encode()[: cuts[level]], (0, 0))
            p = (t + toxicity.PRIOR[level] * p) / (c + t + toxicity.PRIOR[level])
        return max(toxicity.FLOOR, math.log(p / (1 - p)) - math.log(share / (1 - share)) - toxicity.DRIFT)

    return lambda text: [score(w) for w in plain(text)]


def test_toxicity_brute_force(spark, make, marked):
    """Scores and segments of every text from dictionaries, with the fitted calibration."""
    rows, labels = marked
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    lex = toxicity.fit(make(rows), lab)
    words = toxicity_brute(rows, labels, 3, 1)
    assert lex.docs.tolist() == [sum(t == v and not kept_out(i, 3, 1) for i, _, t in labels) for v in (0, 1)]
    by = {x.doc_id: x for x in toxicity.score(make(rows), lex).collect()}
    for i, text in rows[:60]:
        s = words(text)
        want = []
        for a, b, x in segments_brute(s) if any(v > 0 for v in s) else []:
            log_expected = math.log(lex.k * len(s)) - lex.rate * x
            if math.exp(log_expected) < toxicity.SIGNIFICANT:
                want.append((a, b, -math.log(-math.expm1(-math.exp(log_expected))) if log_expected > -20 else -log_expected))
        got = [(x.first, x.end, x.evidence) for x in by[i].segments]
        assert [x[:2] for x in got] == [x[:2] for x in want] and [x[2] for x in got] == pytest.approx([x[2] for x in want], rel=1e-3)
        total = math.log1p(sum(x[2] for x in want))
        assert by[i].evidence == pytest.approx(math.expm1(total), rel=1e-3, abs=1e-9) and by[i].score == pytest.approx(1 / (1 + math.exp(-lex.curve[0] - lex.curve[1] * total)), rel=1e-3)


def test_toxicity_of_one_class(spark, make, marked):
    rows, labels = marked
    for v in (0, 1):
        lab = spark.createDataFrame([(i, 1, v) for i, _, _ in labels] + [(labels[0][0], 1, 0)], "doc_id long, quality int, toxic int")
        got = toxicity.score(make(rows[:5]), toxicity.fit(make(rows), lab)).collect()
        assert all(abs(x.score - v) < 0.05 and x.predicted == v for x in got)



def test_languages(make):
    r = random.Random(6)
    sounds = {"en": ["the", "ing", "and", "wh"], "fr": ["eau", "è", "que", "ou"], "de": ["sch", "ü", "ung", "ein"]}
    rows = [(i, " ".join("".join(r.choice(sounds[v]) for _ in range(r.randrange(1, 4))) for _ in range(40)), v) for i, v in enumerate(r.choice(list(sounds)) for _ in range(300))]
    more = [(800, None, None), (801, "", "en"), (802, "12 !?", "en"), (803, rows[0][1], None), (None, rows[1][1], "en")]
    got = langid.identify(make(rows + more)).collect()
    by = {r.doc_id: r for r in got}
    truth = {i: v for i, _, v in rows}
    held = [by[i].lang_pred == v for i, v in truth.items() if kept_out(i, 5, 0)]
    assert len(got) == 305 and sum(held) / len(held) > 0.97
    assert [by[i].lang_pred for i in (800, 801, 802, 803)] == ["und", "und", "und", truth[0]] and all(0 <= r.score <= 1 for r in got)
    assert [r.lang_pred for r in langid.identify(make([(1, "text", None)])).collect()] == ["und"] and langid.identify(make([])).collect() == []


def test_every_language_is_learned(make):
    """Over 200 labels, one with long texts only."""
    r = random.Random(7)
    text = lambda k, n: "".join(chr(0x4E00 + 9 * k + r.randrange(9)) + " " * (r.random() < 0.3) for _ in range(n))
    ids = iter(i for i in range(10**6) if not kept_out(i, 5, 0))
    rows = [(next(ids), text(k, 60), f"l{k:03}") for k in range(203) for _ in range(2)]
    rows += [(next(ids), text(300, 60), "zz"), *[(next(ids), text(310, 100_500), "long") for _ in range(3)]]
    by = {x.doc_id: x.lang_pred for x in langid.identify(make(rows)).collect()}
    assert by[rows[406][0]] == "zz" and all(by[i] == "long" for i, _, v in rows if v == "long")
    assert sum(by[i] == v for i, _, v in rows) > 0.97 * len(rows)


def test_kernel():
    a, b = b"abab", b"abc"
    grams = lambda t: {t[i : i + n] for t in [b" " + t + b" "] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    x = langid.presence([a, b])
    assert x[0] @ x[1] == len(grams(a) & grams(b)) and x.sum(1).tolist() == [len(grams(a)), len(grams(b))]


def test_lm_network():
    """Probabilities of all slots add up to one; the gradient is that of the loss."""
    r = np.random.default_rng(1)
    w = lm.Weights.initial(r.integers(0, 50, lm.SLOTS))
    w.wc[:-1], w.wm[:, :-1] = r.normal(0, 0.3, w.wc[:-1].shape), r.normal(0, 0.3, w.wm[:, :-1].shape)
    ctx = list(r.integers(0, lm.SLOTS + 1, (4, 3)))
    total = sum(np.exp(lm.log_probs(w, ctx, np.full(3, s))) for s in range(lm.SLOTS))
    assert total == pytest.approx(np.ones(3), rel=1e-3)
    target = np.array([5, 70, 5])
    g = lm.gradient(w, ctx, target)
    for i in np.argsort(-abs(g))[:40:3]:
        up, down = w.flat.copy(), w.flat.copy()
        up[i] += 1e-2
        down[i] -= 1e-2
        loss = lambda f: -lm.log_probs(lm.Weights(f), ctx, target).astype(float).mean()
        assert (loss(up) - loss(down)) / 2e-2 == pytest.approx(float(g[i]), rel=0.05, abs=1e-3)


def lm_scores(docs):
    counts = lm.word_counts(docs)
    pieces = lm.coded(docs, counts)
    flat = lm.train(pieces, counts)
    return flat, counts, lm.score(pieces, flat, counts).collect()


def lm_slots(words):
    """Slots by definition: the most frequent words have their own, others share one by their ending."""
    ranked = sorted(set(words), key=lambda x: (-words.count(x), int(lm.hashed([x.encode()])[0][0])))
    often = [x for x in ranked if words.count(x) >= max(1, -(-len(words) // lm.FREQUENT))]

    def shared(x):
        e = 0
        for k in range(1, lm.ENDING + 1):
            e = (e * 257 + (x.encode()[-k] if len(x.encode()) >= k else 0)) % 2**32
        return lm.OWN + (e * 2654435761 % 2**32 >> 8) % (lm.SLOTS - lm.OWN)

    own = {x: i for i, x in enumerate(often[: lm.OWN])}
    return {x: own.get(x, shared(x)) for x in ranked}


@pytest.mark.parametrize("frequent", [lm.FREQUENT, 4])
def test_lm_scores_words(make, monkeypatch, frequent):
    """Scores against their definition word by word, with frequent words broadcast or none; the others' counts are joined."""
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    rows = [(i, "common word here " * 5 + " ".join(f"{x}{i}" for x in ("own", "and", "but", "a", "e", "i", "o", "u", "more"))) for i in range(50)] + [(60, "rare word here"), (61, "common word here"), (61, "common word here"), (None, "common word here"), (62, None), (63, ""), (64, " \n")]
    flat, _, got = lm_scores(make(rows))
    words = [w for _, t in rows for w in (t or "").split()]
    slot = lm_slots(words)
    w = lm.Weights(flat)
    groups = {}
    for x in set(words):
        groups.setdefault(slot[x], []).append(x)

    def want(text):
        ids = [lm.SLOTS] * lm.SIDE + [slot[x] for x in text.split()] + [lm.SLOTS] * lm.SIDE
        total = 0.0
        for i, x in enumerate(text.split(), lm.SIDE):
            a = w.bias.astype(float).copy()
            for k, d in enumerate((-2, -1, 1, 2)):
                a += w.enter[k][ids[i + d]]
            h = np.r_[a / (1 + abs(a)), 1]
            c, m = ids[i] % lm.CLASSES, ids[i] // lm.CLASSES
            for z, at in ((h @ w.wc, c), (h @ w.wm[c], m)):
                total += z[at] - math.log(np.exp(z).sum())
            if ids[i] >= lm.OWN:
                same = groups[ids[i]]
                total += math.log((words.count(x) + 1) / (sum(words.count(y) for y in same) + len(same) + 1))
        return total

    assert len(got) == len(rows) and sorted(r.doc_id or 0 for r in got) == sorted(i or 0 for i, _ in rows)
    by = {r.doc_id: r for r in got}
    for i in (62, 63, 64):
        assert (by[i].n_tokens, by[i].log_likelihood, by[i].mean_log_prob) == (0, 0, None)
    for i, t in [(j, u) for j, u in rows if j in (0, 7, 60, 61, None)]:
        assert by[i].log_likelihood == pytest.approx(want(t), rel=1e-4) and by[i].n_tokens == len(t.split())
    assert by[61].log_likelihood > by[60].log_likelihood


def test_lm_learns_and_ignores_partitions(spark, make):
    """Held against word counts on sentences whose words follow from their neighbours; every word is a target, however the input is cut."""
    r = random.Random(3)
    rows = [(i, " ".join(f"{a} then{a}" for a in (r.choice("abcdefgh") for _ in range(100)))) for i in range(300)]
    words = [w for _, t in rows for w in t.split()]
    unigram = sum(c / len(words) * math.log(c / len(words)) for c in (words.count(x) for x in set(words)))
    scores = []
    for n in (1, 4, 16):
        flat, counts, got = lm_scores(make(rows).repartition(n))
        scores.append({x.doc_id: x.log_likelihood for x in got})
        assert sum(x.log_likelihood for x in got) / len(words) > unigram + 0.4
        pieces = lm.coded(make(rows).repartition(n), counts)
        assert sum(len(bytes(x.slots)) // 2 for x in pieces.select("slots").collect()) == len(words)
    assert all(s[i] == pytest.approx(scores[0][i], rel=1e-5) for s in scores for i in s)
    empty = make([])
    assert lm_scores(empty)[2] == [] and [x.n_tokens for x in lm_scores(make([(1, None), (1, None)]))[2]] == [0, 0]


def test_warc_framing():
    r = random.Random(1)
    for n in (0, 1, 8191, 8192, 8193, 70000):
        body = bytes(r.randrange(256) for _ in range(n))
        assert warc.unchunked(warc.chunked(body)) == body
        data = b"".join(x + b"\r\n\r\n" for x in warc.page_records("7", "http://x/\r\ny", body, None, 1000))
        found = list(warc.parse(data))
        assert len({h["warc-record-id"] for h, _ in found}) == len(found)
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc")
    with pytest.raises(ValueError):
        list(warc.parse(data[:-10]))


def test_warc_round_trip(spark, tmp_path):
    r = random.Random(2)
    big, text = "".join(chr(r.choice([65, 233, 20013, 128578, 13, 10])) for _ in range(60000)), "x" * 1000
    html = [big, text, "x" * 999, "x" * 999, text, None, "", "WARC/1.1\r\n\r\n0\r\n\r\n", text, big]
    pages = spark.createDataFrame([(10 * i, None if i == 2 else f"http://h/{i}", t, "clash") for i, t in enumerate(html)], "page_id long, url string, html string, digest string")
    warc.write(pages, str(tmp_path / "w"), segment=4096)
    found = warc.records(spark, str(tmp_path / "w"))
    assert found.where("type = 'continuation'").count() > 20
    got = {int(x.origin): x for x in warc.assembled(found).collect()}
    assert len(got) == 10 and all(x.ok for x in got.values())
    for i, t in enumerate(html):
        x = got[10 * i]
        body = (t or "").encode()
        last = max(j for j, u in enumerate(html) if (u or "") == (t or ""))
        if len(body) >= 1000 and last != i:
            assert (x.type, x.refers_to, x.body) == ("revisit", str(10 * last), None)
        else:
            assert (x.type, x.body, x.digest) == ("response", body, hashlib.sha1(body).hexdigest())
    # a lost or repeated segment is noticed, a repeated record isn't counted twice
    broken = warc.assembled(found.where("not (origin = '90' and segment = 2)")).where("origin = '90'").first()
    assert not broken.ok and broken.body is None
    assert warc.assembled(found.union(found.where("segment = 2"))).where("origin = '90'").first().ok


def test_warc_query_on_repeated_pages(spark, tmp_path):
    """The query itself: repeated rows, an id with several payloads over a segment, null ids, clashing columns."""
    big, other, shared = "x" * 70000, "y" * 80000, "z" * 1500
    rows = [(1, big), (1, other), (1, other), (2, shared), (3, shared), (3, shared), (4, None), (None, "lost"), (5, "small"), (5, "small"), (-6, other)]
    folder = str(tmp_path / "t")
    spark.createDataFrame([(i, None, t, "x", True, 7) for i, t in rows], "page_id long, url string, html string, digest string, several boolean, held int").write.parquet(f"{folder}/pages.parquet")
    got = sorted(tuple(r) for r in warc.op1(spark, folder).collect())
    want = []
    for i, t in rows:
        body = (t or "").encode()
        holder = max((j for j, u in rows if j is not None and (u or "") == (t or "")), default=None)
        if i is not None:
            again = len(body) >= 1000 and holder != i
            want.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", holder if again else None))
    assert [r[:4] for r in got] == [r[:4] for r in sorted(want)] and [r[4] for r in got] == [r[4] for r in sorted(want)]


def test_warc_empty(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write(pages, str(tmp_path / "w"))
    assert warc.assembled(warc.records(spark, str(tmp_path / "w"))).collect() == []


def test_language_of_one_id(make):
    """A language whose rows all repeat one id is learned like any other."""
    rows = [(i, f"the of and {i} ing tion", "en") for i in range(1, 40)] + [(41, "żółć gęślą jaźń", "xx")] * 3000
    assert zlib.crc32(b"41") % 5 != 0
    got = langid.sample(make(rows, False), 5, 0)
    assert sorted({(i, lang) for i, lang, _ in got if lang == "xx"}) == [(41, "xx")] and len(got) > 20


def test_quality_sample_passes_over_huge_texts(make, spark, monkeypatch):
    """One text that doesn't fit doesn't end the sample."""
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 3000)
    docs = make([(i, "word " * (4000 if i in (3, 8) else 10)) for i in range(40)], False)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(quality.Network, "fit", lambda self, parts, y: seen.append((len(parts), max(map(len, parts)), sorted(set(y.tolist())))) or self)
    quality.fit(docs, labels)
    n = sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(40) if i not in (3, 8))
    assert seen == [(n, 50, [0.0, 1.0])]


def test_toxicity_is_fitted_on_a_bounded_sample(make, spark, monkeypatch):
    """As many documents as fit, whole, and every word of them; a document that doesn't fit is passed over."""
    docs = [(i, f"word{i} common " + "long " * (5000 if i == 7 else 1)) for i in range(60)]
    lab = spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    learned = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert 7 in learned
    assert toxicity.fit(make(docs), lab).docs.sum() == len(learned)
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 400)
    lex = toxicity.fit(make(docs), lab)
    n = int(lex.docs.sum())
    assert 10 < n < len(learned) and len(lex.found[0][0]) == n + 2  # each one's own word, and the two that they share


def plainly_scored(net, text):
    """The network's probability of one text by loops over pairs, filters and chunks."""
    q, width, hop = quality, quality.WIDTH, quality.HOP
    hops = -(-(len(text) + 2 * width) // (2 * hop))
    padded = text + bytes(2 * hop * hops - len(text) + 2 * width)
    end = max(1, -(-len(text) // 2))
    conv = np.full((hops * hop, q.FILTERS), -1e9)
    for at in range(end):
        conv[at] = sum(net.embed[padded[2 * at + j]].astype(float) @ net.filters[j].astype(float) for j in range(2 * width))
    last = max(1, hops - 1)
    chunks = [np.maximum(conv[c * hop : (c + 2) * hop].max(0) + net.bias, 0) for c in range(hops if hops == 1 else last)]
    if hops > 1:  # the last hop by itself
        chunks.append(np.maximum(conv[(hops - 1) * hop :].max(0) + net.bias, 0))
    x = np.r_[np.sum(chunks, 0) / hops, np.max(chunks, 0)]
    return 1 / (1 + math.exp(-float(x @ net.out + net.base[0])))


def written(spark, folder, docs, labels):
    spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, lang string, score string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_registered_quality_by_loops(spark, tmp_path, monkeypatch):
    """op5 as registered: each score is that of the fitted network worked out by loops, also of empty, long and repeated texts."""
    monkeypatch.setattr(quality, "STEPS", 40)
    r = random.Random(41)
    docs = [(i, prose(r, r.choice([1, 30, 200])) if i % 2 else "".join(r.choice("#$%&*()") for _ in range(r.randrange(1, 900))), "en") for i in range(60)]
    docs += [(100, None, "en"), (101, "", "en"), (102, "é" * 255, None), (103, prose(r, 3000), "en"), (5, docs[5][1], "en"), (None, "no id", "en")]
    labels = [(i, i % 2, 0) for i in range(60)] + [(3, 0, 0), (None, 1, 0), (104, 1, 0)]
    nets = []
    fit = quality.Network.fit
    monkeypatch.setattr(quality.Network, "fit", lambda self, *a: nets.append(fit(self, *a)) or nets[-1])
    got = quality.op5(spark, written(spark, tmp_path, docs, labels)).collect()
    assert sorted(str(x.doc_id) for x in got) == sorted(str(i) for i, *_ in docs)
    want = {}
    for i, text, _ in docs:
        want.setdefault(i, plainly_scored(nets[0], (text or "").encode()))
    for x in got:
        assert x.score == pytest.approx(want[x.doc_id], abs=1e-4) and x.predicted == int(x.score >= 0.3)
        assert x.held_out == (x.doc_id is not None and zlib.crc32(str(x.doc_id).encode()) % 5 == 0)


def test_registered_language_by_loops(spark, tmp_path):
    """op9 as registered: the prediction is the best of the ridge scores over the kernel with the landmarks, from sets of n-grams."""
    r = random.Random(42)
    words = {"aa": "kato mura sine toki pana lipu".split(), "bb": "strch ggrum zwolp pfant schlr".split(), "cc": "о не дом вода сила".split()}
    docs = [(i, " ".join(r.choice(words[v]) for _ in range(r.randrange(3, 40))), v) for i, v in enumerate(["aa", "bb", "cc"] * 40)]
    docs += [(500, None, "aa"), (501, "123 !?", "bb"), (502, "", None), (None, "kato mura", "aa"), (7, docs[7][1], "bb")]
    got = langid.op9(spark, written(spark, tmp_path, docs, [(1, 1, 0)])).collect()

    def grams(text):
        b = b" " + (text or "").encode().lower() + b" "
        place = lambda g, n: ((sum(c * 257 ** (n - 1 - j) for j, c in enumerate(g)) + ((n << 27) if n > 1 else 0)) * 2654435761 % 2**32) >> 19
        return {place(b[i : i + n], n) for n in (1, 2, 3) for i in range(len(b) - n + 1)}

    learned = langid.sample(spark.read.parquet(f"{tmp_path}/documents.parquet"), 5, 0)
    assert len(learned) == len({(i, v) for i, _, v in docs if i is not None and v and _ is not None and zlib.crc32(str(i).encode()) % 5})
    model = langid.Model.fit_packed([bytes(x) for *_, x in learned], [v for _, v, _ in learned])
    marks = [set(np.flatnonzero(c).tolist()) for c in model.landmarks.T]
    for x in got:
        text = next(t for i, t, _ in docs if i == x.doc_id)
        if not any(map(str.isalpha, text or "")):
            assert (x.lang_pred, x.score) == ("und", 0.0)
            continue
        g = grams(text)
        kernel = [len(g & m) / math.sqrt(len(g) * len(m)) for m in marks]
        s = [float(np.dot(kernel, model.weights[:, k]) + model.bias[k]) for k in range(len(model.languages))]
        assert model.languages[int(np.argmax(s))] == x.lang_pred
        assert x.score == pytest.approx(1 / sum(math.exp(4 * (v - max(s))) for v in s), abs=1e-3)
    right = [x.lang_pred == docs[x.doc_id][2] for x in got if x.held_out and x.doc_id is not None and x.doc_id < 120]
    assert len(right) > 10 and all(right)
