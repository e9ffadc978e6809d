"""Quantiles, curves, monotone fits and samples against sequential brute force, with groups whole and cut into ranges."""

import math
import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from tickmill.config import Sampling
from tickmill.operators import ranks, sampling, survival


@pytest.fixture(params=["whole", "ranges"])
def cut(request, monkeypatch):
    if request.param == "ranges":
        monkeypatch.setattr(ranks, "LARGEST", 50)
        monkeypatch.setattr(ranks, "RANGES", 8)
    return request.param


def quantile(rows, q):
    total, cum = sum(Decimal(repr(w)) for _, w in rows), Decimal(0)
    for v, w in sorted(rows):
        cum += Decimal(repr(w))
        if float(cum) >= q * float(total):
            return v


def test_weighted_quantiles(spark, cut):
    r = random.Random(8)
    groups = {k: [(r.choice([r.randrange(30), r.random() * 30, -r.randrange(5)]), round(r.random() * 3, r.randrange(1, 12))) for _ in range(r.choice([1, 2, 700, 1500]))] for k in [*range(40), None]}
    rows = [(k, float(v), w) for k, vs in groups.items() for v, w in vs] + [(None, None, 1.0), (99, None, 1.0), (98, 2.0, None)]
    qs = {"a": 0.001, "b": 0.1, "c": 0.5, "d": 0.9, "e": 1.0}
    got = {x.k: x for x in survival.weighted_quantile(spark.createDataFrame(rows, "k long, v double, w double"), ["k"], "v", "w", qs).collect()}
    assert set(got) == {*groups, 98}
    for k, vs in groups.items():
        whole = {}  # as one weight for each value, or the order of equal values would matter
        for v, w in vs:
            whole[v] = whole.get(v, 0) + Decimal(repr(w))
        assert [got[k][n] for n in qs] == [quantile([(v, float(w)) for v, w in whole.items()], q) for q in qs.values()]


def test_described(spark, cut):
    r = random.Random(9)
    rows = [(r.choice(["a", "b", None]), r.choice([None, float(r.randrange(8)), r.random() * 9]), r.random() < 0.3) for _ in range(900)] + [("empty", None, True)]
    got = {x.k: x for x in ranks.described(spark.createDataFrame(rows, "k string, v double, f boolean"), ["k"], "v", {"share": ranks.mean(F.col("f"))}, "m", ("p", 0.9)).collect()}
    for k in ("a", "b", None, "empty"):
        vs = sorted(v for kk, v, _ in rows if kk == k and v is not None)
        fs = [f for kk, _, f in rows if kk == k]
        assert got[k].n == len(fs) and got[k].share == pytest.approx(sum(fs) / len(fs))
        if vs:
            assert got[k].m == pytest.approx(statistics.median(vs)) and got[k].p == vs[math.floor(0.9 * (len(vs) - 1) + 0.5)]
        else:
            assert got[k].m is None and got[k].p is None
    numbered = ranks.numbered(spark.range(300).withColumn("k", F.col("id") % 3), ["k"], "id", "n").collect()
    assert all(x.n == x.id // 3 + 1 for x in numbered)


def curve(times, found, weights, q):
    """The survival product in time order."""
    pooled = {}
    for t, f, w in zip(times, found, weights):
        e, total = pooled.get(t, (0.0, 0.0))
        pooled[t] = (e + (w if f else 0.0), total + w)
    risk, left = sum(total for _, total in pooled.values()), 1.0
    for t in sorted(pooled):
        e, total = pooled[t]
        if e > 0:
            before, left = 1 - left, left * (1 - e / risk)
            after = 1 - left
            if after >= q - survival.TOLERANCE:
                lo = max(t - 0.5, 0.0)
                return min(t + 0.5, lo + (t + 0.5 - lo) * (q - before) / (after - before))
        risk -= total
    return None


def curves(spark, made, qs=(0.25, 0.5, 0.75)):
    rows = [(k, float(t), f, float(w)) for k, group in enumerate(made) for t, f, w in group]
    df = spark.createDataFrame(rows, "k int, t double, y boolean, w double")
    got = {x.k: x for x in survival.km_quantiles(survival.km_cells(df, ["k"], "t", "y", "w"), ["k"], {f"q{i}": q for i, q in enumerate(qs)}).collect()}
    for k, group in enumerate(made):
        for i, q in enumerate(qs):
            want = curve(*zip(*group), q)
            assert got[k][f"q{i}"] == (pytest.approx(want, abs=1e-6) if want is not None else None), (k, q, group)


def test_curves_that_just_reach(spark, cut):
    """The share is reached exactly: half of n found one after another, the rest never, for every even n; and tied late finds."""
    made = [[(t, True, 1) for t in range(n // 2)] + [(200, False, 1)] * (n // 2) for n in range(2, 80, 2)]
    made += [[(3, True, 1), (7, True, 1), (40, True, 1), (40, True, 1), (50, False, 1), (50, False, 1), (50, False, 1), (50, False, 1)], [(4, False, 2), (4, True, 2)], [(6, False, 1), (9, False, 3)]]
    curves(spark, made, (0.5,))


def test_random_curves(spark):
    r = random.Random(10)
    made = [[(r.randrange(12), r.random() < 0.7, r.choice([1, 1, 2, 0.1, 0.3, 2.5])) for _ in range(r.randrange(1, 14))] for _ in range(10_000)]
    curves(spark, made)


def test_long_curves(spark, cut):
    r = random.Random(11)
    curves(spark, [[(r.random() * 400, r.random() < p, r.random() + 0.1) for _ in range(600)] for p in (0.02, 0.5, 0.97)])


def pava(values, weights):
    out = []
    for v, w in zip(values, weights):
        out.append([v, w, 1])
        while len(out) > 1 and out[-2][0] > out[-1][0]:
            b, a = out.pop(), out.pop()
            out.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return [v for v, _, n in out for _ in range(n)]


def test_isotonic_against_pooling(spark, cut):
    r = random.Random(12)
    shapes = {"rising": lambda i: i, "falling": lambda i: -i, "noise": lambda i: r.random(), "ties": lambda i: r.randrange(3), "trend": lambda i: i / 40 + r.random()}
    made = {name: [(float(f(i)), r.choice([1.0, 2.0, 0.25])) for i in range(200)] for name, f in shapes.items()}
    rows = [(k, i, v, w) for k, points in made.items() for i, (v, w) in enumerate(points)] + [("rising", 500, None, 1.0), (None, 1, 5.0, 1.0)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, x int, v double, w double").withColumn("u", -F.col("v"))
    got = survival.isotonics(df, ["k"], "x", "w", {"up": ("v", True), "down": ("u", False)}).collect()
    assert len(got) == len(rows)
    for k, points in made.items():
        mine = sorted((x for x in got if x.k == k and x.v is not None), key=lambda x: x.x)
        want = pava(*zip(*points))
        assert [x.up for x in mine] == pytest.approx(want) and [-x.down for x in mine] == pytest.approx(want)
    assert [x.up for x in got if x.k is None] == [5.0] and [x.up for x in got if x.x == 500] == [None]


def test_isotonic_of_many_points(spark, monkeypatch):
    monkeypatch.setattr(ranks, "LARGEST", 20_000)
    r = random.Random(13)
    values = [math.sin(i / 9000) * 5 + i / 30_000 + r.gauss(0, 2) for i in range(100_000)]
    df = spark.createDataFrame([(1, i, v, 1.0) for i, v in enumerate(values)], "k int, x int, v double, w double").repartition(4)
    got = survival.isotonic(df, ["k"], "x", "v", "w", True, "fit").orderBy("x").select("fit").collect()
    assert [x.fit for x in got] == pytest.approx(pava(values, [1.0] * len(values)))


CANDIDATE = "game_id string, ply int, mover_elo int, tc_class string, stage2_u double, game_eligible_plies long, game_sampled_plies long"


@pytest.mark.parametrize("uniform", ["even", "repeated", "skewed", "constant"])
def test_strata_get_their_quotas(spark, uniform):
    """Whatever the uniforms: each stratum's rows are its smallest ones, and as many as its quota."""
    r = random.Random(14)
    draw = {"even": r.random, "repeated": lambda: r.choice([0.1, 0.5, 0.9]), "skewed": lambda: 1 - r.random() ** 8 * 1e-3, "constant": lambda: 1.0}[uniform]
    rows = [(f"g{i:05d}", 12 + i % 50, 1000 + 100 * (i % 7 if i % 3 else 0), "blitz" if i % 5 else None, draw(), 1, 1) for i in range(4000)]
    got = sampling.stratified(spark.createDataFrame(rows, CANDIDATE), 600, Sampling()).collect()
    strata = {}
    for g, ply, elo, tc, u, *_ in rows:
        strata.setdefault((tc, elo // 100 * 100, 60 if ply >= 60 else 40 if ply >= 40 else 20 if ply >= 20 else 10), []).append((u, g, ply))
    assert len(got) == 600
    by = {}
    for x in got:
        by.setdefault((x.tc_class, x.rating_band, x.ply_bucket), []).append((x.game_id, x.ply, x.stratum_sampled))
    for k, mine in by.items():
        assert len(mine) == mine[0][2] and {(g, p) for g, p, _ in mine} == {(g, p) for _, g, p in sorted(strata[k])[: len(mine)]}


def shared_out(sizes, target):
    """Water-filling, one stratum after the other: the smaller ones give all they have while that is below an even share of what is left."""
    left, order, out = min(target, sum(sizes.values())), sorted(sizes, key=lambda k: (sizes[k], k)), {}
    for i, k in enumerate(order):
        share = left // (len(order) - i)
        if sizes[k] > share:
            rest = sorted(order[i:])
            return out | {x: share + (j < left - share * len(rest)) for j, x in enumerate(rest)}
        out[k] = sizes[k]
        left -= sizes[k]
    return out


def test_quotas(spark):
    r = random.Random(15)
    for _ in range(6):
        sizes = {f"k{i}": r.choice([0, 1, 7, r.randrange(90)]) for i in range(r.randrange(1, 9))}
        target = r.randrange(1, 150)
        got = sampling.quotas(spark.createDataFrame(list(sizes.items()), "k string, n long"), target, ["k"])
        assert {x.k: x.quota for x in got.collect()} == shared_out(sizes, target)
