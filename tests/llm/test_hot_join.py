"""The hot-key join against nested loops, with and without spilling."""

import random
from collections import Counter

import pytest
from pyspark.sql import Row
from tickmill.llm import hot_join


def sides(seed=1, n=300, hot=0.35):
    r = random.Random(seed)
    key = lambda: None if r.random() < 0.05 else (7, "é") if r.random() < hot else (r.randrange(40), r.choice("ab"))
    made = []
    for side in range(2):
        rows = []
        for i in range(n):
            k = key() or (None, r.choice(["a", None]))
            rows.append((*k, i // 2, r.choice([None, i % 7, -i]), "x"))
        made.append(rows + rows[:20] + [rows[3]] * 9)
    return made


COLUMNS = "k long, name string, id long, v long, cell string"


def brute(left, right, how, ok=lambda a, b: True):
    out, seen = Counter(), set()
    for a in left:
        found = False
        for j, b in enumerate(right):
            if None not in a[:2] and a[:2] == b[:2] and ok(a, b):
                out[(a, b)] += 1
                found = True
                seen.add(j)
        if not found and how in ("left", "full"):
            out[(a, None)] += 1
    if how in ("right", "full"):
        for j, b in enumerate(right):
            if j not in seen:
                out[(None, b)] += 1
    return out


@pytest.fixture(params=["fits", "spills"])
def small(request, monkeypatch):
    """Hot keys at this size; in the second case tasks spill too, down to blocks of a single cell."""
    monkeypatch.setattr(hot_join, "LEAST_BLOCK", 10)
    if request.param == "spills":
        monkeypatch.setattr(hot_join, "BUDGET", 3000)
        monkeypatch.setattr(hot_join, "ROWS_OUT", 50)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
@pytest.mark.parametrize("condition", [None, "l.v < r.v OR r.v = 3"])
def test_join(spark, small, how, condition):
    left, right = sides()
    ok = (lambda a, b: (a[3] is not None and b[3] is not None and a[3] < b[3]) or b[3] == 3) if condition else (lambda a, b: True)
    a, b = (spark.createDataFrame(x, COLUMNS) for x in (left, right))
    got = Counter((None if r.l is None else tuple(r.l), None if r.r is None else tuple(r.r)) for r in hot_join.join(a, b, ["k", "name"], how, condition).collect())
    assert got == brute(left, right, how, ok)


def test_partners(spark, small):
    left, right = sides(2)
    a, b = (spark.createDataFrame(x, COLUMNS) for x in (left, right))
    got = {(r.left, r.k, r.name, r.id, r.partner_sum, r.partners, r.copies) for r in hot_join.partners(a, b, ["k", "name"], ("id", "id"), ("v", "v")).collect()}
    want = set()
    for side, mine, others in ((True, left, right), (False, right, left)):
        for (k, name, i, v), copies in Counter((k, name, i, v or 0) for k, name, i, v, _ in mine).items():
            met = [o for o in others if None not in (k, name) and o[:2] == (k, name)]
            want.add((side, k, name, i, sum(o[3] or 0 for o in met), len(met), copies))
    assert got == want


def test_edges(spark):
    empty, one = spark.createDataFrame([], COLUMNS), spark.createDataFrame([(1, "a", 1, None, "x")] * 3 + [(None, "a", None, 2, "x")], COLUMNS)
    assert hot_join.join(empty, empty, ["k"], "full").collect() == [] == hot_join.partners(empty, empty, ["k"], ("id", "id"), ("v", "v")).collect()
    assert hot_join.join(one, empty, ["k"], "left").count() == 4 and hot_join.join(empty, one, ["k"], "full").count() == 4
    assert hot_join.join(one, one, ["k"]).count() == 9
    assert sorted(r.copies for r in hot_join.partners(one, empty, ["k"], ("id", "id"), ("v", "v")).collect()) == [1, 3]
    with pytest.raises(ValueError):
        hot_join.join(one.selectExpr("cast(k as double) k"), one, ["k"])


def test_hot_rows_are_dealt(spark, monkeypatch):
    """No task gets a hot key whole: its rows spread over blocks, each with one row for the other side."""
    monkeypatch.setattr(hot_join, "LEAST_BLOCK", 10)
    seen = []
    task = hot_join._partner_task
    monkeypatch.setattr(hot_join, "_partner_task", lambda *a: seen.append(a) or task(*a))
    rows = [Row(k=5, id=i, v=1) for i in range(400)]
    df = spark.createDataFrame(rows)
    plan = hot_join.partners(df, df, ["k"], ("id", "id"), ("v", "v"))
    assert {(r.partners, r.partner_sum) for r in plan.collect()} == {(400, 400)} and seen
    hot = hot_join._hot(*[df.selectExpr("k AS k0", "v AS s", "true AS known")] * 2, ["k0"], 4).collect()
    assert [(r.bl, r.br) for r in hot] == [(4, 4)]


def test_registered_query(spark, tmp_path):
    """Broken rows: null ids, clients and amounts, ids that occur many times."""
    spark.createDataFrame([(1, 5, 1.005), (1, 5, 1.005), (2, 5, None), (None, 5, 2.0), (3, None, -0.004)], "click_id long, client_id long, value double").write.parquet(f"{tmp_path}/clicks.parquet")
    spark.createDataFrame([(9, 5, 7.0), (9, 5, 7.0), (11, 8, 1e9), (12, None, None)], "sale_id long, client_id long, total double").write.parquet(f"{tmp_path}/sales.parquet")
    from zlib import crc32

    def rows(ids, table):
        out = []
        for i, client, x in table:
            h = crc32(str(i).encode()) if i is not None else None
            k = h // 10 % 7 if h is not None and h % 10 < 3 else client
            import math

            out.append((ids, i, k, crc32(f"{'' if i is None else i}:{'' if x is None else math.floor(100 * x + 0.5)}".encode())))
        return out

    a = rows("click", [(1, 5, 1.005), (1, 5, 1.005), (2, 5, None), (None, 5, 2.0), (3, None, -0.004)])
    b = rows("sale", [(9, 5, 7.0), (9, 5, 7.0), (11, 8, 1e9), (12, None, None)])
    want = {}
    for mine, others in ((a, b), (b, a)):
        for side, i, k, _ in mine:
            met = [o for o in others if k is not None and o[2] == k]
            w = want.setdefault((side, i), [k, 0, 0, 0, 0, 0])
            for at, x in enumerate((1, len(met), max(1, len(met)) if side == "click" else len(met), max(1, len(met)), sum(o[3] for o in met)), 1):
                w[at] += x
    got = {(r.side, r.id): [r.client_id, r.copies, r.inner_rows, r.left_rows, r.full_rows, r.partner_crc] for r in hot_join.op11(spark, str(tmp_path)).collect()}
    assert got == want
