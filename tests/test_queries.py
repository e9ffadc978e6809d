"""Every registered query that has SQL equals it, on small tables of random rows in the driver's schemas."""

import datetime as dt
import importlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F
from tickmill.plans import registry

DDL = {
    "region": "r_regionkey int, r_name string", "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double", "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string", "documents": "doc_id long, text string, lang string, source string, n_chars long", "labels": "doc_id long, quality int, toxic int",
    "embeddings": "vec_id long, embedding array<float>, label int", "pages": "page_id long, url string, html string", "conversations": "conv_id long, turn long, role string, text string",
}


def rows(r):
    day = lambda: dt.datetime(1994, 1, 1) + dt.timedelta(days=r.randrange(2000))
    money = lambda a, b: round(r.uniform(a, b), 2)
    yield "region", [(0, "AFRICA"), (1, "ASIA")]
    yield "nation", [(i, f"N{i}", i % 2) for i in range(6)]
    yield "customer", [(i, f"C{i}", i % 6, money(-900, 9000), "B") for i in range(1, 90)]
    yield "supplier", [(i, f"S{i}", i % 6, money(-900, 9000)) for i in range(1, 20)]
    yield "part", [(i, f"P{i}", "b", "t", r.randrange(1, 51), money(900, 2000)) for i in range(1, 80)]
    yield "orders", [(i, r.randrange(1, 90), r.choice("FOP"), money(1000, 400000), day(), f"{r.randrange(1, 6)}-X") for i in range(1, 900)]
    yield "lineitem", [(r.randrange(1, 900), r.randrange(1, 80), r.randrange(1, 20), r.randrange(1, 8), float(r.randrange(1, 51)), money(900, 90000), r.randrange(11) / 100, r.randrange(9) / 100, r.choice("ANR"), r.choice("FO"), day()) for _ in range(4000)]
    yield "events", [(i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i * 7), r.randrange(20), r.choice(["click", "view", "buy"]), money(0, 300), '{"k": %d}' % r.randrange(100)) for i in range(1500)]
    yield "documents", [(i, f"text {i}", r.choice(["en", "fr"]), "s", 5) for i in range(60)]
    yield "labels", [(i, r.randrange(2), r.randrange(2)) for i in range(0, 60, 3)]
    yield "embeddings", [(i, [r.gauss(0, 1) for _ in range(64)], 0) for i in range(60)]
    yield "pages", [(i, f"https://h{i % 5}.org/a/{i}", "<a href=x>" if i % 2 else "<p>") for i in range(40)]
    yield "conversations", [(c, k, "user" if k % 2 == 0 else "assistant", "hello") for c in range(20) for k in range(r.randrange(1, 9))]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    for name, data in rows(random.Random(11)):
        spark.createDataFrame(data, DDL[name]).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    con = duckdb.connect()
    for name in DDL:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
    return folder, con


def plain(value):
    if isinstance(value, float):
        return "nan" if value != value else repr(round(value, 5))
    return "nan" if value is None else str(int(value)) if isinstance(value, bool) else str(value)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, tables, name):
    folder, con = tables
    got = registry.queries()[name](spark, folder)
    cursor = con.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(got.columns) == sorted(columns)
    want = sorted(tuple(plain(v) for _, v in sorted(zip(columns, r))) for r in cursor.fetchall())
    assert sorted(tuple(plain(r[c]) for c in sorted(got.columns)) for r in got.collect()) == want


def test_entry_without_the_optional_part(monkeypatch):
    import __spark_entry__ as entry

    assert set(registry.oracle_sql()) <= set(entry.oracle_sql()) and set(registry.queries()) <= set(entry.queries())
    monkeypatch.setattr(entry, "_llm", None)
    monkeypatch.setattr(entry, "_pipeline", None)
    assert set(entry.queries()) == set(registry.queries())
    importlib.reload(entry)


def test_filters_reach_the_scan(spark, tables):
    folder, _ = tables
    plan = registry.queries()["two_level_agg"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan.split("ReadSchema")[1]
    scan = spark.read.parquet(f"{folder}/orders.parquet").where(F.col("o_orderstatus") == "F").select("o_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in scan
