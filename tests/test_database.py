"""Database sinks against Derby, which Spark brings along."""

import pytest
from pyspark.sql import functions as F
from tickmill.sources import database, store

POOL = "position_id varchar(40), fen varchar(90), source_rating int, lines varchar(2000), active boolean"


@pytest.fixture
def url(spark, tmp_path):
    u = f"jdbc:derby:{tmp_path}/db;create=true"
    database._execute(spark, u, [f"CREATE TABLE positions ({POOL})", "CREATE TABLE budgets (model varchar(8), rating int, budget_s double)", "CREATE TABLE users (user_id bigint, name varchar(20))"])
    return u


def pool(spark, ids, rating):
    return spark.createDataFrame([(f"p{i}", f"fen {i}", rating + i, [("e2e4", 5)]) for i in ids], "position_id string, fen string, source_rating int, lines array<struct<uci:string,cp:int>>")


def rows(spark, url, table="positions"):
    return sorted((tuple(r) for r in database.read(spark, url, table).collect()), key=str)


def test_upsert(spark, url):
    assert database.upsert(pool(spark, range(300), 1000), url, "positions", "position_id", parts=4) == {"merged": 300, "deactivated": 0}
    new = pool(spark, range(100, 350), 2000)
    assert database.upsert(new, url, "positions", "position_id", parts=4) == {"merged": 250, "deactivated": 100}
    once = rows(spark, url)
    assert database.upsert(new, url, "positions", "position_id", parts=3)["deactivated"] == 0 and rows(spark, url) == once  # again: the same
    # the same as the table operator's merge
    old = pool(spark, range(300), 1000).withColumn("lines", F.to_json("lines")).withColumn("active", F.lit(True))
    want = store.upsert(old, new.withColumn("lines", F.to_json("lines")), "position_id").select("position_id", "fen", "source_rating", "lines", "active")
    assert once == sorted((tuple(r) for r in want.collect()), key=str)
    assert database.tables(spark, url) >= {"positions"} and not any(t.endswith("_staged") for t in database.tables(spark, url))


def test_lost_write(spark, url):
    """A write that breaks leaves the table as it was; its staging table doesn't stop the next one."""
    database.upsert(pool(spark, range(5), 1000), url, "positions", "position_id")
    before = rows(spark, url)
    with pytest.raises(Exception):
        database.upsert(pool(spark, [1, 1], 9), url, "positions", "position_id")  # a key twice
    assert rows(spark, url) == before and "positions_staged" in database.tables(spark, url)
    assert database.upsert(pool(spark, range(5), 1000), url, "positions", "position_id")["merged"] == 5 and rows(spark, url) == before


def test_replace_and_insert(spark, url):
    budgets = lambda model, n: spark.createDataFrame([(model, i, i / 2) for i in range(n)], "model string, rating int, budget_s double")
    database.replace(budgets("m0", 4).union(budgets("m1", 2)), url, "budgets", "model")
    assert database.replace(budgets("m0", 3), url, "budgets", "model") == {"deleted": 4, "inserted": 3}
    assert [r[0] for r in rows(spark, url, "budgets")] == ["m0"] * 3 + ["m1"] * 2
    users = spark.createDataFrame([(1, "local")], "user_id long, name string")
    assert [database.insert_absent(users, url, "users", "user_id") for _ in range(2)] == [1, 0]


def test_partitioned_read(spark, url):
    database.replace(spark.range(0, 1000, 1, 4).select(F.lit("m").alias("model"), F.col("id").cast("int").alias("rating"), F.lit(1.0).alias("budget_s")), url, "budgets", "model")
    df = database.read(spark, url, "budgets", "rating", 5)
    assert df.rdd.getNumPartitions() == 5 and sorted(r.RATING for r in df.collect()) == list(range(1000))
    assert max(len(p) for p in df.rdd.glom().collect()) <= 250
    assert database.read(spark, url, "budgets", "rating", 5, "rating >= 990").count() == 10
    assert database.read(spark, url, "users", "user_id").count() == 0
    plan = df.where("rating < 10")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "LessThan" in plan
