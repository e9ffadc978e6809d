"""The filtered semi-join: nothing lost, little let through, and only that shuffled."""

import pytest
from pyspark.sql import functions as F
from tickmill.operators import bloom, labels


@pytest.mark.parametrize("kind", ["long", "string"])
def test_semi_join(spark, kind):
    rows = spark.range(0, 200_000, 1, 8).select(F.when(F.col("id") % 11 != 0, (F.col("id") * 7 % 90_000).cast(kind)).alias("k"), F.col("id").alias("w0"))
    keys = spark.range(900).select((F.col("id") * 100).cast(kind).alias("key")).unionByName(spark.range(1).select(F.lit(None).cast(kind).alias("key")))
    want = {r.w0 for r in rows.join(keys, F.col("k") == F.col("key"), "left_semi").collect()}
    assert {r.w0 for r in bloom.semi_join(rows, "k", keys, "key").collect()} == want
    got = bloom.semi_join(rows, "k", keys, "key", broadcast_bytes=0)
    assert {r.w0 for r in got.collect()} == want and got.columns == rows.columns
    passed = bloom.passing(rows, "k", keys, "key", 900)
    assert len(want) <= passed.count() <= len(want) + 0.01 * rows.count()


def shuffled(df):
    """Records that the plan's exchanges wrote, by the rows of their output."""
    df.collect()
    found = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if name == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        for i in range(node.children().length()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_only_what_passes_is_shuffled(spark):
    """One line in a hundred is wanted: about one in a hundred is shuffled, not all of them."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = spark.range(0, 100_000, 1, 4).select(F.format_string('{"fen":"position %d w - -","evals":[]}', "id").alias("value"))
        wanted = spark.range(1000).select(F.format_string("position %d w - -", F.col("id") * 100).alias("epd"))
        got = labels.wanted_records(lines, wanted, broadcast_bytes=0)
        rows = shuffled(got)
        assert got.count() == 1000 and max(rows) < 2500 and sum(rows) > 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_of_any_spacing(spark):
    lines = spark.createDataFrame([('{"fen":"a b","evals":[]}',), ('{ "fen" : "a b", "evals": []}',), ('{"evals": [], "fen": "c"}',), ('{"fen":"cut',), ("",), (None,)], "value string")
    wanted = spark.createDataFrame([("a b",), ("c",), (None,)], "epd string")
    assert labels.wanted_records(lines, wanted).count() == 3 == labels.wanted_records(lines, wanted, 0).count()


def test_many_keys_and_few_blocks(spark, monkeypatch):
    """Beyond its bound the filter lets more through, and still loses nothing."""
    monkeypatch.setattr(bloom, "MOST_BLOCKS", 4)
    rows = spark.range(5000).withColumnRenamed("id", "k")
    assert bloom.semi_join(rows, "k", spark.range(0, 5000, 3), "id", 0).count() == 1667
    assert bloom.semi_join(rows, "k", spark.range(0), "id", 0).count() == 0
