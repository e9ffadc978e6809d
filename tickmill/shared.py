"""Results kept between jobs, rows dealt for costly steps, and broadcasts of measured size."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most bytes that are broadcast, as rows take them in memory; beyond it the join shuffles.
BROADCAST_BYTES = 64 << 20


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, which driver and executors share; without one, a temporary folder, which only a local master may use."""
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not given:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: executors need a folder that they share with the driver")
        given = tempfile.mkdtemp(prefix="tickmill-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(given)
    return given.rstrip("/")


def settled(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the checkpoint folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """df's rows dealt evenly over as many partitions as the session shuffles into, and at least one a core: for rows of few bytes that cost much, of which one split of a file would hold too many."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def row_bytes(df: DataFrame) -> int:
    """About what df's rows take in memory; df should be settled, since measuring computes it."""
    row = F.lit(32 + 8 * len(df.columns)).cast("long")
    for f in df.schema:
        kind = f.dataType.simpleString()
        if kind in ("string", "binary"):
            row = row + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif kind.startswith("array"):
            row = row + 8 * F.coalesce(F.size(f.name), F.lit(0))
    return df.agg(F.sum(row)).first()[0] or 0


def maybe_broadcast(df: DataFrame, most: int | None = None) -> DataFrame:
    """df with a broadcast hint if its rows, measured, take at most `most` bytes, else df as it is."""
    return F.broadcast(df) if row_bytes(df) <= (BROADCAST_BYTES if most is None else most) else df
