"""Incremental ingest of game dumps as a Structured Streaming job: each file once, resumable, bounded per trigger.

The windowed report over an event stream is extra: the engine's batch operators don't need it.
"""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions import scores, text
from ..sources import store

_SEPARATOR = "\n\n[Event "


def game_stream(spark: SparkSession, folder: str, files_per_trigger: int = 8) -> DataFrame:
    rows = spark.readStream.option("lineSep", _SEPARATOR).option("maxFilesPerTrigger", files_per_trigger).text(folder).select("value", F.col("_metadata.file_path").alias("file"))
    whole = F.when(F.startswith(F.ltrim("value"), F.lit("[Event ")), F.col("value")).otherwise(F.concat(F.lit("[Event "), F.col("value")))
    return rows.where(F.btrim("value", F.lit(" \t\r\n")) != "").select(whole.alias("value"), "file")


def ingest(spark: SparkSession, folder: str, out: str, checkpoint: str, cfg: Config | None = None, files_per_trigger: int = 8) -> None:
    """Filters all files that no earlier run took: kept games to out/games by month, counts by reason to out/counts.

    The micro-batch id names the batch's output, so a batch that is tried again overwrites itself. A run with
    other settings than those before it is refused.
    """
    cfg = cfg or Config()
    store.check_manifest(spark, f"{out}/settings", {"settings": asdict(cfg)})

    def write(batch: DataFrame, number: int) -> None:
        marked = text.with_reason(batch, cfg).persist()
        try:
            kept = text.kept_games(marked, cfg).withColumn("month", F.date_format("utc_date", "yyyy-MM")).withColumn("batch", F.lit(number))
            kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("batch", "month").parquet(f"{out}/games")
            marked.groupBy("reason").count().withColumn("batch", F.lit(number)).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{out}/counts")
        finally:
            marked.unpersist()

    query = game_stream(spark, folder, files_per_trigger).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def report(spark: SparkSession, out: str) -> DataFrame:
    """Counts by reason over all runs, the most frequent first."""
    return spark.read.parquet(f"{out}/counts").groupBy("reason").agg(F.sum("count").alias("n")).orderBy(F.desc("n"), "reason")


def players_by_band(games: DataFrame, width: int = 200) -> DataFrame:
    """Both players of every game by class and rating band."""
    return games.select("tc_class", F.explode(F.array("white_elo", "black_elo")).alias("elo")).groupBy("tc_class", scores.band(F.col("elo"), width).alias("band")).agg(F.count("*").alias("n"))


def windowed_counts(events: DataFrame, delay: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Extra: events by type in tumbling windows, late ones dropped after the watermark."""
    at = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    return at.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value"))
