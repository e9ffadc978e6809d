"""Sources: game dumps, evaluation and puzzle dumps (plain or compressed), and report sidecars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import dumps

_SEPARATOR = "\n\n[Event "


#: Endings of compressed dumps, which the dump source reads; Spark splits plain text by itself.
_PACKED = (".zst", ".gz", ".bz2")


def read_games(spark: SparkSession, path, partitions: int | None = None) -> DataFrame:
    """One row (value, file) for each game record of a plain or compressed dump, also of one that was cut short; dealt to `partitions` if given."""
    if str(path).endswith(_PACKED):
        rows = dumps.read_records(spark, str(path), _SEPARATOR)
        return rows.repartition(partitions) if partitions else rows
    rows = spark.read.option("lineSep", _SEPARATOR).text(path).select(F.col("value"), F.col("_metadata.file_path").alias("file"))
    whole = F.when(F.startswith(F.ltrim("value"), F.lit("[Event ")), F.col("value")).otherwise(F.concat(F.lit("[Event "), F.col("value")))
    rows = rows.where(F.btrim("value", F.lit(" \t\r\n")) != "").select(whole.alias("value"), "file")
    return rows.repartition(partitions) if partitions else rows


def read_lines(spark: SparkSession, path) -> DataFrame:
    """Lines of JSONL files, plain or compressed; a last line that is cut short is dropped by whoever parses it."""
    return dumps.read_records(spark, str(path), "\n").select("value") if str(path).endswith(_PACKED) else spark.read.text(path)


def read_puzzles(spark: SparkSession, path) -> DataFrame:
    """The typed puzzle table of CSV files; nothing is inferred. Moves that lack a reply have a null solution."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    moves = F.split("Moves", " ")
    url = F.col("GameUrl")
    found = lambda p: F.nullif(F.regexp_extract(url, p, 1), F.lit(""))
    return raw.select(
        F.col("PuzzleId").alias("puzzle_id"), F.col("FEN").alias("fen_before"), moves.alias("moves"), F.get(moves, F.lit(0)).alias("setup_uci"), F.get(moves, F.lit(1)).alias("solution_uci"),
        F.col("Rating").cast("short").alias("puzzle_rating"), F.col("RatingDeviation").cast("short").alias("rating_deviation"), F.col("Popularity").cast("byte").alias("popularity"), F.col("NbPlays").cast("int").alias("nb_plays"),
        F.split("Themes", " ").alias("themes"), found(r"\.org/(\w{8})").alias("game_id"), found(r"#(\d+)$").cast("int").alias("setup_ply"),
        # the URL names the side that made the setup move
        F.when(F.contains(url, F.lit("/black#")), "w").otherwise("b").alias("solver_side"), F.split("OpeningTags", " ").alias("opening_tags"),
    )


def read_months(spark: SparkSession, path: str, months: list[str] | None = None) -> DataFrame:
    """A table in month=YYYY-MM folders; other months' files aren't opened."""
    df = spark.read.parquet(path)
    return df.where(F.col("month").isin(*months)) if months else df


def read_sidecars(spark: SparkSession, folder: str) -> list[dict]:
    """All JSON reports of a folder by file name; reports are few."""
    rows = spark.read.option("multiLine", True).option("pathGlobFilter", "*.json").json(folder).select("*", F.col("_metadata.file_name").alias("_file")).collect()
    return [{k: v for k, v in r.asDict(True).items() if k != "_file"} for r in sorted(rows, key=lambda r: r["_file"])]
