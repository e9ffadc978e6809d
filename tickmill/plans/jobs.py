"""The pipeline's jobs: each reads tables, writes tables, and returns its report. Run in order, or any one alone."""

from __future__ import annotations

from dataclasses import asdict
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import shared
from ..config import Config
from ..functions import text
from ..operators import labels, replay, reports, sampling, survival
from ..sources import database, records, store


def filter_games(spark: SparkSession, dump, out: str, cfg: Config | None = None, partitions: int | None = None) -> dict:
    """Kept games of a dump by month, and counts by reason from the same pass; of rejected games only the reason is written."""
    cfg = cfg or Config()
    store_path = f"{out}/_marked"
    marked = text.with_reason(records.read_games(spark, dump, partitions), cfg)
    marked.withColumns({c: F.when(F.col("reason") == "kept", F.col(c)) for c in marked.columns if c != "reason"}).write.mode("overwrite").option("compression", "zstd").partitionBy("reason").parquet(store_path)
    marked = spark.read.parquet(store_path)
    kept = text.kept_games(marked, cfg).withColumn("month", F.date_format("utc_date", "yyyy-MM"))
    store.write_table(kept, f"{out}/filtered", ["month"])
    return {r["reason"]: r["count"] for r in marked.groupBy("reason").count().collect()}


def bucket_games(spark: SparkSession, interim: str, database: str, buckets: int) -> None:
    """games and moves as catalogue tables in as many buckets by game, sorted: joins of the two, and windows over a game, then need no shuffle."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    store.write_bucketed(spark.read.parquet(f"{interim}/games"), f"{database}.games", "game_id", buckets)
    store.write_bucketed(spark.read.parquet(f"{interim}/moves"), f"{database}.moves", "game_id", buckets, ("ply",))


def parse_games(spark: SparkSession, interim: str, cfg: Config | None = None, months: list[str] | None = None) -> dict:
    """games and moves by month; moves of a game lie together, ordered. Given months replace their own and leave the others, which must have been made with the same settings."""
    games = records.read_months(spark, f"{interim}/filtered", months)
    meta, moves = replay.parse_moves(games, cfg)
    month = games.select("game_id", "month")
    moves = moves.join(month, "game_id").sortWithinPartitions("game_id", "ply")
    settings = {"settings": settings_of(cfg or Config())}
    if months:
        store.check_manifest(spark, f"{interim}/games_settings", settings)
    for df, name in ((meta, "games"), (moves, "moves")):
        if months:
            store.replace_partition(df, f"{interim}/{name}", "month")
        else:
            store.write_table(df, f"{interim}/{name}", ["month"])
    if not months:
        store.write_json(spark, f"{interim}/games_settings/_manifest.json", settings)
    done = spark.read.parquet(f"{interim}/games")
    return {r["e"] or "parsed": r["n"] for r in done.groupBy(F.col("parse_error").alias("e")).agg(F.count("*").alias("n")).collect()}


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path; None if nothing was written there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _games(spark: SparkSession, interim: str) -> DataFrame:
    return spark.read.parquet(f"{interim}/games").where("parse_error is null")


def join_puzzles(spark: SparkSession, path, interim: str, out: str) -> dict:
    found = replay.puzzle_outcomes(records.read_puzzles(spark, path), _games(spark, interim), spark.read.parquet(f"{interim}/moves"))
    store.write_table(found, f"{out}/puzzle_positions")
    return {r[0]: r[1] for r in spark.read.parquet(f"{out}/puzzle_positions").groupBy("outcome").count().collect()}


def sample_positions(spark: SparkSession, interim: str, out: str, cfg: Config | None = None, target: int | None = None) -> dict:
    cfg = cfg or Config()
    moves = spark.read.parquet(f"{interim}/moves")
    picked = sampling.stratified(sampling.game_candidates(moves, _games(spark, interim), cfg), target or cfg.sampling.target_positions, cfg.sampling)
    store.write_table(picked.drop("uci", "eval_white_cp", "eval_white_mate"), f"{out}/_picked")
    store.write_table(replay.replay_positions(spark.read.parquet(f"{out}/_picked"), moves, cfg), f"{out}/sampled_positions")
    return reports.sample_summary(spark.read.parquet(f"{out}/sampled_positions")).first().asDict()


def lookup_evaluations(spark: SparkSession, path, out: str, cfg: Config | None = None, also: tuple[str, ...] = ()) -> dict:
    """Database evaluations of the sampled positions (and of other position tables); lines are reduced to wanted positions before they are parsed."""
    cfg = cfg or Config()
    positions = spark.read.parquet(f"{out}/sampled_positions")
    wanted = positions.select("epd")
    for p in also:
        wanted = wanted.union(spark.read.parquet(p).select("epd"))
    raw = labels.wanted_records(records.read_lines(spark, path), wanted.distinct())
    matches = labels.parse_evaluations(raw, cfg, replay.first_legal_move)
    # of several records of a position the one of most nodes, then of most lines, then by move
    matches = matches.groupBy("epd").agg(F.max_by(F.struct(*(c for c in matches.columns if c != "epd")), F.struct("best_knodes", "n_pvs", "best_uci")).alias("_m")).select("epd", "_m.*").select(*matches.columns)
    store.write_table(matches, f"{out}/evaldb_matches")
    return labels.coverage_by(labels.covered(positions, spark.read.parquet(f"{out}/evaldb_matches"), cfg.multipv)).first().asDict()


def label(spark: SparkSession, out: str, evaluator, cfg: Config | None = None, batch: int = 50, limit: int | None = None) -> int:
    """Labels of the positions that the database doesn't cover and no earlier run labelled; evaluator makes an engine for a task.

    A task labels a unit of `batch` positions, and its file is in the table as soon as it is done, also if the job fails or is
    killed later (the committer's second algorithm); no unit waits for another. A run that is lost goes on with the
    positions that have no label. A run with other settings is refused.
    """
    cfg = cfg or Config()
    store.check_manifest(spark, f"{out}/labels_settings", {"settings": settings_of(cfg)})
    todo = labels.positions_to_label(spark.read.parquet(f"{out}/sampled_positions"), spark.read.parquet(f"{out}/evaldb_matches"), cfg.multipv)
    if (done := _existing(spark, f"{out}/labels")) is not None:
        todo = todo.join(done.select("position_id"), "position_id", "left_anti")
    if limit:
        todo = todo.orderBy("position_id").limit(limit)
    todo = shared.settled(todo)
    n = todo.count()
    if n:
        units = replay.label_positions(todo.repartition(-(-n // batch), "position_id"), evaluator)
        units.write.mode("append").option("compression", "zstd").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(f"{out}/labels")
    return n


def build_observations(spark: SparkSession, out: str, cfg: Config | None = None) -> dict:
    positions = spark.read.parquet(f"{out}/sampled_positions")
    store.write_table(labels.observations(positions, spark.read.parquet(f"{out}/labels"), cfg), f"{out}/labeled_observations")
    obs = spark.read.parquet(f"{out}/labeled_observations")
    if obs.count() != positions.count():
        raise ValueError("a label joined more than once")
    return reports.quality_report(obs, _existing(spark, f"{out}/evaldb_matches"), cfg)


def build_budgets(spark: SparkSession, out: str, cfg: Config | None = None, model: str = "m0") -> dict:
    cfg = cfg or Config()
    obs = spark.read.parquet(f"{out}/labeled_observations")
    store.replace_partition(survival.fit_budgets(obs, cfg).withColumn("model", F.lit(model)), f"{out}/budgets", "model")
    return survival.budget_report(survival.training_rows(obs, cfg), spark.read.parquet(f"{out}/budgets").where(F.col("model") == model), cfg)


def build_pool(spark: SparkSession, interim: str, out: str, cfg: Config | None = None) -> int:
    pool = replay.trainer_pool(spark.read.parquet(f"{out}/labeled_observations"), spark.read.parquet(f"{out}/labels"), spark.read.parquet(f"{interim}/moves"), cfg)
    store.write_table(pool, f"{out}/trainer_pool")
    return spark.read.parquet(f"{out}/trainer_pool").count()


def _served_positions(spark: SparkSession, out: str, snapshots: store.Snapshots, now: dict) -> tuple[str, dict]:
    """Writes the serving positions after an upsert of the pool; their place and the counts of the merge."""
    pool = spark.read.parquet(f"{out}/trainer_pool")
    if "positions" in now["tables"]:
        old = spark.read.parquet(f"{snapshots.folder}/{now['tables']['positions']}")
        merged, counts = store.upsert(old, pool, "position_id"), store.upsert_counts(old, pool, "position_id")
    else:
        merged, counts = pool.withColumn("active", F.lit(True)), {"added": pool.count(), "updated": 0, "deactivated": 0}
    place = snapshots.place("positions")
    store.write_serving(merged, f"{snapshots.folder}/{place}")
    return place, counts


def load_serving(spark: SparkSession, out: str, serving: str) -> dict:
    """A new version of the serving positions; returns their path, the version and the counts."""
    snapshots = store.Snapshots(spark, serving)
    now = snapshots.current()
    place, counts = _served_positions(spark, out, snapshots, now)
    return {"path": f"{serving}/{place}", "version": snapshots.commit(now, {"positions": place})["version"], **counts}


def load_app(spark: SparkSession, out: str, serving: str, cfg: Config | None = None, model: str = "m0") -> dict:
    """Everything that the application serves as one version: positions, a model's budgets beside other models', and a first user with default settings if there is none yet.

    Attempts are the application's own table, in the folder of that name. Settings and attempts that refer to a user or position
    that wouldn't be there stop the job before there is a new version.
    """
    cfg = cfg or Config()
    snapshots = store.Snapshots(spark, serving)
    now = snapshots.current()
    tables = {name: spark.read.parquet(f"{serving}/{path}") for name, path in now["tables"].items()}
    new: dict[str, str] = {}

    def put(name: str, df: DataFrame, partition_by: list[str] | None = None) -> None:
        new[name] = snapshots.place(name)
        store.write_table(df, f"{serving}/{new[name]}", partition_by)
        tables[name] = spark.read.parquet(f"{serving}/{new[name]}")

    if "users" not in tables:
        put("users", spark.range(1, 2).select(F.col("id").alias("user_id"), F.lit("local").alias("name"), F.lit(cfg.default_rating).alias("rating"), F.current_timestamp().alias("created_at")))
        mix = F.create_map(*(F.lit(x) for c in survival.TRAINABLE for x in (c, 1.0)))
        put("user_settings", spark.range(1, 2).select(
            F.col("id").alias("user_id"), F.lit(cfg.rating_offset).alias("target_offset"), F.lit(cfg.time_controls.supported[0]).alias("default_class"), F.lit("median").alias("strictness"),
            F.to_json(mix).alias("category_mix"), F.lit(True).alias("continue_after_budget"), F.current_timestamp().alias("updated_at"),
        ))
    if (attempts := _existing(spark, f"{serving}/attempts")) is not None:
        tables["attempts"] = attempts
    new["positions"], counts = _served_positions(spark, out, snapshots, now)
    store.check_references({**tables, "positions": spark.read.parquet(f"{serving}/{new['positions']}").select("position_id")})
    served = ("model", "tc_class", "category", "rating", "budget_s", "budget_strict_s", "p_inf", "sparse")
    mine = spark.read.parquet(f"{out}/budgets").where(F.col("model") == model).select(*served)
    others = [tables["category_budgets"].where(F.col("model") != model).select(*served)] if "category_budgets" in tables else []
    put("category_budgets", reduce(DataFrame.unionByName, [mine, *others]), ["model"])
    version = snapshots.commit(now, new)["version"]
    return {"positions": counts, "budget_rows": mine.count(), "model": model, "user_id": tables["users"].agg(F.min("user_id")).first()[0], "version": version}


def load_database(spark: SparkSession, out: str, url: str, cfg: Config | None = None, model: str = "m0") -> dict:
    """Positions, a model's budgets and a first user into the tables of a SQL database, each by one transaction; running it again changes nothing."""
    cfg = cfg or Config()
    pool = spark.read.parquet(f"{out}/trainer_pool")
    have = {c.lower() for c in database.read(spark, url, "positions", where="1 = 0").columns}
    positions = database.upsert(pool.select(*(c for c in pool.columns if c.lower() in have and c != "active")), url, "positions", "position_id")
    served = ("model", "tc_class", "category", "rating", "budget_s", "budget_strict_s", "p_inf", "sparse")
    budgets = database.replace(spark.read.parquet(f"{out}/budgets").where(F.col("model") == model).select(*served), url, "category_budgets", "model")
    users = database.insert_absent(spark.range(1, 2).select(F.col("id").alias("user_id"), F.lit("local").alias("name"), F.lit(cfg.default_rating).alias("rating")), url, "users", "user_id")
    return {"positions": positions, "budgets": budgets, "users_added": users}


def settings_of(cfg: Config) -> dict:
    return asdict(cfg)
