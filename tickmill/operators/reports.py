"""Report queries: aggregates over the pipeline's tables, each small enough to print."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions import scores
from . import labels, ranks


def _share(c, name: str):
    return F.avg(c.cast("double")).alias(name)


def timing_by_band(moves: DataFrame, games: DataFrame, width: int = 200) -> DataFrame:
    """Decisions with a time by class and the mover's rating band: count, median and nearest 90 % time."""
    elo = F.when(F.col("side") == 0, F.col("white_elo")).otherwise(F.col("black_elo"))
    j = moves.where("time_spent_s is not null").select("game_id", "side", "time_spent_s").join(games.select("game_id", "tc_class", "white_elo", "black_elo"), "game_id")
    rows = j.select("tc_class", scores.band(elo, width).alias("band"), "time_spent_s")
    return ranks.described(rows, ["tc_class", "band"], "time_spent_s", {}, "median_s", ("p90_s", 0.9)).orderBy("tc_class", "band")


def timing_by_control(moves: DataFrame, games: DataFrame, least: int = 10_000) -> DataFrame:
    """The same by exact time control, those with enough decisions."""
    j = moves.where("time_spent_s is not null").select("game_id", "time_spent_s").join(games.select("game_id", "tc_class", "base_s", "increment_s"), "game_id")
    rows = j.select("tc_class", F.concat_ws("+", F.col("base_s").cast("string"), F.col("increment_s").cast("string")).alias("control"), "time_spent_s")
    return ranks.described(rows, ["tc_class", "control"], "time_spent_s", {}, "median_s").where(F.col("n") >= least).orderBy(F.desc("n"), "control")


def flag_shares(moves: DataFrame) -> DataFrame:
    """Shares of flagged moves and of moves with an evaluation."""
    return moves.agg(F.count("*").alias("n"), *(_share(F.col(c), c) for c in ("premove_suspect", "low_clock", "berserk", "time_added")), _share(F.col("eval_white_cp").isNotNull() | F.col("eval_white_mate").isNotNull(), "has_eval"))


def sample_strata(sampled: DataFrame) -> DataFrame:
    """Candidates, sample and its share by class and band, from one row for each stratum."""
    one = sampled.groupBy("tc_class", "rating_band", "ply_bucket").agg(F.max("stratum_candidates").alias("candidates"), F.count("*").alias("sampled"))
    return one.groupBy("tc_class", "rating_band").agg(F.sum("candidates").alias("candidates"), F.sum("sampled").alias("sampled"), (F.sum("sampled") / F.sum("candidates")).alias("share")).orderBy("tc_class", "rating_band")


def sample_summary(sampled: DataFrame) -> DataFrame:
    return sampled.agg(F.count("*").alias("n"), F.countDistinct("game_id").alias("games"), F.countDistinct(F.struct("tc_class", "rating_band", "ply_bucket")).alias("strata"), F.min("sampling_weight").alias("least_weight"), F.max("sampling_weight").alias("largest_weight"), F.sum("sampling_weight").alias("population"))


def label_summary(labels: DataFrame) -> DataFrame:
    """Depth, nodes and lines of labels, and how many losses are small."""
    losses = F.transform("played", lambda p: p["loss_win_pct"])
    return labels.agg(F.count("*").alias("n"), F.avg("depth").alias("mean_depth"), F.median("depth").alias("median_depth"), F.avg(F.size("lines")).alias("mean_lines"), F.median("best_move_stable_depth").alias("median_stable_depth"), _share(F.size("lines") <= 1, "one_line"), F.sum(F.size(F.filter(losses, lambda x: x <= 1))).alias("losses_up_to_1"))


def puzzle_solving(puzzles: DataFrame, width: int = 200) -> DataFrame:
    """Share solved and median time by puzzle rating band, of kept puzzles."""
    return puzzles.where("outcome = 'kept'").groupBy(scores.band(F.col("puzzle_rating"), width).alias("band")).agg(F.count("*").alias("n"), F.bround(F.avg(F.col("played_solution").cast("double")), 3).alias("solved"), F.median("time_spent_s").alias("median_s")).orderBy("band")


def puzzle_times(puzzles: DataFrame) -> DataFrame:
    return puzzles.where("outcome = 'kept'").groupBy("tc_class", "played_solution").agg(F.count("*").alias("n"), F.median("time_spent_s").alias("median_s"))


def pool_counts(pool: DataFrame, cfg: Config | None = None) -> DataFrame:
    """Positions of the pool by category, source class, band and phase, one list of (dimension, value, n)."""
    band = scores.band(F.col("source_rating"), (cfg or Config()).puzzle_band_width).cast("string")
    parts = [("category", F.col("category")), ("source_class", F.col("source_tc_class")), ("source_band", band), ("phase", F.col("phase"))]
    return pool.select(F.explode(F.array(*(F.struct(F.lit(n).alias("dimension"), c.alias("value")) for n, c in parts))).alias("x")).groupBy("x.dimension", "x.value").agg(F.count("*").alias("n")).orderBy("dimension", "value")


def observation_checks(obs: DataFrame) -> DataFrame:
    """Data quality of labelled decisions: how far played moves stand above the best, and domains."""
    o = obs.where("loss_win_pct is not null")
    return o.agg(F.count("*").alias("n"), _share(F.col("loss_win_pct") < -1, "above_best_by_1"), _share(F.col("loss_win_pct") < -5, "above_best_by_5"), F.bool_and(F.col("best_win_pct").between(0, 100)).alias("win_in_range"), F.bool_and(F.col("sampling_weight") > 0).alias("weights_positive"), F.bool_and(F.coalesce(F.col("gap_1_2"), F.lit(0.0)) >= 0).alias("lines_sorted"))


def quality_report(obs: DataFrame, matches: DataFrame | None = None, cfg: Config | None = None, width: int = 200) -> dict:
    """What build_observations prints: checks, rates, tables by state, by category and by class, band and state, and the agreement with database evaluations if there are any. Sizes don't grow with the data."""
    cfg = cfg or Config()
    found = obs.where("loss_win_pct is not null")
    y, best = F.col("y").cast("double"), F.col("is_best").cast("double")
    rates = found.agg(
        F.avg(y).alias("y_sample"), scores.weighted_rate(y, F.col("sampling_weight")).alias("y_population"), scores.weighted_rate(best, F.col("sampling_weight")).alias("best_population"),
        _share(F.col("played_in_multipv"), "played_in_multipv"), _share(F.col("loss_win_pct") < 0, "negative_loss"),
    ).first().asDict()
    rows = lambda df: [r.asDict() for r in df.collect()]
    report = {"observations": obs.count(), "tau_win_pct": cfg.acceptability.tau_win_pct, **observation_checks(obs).first().asDict(), **rates}
    report["by_state"] = rows(labels.acceptance_by(obs, "position_state").orderBy("position_state"))
    report["by_category"] = rows(labels.category_mix(obs))
    by = ["tc_class", "band", "position_state"]
    report["by_class_band_state"] = rows(labels.acceptance_by(obs.withColumn("band", scores.band(F.col("mover_elo"), width)), *by).orderBy(*by))
    if matches is not None:
        report["evaluation_check"] = labels.evaluation_check(obs, matches, cfg.acceptability.tau_win_pct).first().asDict()
    return report
