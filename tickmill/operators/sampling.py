"""Stratified two-stage sampling with weights, reproducible on any partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import shared
from ..config import Config, Sampling
from ..functions import scores
from . import ranks


def quotas(sizes: DataFrame, target: int, keys: list[str], size: str = "n", out: str = "quota") -> DataFrame:
    """Equal allocation by water-filling: strata smaller than an even share of what is left give all they have.

    sizes holds one row for each stratum, a table whose size doesn't grow with the data; its ranks come from an unpartitioned window.
    """
    by_size = Window.orderBy(F.col(size), *keys)
    upto = by_size.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    ranked = sizes.withColumns(
        {"_i": F.row_number().over(by_size), "_before": F.coalesce(F.sum(size).over(upto), F.lit(0)), "_c": F.count("*").over(everything), "_total": F.least(F.lit(target), F.sum(size).over(everything))}
    ).withColumn("_share", F.floor((F.col("_total") - F.col("_before")) / (F.col("_c") - F.col("_i") + 1)))
    first = F.min(F.when(F.col(size) > F.col("_share"), F.col("_i"))).over(everything)
    ranked = ranked.withColumn("_f", first)
    at_first = lambda c: F.max(F.when(F.col("_i") == F.col("_f"), F.col(c))).over(everything)
    ranked = ranked.withColumns({"_s": at_first("_share"), "_p": at_first("_before")})
    late = F.col("_i") >= F.col("_f")
    extra = F.col("_total") - F.col("_p") - F.col("_s") * (F.col("_c") - F.col("_f") + 1)
    by_key = F.sum(F.when(late, 1).otherwise(0)).over(Window.orderBy(*keys))
    full = F.coalesce(late, F.lit(False))
    return ranked.withColumn(out, F.when(~full, F.col(size)).otherwise(F.col("_s") + F.when(by_key <= extra, 1).otherwise(0)).cast("long")).select(*sizes.columns, out)


def eligible(moves: DataFrame, cfg: Sampling | None = None) -> DataFrame:
    """Decisions worth sampling: late enough, with a time, and by default neither instant nor in a berserk game."""
    cfg = cfg or Sampling()
    keep = F.col("time_spent_s").isNotNull() & (F.col("ply") >= cfg.min_ply)
    if cfg.exclude_premove_suspect:
        keep &= ~F.col("premove_suspect")
    if cfg.exclude_berserk:
        keep &= ~F.col("berserk")
    return moves.where(keep)


def game_candidates(moves: DataFrame, games: DataFrame, cfg: Config | None = None) -> DataFrame:
    """Stage 1: up to positions_per_game random eligible plies of each game of a supported class, with the mover's rating."""
    cfg = cfg or Config()
    s = cfg.sampling
    meta = games.where(F.col("tc_class").isin(*cfg.time_controls.supported)).select("game_id", "month", "tc_class", "base_s", "increment_s", "white_elo", "black_elo")
    drop = [c for c in ("month", "tc_class", "base_s", "increment_s") if c in moves.columns]
    rows = eligible(moves, s).drop(*drop).join(meta, "game_id")
    game = Window.partitionBy("game_id")
    white = F.col("side") == 0
    rows = rows.withColumns(
        {
            "u1": scores.uniform(f"{cfg.seed}:game", F.col("game_id"), F.col("ply")),
            "stage2_u": scores.uniform(f"{cfg.seed}:stratum", F.col("game_id"), F.col("ply")),
            "mover_elo": F.when(white, F.col("white_elo")).otherwise(F.col("black_elo")),
            "opp_elo": F.when(white, F.col("black_elo")).otherwise(F.col("white_elo")),
            "game_eligible_plies": F.count("*").over(game),
        }
    )
    rows = rows.withColumn("_r", F.row_number().over(game.orderBy("u1", "ply"))).where(F.col("_r") <= s.positions_per_game)
    return rows.withColumn("game_sampled_plies", F.count("*").over(game)).drop("_r", "u1", "white_elo", "black_elo")


STRATUM = ["tc_class", "rating_band", "ply_bucket"]
#: Bins of a stratum's uniforms: beyond its quota, only the last bin's rows are sorted with it.
BINS = 4096


def stratified(candidates: DataFrame, target: int | None = None, cfg: Sampling | None = None) -> DataFrame:
    """Stage 2: each stratum's quota of the candidates of smallest uniform, with weights that undo both stages; null strata are strata. Exact on any data: a stratum gives less than its quota only if it has no more."""
    cfg = cfg or Sampling()
    rows = candidates.withColumns({"rating_band": scores.band(F.col("mover_elo"), cfg.rating_band_width), "ply_bucket": scores.bucket_floor(F.col("ply"), cfg.min_ply, cfg.ply_bucket_edges)})
    # uniforms in bins: a stratum's counts give its size and the bin that its quota-th smallest uniform is in, whatever their distribution
    cell = F.least(F.floor(F.col("stage2_u") * BINS), F.lit(BINS - 1)).cast("int")
    counts = shared.settled(rows.groupBy(*STRATUM, cell.alias("_bin")).agg(F.count("*").alias("_n")))
    wanted = quotas(counts.groupBy(*STRATUM).agg(F.sum("_n").alias("stratum_candidates")), target or cfg.target_positions, STRATUM, "stratum_candidates", "stratum_sampled")
    upto = F.sum("_n").over(Window.partitionBy(*STRATUM).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0))
    last = ranks.joined(counts.withColumn("_upto", upto), wanted, STRATUM).groupBy(*STRATUM, "stratum_candidates", "stratum_sampled").agg(F.min(F.when(F.col("_upto") >= F.col("stratum_sampled"), F.col("_bin"))).alias("_last"))
    near = ranks.joined(rows.withColumn("_bin", cell), shared.maybe_broadcast(shared.settled(last)), STRATUM).where(F.col("_bin") <= F.col("_last"))
    rank = F.row_number().over(Window.partitionBy(*STRATUM).orderBy("stage2_u", "game_id", "ply"))
    rows = near.withColumn("_r", rank).where(F.col("_r") <= F.col("stratum_sampled"))
    weight = (F.col("game_eligible_plies") / F.col("game_sampled_plies")) * (F.col("stratum_candidates") / F.col("stratum_sampled"))
    return rows.withColumn("sampling_weight", weight).drop("_r", "stage2_u", "_bin", "_last")
