"""Clock state by ordered windows: time spent, berserk starts, added time, and what happened before a decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Clock


def berserk_start(first: Column, base: Column, tolerance: float) -> Column:
    """A first clock at half the base time."""
    return (base > 2 * tolerance) & (F.abs(first - base / 2) <= tolerance)


def move_timings(moves: DataFrame, cfg: Clock | None = None, key: str = "game_id", order: str = "ply", clock: str = "clk") -> DataFrame:
    """Adds the timing of each move to (key, order, clock, base_s, increment_s, tc_class); order counts from 1.

    time_spent_s is null for each side's first move and where time was added to the clock. One shuffle on the key
    serves all windows. Null clocks give null times; an unknown class is never low on time.
    """
    cfg = cfg or Clock()
    game = Window.partitionBy(key).orderBy(order)
    own = Window.partitionBy(key, "side").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    clk = F.col(clock)
    low = F
    for label, bound in cfg.low_clock_s:
        low = low.when(F.col("tc_class") == label, F.col("own_clk_before_s") < bound)
    raw = F.col("own_clk_before_s") - clk + F.when(F.col("berserk"), 0).otherwise(F.col("increment_s"))
    added = (F.col(order) > 2) & (F.col("raw") < -cfg.noise_tolerance_s)
    out = moves.withColumn("side", F.pmod(F.col(order) - 1, F.lit(2)).cast("int")).withColumns(
        {
            "own_clk_before_s": F.coalesce(F.lag(clk, 2).over(game), clk),
            "opp_clk_s": F.coalesce(F.lag(clk, 1).over(game), F.lead(clk, 1).over(game), F.col("base_s")),
            "berserk": F.coalesce(berserk_start(F.first(clk).over(own), F.col("base_s"), cfg.berserk_tolerance_s), F.lit(False)),
        }
    )
    out = out.withColumn("raw", raw).withColumns({"time_added": F.coalesce(added, F.lit(False)), "time_spent_s": F.when((F.col(order) > 2) & ~added, F.greatest(F.col("raw"), F.lit(0)))})
    return out.withColumns({"premove_suspect": F.coalesce(F.col("time_spent_s") <= cfg.premove_max_s, F.lit(False)), "low_clock": F.coalesce(low.otherwise(False), F.lit(False))}).drop("raw")


def decision_context(moves: DataFrame, key: str = "game_id", order: str = "ply") -> DataFrame:
    """Adds what was known before each move: own and opponent's previous times, previous move and evaluation, and a recapture flag where is_capture is given."""
    game = Window.partitionBy(key).orderBy(order)
    have = set(moves.columns)
    new = {"prev_own_time_spent_s": F.lag("time_spent_s", 2).over(game), "opp_prev_time_spent_s": F.lag("time_spent_s", 1).over(game)}
    if "uci" in have:
        new["opp_prev_uci"] = F.lag("uci", 1).over(game)
    for c in ("cp", "mate"):
        if f"eval_white_{c}" in have:
            new |= {f"eval_before_white_{c}": F.lag(f"eval_white_{c}", 1).over(game), f"eval_after_white_{c}": F.col(f"eval_white_{c}")}
    if {"uci", "is_capture"} <= have:
        took = F.coalesce(F.lag("is_capture", 1).over(game), F.lit(False))
        new |= {"opp_prev_was_capture": took, "is_recapture": F.coalesce(F.col("is_capture") & took & (F.substring("uci", 3, 2) == F.substring(F.lag("uci", 1).over(game), 3, 2)), F.lit(False))}
    return moves.withColumns(new)


def phase(placement: Column, ply: Column, endgame: int = 6, opening: int = 11, opening_ply: int = 30) -> Column:
    """From a FEN's placement: by the number of pieces that are neither pawns nor kings."""
    pieces = F.length(F.regexp_replace(F.substring_index(placement, " ", 1), "[^nbrqNBRQ]", ""))
    return F.when(pieces <= endgame, "endgame").when((pieces >= opening) & (ply < opening_ply), "opening").otherwise("middlegame")
