"""Decisions joined to engine labels: features of nested lines, states, categories, database evaluations, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Categories, Config
from ..functions import scores
from . import bloom, ranks
from .survival import CATEGORIES

STATES = ("losing", "balanced", "winning")


def position_features(labels: DataFrame, tau: float = 5.0) -> DataFrame:
    """Each position's best move and depth, and how many lines come how close to the best."""
    wins = F.col("lines.win_pct")
    gap = lambda i: F.get(wins, F.lit(0)) - F.get(wins, F.lit(i))
    near = F.size(F.filter(wins, lambda x: F.get(wins, F.lit(0)) - x <= F.lit(tau).cast("float")))
    return labels.select("position_id", "best_uci", "best_win_pct", "depth", "best_move_first_depth", "best_move_stable_depth", F.size("lines").cast("byte").alias("n_lines"), near.cast("byte").alias("n_acceptable_lines"), gap(1).alias("gap_1_2"), gap(2).alias("gap_1_3"))


def position_state(best: Column, decisive: float = 90.0) -> Column:
    return F.when(best >= decisive, "winning").when(best <= 100 - decisive, "losing").otherwise("balanced")


def best_is_recapture() -> Column:
    return F.coalesce(F.col("opp_prev_was_capture") & (F.substring("best_uci", 3, 2) == F.substring("opp_prev_uci", 3, 2)), F.lit(False))


def category(cfg: Categories | None = None) -> Column:
    """The first of the ordered rules that holds; rows without labels fall through to the last ones."""
    cfg = cfg or Categories()
    good, legal, best = F.col("n_acceptable_lines"), F.col("n_legal_moves"), F.col("best_win_pct")
    few = (good <= cfg.sharp_max_acceptable) & (legal > good)
    rules = (legal == 1, (good == 1) & best_is_recapture(), few & (best >= cfg.tactical_min_win_pct), few & (best <= cfg.defensive_max_win_pct), good == 1, F.col("phase") == "endgame", good >= cfg.many_min_acceptable)
    out = F
    for rule, label in zip(rules, CATEGORIES):
        out = out.when(rule, label)
    return out.otherwise(CATEGORIES[-1])


def observations(positions: DataFrame, labels: DataFrame, cfg: Config | None = None) -> DataFrame:
    """Every decision with its label: loss of the played move, whether it is acceptable (y) and best, state, category. Unlabelled decisions stay, with nulls."""
    cfg = cfg or Config()
    tau = cfg.acceptability.tau_win_pct
    played = labels.select("position_id", F.explode_outer("played").alias("p")).select("position_id", F.col("p.uci").alias("played_uci"), F.col("p.win_pct").alias("played_win_pct"), F.col("p.in_multipv").alias("played_in_multipv"), F.col("p.loss_win_pct").alias("loss_win_pct"))
    out = positions.join(position_features(labels, tau), "position_id", "left").join(played.where("played_uci is not null"), ["position_id", "played_uci"], "left")
    out = out.withColumns({"y": F.col("loss_win_pct") <= F.lit(tau).cast("float"), "is_best": F.col("played_uci") == F.col("best_uci"), "position_state": position_state(F.col("best_win_pct"), cfg.sampling.decisive_win_pct)})
    return out.withColumns({"best_is_recapture": best_is_recapture(), "category": category(cfg.categories)})


def acceptance_by(obs: DataFrame, *keys: str) -> DataFrame:
    """Count, plain and weighted acceptance, mean clipped loss, median and nearest 90 % time of labelled decisions."""
    w, y, best = F.col("sampling_weight"), F.col("y").cast("double"), F.col("is_best").cast("double")
    weighted = lambda x: (x * w, w)
    ratios = {"y_sample": ranks.mean(y), "y_population": weighted(y), "best_population": weighted(best), "mean_loss": ranks.mean(F.greatest(F.col("loss_win_pct"), F.lit(0.0)))}
    return ranks.described(obs.where("loss_win_pct is not null"), list(keys), "time_spent_s", ratios, "median_s", ("p90_s", 0.9))


def category_mix(obs: DataFrame) -> DataFrame:
    """Distinct positions by category (the first decision of each counts), their share and those balanced, with performance; in declared order."""
    first = F.row_number().over(Window.partitionBy("position_id").orderBy("game_id", "ply"))
    one = obs.where("loss_win_pct is not null").withColumn("_r", first).where("_r = 1")
    mix = one.groupBy("category").agg(F.count("*").alias("positions"), F.count_if(F.col("position_state") == "balanced").alias("balanced"))
    mix = mix.withColumn("share", F.col("positions") / F.sum("positions").over(Window.partitionBy()))
    return mix.join(acceptance_by(obs, "category"), "category", "left").orderBy(scores.ordinal(F.col("category"), CATEGORIES))


def state_share(obs: DataFrame) -> DataFrame:
    n = obs.where("loss_win_pct is not null").groupBy("position_state").agg(F.count("*").alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy())).orderBy(scores.ordinal(F.col("position_state"), STATES))


# --- the evaluation database ---

EVAL_DDL = "fen string, evals array<struct<pvs:array<struct<cp:int,mate:int,line:string>>,knodes:bigint,depth:int>>"


def wanted_records(lines: DataFrame, wanted: DataFrame, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """Raw JSON lines whose position is in wanted(epd), before any parsing. Few wanted positions, measured, are broadcast; more pass lines through a Bloom filter, and only those that pass it are shuffled."""
    compact = F.substring_index(F.substring_index(F.col("value"), '"fen":"', -1), '"', 1)
    key = F.when(F.contains("value", F.lit('"fen":"')), compact).otherwise(F.regexp_extract("value", r'"fen"\s*:\s*"([^"]*)"', 1))
    return bloom.semi_join(lines.withColumn("_key", key), "_key", wanted, "epd", broadcast_bytes).drop("_key")


def parse_evaluations(lines: DataFrame, cfg: Config | None = None, first_move=None) -> DataFrame:
    """One row for each record with a usable evaluation: the best by nodes, the widest by lines, scores from the mover's side, lines by falling win%.

    first_move(fen, line) -> Column gives a line's first legal move in standard notation or null; by default
    the move as written. Lines that don't parse are dropped.
    """
    cfg = cfg or Config()
    first_move = first_move or (lambda fen, line: F.nullif(F.substring_index(line, " ", 1), F.lit("")))
    rec = lines.select(F.from_json("value", EVAL_DDL).alias("r")).where("r.fen is not null").select("r.*")
    usable = F.filter("evals", lambda e: (F.coalesce(e["knodes"], F.lit(0)) >= cfg.min_knodes) & (F.coalesce(F.size(e["pvs"]), F.lit(0)) > 0))
    rec = rec.withColumns({"white": F.substring_index(F.substring_index("fen", " ", 2), " ", -1) == "w", "u": usable}).where(F.size("u") > 0)
    most = lambda key: F.get(F.array_sort(F.transform("u", lambda e, i: F.struct(*(-k for k in key(e)), i.alias("i")))), F.lit(0))["i"]
    rec = rec.withColumns({"best": F.get("u", most(lambda e: (e["knodes"],))), "wide": F.get("u", most(lambda e: (F.size(e["pvs"]).cast("long"), e["knodes"])))})
    line = lambda pv: F.struct(pv["line"].alias("line"), scores.for_mover(pv["cp"], F.col("white")).alias("cp"), scores.for_mover(pv["mate"], F.col("white")).alias("mate"))
    rec = rec.withColumns({"n_evals": F.size("evals"), "top": line(F.get(F.col("best.pvs"), F.lit(0))), "lines": F.transform(F.col("wide.pvs"), line)})
    rec = rec.withColumn("best_uci", first_move(F.col("fen"), F.col("top.line"))).where("best_uci is not null")
    # moves of the widest evaluation's lines, one row each, so that a UDF may judge them
    rows = rec.select("*", F.posexplode("lines").alias("i", "pv")).withColumn("uci", first_move(F.col("fen"), F.col("pv.line")))
    win = scores.eval_win_pct(F.col("pv.cp"), F.col("pv.mate"), cfg.acceptability)
    pvs = F.collect_list(F.when(F.col("uci").isNotNull(), F.struct((-win).alias("o"), "i", "uci", F.col("pv.cp").alias("cp"), F.col("pv.mate").alias("mate"), win.cast("float").alias("win_pct"))))
    one = ["fen", "n_evals", "best_uci", "top", "best", "wide"]
    got = rows.groupBy(F.xxhash64(F.to_json(F.struct("fen", "best", "wide"))).alias("_g"), *one).agg(F.transform(F.array_sort(pvs), lambda p: F.struct(*(p[c].alias(c) for c in ("uci", "cp", "mate", "win_pct")))).alias("pvs"))
    best_win = scores.eval_win_pct(F.col("top.cp"), F.col("top.mate"), cfg.acceptability).cast("float")
    return got.select(F.col("fen").alias("epd"), "n_evals", "best_uci", F.col("top.cp").alias("best_cp"), F.col("top.mate").alias("best_mate"), best_win.alias("best_win_pct"), F.col("best.knodes").alias("best_knodes"), F.col("best.depth").alias("best_depth"), F.size("pvs").alias("n_pvs"), F.col("wide.knodes").alias("multi_knodes"), F.col("wide.depth").alias("multi_depth"), "pvs")


def covered(positions: DataFrame, matches: DataFrame, multipv: int = 5) -> DataFrame:
    """Decisions with what the database knows of them: covered, covered_multipv, played_in_pvs."""
    obs = positions.join(matches.select("epd", "best_uci", "n_pvs", "pvs"), "epd", "left")
    no = F.lit(False)
    return obs.withColumns({"covered": F.col("best_uci").isNotNull(), "covered_multipv": F.coalesce(F.col("n_pvs") >= F.least(F.lit(multipv), F.col("n_legal_moves")), no), "played_in_pvs": F.coalesce(F.array_contains("pvs.uci", F.col("played_uci")), no)})


def coverage_by(cov: DataFrame, *keys: str) -> DataFrame:
    share = lambda c: F.avg(F.col(c).cast("double")).alias(c)
    return cov.groupBy(*keys).agg(F.count("*").alias("n"), share("covered"), share("covered_multipv"), share("played_in_pvs"))


def positions_to_label(positions: DataFrame, evaldb: DataFrame, multipv: int = 5) -> DataFrame:
    """Distinct positions with all moves played in them, without those whose database lines are enough and hold all of them."""
    todo = positions.groupBy("position_id").agg(F.first("epd").alias("epd"), F.min("fen").alias("fen"), F.sort_array(F.collect_set("played_uci")).alias("played"))
    known = todo.join(evaldb.select("epd", "n_pvs", F.col("pvs.uci").alias("ucis")), "epd").where((F.col("n_pvs") >= multipv) & (F.size(F.array_except("played", "ucis")) == 0))
    return todo.join(known.select("position_id"), "position_id", "left_anti")


def depth_profile(tops: Column, best: Column) -> tuple[Column, Column]:
    """(first depth at which best leads, depth from which it stays) of array<struct<depth, uci>>; nulls if it isn't last."""
    mine = F.filter(tops, lambda t: t["uci"] == best)
    other = F.array_max(F.transform(F.filter(tops, lambda t: t["uci"] != best), lambda t: t["depth"]))
    stays = F.array_min(F.transform(F.filter(mine, lambda t: other.isNull() | (t["depth"] > other)), lambda t: t["depth"]))
    return F.array_min(F.transform(mine, lambda t: t["depth"])), stays


def evaluation_check(obs: DataFrame, evaldb: DataFrame, tau: float = 5.0) -> DataFrame:
    """Labels against database lines for the same played move: agreement on the best move and on acceptance, mean and median difference of loss."""
    lines = evaldb.select("epd", F.col("best_uci").alias("db_best"), F.explode("pvs").alias("p")).select("epd", "db_best", F.col("p.uci").alias("played_uci"), (F.max("p.win_pct").over(Window.partitionBy("epd")) - F.col("p.win_pct")).alias("db_loss"))
    both = obs.where("loss_win_pct is not null").join(lines, ["epd", "played_uci"])
    diff = F.abs(F.col("loss_win_pct") - F.col("db_loss"))
    return both.agg(F.count("*").alias("n"), F.avg((F.col("best_uci") == F.col("db_best")).cast("double")).alias("same_best"), F.avg(((F.col("loss_win_pct") <= tau) == (F.col("db_loss") <= tau)).cast("double")).alias("same_y"), F.avg(diff).alias("mean_abs_diff"), F.median(diff).alias("median_abs_diff"))
