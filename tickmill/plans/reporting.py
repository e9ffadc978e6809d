"""Queries over the jobs' filters and reports: decisions, labels, database lines and puzzles put together from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions import scores, text
from ..operators import labels, reports, survival
from .registry import _query

_CLASS_SQL = "CASE o_custkey % 3 WHEN 0 THEN 'blitz' WHEN 1 THEN 'rapid' ELSE 'classical' END"


def _class(key: str):
    return F.when(F.col(key) % 3 == 0, "blitz").when(F.col(key) % 3 == 1, "rapid").otherwise("classical")


# --- puzzles ---


def _puzzles(t) -> DataFrame:
    e = F.col("event_id")
    return t("events").select(F.when(F.col("event_type") == "click", "setup_mismatch").otherwise("kept").alias("outcome"), (800 + e % 1500).alias("puzzle_rating"), (F.col("value") > 100).alias("played_solution"), F.col("value").alias("time_spent_s"), _class("user_id").alias("tc_class"))


@_query("""SELECT cast(floor((800 + event_id % 1500) / 200.0) * 200 AS integer) AS band, count(*) AS n, round_even(avg(cast(value > 100 AS double)), 3) AS solved, round(median(value), 4) AS median_s
FROM events WHERE event_type <> 'click' GROUP BY 1""")
def puzzle_solving(t):
    return reports.puzzle_solving(_puzzles(t)).withColumn("median_s", F.round("median_s", 4))


@_query(f"SELECT {_CLASS_SQL.replace('o_custkey', 'user_id')} AS tc_class, value > 100 AS played_solution, count(*) AS n, round(median(value), 4) AS median_s FROM events WHERE event_type <> 'click' GROUP BY 1, 2")
def puzzle_times(t):
    return reports.puzzle_times(_puzzles(t)).withColumn("median_s", F.round("median_s", 4))


# --- labels and the evaluation database ---


@_query("""SELECT count(*) AS n, round(avg(10 + vec_id % 9), 9) AS mean_depth, median(10 + vec_id % 9) AS median_depth, round(avg(1 + vec_id % 3), 9) AS mean_lines, median(vec_id % 12) AS median_stable_depth,
round(avg(cast(vec_id % 3 = 0 AS double)), 9) AS one_line, cast(sum(CASE WHEN vec_id % 4 <= 1 THEN 1 ELSE 0 END + CASE WHEN vec_id % 5 <= 1 THEN 1 ELSE 0 END) AS bigint) AS losses_up_to_1 FROM embeddings""")
def label_summary(t):
    v = F.col("vec_id")
    loss = lambda m: F.struct((v % m).cast("float").alias("loss_win_pct"))
    made = t("embeddings").select((10 + v % 9).alias("depth"), F.sequence(F.lit(0).cast("long"), v % 3).alias("lines"), (v % 12).alias("best_move_stable_depth"), F.array(loss(4), loss(5)).alias("played"))
    got = reports.label_summary(made)
    return got.withColumns({c: F.round(c, 9) for c in ("mean_depth", "mean_lines", "one_line")})


#: Decisions in the position of an order's customer, one of six moves played; database lines m0, m1, ... of customers in credit.
_LINES_SQL = """o AS (SELECT *, 1 + o_orderkey % 8 AS legal, o_orderkey % 6 AS played FROM orders),
m AS (SELECT c_custkey, 1 + c_custkey % 5 AS n FROM customer WHERE c_acctbal >= 0)"""


def _decisions(t) -> DataFrame:
    k, epd = F.col("o_orderkey"), F.concat(F.lit("e"), F.col("o_custkey").cast("string"))
    return t("orders").select(
        "o_orderpriority", epd.alias("epd"), epd.alias("position_id"), F.concat(epd, F.lit(" 0 1")).alias("fen"), (1 + k % 8).alias("n_legal_moves"), F.concat(F.lit("m"), (k % 6).cast("string")).alias("played_uci"),
        F.when(F.col("o_orderstatus") != "P", (k % 7).cast("double")).alias("loss_win_pct"), F.concat(F.lit("m"), (k % 2).cast("string")).alias("best_uci"),
    )


def _database(t) -> DataFrame:
    n = 1 + F.col("c_custkey") % 5
    line = lambda i: F.struct(F.concat(F.lit("m"), i.cast("string")).alias("uci"), (60.0 - 2 * i).alias("win_pct"))
    return t("customer").where("c_acctbal >= 0").select(F.concat(F.lit("e"), F.col("c_custkey").cast("string")).alias("epd"), F.lit("m0").alias("best_uci"), n.alias("n_pvs"), F.transform(F.sequence(F.lit(0).cast("long"), n - 1), line).alias("pvs"))


@_query(f"""WITH {_LINES_SQL} SELECT o_orderpriority, count(*) AS n, round(avg(cast(n IS NOT NULL AS double)), 9) AS covered, round(avg(cast(coalesce(n >= least(5, legal), false) AS double)), 9) AS covered_multipv,
round(avg(cast(coalesce(played < n, false) AS double)), 9) AS played_in_pvs FROM o LEFT JOIN m ON c_custkey = o_custkey GROUP BY 1""")
def database_coverage(t):
    cov = labels.covered(_decisions(t).drop("best_uci"), _database(t))
    return labels.coverage_by(cov, "o_orderpriority").withColumns({c: F.round(c, 9) for c in ("covered", "covered_multipv", "played_in_pvs")})


@_query(f"""WITH {_LINES_SQL}, g AS (SELECT o_custkey, array_to_string(list_sort(list(DISTINCT 'm' || played)), ' ') AS played, max(played) AS last FROM o GROUP BY 1)
SELECT 'e' || o_custkey AS position_id, played FROM g LEFT JOIN m ON c_custkey = o_custkey WHERE NOT coalesce(n >= 5 AND last < n, false)""")
def positions_to_label(t):
    return labels.positions_to_label(_decisions(t), _database(t)).select("position_id", F.array_join("played", " ").alias("played"))


@_query(f"""WITH {_LINES_SQL}, d AS (SELECT o_orderkey, abs(cast(o_orderkey % 7 AS double) - 2 * played) AS diff, (o_orderkey % 7 <= 5) = (2 * played <= 5) AS same FROM o JOIN m ON c_custkey = o_custkey WHERE played < n AND o_orderstatus <> 'P')
SELECT count(*) AS n, round(avg(cast(o_orderkey % 2 = 0 AS double)), 9) AS same_best, round(avg(cast(same AS double)), 9) AS same_y, round(avg(diff), 9) AS mean_abs_diff, median(diff) AS median_abs_diff FROM d""")
def evaluation_check(t):
    got = labels.evaluation_check(_decisions(t), _database(t))
    return got.withColumns({c: F.round(c, 9) for c in ("same_best", "same_y", "mean_abs_diff")})


# --- decisions ---

_CATEGORY_SQL = f"[{', '.join(repr(c) for c in survival.CATEGORIES)}][o_orderkey % 8 + 1]"


def _observations(t) -> DataFrame:
    k = F.col("o_orderkey")
    state = F.when(F.col("o_orderstatus") == "F", "balanced").when(F.col("o_orderstatus") == "O", "winning").otherwise("losing")
    return t("orders").select(
        k, _class("o_custkey").alias("tc_class"), F.element_at(F.array(*map(F.lit, survival.CATEGORIES)), (k % 8 + 1).cast("int")).alias("category"), state.alias("position_state"), (k % 5 == 0).alias("low_clock"), (F.col("o_custkey") % 2000).alias("mover_elo"),
        F.col("o_totalprice").alias("time_spent_s"), (k % 2 == 0).alias("y"), (1.0 + k % 3).alias("sampling_weight"), F.when(k % 11 != 0, (k % 9 - 6).cast("double")).alias("loss_win_pct"), (F.col("o_custkey") % 101).cast("double").alias("best_win_pct"), (k % 4).cast("double").alias("gap_1_2"),
    )


@_query(f"""SELECT {_CLASS_SQL} AS tc_class, {_CATEGORY_SQL} AS category, o_custkey % 2000 AS mover_elo, o_totalprice AS time_spent_s, o_orderkey % 2 = 0 AS y, cast(1 + o_orderkey % 3 AS double) AS sampling_weight
FROM orders WHERE o_orderkey % 11 <> 0 AND o_custkey % 3 < 2 AND o_orderkey % 8 >= 2 AND o_orderstatus = 'F' AND o_orderkey % 5 <> 0""")
def budget_training_rows(t):
    """The rows that budgets are fitted on: labelled, of a supported class and trainable category, balanced, not short of time."""
    return survival.training_rows(_observations(t))


_BUDGET_OBS_SQL = """o AS (SELECT ['blitz', 'rapid', 'classical'][l_orderkey % 3 + 1] AS tc, {categories} AS cat, 400 + (l_suppkey * 37 + l_partkey * 11) % 2601 AS elo, l_quantity AS t, l_discount > 0.05 AS y, cast(1 + l_linenumber % 3 AS double) AS w FROM lineitem
WHERE l_tax > 0 AND l_orderkey % 3 < 2 AND l_partkey % 8 >= 2 AND l_returnflag = 'N' AND l_linenumber <> 7)""".format(categories=f"[{', '.join(repr(c) for c in survival.CATEGORIES)}][l_partkey % 8 + 1]")


def _fit_sql(value: str, sign: int) -> str:
    """The weighted monotone fit by its definition, the largest of the least means of intervals around a point."""
    return f"""(SELECT tc, cat, rating, {sign} * max(lo) AS fit FROM (
  SELECT i.tc, i.cat, i.rating, a.i AS a, min((b.{value} - a.{value} + {sign} * a.w * a.{value[1:]}) / (b.sw - a.sw + a.w)) AS lo FROM sums i JOIN sums a ON a.tc = i.tc AND a.cat = i.cat AND a.i <= i.i JOIN sums b ON b.tc = i.tc AND b.cat = i.cat AND b.i >= i.i GROUP BY ALL) GROUP BY ALL)"""


@_query(f"""WITH {_BUDGET_OBS_SQL},
grid AS (SELECT tc, cat, rating, h FROM (SELECT unnest(['blitz', 'rapid']) AS tc), (SELECT unnest({list(survival.TRAINABLE)!r}) AS cat), (SELECT cast(unnest(range(400, 3001, 50)) AS integer) AS rating), (SELECT cast(unnest(range(50, 401, 50)) AS integer) AS h)),
cells AS (SELECT tc, cat, elo, count(*) AS n, count(*) FILTER (WHERE y) AS finds FROM o GROUP BY ALL),
sized AS (SELECT g.tc, g.cat, rating, h, cast(coalesce(sum(n), 0) AS bigint) AS n_obs, cast(coalesce(sum(finds), 0) AS bigint) AS n_success FROM grid g LEFT JOIN cells c ON c.tc = g.tc AND c.cat = g.cat AND c.elo BETWEEN rating - h AND rating + h GROUP BY ALL),
win AS (SELECT * FROM sized QUALIFY row_number() OVER (PARTITION BY tc, cat, rating ORDER BY CASE WHEN n_success >= 40 THEN h ELSE 1000 - h END) = 1),
inside AS (SELECT w.tc, w.cat, rating, t, sum(CASE WHEN y THEN w ELSE 0 END) AS e, sum(w) AS total FROM win w JOIN o ON o.tc = w.tc AND o.cat = w.cat AND o.elo BETWEEN rating - h AND rating + h WHERE n_success > 0 GROUP BY ALL),
risk AS (SELECT *, sum(total) OVER (PARTITION BY tc, cat, rating ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS risk FROM inside),
curve AS (SELECT *, 1 - product(1 - e / risk) OVER k AS after_, 1 - coalesce(product(1 - e / risk) OVER (PARTITION BY tc, cat, rating ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS before_, greatest(t - 0.5, 0) AS lo FROM risk WINDOW k AS (PARTITION BY tc, cat, rating ORDER BY t ROWS UNBOUNDED PRECEDING)),
km AS (SELECT tc, cat, rating, arg_min(lo + (t + 0.5 - lo) * (0.5 - before_) / (after_ - before_), t) FILTER (WHERE e > 0 AND after_ >= 0.5 - 1e-12) AS q,
       arg_min(lo + (t + 0.5 - lo) * (0.3 - before_) / (after_ - before_), t) FILTER (WHERE e > 0 AND after_ >= 0.3 - 1e-12) AS s, sum(e) / sum(total) AS rate FROM curve GROUP BY ALL),
raw AS (SELECT w.*, CASE w.tc WHEN 'blitz' THEN 60.0::double ELSE 180.0::double END AS top, rate, q, s FROM win w LEFT JOIN km USING (tc, cat, rating)),
pts AS (SELECT tc, cat, rating, cast(n_success AS double) AS w, ln(coalesce(q, top)) AS b, ln(coalesce(s, top)) AS z, rate AS p FROM raw WHERE n_success > 0),
sums AS (SELECT *, row_number() OVER k AS i, sum(w) OVER k AS sw, sum(-b * w) OVER k AS sb, sum(-z * w) OVER k AS sz, sum(p * w) OVER k AS sp FROM pts WINDOW k AS (PARTITION BY tc, cat ORDER BY rating ROWS UNBOUNDED PRECEDING)),
fits AS (SELECT tc, cat, rating, exp(fb.fit) AS b, exp(fz.fit) AS z, fp.fit AS p FROM {_fit_sql('sb', -1)} fb JOIN {_fit_sql('sz', -1)} fz USING (tc, cat, rating) JOIN {_fit_sql('sp', 1)} fp USING (tc, cat, rating)),
up AS (SELECT r.*, f.b, f.z, f.p, max(f.b) OVER c AS mb, max(f.z) OVER c AS mz, max(f.b) OVER d AS fb, max(f.z) OVER d AS fz FROM raw r LEFT JOIN fits f USING (tc, cat, rating)
       WINDOW c AS (PARTITION BY cat, rating ORDER BY tc ROWS UNBOUNDED PRECEDING), d AS (PARTITION BY cat, rating ORDER BY tc ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT tc AS tc_class, cat AS category, rating, h AS half_width, n_obs, n_success, n_success > 0 AND (q IS NULL OR s IS NULL) AS unreached, CASE WHEN mb IS NOT NULL THEN round(least(greatest(mb, 3), top), 6) END AS budget_s, CASE WHEN mz IS NOT NULL THEN round(least(greatest(mz, 3), top), 6) END AS budget_strict_s, round(p, 6) AS p_inf,
       coalesce(b < fb - 1e-9 OR z < fz - 1e-9, false) AS raised_to_faster, n_success < 40 AS sparse, mb < 3 - 1e-9 AS clipped_low, mb > top + 1e-9 AS clipped_high FROM up""")
def fit_budgets(t):
    """The whole budget table: widened windows, both quantiles of each curve, monotone fits, classes and bounds. Whole seconds make exact ties common."""
    k = F.col("l_partkey") % 8 + 1
    obs = t("lineitem").select(
        F.element_at(F.array(*map(F.lit, ("blitz", "rapid", "classical"))), (F.col("l_orderkey") % 3 + 1).cast("int")).alias("tc_class"), F.element_at(F.array(*map(F.lit, survival.CATEGORIES)), k.cast("int")).alias("category"),
        F.when(F.col("l_returnflag") == "N", "balanced").otherwise("winning").alias("position_state"), (F.col("l_linenumber") == 7).alias("low_clock"), (400 + (F.col("l_suppkey") * 37 + F.col("l_partkey") * 11) % 2601).alias("mover_elo"),
        F.col("l_quantity").alias("time_spent_s"), (F.col("l_discount") > 0.05).alias("y"), (1.0 + F.col("l_linenumber") % 3).alias("sampling_weight"), F.when(F.col("l_tax") > 0, F.col("l_tax")).alias("loss_win_pct"),
    )
    table = survival.fit_budgets(obs, Config.from_dict({"budget": {"min_successes": 40}}))
    flags = ("half_width", "n_obs", "n_success", "unreached", "raised_to_faster", "sparse", "clipped_low", "clipped_high")
    return table.select("tc_class", "category", "rating", *flags, *(F.round(c, 6).alias(c) for c in ("budget_s", "budget_strict_s", "p_inf")))


@_query("""WITH t AS (SELECT CASE o_custkey % 2 WHEN 0 THEN 'blitz' ELSE 'rapid' END AS tc, o_orderpriority AS cat, cast(floor(o_totalprice / 50000) * 50000 AS integer) AS rating, round(avg(cast(o_custkey % 97 AS double)), 6) AS b, round(avg(cast(o_custkey % 101 AS double)), 6) AS s,
  CASE WHEN count(*) > 5 THEN round(avg(cast(o_orderstatus = 'F' AS double)), 6) END AS p FROM orders GROUP BY 1, 2, 3),
m AS (SELECT *, lag(b) OVER r AS lb, lag(p) OVER r AS lp, lag(b) OVER (PARTITION BY cat, rating ORDER BY tc) AS fb FROM t WINDOW r AS (PARTITION BY tc, cat ORDER BY rating))
SELECT DISTINCT tc AS tc_class, cat AS category, problem FROM (
  SELECT tc, cat, unnest([CASE WHEN p IS NULL THEN 'missing values' END, CASE WHEN b > lb + 1e-9 THEN 'budget increases with rating' END, CASE WHEN p < lp - 1e-9 THEN 'solve rate decreases with rating' END,
    CASE WHEN s > b + 1e-9 THEN 'strict budget above the regular one' END, CASE WHEN b < fb - 1e-9 THEN 'budget below a faster class' END]) AS problem FROM m) WHERE problem IS NOT NULL""")
def budget_violations(t):
    """Every rule that a table of unconstrained values breaks."""
    o = t("orders")
    table = o.groupBy(F.when(F.col("o_custkey") % 2 == 0, "blitz").otherwise("rapid").alias("tc_class"), F.col("o_orderpriority").alias("category"), scores.band(F.col("o_totalprice"), 50000).alias("rating")).agg(
        F.round(F.avg((F.col("o_custkey") % 97).cast("double")), 6).alias("budget_s"), F.round(F.avg((F.col("o_custkey") % 101).cast("double")), 6).alias("budget_strict_s"),
        F.when(F.count("*") > 5, F.round(F.avg((F.col("o_orderstatus") == "F").cast("double")), 6)).alias("p_inf"),
    )
    return survival.violations(table)


@_query("""SELECT count(*) AS n, round(avg(cast(o_orderkey % 9 - 6 < -1 AS double)), 9) AS above_best_by_1, round(avg(cast(o_orderkey % 9 - 6 < -5 AS double)), 9) AS above_best_by_5, bool_and(o_custkey % 101 BETWEEN 0 AND 100) AS win_in_range,
bool_and(1 + o_orderkey % 3 > 0) AS weights_positive, bool_and(o_orderkey % 4 >= 0) AS lines_sorted FROM orders WHERE o_orderkey % 11 <> 0""")
def observation_checks(t):
    got = reports.observation_checks(_observations(t))
    return got.withColumns({c: F.round(c, 9) for c in ("above_best_by_1", "above_best_by_5")})


@_query(f"""WITH p AS (SELECT {_CATEGORY_SQL} AS category, {_CLASS_SQL} AS c, cast(cast(floor((o_custkey % 2000) / 200.0) * 200 AS integer) AS varchar) AS band, o_orderstatus AS phase FROM orders)
SELECT dimension, value, count(*) AS n FROM (SELECT unnest(['category', 'source_class', 'source_band', 'phase']) AS dimension, unnest([category, c, band, phase]) AS value FROM p) GROUP BY 1, 2""")
def pool_counts(t):
    pool = _observations(t).join(t("orders").select("o_orderkey", F.col("o_orderstatus").alias("phase")), "o_orderkey")
    return reports.pool_counts(pool.withColumnsRenamed({"tc_class": "source_tc_class", "mover_elo": "source_rating"}))


# --- expressions ---


@_query("SELECT least(floor(least(greatest(l_quantity / (l_linenumber * 10), 0.0), 1.0) * 10), 9) / 10 AS tenth, count(*) AS n FROM lineitem GROUP BY 1")
def clock_share_tenths(t):
    return t("lineitem").groupBy(scores.tenths(F.col("l_quantity"), F.col("l_linenumber") * 10).alias("tenth")).agg(F.count("*").alias("n"))


@_query("SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1")
def month_of_path(t):
    path = F.concat(F.lit("/dumps/games_"), F.date_format("o_orderdate", "yyyy-MM"), F.lit(".pgn.zst"))
    return t("orders").groupBy(text.month_of_path(path).alias("month")).agg(F.count("*").alias("n"))


@_query("SELECT o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 3.0::double WHEN 'O' THEN 5.0::double ELSE 8.0::double END AS least_s, count(*) AS n FROM orders GROUP BY 1, 2")
def mapped_values(t):
    return t("orders").groupBy("o_orderstatus", scores.mapped(F.col("o_orderstatus"), {"F": 3.0, "O": 5.0, "P": 8.0}).alias("least_s")).agg(F.count("*").alias("n"))


@_query("""SELECT l_orderkey, CASE WHEN count(*) FILTER (WHERE l_returnflag = 'R') > 0 THEN 'missing' ELSE array_to_string(list_sort(list(cast(l_quantity AS integer))), ' ') END AS clocks FROM lineitem GROUP BY 1""")
def read_clocks(t):
    """The clocks of an order's lines; `missing` if a returned line has none."""
    token = F.struct(F.when(F.col("l_returnflag") != "R", F.col("l_quantity").cast("int")).alias("clock_s"))
    games = t("lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(token)).alias("tokens"))
    return games.select("l_orderkey", F.coalesce(F.array_join(text.read_clocks(F.col("tokens")).cast("array<string>"), " "), F.lit("missing")).alias("clocks"))
