"""The engine's own operators as queries over the driver's tables, each beside the SQL that it must equal.

A query is registered by name; its SQL twin is written from the operator's definition for DuckDB.
Whole tables are read; sums of floats are taken as decimals or rounded, since their order differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import shared
from ..config import Config
from ..functions import scores, text
from ..operators import labels, ranks, sampling, survival, timing
from ..sources import store

_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(fn):
        _QUERIES[fn.__name__] = lambda spark, sf_dir: fn(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        if sql:
            _SQL[fn.__name__] = sql
        return fn

    return add


def queries() -> dict:
    from . import chess, reporting  # noqa: F401  register their own

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from . import chess, reporting  # noqa: F401

    return dict(_SQL)


def _uniform_sql(salt: str, *keys: str) -> str:
    """The hashed uniform of scores.uniform."""
    inner = ", ".join(f"cast({k} AS varchar)" for k in keys)
    return f"(cast('0x' || substring(md5(concat_ws('|', '{salt}', {inner})), 1, 13) AS bigint) / 4503599627370496.0)"


def _win_sql(cp: str) -> str:
    return f"(50 + 50 * (2 / (1 + exp(-0.00368208 * least(greatest(cast({cp} AS double), -1000.0), 1000.0))) - 1))"


def _speed_sql(est: str) -> str:
    return f"CASE WHEN {est} <= 29 THEN 'ultrabullet' WHEN {est} <= 179 THEN 'bullet' WHEN {est} <= 479 THEN 'blitz' WHEN {est} <= 1499 THEN 'rapid' WHEN {est} <= 21599 THEN 'classical' END"


def _nearest_sql(x: str, q: float) -> str:
    return f"list_sort(list({x}) FILTER (WHERE {x} IS NOT NULL))[cast(floor({q} * (count({x}) - 1) + 0.5) AS bigint) + 1]"


# --- filters, headers and movetext: records are put together from the tables' rows ---

_EST = "(base + 40 * inc)"
_RECORDS = """SELECT o_orderkey AS k, o_custkey % 900 AS base, o_orderkey % 12 AS inc, o_orderpriority AS priority, o_orderstatus AS status,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE cast(400 + o_custkey % 3300 AS bigint) END AS we, cast(380 + o_orderkey % 3200 AS bigint) AS be,
  o_orderkey % 23 = 0 AS bot, o_orderkey % 19 = 0 AS abandoned, o_orderkey % 29 = 0 AS unclocked, o_orderkey % 31 = 0 AS cut, strftime(o_orderdate, '%Y.%m.%d') AS d FROM orders"""
_REASON = f"""CASE WHEN cut THEN 'incomplete' WHEN replace(substring(d, 1, 7), '.', '-') < '1995-01' THEN 'before_min_month'
  WHEN coalesce(({_speed_sql(_EST)}) NOT IN ('blitz', 'rapid', 'classical'), true) THEN 'class_' || coalesce({_speed_sql(_EST)}, 'correspondence')
  WHEN we IS NULL THEN 'missing_elo' WHEN we NOT BETWEEN 400 AND 3500 OR be NOT BETWEEN 400 AND 3500 THEN 'elo_out_of_range'
  WHEN bot THEN 'excluded_title' WHEN abandoned THEN 'excluded_termination' WHEN unclocked THEN 'no_clock' ELSE 'kept' END"""


def _records(orders: DataFrame) -> DataFrame:
    """A game record in text form for each order; the orders are dealt over all cores, since a record takes far longer to parse than its key to read."""
    orders = shared.spread(orders.select("o_orderkey", "o_custkey", "o_orderdate"))
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    tag = lambda name, value: F.concat(F.lit(f'[{name} "'), value.cast("string"), F.lit('"]\n'))
    white = F.when(k % 17 == 0, F.lit("?")).otherwise((400 + c % 3300).cast("string"))
    title = F.when(k % 23 == 0, tag("BlackTitle", F.lit("BOT"))).otherwise(F.lit(""))
    ending = F.when(k % 19 == 0, F.lit("Abandoned")).otherwise(F.lit("Normal"))
    moves = F.when(k % 29 == 0, F.lit("1. e4 e5 1-0")).otherwise(F.lit("1. e4 { [%clk 0:03:00] } 1... e5?! { [%eval 0.2] [%clk 0:02:59] } 1-0"))
    moves = F.when(k % 31 == 0, F.lit("1. e4 { [%clk 0:0")).otherwise(moves)
    value = F.concat(
        tag("Event", F.lit("Rated")), tag("Site", F.concat(F.lit("https://example.org/"), F.lpad(k.cast("string"), 8, "0"))), tag("Result", F.lit("1-0")), tag("UTCDate", F.date_format("o_orderdate", "yyyy.MM.dd")),
        tag("WhiteElo", white), tag("BlackElo", 380 + k % 3200), title, tag("TimeControl", F.concat_ws("+", (c % 900).cast("string"), (k % 12).cast("string"))), tag("Termination", ending), F.lit("\n"), moves,
    )
    return orders.select(k, value.alias("value"))


def _config() -> Config:
    return Config.from_dict({"filter": {"min_month": "1995-01"}})


@_query(f"SELECT lpad(cast(k AS varchar), 8, '0') AS game_id, {_REASON} AS reason FROM ({_RECORDS})")
def flt_reason_cascade(t):
    return text.with_reason(_records(t("orders")), _config()).select(text.site_id(F.col("Site")).alias("game_id"), "reason")


@_query(f"SELECT {_REASON} AS reason, count(*) AS n FROM ({_RECORDS}) GROUP BY 1")
def flt_reason_counts(t):
    return text.with_reason(_records(t("orders")), _config()).groupBy("reason").agg(F.count("*").alias("n"))


@_query(
    f"""SELECT lpad(cast(k AS varchar), 8, '0') AS game_id, replace(d, '.', '-') AS utc_date, cast(we AS smallint) AS white_elo, cast(be AS smallint) AS black_elo, cast(base AS integer) AS base_s, cast(inc AS smallint) AS increment_s,
    {_speed_sql(_EST)} AS tc_class, true AS has_evals, '1-0' AS result FROM ({_RECORDS}) WHERE {_REASON} = 'kept'"""
)
def kept_games(t):
    return text.kept_games(text.with_reason(_records(t("orders")), _config())).select("game_id", F.col("utc_date").cast("string").alias("utc_date"), "white_elo", "black_elo", "base_s", "increment_s", "tc_class", "has_evals", "result")


@_query("SELECT page_id, nullif(regexp_extract(url, '^https?://([^/]+)', 1), '') AS host, nullif(regexp_extract(url, '/([^/?#]*)$', 1), '') AS last_part, contains(html, '<a ') AS has_link FROM pages")
def header_tag_extract(t):
    return t("pages").select("page_id", text.extract(F.col("url"), "^https?://([^/]+)").alias("host"), text.extract(F.col("url"), "/([^/?#]*)$").alias("last_part"), F.contains("html", F.lit("<a ")).alias("has_link"))


@_query(f"SELECT o_orderkey, cast(base AS integer) AS base_s, cast(inc AS integer) AS increment_s, {_speed_sql(_EST)} AS tc_class FROM (SELECT o_orderkey, o_custkey % 900 AS base, o_orderkey % 12 AS inc FROM orders)")
def time_control_parse_classify(t):
    control = F.concat(F.lit(" "), (F.col("o_custkey") % 900).cast("string"), F.lit("+"), (F.col("o_orderkey") % 12).cast("string"))
    base, inc = text.base_seconds(control), text.increment_seconds(control)
    return t("orders").select("o_orderkey", base.alias("base_s"), inc.alias("increment_s"), text.speed_class(base, inc).alias("tc_class"))


@_query("""SELECT conv_id, turn AS ply, 'm' || cast(turn AS varchar) AS san, cast(3600 - turn * 7 AS double) + 0.5 AS clock_s, cast(CASE WHEN turn % 3 <> 0 THEN (turn - 2) * 15 END AS double) AS cp, cast(CASE WHEN turn % 3 = 0 THEN -turn END AS double) AS mate
FROM conversations""")
def movetext_tokens(t):
    """Movetext of a conversation: a move for each turn, with clock and evaluation comments, move numbers, glyphs and a result around them."""
    k, left = F.col("turn"), 3600 - F.col("turn") * 7
    clock = F.format_string("[%%clk %d:%02d:%02d.5]", F.floor(left / 3600), F.floor(left % 3600 / 60), left % 60)
    ev = F.when(k % 3 == 0, F.format_string("[%%eval #%d]", -k)).otherwise(F.format_string("[%%eval %.2f]", (k - 2) * 0.15))
    piece = F.concat((k + 1).cast("string"), F.lit(". m"), k.cast("string"), F.lit("?! $5 { "), ev, F.lit(" } { "), clock, F.lit(" }"))
    games = t("conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", piece.alias("p")))).alias("ps"))
    moves = games.select("conv_id", F.col("ps.turn").alias("turns"), text.move_tokens(F.concat(F.array_join("ps.p", " "), F.lit(" 1/2-1/2"))).alias("ms"))
    rows = moves.select("conv_id", "turns", F.posexplode("ms").alias("i", "m"))
    return rows.select("conv_id", F.get("turns", F.col("i")).alias("ply"), "m.san", "m.clock_s", F.col("m.cp").cast("double").alias("cp"), F.col("m.mate").cast("double").alias("mate"))


@_query("SELECT l_orderkey, l_linenumber, cast(l_partkey % 5 * 3600 + l_suppkey % 60 * 60 + l_linenumber AS double) + 0.25 AS clock_s FROM lineitem")
def clock_seconds(t):
    comment = F.format_string("{ [%%clk %d:%02d:%02d.25] }", F.col("l_partkey") % 5, F.col("l_suppkey") % 60, F.col("l_linenumber"))
    return t("lineitem").select("l_orderkey", "l_linenumber", text.clock_seconds(comment).alias("clock_s"))


# --- clocks ---

_MOVES_SQL = """m AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ply, round(300 - value, 2) AS clk FROM events),
g AS (SELECT *, cast((ply - 1) % 2 AS integer) AS side, CASE user_id % 3 WHEN 0 THEN 'blitz' WHEN 1 THEN 'rapid' ELSE 'bullet' END AS tc_class, cast(300 AS integer) AS base_s, cast(user_id % 4 AS integer) AS increment_s FROM m),
a AS (SELECT *, coalesce(lag(clk, 2) OVER w, clk) AS own, coalesce(lag(clk, 1) OVER w, lead(clk, 1) OVER w, base_s) AS opp, abs(first_value(clk) OVER (PARTITION BY user_id, side ORDER BY ply) - base_s / 2.0) <= 1 AS berserk FROM g WINDOW w AS (PARTITION BY user_id ORDER BY ply)),
b AS (SELECT *, own - clk + CASE WHEN berserk THEN 0 ELSE increment_s END AS raw FROM a),
c AS (SELECT *, ply > 2 AND raw < -1 AS time_added, CASE WHEN ply > 2 AND raw >= -1 THEN greatest(raw, 0) END AS spent FROM b),
x AS (SELECT *, coalesce(spent <= 0, false) AS premove_suspect, CASE tc_class WHEN 'blitz' THEN own < 10 WHEN 'rapid' THEN own < 20 WHEN 'classical' THEN own < 30 ELSE false END AS low_clock FROM c)"""


def _moves(events: DataFrame) -> DataFrame:
    """Each user's events as a game: clocks by order of time."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    u = F.col("user_id")
    kind = F.when(u % 3 == 0, "blitz").when(u % 3 == 1, "rapid").otherwise("bullet")
    return events.select("user_id", "event_id", "event_type", F.row_number().over(order).alias("ply"), F.round(300 - F.col("value"), 2).alias("clk"), kind.alias("tc_class"), F.lit(300).alias("base_s"), (u % 4).cast("int").alias("increment_s"))


def _timed(events: DataFrame) -> DataFrame:
    return timing.move_timings(_moves(events), key="user_id")


@_query(f"WITH {_MOVES_SQL} SELECT event_id, cast(ply AS integer) AS ply, round(own, 2) AS own_clk_before_s, round(opp, 2) AS opp_clk_s, round(spent, 2) AS time_spent_s, berserk, time_added, premove_suspect, low_clock FROM x")
def clock_timings(t):
    r = lambda c: F.round(F.col(c).cast("double"), 2).alias(c)
    return _timed(t("events")).select("event_id", "ply", r("own_clk_before_s"), r("opp_clk_s"), r("time_spent_s"), "berserk", "time_added", "premove_suspect", "low_clock")


@_query(f"WITH {_MOVES_SQL} SELECT event_id, round(lag(spent, 2) OVER w, 2) AS prev_own_time_spent_s, round(lag(spent, 1) OVER w, 2) AS opp_prev_time_spent_s FROM x WINDOW w AS (PARTITION BY user_id ORDER BY ply)")
def context_lags(t):
    out = timing.decision_context(_timed(t("events")), key="user_id")
    return out.select("event_id", *(F.round(c, 2).alias(c) for c in ("prev_own_time_spent_s", "opp_prev_time_spent_s")))


@_query(f"WITH {_MOVES_SQL} SELECT event_id, cast(ply AS integer) AS ply FROM x WHERE spent IS NOT NULL AND ply >= 10 AND NOT premove_suspect AND NOT berserk")
def eligible_filter(t):
    return sampling.eligible(_timed(t("events"))).select("event_id", "ply")


@_query(f"WITH {_MOVES_SQL} SELECT tc_class, cast(count(spent) AS bigint) AS n, round(median(spent), 4) AS median_s, round({_nearest_sql('spent', 0.9)}, 4) AS p90_s, round(avg(cast(low_clock AS double)), 9) AS low_clock, round(avg(cast(time_added AS double)), 9) AS time_added FROM x GROUP BY 1")
def thinking_time_by_class(t):
    got = ranks.described(_timed(t("events")), ["tc_class"], "time_spent_s", {c: ranks.mean(F.col(c)) for c in ("low_clock", "time_added")}, "median_s", ("p90_s", 0.9), n_values=True)
    return got.withColumns({"median_s": F.round("median_s", 4), "p90_s": F.round("p90_s", 4), "low_clock": F.round("low_clock", 9), "time_added": F.round("time_added", 9)})


@_query("""WITH r AS (SELECT p_partkey, chr(cast(97 + p_partkey % 8 AS integer)) AS file, p_size FROM part),
f AS (SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR' WHEN 1 THEN '4k3/8/8/3q4/8/8/4R3/4K3' ELSE 'r2qkb1r/8/8/8/8/8/8/R2QKB1R' END AS p, p_size AS ply FROM part)
SELECT p_partkey, CASE WHEN length(regexp_replace(p, '[^nbrqNBRQ]', '', 'g')) <= 6 THEN 'endgame' WHEN length(regexp_replace(p, '[^nbrqNBRQ]', '', 'g')) >= 11 AND ply < 30 THEN 'opening' ELSE 'middlegame' END AS phase FROM f""")
def phase_from_text(t):
    p = F.when(F.col("p_size") % 3 == 0, "rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR").when(F.col("p_size") % 3 == 1, "4k3/8/8/3q4/8/8/4R3/4K3").otherwise("r2qkb1r/8/8/8/8/8/8/R2QKB1R")
    return t("part").select("p_partkey", timing.phase(F.concat(p, F.lit(" w - - 0 1")), F.col("p_size")).alias("phase"))


# --- aggregates ---


@_query(f"""SELECT o_orderpriority AS class, cast(floor(l_extendedprice / 10000) * 10000 AS integer) AS band, count(*) AS n, median(l_quantity) AS median_q, {_nearest_sql('l_quantity', 0.9)} AS p90_q
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def band_stats(t):
    rows = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_orderpriority").alias("class"), scores.band(F.col("l_extendedprice"), 10000).alias("band"), "l_quantity")
    return ranks.described(rows, ["class", "band"], "l_quantity", {}, "median_q", ("p90_q", 0.9))


@_query("SELECT l_returnflag || '+' || cast(l_linenumber AS varchar) AS control, count(*) AS n, median(l_quantity) AS median_q FROM lineitem GROUP BY 1 HAVING count(*) >= (SELECT count(*) / 30 FROM lineitem)")
def tc_stats_having(t):
    rows = ranks.described(t("lineitem").select(F.concat_ws("+", "l_returnflag", F.col("l_linenumber").cast("string")).alias("control"), "l_quantity"), ["control"], "l_quantity", {}, "median_q")
    return rows.withColumn("_all", F.sum("n").over(Window.partitionBy())).where(F.col("n") >= F.col("_all") / 30).drop("_all")


@_query("SELECT count(*) AS n, round(avg(cast(lang = 'en' AS double)), 9) AS english, round(avg(cast(coalesce(quality = 0, false) AS double)), 9) AS low_quality, round(avg(cast(toxic = 1 AS double)), 9) AS toxic FROM documents LEFT JOIN labels USING (doc_id)")
def flag_shares(t):
    share = lambda c, name: F.round(F.avg(c.cast("double")), 9).alias(name)
    j = t("documents").select("doc_id", "lang").join(t("labels"), "doc_id", "left")
    return j.agg(F.count("*").alias("n"), share(F.col("lang") == "en", "english"), share(F.coalesce(F.col("quality") == 0, F.lit(False)), "low_quality"), share(F.col("toxic") == 1, "toxic"))


@_query("SELECT lang, round(avg(cast(quality IS NOT NULL OR toxic IS NOT NULL AS double)), 9) AS labelled FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang")
def either_present_share(t):
    j = t("documents").select("doc_id", "lang").join(t("labels"), "doc_id", "left")
    return j.groupBy("lang").agg(F.round(F.avg((F.col("quality").isNotNull() | F.col("toxic").isNotNull()).cast("double")), 9).alias("labelled"))


@_query("""WITH a AS (SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n, count(*) FILTER (WHERE l_discount > 0.05) AS hit FROM lineitem GROUP BY ALL)
SELECT l_returnflag, cast(count(*) AS bigint) AS strata, cast(sum(n) AS bigint) AS n, cast(sum(hit) AS double) / cast(sum(n) AS double) AS rate FROM a GROUP BY 1""")
def two_level_agg(t):
    a = t("lineitem").groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(F.count("*").alias("n"), F.count_if(F.col("l_discount") > 0.05).alias("hit"))
    return a.groupBy("l_returnflag").agg(F.count("*").alias("strata"), F.sum("n").alias("n"), (F.sum("hit").cast("double") / F.sum("n").cast("double")).alias("rate"))


@_query("SELECT l_linestatus, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) / sum(l_quantity) AS returned FROM lineitem GROUP BY 1")
def weighted_rate(t):
    return t("lineitem").groupBy("l_linestatus").agg(scores.weighted_rate((F.col("l_returnflag") == "R").cast("double"), F.col("l_quantity")).alias("returned"))


@_query("SELECT o_orderstatus, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM orders GROUP BY 1")
def state_share(t):
    n = t("orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


@_query("""WITH n AS (SELECT cast(floor(o_totalprice / 50000) * 50000 AS integer) AS band, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT band, o_orderpriority, n, n / sum(n) OVER (PARTITION BY band) AS share FROM n QUALIFY sum(n) OVER (PARTITION BY band) >= 100""")
def share_in_large_bands(t):
    n = t("orders").groupBy(scores.band(F.col("o_totalprice"), 50000).alias("band"), "o_orderpriority").agg(F.count("*").alias("n")).withColumn("_all", F.sum("n").over(Window.partitionBy("band")))
    return n.where("_all >= 100").select("band", "o_orderpriority", "n", (F.col("n") / F.col("_all")).alias("share"))


@_query("SELECT count(DISTINCT (l_returnflag, l_linestatus, l_linenumber)) AS combos, count(DISTINCT l_partkey) AS parts FROM lineitem")
def distinct_struct_count(t):
    return t("lineitem").agg(F.countDistinct(F.struct("l_returnflag", "l_linestatus", "l_linenumber")).alias("combos"), F.countDistinct("l_partkey").alias("parts"))


@_query("SELECT conv_id, array_to_string(list(role ORDER BY turn), ',') AS roles, cast(sum(length(text)) AS bigint) AS chars FROM conversations GROUP BY 1")
def ordered_list_agg(t):
    return t("conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"]), ",").alias("roles"), F.sum(F.length("text")).alias("chars"))


@_query("SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS types FROM events GROUP BY 1")
def collect_distinct_sorted(t):
    return t("events").groupBy("user_id").agg(F.array_join(F.sort_array(F.collect_set("event_type")), ",").alias("types"))


@_query("SELECT l_returnflag, cast(floor(k / 500) * 500 AS integer) AS band, count(*) AS n FROM (SELECT l_returnflag, unnest([l_partkey, l_suppkey]) AS k FROM lineitem) GROUP BY 1, 2")
def both_sides_explode(t):
    return t("lineitem").select("l_returnflag", F.explode(F.array("l_partkey", "l_suppkey")).alias("k")).groupBy("l_returnflag", scores.band(F.col("k"), 500).alias("band")).agg(F.count("*").alias("n"))


@_query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def count_per_key(t):
    return t("events").groupBy("event_type").agg(F.count("*").alias("n"))


@_query("SELECT min(l_quantity) AS lo, max(l_quantity) AS hi, bool_and(l_discount <= 0.11) AS small, bool_or(l_tax > 0.07) AS taxed, count(*) FILTER (WHERE l_shipdate IS NULL) AS nulls, bool_and(l_returnflag IN ('A', 'N', 'R')) AS domain_ok FROM lineitem")
def domain_checks(t):
    return t("lineitem").agg(F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"), F.bool_and(F.col("l_discount") <= 0.11).alias("small"), F.bool_or(F.col("l_tax") > 0.07).alias("taxed"), F.count_if(F.col("l_shipdate").isNull()).alias("nulls"), F.bool_and(F.col("l_returnflag").isin("A", "N", "R")).alias("domain_ok"))


@_query("SELECT cast(floor(c_acctbal / 1000) * 1000 AS integer) AS band, count(*) AS n, round(avg(greatest(c_acctbal, 0.0)), 6) AS mean_clipped FROM customer GROUP BY 1")
def clipped_mean(t):
    return t("customer").groupBy(scores.band(F.col("c_acctbal"), 1000).alias("band")).agg(F.count("*").alias("n"), F.round(F.avg(F.greatest("c_acctbal", F.lit(0.0))), 6).alias("mean_clipped"))


_WQ_SQL = """c AS (SELECT l_returnflag, l_extendedprice AS v, sum(l_quantity) AS w FROM lineitem GROUP BY 1, 2),
d AS (SELECT *, sum(w) OVER (PARTITION BY l_returnflag ORDER BY v ROWS UNBOUNDED PRECEDING) AS cum, sum(w) OVER (PARTITION BY l_returnflag) AS total FROM c)"""


@_query(f"WITH {_WQ_SQL} SELECT l_returnflag, min(v) FILTER (WHERE cum >= 0.5 * total) AS p50, min(v) FILTER (WHERE cum >= 0.9 * total) AS p90 FROM d GROUP BY 1")
def weighted_quantile(t):
    return survival.weighted_quantile(t("lineitem"), ["l_returnflag"], "l_extendedprice", "l_quantity", {"p50": 0.5, "p90": 0.9})


@_query("SELECT event_type, p AS point, sum(CASE WHEN value <= p THEN event_id % 7 + 1 ELSE 0 END) / sum(event_id % 7 + 1) AS share FROM events, (SELECT unnest([10.0::double, 50.0, 100.0, 200.0]) AS p) GROUP BY 1, 2")
def weighted_ecdf(t):
    e = t("events").withColumn("w", (F.col("event_id") % 7 + 1).cast("double"))
    return survival.weighted_ecdf(e, ["event_type"], "value", "w", [10, 50, 100, 200]).withColumnRenamed("at", "point")


@_query("""WITH c AS (SELECT o_orderpriority AS k, l_quantity AS v, cast(l_linenumber AS double) AS w, cast(l_returnflag = 'R' AS double) AS y, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
g AS (SELECT k, v, sum(w) AS w FROM c GROUP BY 1, 2),
d AS (SELECT *, sum(w) OVER (PARTITION BY k ORDER BY v ROWS UNBOUNDED PRECEDING) AS cum, sum(w) OVER (PARTITION BY k) AS total FROM g),
q AS (SELECT k, min(v) FILTER (WHERE cum >= 0.5 * total) AS t50, min(v) FILTER (WHERE cum >= 0.75 * total) AS t75, min(v) FILTER (WHERE cum >= 0.9 * total) AS t90 FROM d GROUP BY 1)
SELECT k, n, rate, weight, t50, t75, t90 FROM (SELECT k, count(*) AS n, sum(y * w) / sum(w) AS rate, sum(w) AS weight FROM c GROUP BY 1) JOIN q USING (k) WHERE n >= 150""")
def summarize_groups(t):
    c = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_orderpriority").alias("k"), F.col("l_quantity").alias("v"), F.col("l_linenumber").cast("double").alias("w"), (F.col("l_returnflag") == "R").cast("double").alias("y"))
    qs = survival.weighted_quantile(c, ["k"], "v", "w", {"t50": 0.5, "t75": 0.75, "t90": 0.9})
    return c.groupBy("k").agg(F.count("*").alias("n"), scores.weighted_rate(F.col("y"), F.col("w")).alias("rate"), F.sum("w").alias("weight")).where("n >= 150").join(qs, "k")


# --- windows, top-k, sets ---


@_query("SELECT event_id, user_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) <= 3")
def topk_per_group(t):
    r = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("value"), "event_id"))
    return t("events").withColumn("_r", r).where("_r <= 3").select("event_id", "user_id", "value")


@_query("SELECT user_id, arg_min(event_id, (ts, event_id)) AS event_id, arg_min(event_type, (ts, event_id)) AS event_type FROM events GROUP BY 1")
def keep_first_dedupe(t):
    key = F.struct("ts", "event_id")
    return t("events").groupBy("user_id").agg(F.min_by("event_id", key).alias("event_id"), F.min_by("event_type", key).alias("event_type"))


@_query("SELECT event_id, count(*) OVER (PARTITION BY user_id) AS n_user, max(value) OVER (PARTITION BY event_type) - value AS below_best FROM events")
def partition_windows(t):
    """Aggregates joined back rather than windows, so that a type with a third of all rows isn't one task."""
    e = t("events").select("event_id", "user_id", "event_type", "value")
    users = e.groupBy("user_id").agg(F.count("*").alias("n_user"))
    types = e.groupBy("event_type").agg(F.max("value").alias("_best"))
    return ranks.joined(ranks.joined(e, types, ["event_type"]), users, ["user_id"]).select("event_id", "n_user", (F.col("_best") - F.col("value")).alias("below_best"))


@_query("""WITH m AS (SELECT cast(floor(o_totalprice / 25000) * 25000 AS integer) AS band, o_orderpriority, cast(round(avg(o_totalprice), 2) AS double) AS v FROM orders GROUP BY 1, 2)
SELECT o_orderpriority, band FROM m QUALIFY v < lag(v) OVER (PARTITION BY o_orderpriority ORDER BY band) OR v > 1.9 * lag(v) OVER (PARTITION BY o_orderpriority ORDER BY band)""")
def pairwise_violations(t):
    m = t("orders").groupBy(scores.band(F.col("o_totalprice"), 25000).alias("band"), "o_orderpriority").agg(F.round(F.avg("o_totalprice"), 2).alias("v"))
    before = F.lag("v").over(Window.partitionBy("o_orderpriority").orderBy("band"))
    return m.withColumn("b", before).where((F.col("v") < F.col("b")) | (F.col("v") > 1.9 * F.col("b"))).select("o_orderpriority", "band")


@_query("SELECT o_orderkey, cast(floor((rn - 1) / 50) AS bigint) AS batch FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS rn FROM orders)")
def batches(t):
    rows = ranks.numbered(t("orders").select("o_orderkey", "o_orderstatus"), ["o_orderstatus"], "o_orderkey", "rn")
    return rows.select("o_orderkey", F.floor((F.col("rn") - 1) / 50).alias("batch"))


@_query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def head_sorted(t):
    return t("orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@_query("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(t):
    return t("customer").select(F.col("c_nationkey").alias("k")).union(t("supplier").select("s_nationkey")).distinct()


@_query("SELECT r, c, coalesce(n, 0) AS n FROM (SELECT * FROM (SELECT DISTINCT o_orderpriority AS r FROM orders) CROSS JOIN (SELECT DISTINCT o_orderstatus AS c FROM orders)) LEFT JOIN (SELECT o_orderpriority AS r, o_orderstatus AS c, count(*) AS n FROM orders GROUP BY 1, 2) USING (r, c)")
def cross_grid(t):
    o = t("orders").select(F.col("o_orderpriority").alias("r"), F.col("o_orderstatus").alias("c"))
    return o.select("r").distinct().crossJoin(o.select("c").distinct()).join(o.groupBy("r", "c").agg(F.count("*").alias("n")), ["r", "c"], "left").select("r", "c", F.coalesce("n", F.lit(0)).alias("n"))


@_query("SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def semi_join_prune(t):
    keys = t("lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return t("orders").join(keys, "o_orderkey", "left_semi").select("o_orderkey")


@_query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def anti_join_missing(t):
    return t("orders").join(t("lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti").select("o_orderkey")


@_query("SELECT a.conv_id, a.turn AS turn, b.turn AS other FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND (b.turn = a.turn OR b.turn = a.turn + 1) WHERE a.role = 'user'")
def residual_theta_join(t):
    a = t("conversations").where("role = 'user'").select("conv_id", "turn")
    b = t("conversations").select(F.col("conv_id").alias("c"), F.col("turn").alias("other"))
    return a.join(b, (F.col("conv_id") == F.col("c")) & ((F.col("other") == F.col("turn")) | (F.col("other") == F.col("turn") + 1))).select("conv_id", "turn", "other")


@_query("SELECT doc_id, lang, cast(quality AS double) AS quality, cast(toxic AS double) AS toxic FROM documents LEFT JOIN labels USING (doc_id)")
def left_join_assert(t):
    """Raises if the label of a document isn't unique."""
    once = t("labels").groupBy("doc_id").agg(F.count("*").alias("_n"), F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    once = once.withColumn("quality", F.when(F.col("_n") > 1, F.raise_error(F.lit("repeated label")).cast("int")).otherwise(F.col("quality"))).drop("_n")
    return t("documents").select("doc_id", "lang").join(once, "doc_id", "left").withColumns({c: F.col(c).cast("double") for c in ("quality", "toxic")})


@_query("SELECT n_name, count(*) AS n, cast(sum(c_acctbal > 0) AS bigint) AS solvent FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' GROUP BY 1")
def star_join(t):
    n = t("nation").join(t("region").where("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    return t("customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.count("*").alias("n"), F.count_if(F.col("c_acctbal") > 0).alias("solvent"))


# --- sampling ---

_QUOTA_SQL = """r AS (SELECT *, row_number() OVER (ORDER BY n, {keys}) AS i, coalesce(sum(n) OVER (ORDER BY n, {keys} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, count(*) OVER () AS c, least({target}, sum(n) OVER ()) AS total FROM sizes),
s AS (SELECT *, floor((total - before) / (c - i + 1)) AS share FROM r),
f AS (SELECT *, min(CASE WHEN n > share THEN i END) OVER () AS f FROM s),
h AS (SELECT *, max(CASE WHEN i = f THEN share END) OVER () AS fs, max(CASE WHEN i = f THEN before END) OVER () AS fp FROM f),
quotas AS (SELECT * EXCLUDE (share), cast(CASE WHEN f IS NULL OR i < f THEN n ELSE fs + CASE WHEN sum(CASE WHEN i >= f THEN 1 ELSE 0 END) OVER (ORDER BY {keys}) <= total - fp - fs * (c - f + 1) THEN 1 ELSE 0 END END AS bigint) AS quota FROM h)"""


@_query(f"WITH sizes AS (SELECT o_orderpriority AS p, cast(floor(o_totalprice / 50000) * 50000 AS integer) AS band, count(*) AS n FROM orders GROUP BY 1, 2), {_QUOTA_SQL.format(keys='p, band', target=700)} SELECT p, band, n, quota FROM quotas")
def quota_water_filling(t):
    sizes = t("orders").groupBy(F.col("o_orderpriority").alias("p"), scores.band(F.col("o_totalprice"), 50000).alias("band")).agg(F.count("*").alias("n"))
    return sampling.quotas(sizes, 700, ["p", "band"])


_SAMPLE_SQL = f"""{_MOVES_SQL},
e AS (SELECT *, {_uniform_sql('20261001:game', "'u' || user_id", 'ply')} AS u1, {_uniform_sql('20261001:stratum', "'u' || user_id", 'ply')} AS u2, count(*) OVER (PARTITION BY user_id) AS eligible FROM x
      WHERE spent IS NOT NULL AND ply >= 10 AND NOT premove_suspect AND NOT berserk AND tc_class IN ('blitz', 'rapid')),
k AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY u1, ply) <= 3),
q AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS sampled, cast(floor((1000 + user_id % 700 + side * 25) / 100.0) * 100 AS integer) AS rating_band, CASE WHEN ply >= 60 THEN 60 WHEN ply >= 40 THEN 40 WHEN ply >= 20 THEN 20 ELSE 10 END AS ply_bucket FROM k),
sizes AS (SELECT tc_class, rating_band, ply_bucket, count(*) AS n FROM q GROUP BY ALL), {_QUOTA_SQL.format(keys='tc_class, rating_band, ply_bucket', target=120)},
z AS (SELECT q.*, quotas.n AS n, quota FROM q JOIN quotas USING (tc_class, rating_band, ply_bucket) QUALIFY row_number() OVER (PARTITION BY tc_class, rating_band, ply_bucket ORDER BY u2, 'u' || user_id, ply) <= quota)"""


@_query(f"WITH {_SAMPLE_SQL} SELECT event_id, tc_class, rating_band, cast(ply_bucket AS integer) AS ply_bucket, (eligible / sampled) * (n / quota) AS sampling_weight FROM z")
def stratified_sample_weights(t):
    game = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    moves = timing.move_timings(_moves(t("events")).withColumn("game_id", game))
    elo = 1000 + F.col("user_id") % 700
    games = t("events").select("user_id").distinct().select(game.alias("game_id"), F.lit("2024-01").alias("month"), F.when(F.col("user_id") % 3 == 0, "blitz").when(F.col("user_id") % 3 == 1, "rapid").otherwise("bullet").alias("tc_class"), F.lit(300).alias("base_s"), (F.col("user_id") % 4).alias("increment_s"), elo.alias("white_elo"), (elo + 25).alias("black_elo"))
    out = sampling.stratified(sampling.game_candidates(moves, games), 120)
    return out.select("event_id", "tc_class", "rating_band", "ply_bucket", "sampling_weight")


# --- ranges, survival, monotone fits ---


@_query("""WITH c AS (SELECT l_returnflag AS k, cast(l_quantity AS integer) AS pos, count(*) AS n, count(*) FILTER (WHERE l_discount > 0.05) AS finds FROM lineitem GROUP BY 1, 2)
SELECT g.k, r AS rating, cast(coalesce(sum(n), 0) AS bigint) AS n_obs, cast(coalesce(sum(finds), 0) AS bigint) AS n_success FROM (SELECT DISTINCT k FROM c) g CROSS JOIN (SELECT cast(unnest(range(5, 51, 5)) AS integer) AS r) LEFT JOIN c ON c.k = g.k AND pos BETWEEN r - 3 AND r + 3 GROUP BY 1, 2""")
def range_window_gather(t):
    c = _cells(t)
    return survival.widened(c, ["k"], _grid(c), "at", "n", "finds", 0, 3, 3).select("k", "rating", "n_obs", "n_success")


def _cells(t) -> DataFrame:
    return t("lineitem").groupBy(F.col("l_returnflag").alias("k"), F.col("l_quantity").cast("int").alias("at")).agg(F.count("*").alias("n"), F.count_if(F.col("l_discount") > 0.05).alias("finds"))


def _grid(c: DataFrame) -> DataFrame:
    return c.select("k").distinct().withColumn("rating", F.explode(F.sequence(F.lit(5), F.lit(50), F.lit(5))))


@_query("""WITH c AS (SELECT l_returnflag AS k, cast(l_quantity AS integer) AS pos, count(*) AS n, count(*) FILTER (WHERE l_discount > 0.05) AS finds FROM lineitem GROUP BY 1, 2),
w AS (SELECT g.k, r, h, cast(coalesce(sum(n), 0) AS bigint) AS n_obs, cast(coalesce(sum(finds), 0) AS bigint) AS n_success FROM (SELECT DISTINCT k FROM c) g CROSS JOIN (SELECT cast(unnest(range(5, 51, 5)) AS integer) AS r) CROSS JOIN (SELECT cast(unnest(range(2, 13, 2)) AS integer) AS h) LEFT JOIN c ON c.k = g.k AND pos BETWEEN r - h AND r + h GROUP BY 1, 2, 3)
SELECT k, r AS rating, h AS half_width, n_obs, n_success FROM w QUALIFY row_number() OVER (PARTITION BY k, r ORDER BY CASE WHEN n_success >= 2000 THEN 0 ELSE 1 END, CASE WHEN n_success >= 2000 THEN h ELSE -h END) = 1""")
def adaptive_window(t):
    c = _cells(t)
    return survival.widened(c, ["k"], _grid(c), "at", "n", "finds", 2000, 2, 12).select("k", "rating", "half_width", "n_obs", "n_success")


_KM_SQL = """g AS (SELECT l_linestatus AS k, l_quantity AS t, sum(CASE WHEN l_returnflag = 'R' THEN cast(l_linenumber AS double) ELSE 0.0 END) AS e, sum(cast(l_linenumber AS double)) AS total FROM lineitem GROUP BY 1, 2),
a AS (SELECT *, sum(total) OVER (PARTITION BY k ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS risk FROM g),
b AS (SELECT *, 1 - product(1 - e / risk) OVER (PARTITION BY k ORDER BY t ROWS UNBOUNDED PRECEDING) AS after_ FROM a),
c AS (SELECT *, coalesce(lag(after_) OVER (PARTITION BY k ORDER BY t), 0) AS before_, greatest(t - 0.5, 0) AS lo FROM b)"""


@_query(f"""WITH {_KM_SQL} SELECT k, round(arg_min(lo + (t + 0.5 - lo) * (0.25 - before_) / (after_ - before_), t) FILTER (WHERE e > 0 AND after_ >= 0.25 - 1e-12), 6) AS q25,
round(arg_min(lo + (t + 0.5 - lo) * (0.5 - before_) / (after_ - before_), t) FILTER (WHERE e > 0 AND after_ >= 0.5 - 1e-12), 6) AS q50 FROM c GROUP BY 1""")
def km_quantile(t):
    rows = t("lineitem").select(F.col("l_linestatus").alias("k"), F.col("l_quantity").alias("time"), (F.col("l_returnflag") == "R").alias("y"), F.col("l_linenumber").cast("double").alias("w"))
    out = survival.km_quantiles(survival.km_cells(rows, ["k"], "time", "y", "w"), ["k"], {"q25": 0.25, "q50": 0.5})
    return out.select("k", F.round("q25", 6).alias("q25"), F.round("q50", 6).alias("q50"))


_ISO_SQL = """v AS (SELECT l_returnflag AS k, cast(l_quantity AS integer) AS x, cast(sum(cast(l_extendedprice AS decimal(18, 2))) AS double) / count(*) AS v, count(*) AS w FROM lineitem GROUP BY 1, 2),
s AS (SELECT *, row_number() OVER p AS i, sum(v * w) OVER p AS sx, sum(w) OVER p AS sw FROM v WINDOW p AS (PARTITION BY k ORDER BY x ROWS UNBOUNDED PRECEDING)),
m AS (SELECT i.k, i.x, a.i AS a, min((b.sx - coalesce(z.sx, 0)) / (b.sw - coalesce(z.sw, 0))) AS lo FROM s i JOIN s a ON a.k = i.k AND a.i <= i.i JOIN s b ON b.k = i.k AND b.i >= i.i LEFT JOIN s z ON z.k = a.k AND z.i = a.i - 1 GROUP BY 1, 2, 3)"""


@_query(f"WITH {_ISO_SQL} SELECT k, x, round(max(lo), 4) AS fit FROM m GROUP BY 1, 2")
def isotonic_fit(t):
    v = t("lineitem").groupBy(F.col("l_returnflag").alias("k"), F.col("l_quantity").cast("int").alias("x")).agg((F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double") / F.count("*")).alias("v"), F.count("*").alias("w"))
    return survival.isotonic(v, ["k"], "x", "v", "w", True, "fit").select("k", "x", F.round("fit", 4).alias("fit"))


@_query("""WITH m AS (SELECT o_orderpriority AS k, o_orderstatus AS c, round(avg(o_totalprice), 2) AS v, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS i FROM orders GROUP BY 1, 2, 4)
SELECT k, c, max(v) OVER (PARTITION BY k ORDER BY i ROWS UNBOUNDED PRECEDING) AS v, coalesce(v < max(v) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS raised FROM m""")
def cross_class_max(t):
    m = t("orders").groupBy(F.col("o_orderpriority").alias("k"), F.col("o_orderstatus").alias("c")).agg(F.round(F.avg("o_totalprice"), 2).alias("v"))
    by = Window.partitionBy("k").orderBy(scores.ordinal(F.col("c"), ("F", "O", "P")))
    return m.select("k", "c", F.max("v").over(by.rowsBetween(Window.unboundedPreceding, 0)).alias("v"), F.coalesce(F.col("v") < F.max("v").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False)).alias("raised"))


# --- scores, nested arrays, categories, JSON ---


@_query(f"SELECT l_orderkey, l_linenumber, round({_win_sql('l_partkey % 4000 - 2000')}, 9) AS win_pct, CASE WHEN l_linenumber % 3 = 0 THEN CASE WHEN l_suppkey % 5 - 2 > 0 THEN 1000 ELSE -1000 END ELSE cast(least(greatest(l_partkey % 4000 - 2000, -1000), 1000) AS integer) END AS cp FROM lineitem")
def win_pct(t):
    cp = (F.col("l_partkey") % 4000 - 2000).cast("int")
    mate = F.when(F.col("l_linenumber") % 3 == 0, (F.col("l_suppkey") % 5 - 2).cast("int"))
    return t("lineitem").select("l_orderkey", "l_linenumber", F.round(scores.win_pct(cp), 9).alias("win_pct"), scores.score_to_cp(cp, mate).alias("cp"))


@_query("""WITH w AS (SELECT vec_id, list_reverse(list_sort(list_transform(embedding[1:6], lambda x: cast(round(cast(x AS double) * 100, 3) AS double)))) AS w FROM embeddings)
SELECT vec_id, w[1] AS best, cast(len(w) AS integer) AS n, cast(len(list_filter(w, lambda x: w[1] - x <= 10)) AS integer) AS near, round(w[1] - w[2], 6) AS gap_1_2, round(w[1] - w[3], 6) AS gap_1_3, round(w[1] - w[9], 6) AS gap_1_9, list_contains(w, w[6]) AS holds FROM w""")
def array_features(t):
    w = F.sort_array(F.transform(F.slice("embedding", 1, 6), lambda x: F.round(x.cast("double") * 100, 3)), asc=False)
    e = t("embeddings").select("vec_id", w.alias("w"))
    gap = lambda i: F.round(F.get("w", F.lit(0)) - F.get("w", F.lit(i)), 6)
    return e.select("vec_id", F.get("w", F.lit(0)).alias("best"), F.size("w").alias("n"), F.size(F.filter("w", lambda x: F.get("w", F.lit(0)) - x <= 10)).alias("near"), gap(1).alias("gap_1_2"), gap(2).alias("gap_1_3"), gap(8).alias("gap_1_9"), F.array_contains("w", F.get("w", F.lit(5))).alias("holds"))


@_query("SELECT vec_id, cast(list_position(embedding, list_max(embedding)) AS integer) AS at_max, round(cast(list_max(embedding) AS double), 6) AS top, cast(len(list_filter(embedding, lambda x: x > 0)) AS integer) AS positive FROM embeddings")
def array_best_sort(t):
    best = F.element_at(F.array_sort(F.transform("embedding", lambda x, i: F.struct((-x).alias("o"), i.alias("i")))), 1)["i"] + 1
    return t("embeddings").select("vec_id", best.alias("at_max"), F.round(F.array_max("embedding").cast("double"), 6).alias("top"), F.size(F.filter("embedding", lambda x: x > 0)).alias("positive"))


@_query("SELECT event_id, cast(json_extract(props, '$.k') AS integer) AS k FROM events WHERE cast(json_extract(props, '$.k') AS integer) IN (SELECT n_nationkey FROM nation)")
def json_props(t):
    """Keys are cut out of the raw text and reduced by a semi-join before any JSON is parsed."""
    raw = F.regexp_extract("props", r'"k":\s*(\d+)', 1).cast("int")
    e = t("events").select("event_id", "props", raw.alias("key"))
    wanted = t("nation").select(F.col("n_nationkey").cast("int").alias("key"))
    return e.join(wanted, "key", "left_semi").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


_OBS_SQL = """o AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, cast(1 + l_partkey % 9 AS integer) AS legal, least(cast(1 + l_suppkey % 6 AS integer), cast(1 + l_partkey % 9 AS integer)) AS good, cast(l_quantity * 2 - 1 AS double) AS best,
CASE WHEN l_linenumber % 3 = 0 THEN 'endgame' WHEN l_linenumber % 3 = 1 THEN 'opening' ELSE 'middlegame' END AS phase, l_returnflag = 'R' AS took, CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE 'a2e' || cast(1 + l_linenumber % 4 AS varchar) END AS prev, 'b1e' || cast(1 + l_partkey % 4 AS varchar) AS mv FROM lineitem)"""
_CAT_SQL = """CASE WHEN legal = 1 THEN 'forced' WHEN good = 1 AND coalesce(took AND substring(mv, 3, 2) = substring(prev, 3, 2), false) THEN 'recapture' WHEN good <= 2 AND legal > good AND best >= 60 THEN 'tactical'
WHEN good <= 2 AND legal > good AND best <= 40 THEN 'defensive' WHEN good = 1 THEN 'only-move' WHEN phase = 'endgame' THEN 'endgame' WHEN good >= 4 THEN 'many-good-moves' ELSE 'quiet' END"""


def _decisions(t) -> DataFrame:
    legal = (1 + F.col("l_partkey") % 9).cast("int")
    kind = F.when(F.col("l_linenumber") % 3 == 0, "endgame").when(F.col("l_linenumber") % 3 == 1, "opening").otherwise("middlegame")
    return t("lineitem").withColumns(
        {
            "n_legal_moves": legal, "n_acceptable_lines": F.least((1 + F.col("l_suppkey") % 6).cast("int"), legal), "best_win_pct": F.col("l_quantity") * 2 - 1, "phase": kind, "opp_prev_was_capture": F.col("l_returnflag") == "R",
            "opp_prev_uci": F.when(F.col("l_suppkey") % 3 != 0, F.concat(F.lit("a2e"), (1 + F.col("l_linenumber") % 4).cast("string"))), "best_uci": F.concat(F.lit("b1e"), (1 + F.col("l_partkey") % 4).cast("string")),
        }
    )


@_query(f"WITH {_OBS_SQL} SELECT {_CAT_SQL} AS category, CASE WHEN best >= 90 THEN 'winning' WHEN best <= 10 THEN 'losing' ELSE 'balanced' END AS position_state, count(*) AS n FROM o GROUP BY 1, 2")
def category_cascade(t):
    return _decisions(t).groupBy(labels.category().alias("category"), labels.position_state(F.col("best_win_pct")).alias("position_state")).agg(F.count("*").alias("n"))


@_query("SELECT p_partkey, CASE WHEN p_size >= 40 THEN 40 WHEN p_size >= 20 THEN 20 WHEN p_size IS NOT NULL THEN 1 END AS bucket, CASE WHEN p_retailprice < 1000 THEN 'low' WHEN p_retailprice < 1500 THEN 'mid' ELSE 'high' END AS price, least(greatest(p_size, 10), 30) AS clipped FROM part")
def bin_cut(t):
    return t("part").select("p_partkey", scores.bucket_floor(F.col("p_size"), 1, (20, 40)).alias("bucket"), scores.cut(F.col("p_retailprice"), (1000, 1500), ("low", "mid", "high")).alias("price"), scores.clip(F.col("p_size"), 10, 30).alias("clipped"))


@_query("SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS F, count(*) FILTER (WHERE o_orderstatus = 'O') AS O, count(*) FILTER (WHERE o_orderstatus = 'P') AS P FROM orders GROUP BY 1")
def pivot_classes(t):
    wide = t("orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1)))
    return wide.select("o_orderpriority", *(F.coalesce(c, F.lit(0)).alias(c) for c in "FOP"))


@_query("SELECT p_partkey, unnest(['size', 'price']) AS name, unnest([cast(p_size AS double), p_retailprice]) AS value FROM part")
def unpivot(t):
    return t("part").select("p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price")).unpivot("p_partkey", ["size", "price"], "name", "value")


@_query("SELECT conv_id, turn, word FROM (SELECT conv_id, turn, unnest(CASE WHEN turn % 4 = 3 THEN [NULL] ELSE string_split(role, 's') END) AS word FROM conversations)")
def explode_keep_empty(t):
    words = F.when(F.col("turn") % 4 != 3, F.split("role", "s"))
    return t("conversations").select("conv_id", "turn", F.explode_outer(words).alias("word"))


# --- sinks, as the tables they leave ---


@_query("""SELECT coalesce(n.k, o.k) AS k, CASE WHEN n.k IS NOT NULL THEN n.name ELSE o.name END AS name, CASE WHEN n.k IS NOT NULL THEN n.bal ELSE o.bal END AS bal, n.k IS NOT NULL AS active
FROM (SELECT c_custkey AS k, c_name AS name, c_acctbal AS bal FROM customer WHERE c_custkey % 3 <> 0) o FULL JOIN (SELECT c_custkey AS k, upper(c_name) AS name, c_acctbal + 1 AS bal FROM customer WHERE c_custkey % 2 = 0) n USING (k)""")
def upsert_merge(t):
    c = t("customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"))
    new = c.where("k % 2 = 0").withColumns({"name": F.upper("name"), "bal": F.col("bal") + 1})
    return store.upsert(c.where("k % 3 <> 0").withColumn("active", F.lit(True)), new, "k")


@_query("SELECT s_suppkey AS k, s_name AS name FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT s_suppkey, 'new ' || s_name FROM supplier WHERE s_suppkey % 2 <> 0")
def insert_if_absent(t):
    s = t("supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))
    return store.insert_absent(s.where("k % 2 = 0"), s.withColumn("name", F.concat(F.lit("new "), "name")), "k")


@_query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')")
def foreign_key_orphans(t):
    return store.orphans(t("lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey", t("orders").where("o_orderstatus <> 'P'"), "o_orderkey").select("l_orderkey", "l_linenumber")
