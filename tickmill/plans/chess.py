"""Queries over positions and evaluations: games with known outcomes dealt over the tables, and records put together from them."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from .. import shared
from ..operators import labels, replay, reports, timing
from .registry import _MOVES_SQL, _moves, _nearest_sql, _query, _win_sql

_GAMES = {
    "ruy": ("e4 e5 Nf3 Nc6 Bb5 a6 Bxc6 dxc6 O-O", "e2e4 e7e5 g1f3 b8c6 f1b5 a7a6 b5c6 d7c6 e1g1"),
    "fool": ("f3 e5 g4 Qh4#", "f2f3 e7e5 g2g4 d8h4"),
    "passant": ("e4 a6 e5 d5 exd6", "e2e4 a7a6 e4e5 d7d5 e5d6"),
    "bad": ("e4 e4", None),
}


#: Positions before the last ply of each game, and the pieces after it, a8 last (fixed values, counted by hand): FEN, legal moves, whether the move captures, whether the side to move is in check.
_REPLAYED = {
    "ruy": ("r1bqkbnr/1pp2ppp/p1p5/4p3/4P3/5N2/PPPP1PPP/RNBQK2R w KQkq - 0 5", 25, False, False, "RNBQ.RK.PPPP.PPP.....N......P.......p...p.p......pp..pppr.bqkbnr"),
    "fool": ("rnbqkbnr/pppp1ppp/8/4p3/6P1/5P2/PPPPP2P/RNBQKBNR b KQkq - 0 2", 30, False, False, "RNBQKBNRPPPPP..P.....P........Pq....p...........pppp.ppprnb.kbnr"),
    "passant": ("rnbqkbnr/1pp1pppp/p7/3pP3/8/8/PPPP1PPP/RNBQKBNR w KQkq d6 0 3", 31, True, False, "RNBQKBNRPPPP.PPP........................p..P.....pp.pppprnbqkbnr"),
}
_NAMES = list(_GAMES)


def _games(t, column: int):
    """A game for each customer, by key, whose first moves are played: as many as the key says, all of every eighth. Customers are dealt over all cores, since a game takes far longer to play than its key to read."""
    n = F.col("c_custkey")
    moves = F.element_at(F.array(*(F.split(F.lit(v[column] or "e2e4 e7e5"), " ") for v in _GAMES.values())), (n % len(_GAMES) + 1).cast("int"))
    name = F.element_at(F.array(*map(F.lit, _NAMES)), (n % len(_GAMES) + 1).cast("int"))
    return shared.spread(t("customer").select("c_custkey")).select(n.alias("game"), name.alias("name"), moves.alias("whole")).withColumn("moves", F.when(F.col("game") % 8 < 4, F.col("whole")).otherwise(F.slice("whole", F.lit(1), (1 + F.floor(F.col("game") / 8) % F.size("whole")).cast("int"))))


def _games_sql() -> str:
    """The same games by their moves between squares: c_custkey, name, uci, n (moves played), size (moves in all)."""
    rows = ", ".join(f"({i}, '{k}', {[*(u or 'e2e4 e7e5').split()]})" for i, (k, (_, u)) in enumerate(_GAMES.items()))
    return f"""v AS (SELECT * FROM (VALUES {rows}) v(i, name, whole)),
    g AS (SELECT c_custkey, name, whole, len(whole) AS size, CASE WHEN c_custkey % 8 < 4 THEN len(whole) ELSE 1 + (c_custkey // 8) % len(whole) END AS n FROM customer JOIN v ON i = c_custkey % {len(_GAMES)})"""


@_query(f"WITH {_games_sql()} SELECT c_custkey, CASE WHEN name = 'bad' AND n > 1 THEN NULL ELSE array_to_string(whole[1:n], ' ') END AS uci, CASE WHEN name = 'bad' AND n > 1 THEN 'illegal_move' END AS error FROM g")
def san_to_uci(t):
    """Notation of every customer's game, by the rules; one game of four breaks them at its second move."""
    return _games(t, 0).withColumn("x", replay.san_to_uci("moves")).select(F.col("game").alias("c_custkey"), F.array_join("x.uci", " ").alias("uci"), "x.error")


@_query(f"""WITH {_games_sql()}, r AS (SELECT * FROM (VALUES {', '.join(f"('{k}', '{f}', {n}, {str(c).lower()}, {str(x).lower()})" for k, (f, n, c, x, _) in _REPLAYED.items())}) r(name, fen, n_legal_moves, is_capture, in_check))
    SELECT c_custkey, cast(size AS integer) AS ply, fen, n_legal_moves, is_capture, in_check FROM g JOIN r USING (name) WHERE n = size""")
def board_replay(t):
    """The position before the last move of every customer's whole game."""
    g = _games(t, 1).where((F.col("name") != "bad") & (F.size("moves") == F.size("whole"))).withColumn("x", F.explode(replay.replayed("moves", F.array(F.size("moves")))))
    return g.select(F.col("game").alias("c_custkey"), F.col("x.ply").cast("int").alias("ply"), "x.fen", F.col("x.n_legal_moves").cast("int").alias("n_legal_moves"), "x.is_capture", "x.in_check")


@_query(f"""WITH {_games_sql()}, r AS (SELECT * FROM (VALUES {', '.join(f"('{k}', '{x[-1]}')" for k, x in _REPLAYED.items())}) r(name, placement)) SELECT c_custkey, placement FROM g JOIN r USING (name) WHERE n = size""")
def placement_fold(t):
    """The pieces after the last move of every customer's whole game."""
    return _games(t, 1).where((F.col("name") != "bad") & (F.size("moves") == F.size("whole"))).select(F.col("game").alias("c_custkey"), replay.placement_after(F.col("moves")).alias("placement"))


_EVAL_SQL = f"""e AS (SELECT vec_id, vec_id % 2 = 0 AS white, cast(round(cast(embedding[1] AS double) * 500) AS integer) AS a, cast(round(cast(embedding[2] AS double) * 500) AS integer) AS b, cast(round(cast(embedding[3] AS double) * 500) AS integer) AS c, 500 + vec_id % 4 * 400 AS k1, 900 + vec_id % 3 * 400 AS k2 FROM embeddings),
s AS (SELECT *, CASE WHEN white THEN a ELSE -a END AS sa, CASE WHEN white THEN b ELSE -b END AS sb, CASE WHEN white THEN c ELSE -c END AS sc, k1 >= 1000 AS u1, k2 >= 1000 AS u2 FROM e)"""


@_query(
    f"""WITH {_EVAL_SQL} SELECT 'p' || vec_id || CASE WHEN white THEN ' w' ELSE ' b' END AS epd, CASE WHEN u1 AND (NOT u2 OR k1 >= k2) THEN 'm1' ELSE 'm2' END AS best_uci, cast(CASE WHEN u1 AND (NOT u2 OR k1 >= k2) THEN sa ELSE sb END AS integer) AS best_cp,
    round({_win_sql('CASE WHEN u1 AND (NOT u2 OR k1 >= k2) THEN sa ELSE sb END')}, 3) AS best_win_pct, cast(CASE WHEN u1 AND (NOT u2 OR k1 >= k2) THEN k1 ELSE k2 END AS bigint) AS best_knodes, cast(CASE WHEN u2 THEN 2 ELSE 1 END AS integer) AS n_pvs,
    CASE WHEN NOT u2 THEN 'm1' WHEN least(greatest(sb, -1000), 1000) >= least(greatest(sc, -1000), 1000) THEN 'm2 m3' ELSE 'm3 m2' END AS line_order FROM s WHERE u1 OR u2"""
)
def evaluation_records(t):
    """Evaluation records: one of one line, one of two, by nodes that may be too few; only even ids' and odd ids' sides differ."""
    cp = lambda i: F.round(F.get("embedding", F.lit(i)).cast("double") * 500).cast("int")
    pv = lambda i, m: F.struct(cp(i).alias("cp"), F.lit(m).alias("line"))
    one = F.struct(F.array(pv(0, "m1 x")).alias("pvs"), (500 + F.col("vec_id") % 4 * 400).alias("knodes"), F.lit(20).alias("depth"))
    two = F.struct(F.array(pv(1, "m2 x"), pv(2, "m3 x")).alias("pvs"), (900 + F.col("vec_id") % 3 * 400).alias("knodes"), F.lit(18).alias("depth"))
    fen = F.concat(F.lit("p"), F.col("vec_id").cast("string"), F.when(F.col("vec_id") % 2 == 0, " w").otherwise(" b"))
    lines = t("embeddings").select(F.to_json(F.struct(fen.alias("fen"), F.array(one, two).alias("evals"))).alias("value"), fen.alias("epd"))
    got = labels.parse_evaluations(labels.wanted_records(lines.select("value"), lines.select("epd")))
    return got.select("epd", "best_uci", "best_cp", F.round(F.col("best_win_pct").cast("double"), 3).alias("best_win_pct"), "best_knodes", "n_pvs", F.array_join("pvs.uci", " ").alias("line_order"))


@_query(
    """WITH d AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS depth, event_type FROM events),
    o AS (SELECT user_id, min(depth) FILTER (WHERE event_type = 'click') AS first_depth, max(depth) FILTER (WHERE event_type <> 'click') AS other FROM d GROUP BY 1)
    SELECT d.user_id, cast(coalesce(any_value(first_depth), -1) AS integer) AS first_depth, cast(coalesce(min(depth) FILTER (WHERE event_type = 'click' AND (other IS NULL OR depth > other)), -1) AS integer) AS stable_depth FROM d JOIN o USING (user_id) GROUP BY 1"""
)
def depth_profiles(t):
    moves = _moves(t("events")).groupBy("user_id").agg(F.collect_list(F.struct(F.col("ply").alias("depth"), F.col("event_type").alias("uci"))).alias("tops"))
    first, stable = labels.depth_profile(F.col("tops"), F.lit("click"))
    return moves.select("user_id", F.coalesce(first, F.lit(-1)).alias("first_depth"), F.coalesce(stable, F.lit(-1)).alias("stable_depth"))


@_query(
    f"""WITH {_MOVES_SQL}, z AS (SELECT tc_class, cast(floor((CASE WHEN side = 0 THEN 1000 + user_id % 700 ELSE 1025 + user_id % 700 END) / 200.0) * 200 AS integer) AS band, spent FROM x WHERE spent IS NOT NULL)
    SELECT tc_class, band, count(*) AS n, round(median(spent), 4) AS median_s, round({_nearest_sql('spent', 0.9)}, 4) AS p90_s FROM z GROUP BY 1, 2"""
)
def timing_by_band(t):
    """The report of thinking times by class and rating band."""
    moves = timing.move_timings(_moves(t("events")).withColumnRenamed("user_id", "game_id"))
    games = moves.select("game_id", "tc_class", (1000 + F.col("game_id") % 700).alias("white_elo"), (1025 + F.col("game_id") % 700).alias("black_elo")).distinct()
    return reports.timing_by_band(moves, games).select("tc_class", "band", "n", F.round("median_s", 4).alias("median_s"), F.round("p90_s", 4).alias("p90_s"))


@_query(
    """WITH l AS (SELECT vec_id, cast(round(50 + 10 * cast(embedding[1] AS double), 3) AS double) AS w1, cast(round(50 + 10 * cast(embedding[2] AS double), 3) AS double) AS w2, cast(round(50 + 10 * cast(embedding[3] AS double), 3) AS double) AS w3 FROM embeddings WHERE vec_id % 5 <> 0),
    s AS (SELECT vec_id, list_reverse(list_sort([w1, w2, w3])) AS w, w1 FROM l)
    SELECT e.vec_id, CASE WHEN s.vec_id IS NULL THEN -999 ELSE round(w[1] - w1, 3) END AS loss, coalesce(w[1] - w1 <= 5, false) AS y, CASE WHEN w[1] >= 60 THEN 'winning' WHEN w[1] <= 40 THEN 'losing' ELSE 'balanced' END AS state,
    cast(coalesce(len(list_filter(w, lambda x: w[1] - x <= 5)), -1) AS integer) AS near FROM embeddings e LEFT JOIN s ON s.vec_id = e.vec_id"""
)
def observations_join(t):
    """Decisions joined to labels of three lines, the first of which was played; every fifth has no label."""
    w = lambda i: F.round(50 + 10 * F.get("embedding", F.lit(i)).cast("double"), 3)
    e = t("embeddings").withColumn("position_id", F.col("vec_id").cast("string"))
    lines = F.array_sort(F.array(*(F.struct((-w(i)).alias("o"), F.lit(f"m{i}").alias("uci"), w(i).alias("win_pct")) for i in range(3))))
    lab = e.where("vec_id % 5 <> 0").select("position_id", lines.alias("lines"))
    best = F.get("lines", F.lit(0))
    played = F.array(F.struct(F.lit("m0").alias("uci"), F.get(F.filter("lines", lambda x: x["uci"] == "m0"), F.lit(0))["win_pct"].alias("win_pct"), F.lit(True).alias("in_multipv"), F.round(best["win_pct"] - F.get(F.filter("lines", lambda x: x["uci"] == "m0"), F.lit(0))["win_pct"], 9).alias("loss_win_pct")))
    lab = lab.select("position_id", "lines", best["uci"].alias("best_uci"), best["win_pct"].alias("best_win_pct"), F.lit(1).alias("depth"), F.lit(1).alias("best_move_first_depth"), F.lit(1).alias("best_move_stable_depth"), played.alias("played"))
    pos = e.select("vec_id", "position_id", F.lit("m0").alias("played_uci"), F.lit(20).alias("n_legal_moves"), F.lit("opening").alias("phase"), F.lit(False).alias("opp_prev_was_capture"), F.lit("a2a3").alias("opp_prev_uci"))
    from ..config import Config

    out = labels.observations(pos, lab, Config.from_dict({"sampling": {"decisive_win_pct": 60.0}}))
    return out.select("vec_id", F.coalesce(F.round("loss_win_pct", 3), F.lit(-999.0)).alias("loss"), F.coalesce("y", F.lit(False)).alias("y"), F.col("position_state").alias("state"), F.coalesce(F.col("n_acceptable_lines").cast("int"), F.lit(-1)).alias("near"))




# --- sampled positions, puzzles and the pool ---

#: Positions of the whole games above by ply (fixed values, by hand): FEN, FEN one ply earlier, the move before, whether that captured, whether the move takes back.
_POSITIONS = {
    ("ruy", 8): ("r1bqkbnr/1ppp1ppp/p1B5/4p3/4P3/5N2/PPPP1PPP/RNBQK2R b KQkq - 0 4", "r1bqkbnr/1ppp1ppp/p1n5/1B2p3/4P3/5N2/PPPP1PPP/RNBQK2R w KQkq - 0 4", "b5c6", True, True),
    ("ruy", 9): (_REPLAYED["ruy"][0], "r1bqkbnr/1ppp1ppp/p1B5/4p3/4P3/5N2/PPPP1PPP/RNBQK2R b KQkq - 0 4", "d7c6", True, False),
    ("fool", 4): (_REPLAYED["fool"][0], "rnbqkbnr/pppp1ppp/8/4p3/8/5P2/PPPPP1PP/RNBQKBNR w KQkq - 0 2", "g2g4", False, False),
    ("passant", 5): (_REPLAYED["passant"][0], "rnbqkbnr/1ppppppp/p7/4P3/8/8/PPPP1PPP/RNBQKBNR b KQkq - 0 2", "d7d5", False, False),
}


def _positions_sql() -> str:
    """name, ply, fen, prev_fen, before, took, back, position_id (BLAKE2b of the position without its counters) as a relation."""
    digest = lambda fen: hashlib.blake2b(fen.rsplit(" ", 2)[0].encode(), digest_size=8).hexdigest()
    rows = ", ".join(f"('{n}', {p}, '{f}', '{e}', '{b}', {str(x).lower()}, {str(y).lower()}, '{digest(f)}')" for (n, p), (f, e, b, x, y) in _POSITIONS.items())
    return f"{_games_sql()}, r AS (SELECT * FROM (VALUES {rows}) r(name, ply, fen, prev_fen, before, took, back, position_id))"


def _replay_input(t):
    """(sampled plies of every whole game, all games' moves)."""
    games = _games(t, 1).select(F.concat(F.lit("g"), F.col("game").cast("string")).alias("game_id"), "game", "name", "moves", "whole")
    wanted = F.when(F.col("name") == "ruy", F.array(F.lit(8), F.lit(9))).when(F.col("name") == "fool", F.array(F.lit(4))).when(F.col("name") == "passant", F.array(F.lit(5)))
    sampled = games.where(F.size("moves") == F.size("whole")).select("game_id", "game", F.explode(wanted.cast("array<smallint>")).alias("ply"))
    moves = games.select("game_id", "game", F.posexplode("moves").alias("i", "uci")).select("game_id", (F.col("i") + 1).cast("short").alias("ply"), "uci", (F.col("i") + 1 + F.col("game") % 10).cast("double").alias("time_spent_s"))
    return sampled, moves


@_query(f"""WITH {_positions_sql()} SELECT c_custkey, cast(ply AS integer) AS ply, fen, position_id, cast((ply + 1) // 2 AS integer) AS move_number, 'opening' AS phase, before AS opp_prev_uci, took AS opp_prev_was_capture, back AS is_recapture,
    cast(ply - 1 + c_custkey % 10 AS double) AS opp_prev_time_spent_s, cast(ply - 2 + c_custkey % 10 AS double) AS prev_own_time_spent_s FROM g JOIN r USING (name) WHERE n = size""")
def replayed_samples(t):
    """Sampled decisions with the facts that replay gives them."""
    out = replay.replay_positions(*_replay_input(t))
    return out.select(F.col("game").alias("c_custkey"), F.col("ply").cast("int").alias("ply"), "fen", "position_id", F.col("move_number").cast("int").alias("move_number"), "phase", "opp_prev_uci", "opp_prev_was_capture", "is_recapture", "opp_prev_time_spent_s", "prev_own_time_spent_s")


@_query(f"""WITH {_positions_sql()} SELECT position_id, fen, prev_fen, before AS opp_prev_uci, min('g' || c_custkey) AS source_game_id FROM g JOIN r USING (name) WHERE n = size GROUP BY ALL""")
def trainer_pool(t):
    """Every distinct position of the samples, from its first game, replayed again and checked."""
    sampled, moves = _replay_input(t)
    played = shared.settled(replay.replay_positions(sampled, moves).select("game_id", "ply", "position_id", "fen", "opp_prev_uci"))  # read more than once below
    obs = played.withColumns({"loss_win_pct": F.lit(1.0), "category": F.lit("quiet"), "position_state": F.lit("balanced")})
    lines = obs.select("position_id").distinct().withColumn("lines", F.array(F.lit("a line")))
    return replay.trainer_pool(obs, lines, moves).select("position_id", "fen", "prev_fen", "opp_prev_uci", "source_game_id")


@_query("""WITH k AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 1 THEN 'd7d5' WHEN 3 THEN NULL ELSE 'd8h4' END AS played, CASE WHEN c_custkey % 5 = 0 THEN 'd8g5' ELSE 'd8h4' END AS solution FROM customer)
    SELECT 'p' || c_custkey AS puzzle_id, CASE c_custkey % 4 WHEN 2 THEN 'setup_mismatch' WHEN 3 THEN 'no_solver_move' ELSE 'kept' END AS outcome, cast(4 AS integer) AS ply, coalesce(played, '-') AS played_uci,
    CASE WHEN played IS NULL THEN 'none' WHEN played = solution OR (c_custkey % 3 = 0 AND played = 'd8h4') THEN 'solved' ELSE 'missed' END AS solved, 1200 + c_custkey % 300 AS solver_elo,
    'rnbqkbnr/pppp1ppp/8/4p3/6P1/5P2/PPPPP2P/RNBQKBNR b KQkq - 0 2' AS fen FROM k""")
def puzzle_outcomes(t):
    """A mate in one for every customer, whose game set it up otherwise, ended before the answer, or answered well or not; another mate than the stored one counts if the theme asks for mate."""
    k = F.col("c_custkey")
    game, solution = F.concat(F.lit("g"), k.cast("string")).alias("game_id"), F.when(k % 5 == 0, "d8g5").otherwise("d8h4")
    themes = F.when(k % 3 == 0, F.array(F.lit("short"), F.lit("mateIn1"))).when(k % 3 == 2, F.array(F.lit("opening")))
    puzzles = t("customer").select(
        F.concat(F.lit("p"), k.cast("string")).alias("puzzle_id"), game, F.lit(_POSITIONS["fool", 4][1]).alias("fen_before"), F.array(F.lit("g2g4"), solution).alias("moves"), F.lit("g2g4").alias("setup_uci"), solution.alias("solution_uci"),
        F.lit(900).alias("puzzle_rating"), F.lit(80).alias("rating_deviation"), F.lit(90).alias("popularity"), F.lit(7).alias("nb_plays"), themes.alias("themes"), F.lit(3).alias("setup_ply"), F.lit("b").alias("solver_side"),
    )
    games = t("customer").select(game, (1000 + k % 500).alias("white_elo"), (1200 + k % 300).alias("black_elo"), F.lit("blitz").alias("tc_class"), F.lit(300).alias("base_s"), F.lit(0).alias("increment_s"))
    played = F.array(F.lit("f2f3"), F.lit("e7e5"), F.when(k % 4 == 2, "g2g3").otherwise("g2g4"), F.when(k % 4 == 1, "d7d5").otherwise("d8h4"))
    moves = t("customer").select(game, F.posexplode(F.slice(played, F.lit(1), F.when(k % 4 == 3, 3).otherwise(4))).alias("i", "uci")).select("game_id", (F.col("i") + 1).cast("int").alias("ply"), "uci")
    out = replay.puzzle_outcomes(puzzles, games, moves)
    solved = F.when(F.col("played_solution").isNull(), "none").when(F.col("played_solution"), "solved").otherwise("missed")
    return out.select("puzzle_id", "outcome", F.col("ply").cast("int").alias("ply"), F.coalesce("played_uci", F.lit("-")).alias("played_uci"), solved.alias("solved"), "solver_elo", "fen")
