"""Operators that need the rules of chess: Arrow-batched Python over arrays of moves, one array for each game."""

from __future__ import annotations

import functools
import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import shared
from ..config import Config
from ..functions import scores, text
from . import bloom, timing
from .board import Board
from .survival import TRAINABLE

_REPLAYED = "array<struct<ply:smallint,uci:string,fen:string,epd:string,n_legal_moves:smallint,in_check:boolean,is_capture:boolean,prev_fen:string>>"


def _vectorised(ddl: str):
    """A pandas UDF made when it is first called: parsing its type needs a session."""

    def wrap(fn):
        made = {}

        @functools.wraps(fn)
        def call(*cols):
            if "udf" not in made:
                made["udf"] = F.pandas_udf(fn, ddl)
            return made["udf"](*cols)

        return call

    return wrap


@_vectorised("struct<uci:array<string>,error:string>")
def san_to_uci(sans: pd.Series) -> pd.DataFrame:
    """The UCI moves of a game's SANs, or the error `illegal_move` and none."""
    out, start = [], Board()
    for game in sans:
        board, moves, error = start.copy(), [], None
        for san in [] if game is None else game:
            try:
                move = board.parse_san(san)
            except ValueError:
                moves, error = None, "illegal_move"
                break
            moves.append(board.uci(move))
            board.push(move)
        out.append((moves, error))
    return pd.DataFrame(out, columns=["uci", "error"])


@_vectorised(_REPLAYED)
def replayed(ucis: pd.Series, wanted: pd.Series) -> pd.Series:
    """Facts about the position before each wanted ply of a game; replay stops after the last one. A game with an illegal move before it has null."""
    out, start = [], Board()
    for game, plies in zip(ucis, wanted):
        plies = set() if plies is None else {int(p) for p in plies}
        last = max(plies, default=0)
        board, rows, prev = start.copy(), [], None
        try:
            for ply, uci in enumerate([] if game is None else game, 1):
                if ply > last:
                    break
                move = board.parse_uci(uci)
                fen = None
                if ply in plies:
                    epd = board.epd()
                    fen = board.fen(epd)
                    rows.append({"ply": ply, "uci": uci, "fen": fen, "epd": epd, "n_legal_moves": len(board.legal()), "in_check": board.in_check(), "is_capture": board.is_capture(move), "prev_fen": prev})
                if ply + 1 in plies:
                    prev = fen or board.fen()
                board.push(move)
        except ValueError:
            rows = None
        out.append(rows)
    return pd.Series(out)


@_vectorised("string")
def first_legal_move(epd: pd.Series, line: pd.Series) -> pd.Series:
    """The first move of a line in standard notation (castling as a king's move); null if it isn't legal."""
    out = []
    for e, x in zip(epd, line):
        try:
            board = Board(f"{e} 0 1")
            out.append(board.uci(board.parse_uci((x or "").split(" ", 1)[0])))
        except (ValueError, IndexError, AttributeError):
            out.append(None)
    return pd.Series(out, dtype=object)


@_vectorised("struct<fen:string,epd:string,side:string,solved:boolean>")
def after_setup(fen: pd.Series, setup: pd.Series, played: pd.Series, solution: pd.Series, mate_in_one: pd.Series) -> pd.DataFrame:
    """The position after a puzzle's setup move, the side to move, and whether the played move solves it: the solution, or any mate if mate in one is asked for."""
    out = []
    for f, s, p, want, mate in zip(fen, setup, played, solution, mate_in_one):
        try:
            board = Board(f)
            board.push(board.parse_uci(s))
        except (ValueError, AttributeError):
            out.append((None, None, None, None))
            continue
        solved = None
        if p is not None:
            solved = p == want
            if not solved and mate:
                try:
                    after = board.copy()
                    after.push(after.parse_uci(p))
                    solved = after.is_checkmate()
                except ValueError:
                    solved = False
        out.append((board.fen(), board.epd(), "w" if board.white else "b", solved))
    return pd.DataFrame(out, columns=["fen", "epd", "side", "solved"])


@_vectorised("string")
def position_hash(epd: pd.Series) -> pd.Series:
    """64-bit BLAKE2b of the EPD in hex."""
    return epd.map(lambda x: None if x is None else hashlib.blake2b(x.encode(), digest_size=8).hexdigest())


# --- pipelines ---


def parse_moves(games: DataFrame, cfg: Config | None = None) -> tuple[DataFrame, DataFrame]:
    """(games with n_plies, parse_error, estimated duration; moves with timing) of kept games.

    A game with a missing clock or an illegal move has no moves at all and null n_plies.
    """
    cfg = cfg or Config()
    tokens = games.withColumn("tokens", text.move_tokens(F.col("movetext")))
    no_clock = F.exists("tokens", lambda m: m["clock_s"].isNull())
    sans = F.when(~no_clock, F.transform("tokens", lambda m: m["san"]))
    played = tokens.withColumn("moved", san_to_uci(sans)).withColumn("parse_error", F.when(no_clock, "missing_clock").otherwise(F.col("moved.error")))
    good = F.col("parse_error").isNull()
    meta = played.withColumns({"n_plies": F.when(good, F.size("tokens")).cast("short"), "est_duration_s": text.estimated_seconds(F.col("base_s"), F.col("increment_s"), cfg.time_controls.increment_weight).cast("int")}).drop("movetext", "tokens", "moved")
    limit = lambda c: scores.clip(c, -32000, 32000).cast("short")
    rows = played.where(good).select("game_id", "base_s", "increment_s", "tc_class", F.posexplode(F.arrays_zip("tokens", F.col("moved.uci").alias("uci"))).alias("i", "m"))
    rows = rows.select("game_id", "base_s", "increment_s", "tc_class", (F.col("i") + 1).cast("short").alias("ply"), F.col("m.uci").alias("uci"), F.col("m.tokens.clock_s").cast("float").alias("clk"), limit(F.col("m.tokens.cp")).alias("eval_white_cp"), limit(F.col("m.tokens.mate")).alias("eval_white_mate"))
    return meta, timing.move_timings(rows, cfg.clock)


def replay_positions(sampled: DataFrame, moves: DataFrame, cfg: Config | None = None) -> DataFrame:
    """sampled(game_id, ply, ...) with the facts of each position: FEN, EPD, id, phase, legal moves, check, captures, evaluations and times before it.

    Only games that are sampled are replayed; a game travels once as one ordered array. Raises if a row is lost.
    """
    cfg = cfg or Config()
    s = cfg.sampling
    games = sampled.groupBy("game_id").agg(F.collect_set("ply").alias("wanted"))
    cols = [c for c in ("ply", "uci", "time_spent_s", "eval_white_cp", "eval_white_mate") if c in moves.columns]
    lists = moves.join(games.select("game_id"), "game_id", "left_semi").groupBy("game_id").agg(F.array_sort(F.collect_list(F.struct(*cols))).alias("ms")).join(games, "game_id")
    # the ply before each sampled one tells whether the opponent just captured
    plies = F.array_distinct(F.concat("wanted", F.filter(F.transform("wanted", lambda p: (p - 1).cast("short")), lambda p: p > 0)))
    facts = lists.withColumn("facts", replayed(F.col("ms.uci"), plies)).select("*", F.explode(F.filter("facts", lambda x: F.array_contains("wanted", x["ply"]))).alias("x"))
    before = lambda name, back: F.get(F.col(f"ms.{name}"), F.col("x.ply") - 1 - back)
    took = F.coalesce(F.get(F.transform(F.filter("facts", lambda y: y["ply"] == F.col("x.ply") - 1), lambda y: y["is_capture"]), F.lit(0)), F.lit(False))
    same = F.substring("x.uci", 3, 2) == F.substring(before("uci", 1), 3, 2)
    out = facts.select(
        "game_id", "x.*", took.alias("opp_prev_was_capture"), F.when(F.col("x.ply") > 1, before("uci", 1)).alias("opp_prev_uci"),
        F.coalesce(F.col("x.is_capture") & took & same, F.lit(False)).alias("is_recapture"),
        F.when(F.col("x.ply") > 2, before("time_spent_s", 2)).alias("prev_own_time_spent_s"), F.when(F.col("x.ply") > 1, before("time_spent_s", 1)).alias("opp_prev_time_spent_s"),
        *(x for c in ("cp", "mate") if f"eval_white_{c}" in cols for x in (F.when(F.col("x.ply") > 1, before(f"eval_white_{c}", 1)).alias(f"eval_before_white_{c}"), before(f"eval_white_{c}", 0).alias(f"eval_after_white_{c}"))),
    )
    out = out.withColumns({"phase": timing.phase(F.col("fen"), F.col("ply"), s.endgame_max_pieces, s.opening_min_pieces, s.opening_max_ply), "position_id": position_hash(F.col("epd")), "move_number": F.floor((F.col("ply") + 1) / 2).cast("short")})
    have = [c for c in out.columns if c in sampled.columns and c not in ("game_id", "ply")]
    joined = sampled.drop(*have).join(out.drop("prev_fen"), ["game_id", "ply"], "left")
    return joined.withColumn("position_id", F.when(F.col("fen").isNull(), F.raise_error(F.concat(F.lit("replay lost "), "game_id"))).otherwise(F.col("position_id"))).withColumnRenamed("uci", "played_uci")


def trainer_pool(obs: DataFrame, labels: DataFrame, moves: DataFrame, cfg: Config | None = None) -> DataFrame:
    """Distinct servable positions, each from its first game, with the position before the opponent's move and the engine's lines. Raises on games that don't replay to the stored position or lack lines."""
    from pyspark.sql import Window

    cfg = cfg or Config()
    keep = F.col("loss_win_pct").isNotNull() & F.col("category").isin(*TRAINABLE) & F.col("position_state").isin(*cfg.position_states) & F.col("opp_prev_uci").isNotNull()
    chosen = shared.settled(obs.where(keep).withColumn("_r", F.row_number().over(Window.partitionBy("position_id").orderBy("game_id", "ply"))).where("_r = 1").drop("_r"))
    games = chosen.groupBy("game_id").agg(F.collect_set("ply").alias("wanted"))
    lists = bloom.semi_join(moves, "game_id", games, "game_id").groupBy("game_id").agg(F.array_sort(F.collect_list(F.struct("ply", "uci"))).alias("ms")).join(games, "game_id")
    back = lists.select("game_id", F.explode(replayed(F.col("ms.uci"), F.col("wanted"))).alias("x")).select("game_id", F.col("x.ply").alias("ply"), F.col("x.prev_fen").alias("prev_fen"), F.col("x.fen").alias("replayed_fen"))
    names = {"game_id": "source_game_id", "month": "source_month", "tc_class": "source_tc_class", "mover_elo": "source_rating"}
    pool = chosen.join(back, ["game_id", "ply"], "left").join(labels.select("position_id", "lines"), "position_id", "left")
    wrong = F.when(F.col("replayed_fen").isNull(), F.lit("game missing")).when(F.col("replayed_fen") != F.col("fen"), F.lit("FEN mismatch")).when(F.col("lines").isNull(), F.lit("no engine lines"))
    pool = pool.withColumn("position_id", F.when(wrong.isNotNull(), F.raise_error(F.concat_ws(" ", wrong, "position_id"))).otherwise(F.col("position_id")))
    cols = ["position_id", "fen", "prev_fen", "opp_prev_uci", "category", "phase", "move_number", "side", "best_uci", "best_win_pct", "n_acceptable_lines", "gap_1_2", "lines", "game_id", "month", "tc_class", "mover_elo"]
    return pool.select(*(c for c in cols if c in pool.columns)).withColumnsRenamed(names)


def puzzle_outcomes(puzzles: DataFrame, games: DataFrame, moves: DataFrame) -> DataFrame:
    """Puzzles of known games with `outcome` (kept, setup_mismatch, no_solver_move) and what the solver did."""
    j = puzzles.join(games.select("game_id", "white_elo", "black_elo", "tc_class", "base_s", "increment_s"), "game_id")
    cols = [c for c in ("time_spent_s", "own_clk_before_s", "opp_clk_s", "premove_suspect", "low_clock", "berserk", "time_added") if c in moves.columns]
    setup = moves.select("game_id", F.col("ply").alias("setup_ply"), F.col("uci").alias("_setup"))
    solver = moves.select("game_id", (F.col("ply") - 1).cast("int").alias("setup_ply"), F.col("uci").alias("played_uci"), *cols)
    j = j.join(setup, ["game_id", "setup_ply"], "left").join(solver, ["game_id", "setup_ply"], "left")
    mate = F.array_contains(F.coalesce("themes", F.array().cast("array<string>")), "mateIn1")
    j = j.withColumn("x", after_setup("fen_before", "setup_uci", "played_uci", "solution_uci", mate))
    same = F.coalesce(F.col("_setup") == F.col("setup_uci"), F.lit(False)) & F.coalesce(F.col("x.side") == F.col("solver_side"), F.lit(False))
    white = F.col("solver_side") == "w"
    return j.select(
        "puzzle_id", "game_id", (F.col("setup_ply") + 1).cast("short").alias("ply"), F.when(~same, "setup_mismatch").when(F.col("played_uci").isNull(), "no_solver_move").otherwise("kept").alias("outcome"),
        F.col("x.fen").alias("fen"), F.col("x.epd").alias("epd"), "solution_uci", F.slice("moves", 2, F.greatest(F.size("moves") - 1, F.lit(0))).alias("solution_line"), "puzzle_rating", "rating_deviation", "popularity", "nb_plays", "themes", "tc_class", "base_s", "increment_s",
        F.when(white, F.col("white_elo")).otherwise(F.col("black_elo")).alias("solver_elo"), F.when(white, F.col("black_elo")).otherwise(F.col("white_elo")).alias("opponent_elo"), "played_uci", F.col("x.solved").alias("played_solution"), *cols,
    )


def label_positions(positions: DataFrame, evaluator) -> DataFrame:
    """positions(position_id, epd, fen, played array) through an evaluator factory: opened once for each partition, asked (fen, played) for each row, closed at the end.

    The answer is a dict with best_uci, best_win_pct, lines and played as LABEL_DDL has them.
    """

    def run(batches):
        engine = evaluator()
        try:
            for pdf in batches:
                rows = []
                for r in pdf.itertuples():
                    rows.append({"position_id": r.position_id, "epd": r.epd, **engine.label(r.fen, list(r.played))})
                yield pd.DataFrame(rows, columns=[x.split(" ")[0] for x in LABEL_COLUMNS])
        finally:
            engine.close()

    return positions.select("position_id", "epd", "fen", "played").mapInPandas(run, ", ".join(LABEL_COLUMNS))


_LINE = "array<struct<uci:string,cp:int,mate:int,win_pct:float>>"
_PLAYED = "array<struct<uci:string,cp:int,mate:int,win_pct:float,in_multipv:boolean,loss_win_pct:float>>"
LABEL_COLUMNS = ("position_id string", "epd string", "best_uci string", "best_win_pct float", f"lines {_LINE}", "depth smallint", "nodes bigint", "best_move_first_depth smallint", "best_move_stable_depth smallint", f"played {_PLAYED}", "seconds float")


def placement_after(ucis: Column) -> Column:
    """Piece placement after a sequence of moves, 64 characters from a1, natively: captures, promotions, castling and en passant by how the squares change. Legality isn't judged."""
    start = "RNBQKBNRPPPPPPPP" + "." * 32 + "pppppppprnbqkbnr"
    index = lambda m, at: (F.ascii(F.substring(m, at, 1)) - 97) + 8 * (F.ascii(F.substring(m, at + 1, 1)) - 49) + 1
    put = lambda b, x, at: F.overlay(b, x, at, F.lit(1))

    def step(b, m):
        f, t = index(m, 1), index(m, 3)
        piece = F.substr(b, f, F.lit(1))
        new = F.when(F.length(m) > 4, F.when(F.upper(piece) == piece, F.upper(F.substring(m, 5, 1))).otherwise(F.substring(m, 5, 1))).otherwise(piece)
        ep = F.lower(piece).eqNullSafe("p") & (F.abs(f - t).isin(7, 9)) & (F.substr(b, t, F.lit(1)) == ".")
        b2 = put(put(b, new, t), F.lit("."), f)
        b2 = F.when(ep, put(b2, F.lit("."), F.when(t > f, t - 8).otherwise(t + 8))).otherwise(b2)
        castle = (F.lower(piece) == "k") & (F.abs(f - t) == 2)
        rook = F.when(piece == "K", "R").otherwise("r")
        return F.when(castle, put(put(b2, F.lit("."), F.when(t > f, f + 3).otherwise(f - 4)), rook, F.when(t > f, f + 1).otherwise(f - 1))).otherwise(b2)

    return F.aggregate(ucis, F.lit(start), step)


