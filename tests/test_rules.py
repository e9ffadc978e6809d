"""Chess rules against known counts, and text functions against hand-made records."""

import pytest
from pyspark.sql import functions as F
from tickmill.config import Config
from tickmill.functions import scores, text
from tickmill.operators import ranks, replay
from tickmill.operators.board import Board, perft


@pytest.mark.parametrize(
    "fen,depth,count",
    [
        ("rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1", 3, 8902),
        ("r3k2r/p1ppqpb1/bn2pnp1/3PN3/1p2P3/2N2Q1p/PPPBBPPP/R3K2R w KQkq - 0 1", 2, 2039),
        ("8/2p5/3p4/KP5r/1R3p1k/8/4P1P1/8 w - - 0 1", 3, 2812),
        ("rnbq1k1r/pp1Pbppp/2p5/8/2B5/8/PPP1NnPP/RNBQK2R w KQ - 1 8", 2, 1486),
        ("r4rk1/1pp1qppp/p1np1n2/2b1p1B1/2B1P1b1/P1NP1N2/1PP1QPPP/R4RK1 w - - 0 10", 2, 2079),
    ],
)
def test_perft(fen, depth, count):
    assert perft(Board(fen), depth) == count


def test_notation():
    b = Board()
    for san in "d4 Nf6 c4 g6 Nc3 d5 cxd5 Nxd5 e4 Nxc3 bxc3 Bg7".split():
        b.push(b.parse_san(san))
    assert b.fen() == "rnbqk2r/ppp1ppbp/6p1/8/3PP3/2P5/P4PPP/R1BQKBNR w KQkq - 1 7"
    b = Board("r3k2r/8/8/8/8/8/8/4K3 b kq - 0 1")
    assert b.uci(b.parse_uci("e8h8")) == "e8g8" and b.uci(b.parse_uci("e8a8")) == "e8c8"
    with pytest.raises(ValueError):
        Board().parse_san("Nd4")
    two = Board("4k3/8/8/8/2N3N1/8/8/4K3 w - - 0 1")
    with pytest.raises(ValueError):
        two.parse_san("Ne3")
    assert two.uci(two.parse_san("Nge3")) == "g4e3"
    assert Board("R5k1/5ppp/8/8/8/8/8/6K1 b - - 0 1").is_checkmate() and not Board("R5k1/5pp1/8/8/8/8/8/6K1 b - - 0 1").is_checkmate()
    # an en-passant square counts only if the capture is legal
    b = Board()
    b.push(b.parse_san("d4"))
    assert b.epd().endswith(" b KQkq -")


RECORD = """[Event "Rated"]
[Site "https://example.org/{id}"]
[Result "1-0"]
[UTCDate "{date}"]
[WhiteElo "{we}"]
[BlackElo "1400"]
{more}[TimeControl "{tc}"]
[Termination "{end}"]

{moves}"""
MOVES = "1. e4 { [%eval 0.2] [%clk 0:03:00] } 1... e5 { [%clk 0:03:00] } 1-0"


def made(id="abcd1234", date="2024.05.01", we="1500", tc="180+2", end="Normal", moves=MOVES, more=""):
    return RECORD.format(**locals())


CASES = [
    (made(), "kept"),
    (made(tc="600+0"), "kept"),
    (made(tc="60+0"), "class_bullet"),
    (made(tc="30000+0"), "class_correspondence"),
    (made(tc="-"), "no_time_control"),
    (made(more='[BlackTitle "BOT"]\n'), "excluded_title"),
    (made(end="Abandoned"), "excluded_termination"),
    (made(moves="1. e4 e5 1-0"), "no_clock"),
    (made(we="?"), "missing_elo"),
    (made(we="3600"), "elo_out_of_range"),
    (made(date="2018.12.31"), "before_min_month"),
    (made(moves="1. e4 { [%clk 0:0"), "incomplete"),
    (made(more='[Variant "Atomic"]\n'), "variant"),
    (made(id="short"), "no_game_id"),
]


def test_reasons(spark):
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(CASES)], "i int, value string")
    got = text.with_reason(df.select("value"), Config()).select("reason").collect()
    assert sorted(r[0] for r in got) == sorted(x for _, x in CASES)
    games = text.kept_games(text.with_reason(df), Config()).collect()
    assert {(g.game_id, g.tc_class, g.white_elo, g.has_evals, str(g.utc_date)) for g in games} == {("abcd1234", "blitz", 1500, True, "2024-05-01"), ("abcd1234", "rapid", 1500, True, "2024-05-01")}


def test_movetext(spark):
    moves = "1. Nf3 $6 { [%clk 1:02:03] } d5!? { [%eval -0.08] [%clk 0:59:59] } { a remark } 2. g3 { [%eval #2] } { [%clk 0:00:07] } Nc6 {unclosed 0-1"
    got = spark.createDataFrame([(moves,), (None,), ("",)], "m string").select(text.move_tokens(F.col("m")).alias("t")).collect()
    assert [tuple(x) for x in got[0].t][:3] == [("Nf3", 3723.0, None, None), ("d5", 3599.0, -8, None), ("g3", 7.0, None, 2)]
    assert got[1].t is None and got[2].t == []


def test_parse_and_replay(spark):
    clocks = ["0:05:00", "0:05:00", "0:04:51", "0:04:58", "0:04:44", "0:04:40", "0:04:41"]
    sans = ["c4", "d5", "cxd5", "Qxd5", "Nc3", "Qd8", "d4"]
    moves = " ".join(f"{s} {{ [%clk {c}] }}" for s, c in zip(sans, clocks)) + " 1-0"
    df = spark.createDataFrame([(made(id="goodgame", moves=moves),), (made(id="badmove1", moves="1. e5 { [%clk 0:03:00] } 1-0"),), (made(id="noclock1", moves="1. e4 { [%clk 0:03:00] } e5 1-0"),)], "value string")
    games = text.kept_games(text.with_reason(df))
    meta, rows = replay.parse_moves(games)
    assert {(r.game_id, r.n_plies, r.parse_error) for r in meta.collect()} == {("goodgame", 7, None), ("badmove1", None, "illegal_move"), ("noclock1", None, "missing_clock")}
    rows = rows.cache()
    got = rows.orderBy("ply").collect()
    assert [r.uci for r in got] == ["c2c4", "d7d5", "c4d5", "d8d5", "b1c3", "d5d8", "d2d4"]
    assert [r.time_spent_s for r in got] == [None, None, 11, 4, 9, 20, 5]
    sampled = spark.createDataFrame([("goodgame", 4), ("goodgame", 5), ("goodgame", 1)], "game_id string, ply smallint")
    out = {r.ply: r for r in replay.replay_positions(sampled, rows).collect()}
    assert out[4].is_capture and out[4].is_recapture and out[4].opp_prev_was_capture and out[4].opp_prev_uci == "c4d5"
    assert not out[5].is_capture and out[5].opp_prev_was_capture and out[5].prev_own_time_spent_s == 11 and out[5].opp_prev_time_spent_s == 4
    assert out[1].n_legal_moves == 20 and out[1].opp_prev_uci is None and out[1].phase == "opening" and len(out[1].position_id) == 16
    native = spark.createDataFrame([(["e2e4", "d7d5", "e4d5", "g8f6", "f1b5", "c7c6", "g1f3", "b8d7", "e1g1"],)], "u array<string>").select(replay.placement_after(F.col("u")).alias("p")).first().p
    b = Board()
    for u in ["e2e4", "d7d5", "e4d5", "g8f6", "f1b5", "c7c6", "g1f3", "b8d7", "e1g1"]:
        b.push(b.parse_uci(u))
    assert native == "".join("".join(b.at[21 + 10 * r : 29 + 10 * r]) for r in range(8))


def test_puzzles(spark, tmp_path):
    from tickmill.sources import records

    fen = "r1bqkb1r/pppp1ppp/2n2n2/4p2Q/2B1P3/8/PPPP1PPP/RNB1K1NR b KQkq - 0 1".replace(" b ", " b ")
    lines = ["PuzzleId,FEN,Moves,Rating,RatingDeviation,Popularity,NbPlays,Themes,GameUrl,OpeningTags,DailyDate"]
    for pid, setup, url in (("Mate", "a7a6", "https://example.org/goodgame/black#6"), ("Bad", "h7h6", "https://example.org/goodgame/black#6"), ("Reply", "a7a6", "https://example.org/endsgame/black#6"), ("Other", "a7a6", "https://example.org/nonesuch/black#6")):
        lines.append(f"{pid},{fen},{setup} h5f7,1000,80,90,10,mateIn1 short,{url},,")
    (tmp_path / "p.csv").write_text("\n".join(lines))
    puzzles = records.read_puzzles(spark, str(tmp_path / "p.csv"))
    games = spark.createDataFrame([(g, 1500, 1400, "blitz", 180, 2) for g in ("goodgame", "endsgame")], "game_id string, white_elo int, black_elo int, tc_class string, base_s int, increment_s int")
    moves = spark.createDataFrame([("goodgame", 6, "a7a6", 3.0), ("goodgame", 7, "h5f7", 4.0), ("endsgame", 6, "a7a6", 3.0)], "game_id string, ply int, uci string, time_spent_s double")
    got = {r.puzzle_id: r for r in replay.puzzle_outcomes(puzzles, games, moves).collect()}
    assert {k: v.outcome for k, v in got.items()} == {"Mate": "kept", "Bad": "setup_mismatch", "Reply": "no_solver_move"}
    assert got["Mate"].played_solution and got["Mate"].solver_elo == 1500 and got["Mate"].ply == 7 and got["Mate"].time_spent_s == 4 and got["Mate"].solution_line == ["h5f7"]


def test_scores(spark):
    row = spark.range(1).select(
        scores.win_pct(F.lit(0)).alias("a"), scores.win_pct(F.lit(100)).alias("b"), scores.win_pct(F.lit(5000)).alias("c"), scores.score_to_cp(F.lit(30), F.lit(0)).alias("d"), scores.score_to_cp(F.lit(30), F.lit(25)).alias("e"),
        scores.acceptable(F.lit(60.0), F.lit(55.0)).alias("f"), scores.band(F.lit(-7), 2).alias("g"), scores.clip(F.lit(None).cast("int"), 1, 2).alias("h"),
    ).first()
    assert row.a == 50 and round(row.b, 2) == 59.10 and row.c == pytest.approx(97.55, abs=0.01) and row.d == -1000 and row.e == 1000 and row.f and row.g == -8 and row.h is None
    q = ranks.at_ranks(spark.createDataFrame([(x,) for x in range(1, 8)], "x int"), [], "x", None, {"q": ranks.nearest(0.9)}).first().q
    assert q == 6
    with pytest.raises(Exception, match="no value"):
        spark.createDataFrame([("z",)], "k string").select(scores.mapped(F.col("k"), {"a": 1.0}).alias("v")).collect()


@pytest.mark.parametrize("bad", [{"nope": 1}, {"filter": {"x": 1}}, {"budget": {"strict_quantile": 0.9}}, {"budget": {"clip_s": [["blitz", 3, 60]]}}, {"categories": {"sharp_max_acceptable": 5}}, {"sampling": {"ply_bucket_edges": [40, 20]}}])
def test_config(bad):
    with pytest.raises((ValueError, TypeError)):
        Config.from_dict(bad)
    assert Config.from_dict({"filter": {"min_elo": 500}}).filter.min_elo == 500


def test_tags_by_every_line(spark):
    """The quick cut of header tags against a walk over all lines: repeated, broken, empty and look-alike lines."""
    import random
    import re

    r = random.Random(31)
    lines = ['[Event "a"]', '[Event ""]', '[Event "b" ', '[Event "c"]  ', ' [Event "d"]', '[Event  "e"]', '[EventDate "f"]', '[Event "x [Event "g"]', '[Event "h"] {', '[Event "]', "text", '[Site "s]"]', '[Site "é"]\r', '[Event "i"]"]', ""]
    heads = ["\n".join(r.choice(lines[:-1]) for _ in range(r.randrange(6))) for _ in range(400)]

    def walked(head, name):
        found = None
        for line in head.split("\n\n")[0].replace("\r", "").split("\n"):
            line = line.rstrip(" ")
            if m := re.fullmatch(rf'\[{name} "(.*)"\]', line):
                found = m[1]
        return found

    got = text.parsed_headers(spark.createDataFrame([(h + "\n\n1. e4 *",) for h in heads], "value string")).select("Event", "Site").collect()
    assert [(x.Event, x.Site) for x in got] == [(walked(h, "Event"), walked(h, "Site")) for h in heads]


def test_config_files(tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "a.yaml").write_text("seed: 7\nfilter:\n  min_elo: 900\nbudget:\n  clip_s: [[blitz, 3, 40], [rapid, 3, 90]]\n")
    (tmp_path / "a.json").write_text('{"seed": 7, "filter": {"min_elo": 900}, "budget": {"clip_s": [["blitz", 3, 40], ["rapid", 3, 90]]}}')
    (tmp_path / "empty.yml").write_text("")
    assert Config.from_file(str(tmp_path / "a.yaml")) == Config.from_file(str(tmp_path / "a.json")) != Config() == Config.from_file(str(tmp_path / "empty.yml"))
    (tmp_path / "bad.yaml").write_text("filter:\n  nope: 1\n")
    with pytest.raises((ValueError, TypeError)):
        Config.from_file(str(tmp_path / "bad.yaml"))
