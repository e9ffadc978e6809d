"""All jobs in a row on a small dump, with a stand-in evaluator whose scores are made up and only used here."""

import json
import os
import random
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from tickmill.config import Config, Settings
from tickmill.operators import reports
from tickmill.operators.board import Board
from tickmill.plans import cli, jobs
from tickmill.sources import database, evaluator, store

from .test_rules import made


class MaterialEvaluator:
    """Orders legal moves by what they capture: a stand-in, not an engine."""

    def label(self, fen, played):
        board, worth = Board(fen), {"p": 100, "n": 300, "b": 300, "r": 500, "q": 900, ".": 0, "k": 0}
        cfg = Config()
        lines = []
        for m in board.legal():
            cp = worth[board.at[m[1]].lower()]
            lines.append({"uci": board.uci(m), "cp": cp, "mate": None, "win_pct": evaluator.win_pct(cp, None, cfg)})
        lines.sort(key=lambda x: (-x["win_pct"], x["uci"]))
        known = {x["uci"]: x for x in lines}
        graded = [{**known[p], "in_multipv": True, "loss_win_pct": lines[0]["win_pct"] - known[p]["win_pct"]} for p in played]
        return {"best_uci": lines[0]["uci"], "best_win_pct": lines[0]["win_pct"], "lines": lines[:5], "depth": 1, "nodes": len(lines), "best_move_first_depth": 1, "best_move_stable_depth": 1, "played": graded, "seconds": 0.0}

    def close(self):
        pass


def played(r, plies):
    """A random legal game as movetext with clocks."""
    board, out, clock = Board(), [], [300, 300]
    for i in range(plies):
        move = r.choice(board.legal())
        # SAN that names the origin square always fits
        kind = board.at[move[0]].upper()
        to, at = Board.uci(move)[2:4], Board.uci(move)[:2]
        if kind == "K" and abs(move[0] - move[1]) == 2:
            san = "O-O" if to[0] == "g" else "O-O-O"
        elif kind == "P":
            san = (at[0] + "x" if board.is_capture(move) else "") + to + ("=" + move[2].upper() if move[2] else "")
        else:
            san = kind + at + ("x" if board.is_capture(move) else "") + to
        board.push(move)
        clock[i % 2] -= r.choice([1, 2, 5, 9]) if i > 1 else 0
        out.append(f"{i // 2 + 1}{'.' if i % 2 == 0 else '...'} {san} {{ [%clk 0:{clock[i % 2] // 60:02d}:{clock[i % 2] % 60:02d}] }}")
        if not board.legal():
            break
    return " ".join(out) + " 1-0"


def test_all_jobs(spark, tmp_path):
    r = random.Random(12)
    games = [made(id=f"game{i:04d}", date=f"2024.0{1 + i % 2}.10", we=str(1200 + 40 * i), tc="300+0", moves=played(r, 44)).strip() for i in range(8)]
    games.append(made(id="notkept1", tc="60+0").strip())
    dump, interim, out, serving = tmp_path / "g.pgn", str(tmp_path / "i"), str(tmp_path / "o"), str(tmp_path / "s")
    dump.write_text("\n\n".join(games) + "\n")
    cfg = Config.from_dict({"budget": {"grid": [1200, 1500, 100], "min_successes": 2, "max_half_width": 200}})
    assert jobs.filter_games(spark, str(dump), interim, cfg) == {"kept": 8, "class_bullet": 1}
    assert jobs.parse_games(spark, interim, cfg) == {"parsed": 8}
    # one month again: the other one stays; other settings are refused
    assert jobs.parse_games(spark, interim, cfg, ["2024-01"]) == {"parsed": 8}
    with pytest.raises(ValueError, match="other settings"):
        jobs.parse_games(spark, interim, Config.from_dict({"seed": 5}), ["2024-01"])
    moves = spark.read.parquet(f"{interim}/moves")
    assert moves.select("game_id").distinct().count() == 8
    assert spark.read.parquet(f"{interim}/games").where("n_plies > 0 and est_duration_s = 300").count() == 8
    by_band = reports.timing_by_band(moves, spark.read.parquet(f"{interim}/games"))
    assert by_band.agg(F.sum("n")).first()[0] == moves.where("time_spent_s is not null").count()
    assert reports.timing_by_control(moves, spark.read.parquet(f"{interim}/games"), 1).first().control == "300+0" and reports.flag_shares(moves).first().time_added == 0
    summary = jobs.sample_positions(spark, interim, out, cfg, 1000)
    sampled = spark.read.parquet(f"{out}/sampled_positions")
    assert summary["n"] == sampled.count() == 24 and summary["games"] == 8
    assert summary["population"] == pytest.approx(moves.where("ply >= 10 and time_spent_s is not null").count())
    assert reports.sample_strata(sampled).agg(F.sum("sampled")).first()[0] == 24
    # replay agrees with an independent one
    one = sampled.orderBy("game_id", "ply").first()
    board = Board()
    for m in moves.where((F.col("game_id") == one.game_id) & (F.col("ply") < one.ply)).orderBy("ply").collect():
        board.push(board.parse_uci(m.uci))
    assert (board.fen(), board.epd(), len(board.legal())) == (one.fen, one.epd, one.n_legal_moves)
    (tmp_path / "db.jsonl").write_text(json.dumps({"fen": one.epd, "evals": [{"pvs": [{"cp": 3, "line": Board.uci(board.legal()[0])}], "knodes": 5000, "depth": 30}]}, separators=(",", ":")) + "\n")
    assert jobs.lookup_evaluations(spark, str(tmp_path / "db.jsonl"), out, cfg)["covered"] == pytest.approx(1 / 24)
    assert jobs.label(spark, out, MaterialEvaluator, cfg, limit=5) == 5
    rest = jobs.label(spark, out, MaterialEvaluator, cfg)
    assert rest == sampled.select("position_id").distinct().count() - 5 and jobs.label(spark, out, MaterialEvaluator, cfg) == 0
    assert reports.label_summary(spark.read.parquet(f"{out}/labels")).first().n == rest + 5
    checks = jobs.build_observations(spark, out, cfg)
    assert checks["n"] == checks["observations"] == 24 and checks["lines_sorted"] and checks["above_best_by_1"] == 0
    obs = [r for r in spark.read.parquet(f"{out}/labeled_observations").collect() if r.loss_win_pct is not None]
    assert checks["y_population"] == pytest.approx(sum(r.sampling_weight for r in obs if r.y) / sum(r.sampling_weight for r in obs))
    assert sum(r["n"] for r in checks["by_state"]) == sum(r["n"] for r in checks["by_class_band_state"]) == 24
    assert sum(r["positions"] for r in checks["by_category"]) == len({r.position_id for r in obs}) and checks["evaluation_check"]["n"] <= 1
    report = jobs.build_budgets(spark, out, cfg)
    assert report["rows"] == 2 * 6 * 4 and all("increases" not in v for v in report["violations"])
    n = jobs.build_pool(spark, interim, out, cfg)
    pool = spark.read.parquet(f"{out}/trainer_pool")
    assert n == pool.select("position_id").distinct().count() > 0 and pool.where("prev_fen is null").count() == 0
    assert reports.pool_counts(pool).where("dimension = 'phase'").agg(F.sum("n")).first()[0] == n
    assert jobs.load_serving(spark, out, serving)["added"] == n
    store.write_table(pool.limit(n - 1), str(tmp_path / "o2") + "/trainer_pool")
    again = jobs.load_serving(spark, str(tmp_path / "o2"), serving)
    assert (again["added"], again["updated"], again["deactivated"]) == (0, n - 1, 1)
    assert spark.read.parquet(again["path"]).where("active").count() == n - 1 and spark.read.parquet(again["path"]).count() == n
    # the command line: the whole load, twice; the first user and their settings stay
    app = str(tmp_path / "app")
    first, second = (cli.run(spark, ["load"], Settings(interim=interim, processed=out, database=app)) for _ in range(2))
    assert first["positions"]["added"] == n and second["positions"]["updated"] == n and first["budget_rows"] == report["rows"] and second["user_id"] == 1
    live = store.Snapshots(spark, app)
    assert live.versions() == [1, 2] and live.tables()["users"].first().rating == 1500 and live.tables()["user_settings"].first().default_class == "blitz"
    assert live.tables()["positions"].count() == n and live.tables()["category_budgets"].count() == report["rows"]
    assert json.loads((tmp_path / "o/reports/load.json").read_text())["budget_rows"] == report["rows"]
    assert cli.run(spark, ["--out", out, "observations"])["y_population"] == checks["y_population"] and "## by_category" in (tmp_path / "o/reports/observations.md").read_text()
    store.write_table(spark.createDataFrame([(1, "nowhere")], "user_id long, position_id string"), f"{app}/attempts")
    with pytest.raises(ValueError, match="attempts.position_id"):
        cli.run(spark, ["load"], Settings(interim=interim, processed=out, database=app))
    assert live.versions() == [1, 2]
    # the same into a SQL database, twice
    url = f"jdbc:derby:{tmp_path}/sql;create=true"
    database._execute(spark, url, ["CREATE TABLE positions (position_id varchar(40), fen varchar(100), category varchar(20), source_rating int, active boolean)", "CREATE TABLE users (user_id bigint, name varchar(20), rating int)", "CREATE TABLE category_budgets (model varchar(9), tc_class varchar(9), category varchar(20), rating int, budget_s double, budget_strict_s double, p_inf double, sparse boolean)"])
    loads = [jobs.load_database(spark, out, url, cfg) for _ in range(2)]
    assert [x["users_added"] for x in loads] == [1, 0] and loads[1]["budgets"] == {"deleted": report["rows"], "inserted": report["rows"]} and loads[1]["positions"] == {"merged": n, "deactivated": 0}
    assert database.read(spark, url, "positions").count() == n
    # bucketed by game: joins and windows over games shuffle nothing
    jobs.bucket_games(spark, interim, "tickmill_buckets", 4)
    both = spark.table("tickmill_buckets.moves").join(spark.table("tickmill_buckets.games").select("game_id", "white_elo"), "game_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        timed = both.withColumn("n", F.count("*").over(Window.partitionBy("game_id")))
        assert timed.count() == moves.count() and "Exchange" not in timed._jdf.queryExecution().executedPlan().toString() and "Exchange" not in both.groupBy("game_id").count()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE tickmill_buckets CASCADE")
    # a pool whose games don't replay is refused
    broken = spark.read.parquet(f"{out}/labeled_observations").withColumn("fen", F.lit("other"))
    from tickmill.operators import replay

    with pytest.raises(Exception, match="FEN mismatch"):
        replay.trainer_pool(broken, spark.read.parquet(f"{out}/labels"), moves, cfg).collect()


class Breaking:
    """Logs every position it is asked for, and breaks at one of them."""

    def __init__(self, folder, name, bad=None):
        self.folder, self.name, self.bad = folder, name, bad

    def __call__(self):
        return self

    def label(self, fen, played):
        if fen == self.bad:
            while len(os.listdir(f"{self.folder}/o/labels") if os.path.isdir(f"{self.folder}/o/labels") else []) < 8:  # other units are done meanwhile
                time.sleep(0.05)
            raise RuntimeError("the engine broke")
        with open(f"{self.folder}/{self.name}", "a") as f:
            f.write(fen + "\n")
        return {"best_uci": "a2a3", "best_win_pct": 50.0, "lines": [], "depth": 1, "nodes": 1, "best_move_first_depth": 1, "best_move_stable_depth": 1, "played": [], "seconds": 0.0}

    def close(self):
        pass


def test_label_goes_on_after_a_loss(spark, tmp_path):
    """A job that dies leaves what its units finished; the next one labels the rest, nothing twice. No unit waits for the broken one."""
    out = str(tmp_path / "o")
    spark.range(60).select(F.format_string("p%d", "id").alias("position_id"), F.format_string("e%d", "id").alias("epd"), F.format_string("f%d", "id").alias("fen"), F.lit("a2a3").alias("played_uci")).write.parquet(f"{out}/sampled_positions")
    spark.createDataFrame([], "epd string, n_pvs int, pvs array<struct<uci:string>>").write.parquet(f"{out}/evaldb_matches")
    with pytest.raises(Exception, match="the engine broke"):
        jobs.label(spark, out, Breaking(str(tmp_path), "one", "f17"), batch=3)
    first = {r.position_id for r in spark.read.parquet(f"{out}/labels").collect()}
    assert 0 < len(first) < 60 and "p17" not in first
    n = jobs.label(spark, out, Breaking(str(tmp_path), "two"), batch=3)
    asked = [f"p{x[1:]}" for x in (tmp_path / "two").read_text().split()]
    got = [r.position_id for r in spark.read.parquet(f"{out}/labels").collect()]
    assert n == len(asked) == len(set(asked)) <= 60 - len(first) and set(asked).isdisjoint(first)
    assert sorted(got) == sorted(f"p{i}" for i in range(60))


def test_versions(spark, tmp_path):
    """Readers of a version see its tables while others are written; two loads from one base can't both be the next."""
    s = store.Snapshots(spark, str(tmp_path / "s"))
    assert s.current() == {"version": 0, "tables": {}} and s.tables() == {}

    def load(n, *tables):
        base, new = s.current(), {}
        for t in tables:
            new[t] = s.place(t)
            spark.range(n).write.parquet(f"{s.folder}/{new[t]}")
        return base, new

    base, new = load(3, "a", "b")
    assert s.tables() == {}  # written, but no version names them
    s.commit(base, new)
    before = s.tables()
    base, new = load(5, "a")
    other, late = load(9, "a", "b")
    assert s.commit(base, new)["version"] == 2
    with pytest.raises(RuntimeError, match="another load"):
        s.commit(other, late)
    assert {k: v.count() for k, v in s.tables().items()} == {"a": 5, "b": 3} and {k: v.count() for k, v in before.items()} == {"a": 3, "b": 3} == {k: v.count() for k, v in s.tables(1).items()}
    assert s.expire(1) == 3 and s.versions() == [2] and {k: v.count() for k, v in s.tables().items()} == {"a": 5, "b": 3}
    with pytest.raises(FileNotFoundError):
        s.current(1)
    for text in ("one", "two"):
        store.write_text(spark, str(tmp_path / "t" / "x.txt"), text)
        assert store.read_text(spark, str(tmp_path / "t" / "x.txt")) == text
    assert [p.name for p in (tmp_path / "t").iterdir() if not p.name.endswith(".crc")] == ["x.txt"]


def test_migrations_both_ways(spark):
    """Up and down between versions: rows stay, columns come and go."""
    store.migrate(spark, "tickmill_steps", 1)
    spark.sql("INSERT INTO tickmill_steps.users VALUES (7, timestamp'2024-01-01'), (8, null)")
    store.migrate(spark, "tickmill_steps")
    spark.sql("INSERT INTO tickmill_steps.users VALUES (9, null, 'Ann', 1700)")
    assert "users" in store.downgrade(spark, "tickmill_steps", 1) and store.downgrade(spark, "tickmill_steps", 1) == []
    assert spark.table("tickmill_steps.users").columns == ["user_id", "created_at"] and [r.user_id for r in spark.table("tickmill_steps.users").orderBy("user_id").collect()] == [7, 8, 9]
    assert store.migrate(spark, "tickmill_steps") == [] and [r.name for r in spark.table("tickmill_steps.users").collect()] == [None] * 3
    store.downgrade(spark, "tickmill_steps")
    assert not spark.catalog.databaseExists("tickmill_steps")


def test_evaluator_answers():
    x = evaluator.parse_info("info depth 12 seldepth 15 multipv 2 score cp -35 nodes 1234 nps 1 pv e2e4 e7e5")
    assert x == {"depth": 12, "rank": 2, "cp": -35, "mate": None, "nodes": 1234, "uci": "e2e4"}
    assert evaluator.parse_info("info depth 3 score mate -2 nodes 5 pv a2a3")["mate"] == -2
    assert evaluator.parse_info("info depth 3 score cp 5 lowerbound pv a2a3") is None and evaluator.parse_info("bestmove e2e4") is None
    assert evaluator.depth_profile({1: "d2d4", 2: "e2e4", 3: "e2e4", 4: "g1f3", 5: "e2e4", 6: "e2e4"}, "e2e4") == (2, 5)
    with pytest.raises(FileNotFoundError):
        evaluator.find_binary("/no/such/file")
    with pytest.raises(FileNotFoundError):
        evaluator.find_binary("", ("/no/such/*",))


def test_engine_process(tmp_path):
    """The protocol against a scripted engine."""
    script = tmp_path / "engine.py"
    script.write_text('''#!/usr/bin/env python3
import sys
for line in sys.stdin:
    w = line.split()
    if w[:1] == ["isready"]: print("readyok", flush=True)
    if w[:1] == ["go"]:
        if "searchmoves" in w: print("info depth 4 multipv 1 score cp -50 nodes 9 pv " + w[-1])
        else:
            print("info depth 1 multipv 1 score cp 10 nodes 5 pv d2d4"); print("info depth 2 multipv 1 score cp 30 nodes 8 pv e2e4"); print("info depth 2 multipv 2 score cp 20 nodes 8 pv d2d4")
        print("bestmove e2e4", flush=True)
    if w[:1] == ["quit"]: break
''')
    script.chmod(0o755)
    engine = evaluator.UciEvaluator(str(script))
    got = engine.label("rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1", ["d2d4", "a2a3"])
    engine.close()
    assert (got["best_uci"], got["depth"], got["best_move_first_depth"], got["best_move_stable_depth"]) == ("e2e4", 2, 2, 2)
    assert [p["in_multipv"] for p in got["played"]] == [True, False] and got["played"][1]["loss_win_pct"] > got["played"][0]["loss_win_pct"] > 0
