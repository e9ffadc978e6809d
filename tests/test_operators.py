"""Timing, sampling, labels, survival, sinks and streaming on small tables with values worked out by hand."""

import json
import math

import pytest
from pyspark.sql import functions as F
from tickmill.config import Config
from tickmill.operators import labels, sampling, survival, timing
from tickmill.sources import records, store
from tickmill.streaming import ingest

from .test_rules import CASES, made


def clocked(clocks, base, inc, kind):
    """(time spent, own clock before, opponent's clock, berserk, added, premove, low) of each move, from one walk over the game."""
    rules, out = {"blitz": 10, "rapid": 20, "classical": 30}, []
    for i, clk in enumerate(clocks):
        own = clocks[i - 2] if i > 1 else clk
        seen = clocks[i - 1] if i else clocks[1] if len(clocks) > 1 else base
        half = base > 2 and abs(clocks[i % 2] - base / 2) <= 1
        raw = own - clk + (0 if half else inc)
        added = i > 1 and raw < -1
        spent = None if i < 2 or added else max(raw, 0)
        out.append((spent, own, seen, half, added, spent is not None and spent <= 0, own < rules.get(kind, -1)))
    return out


def test_clocks(spark):
    """Random games: increments, berserk starts, clocks that rise by noise or by added time, low clocks, unknown classes."""
    import random

    r = random.Random(21)
    games = []
    for n in range(120):
        base, inc, kind = r.choice([(60, 0, "blitz"), (240, 3, "blitz"), (600, 5, "rapid"), (1, 1, "other"), (1800, 20, "classical")])
        left = [base / 2 if r.random() < 0.3 else base for _ in range(2)]
        clocks = []
        for i in range(r.choice([1, 2, 3, 12, 30])):
            if i > 1:
                left[i % 2] = max(0, left[i % 2] - r.choice([0, 0, 1, 5, base // 7]) + inc + r.choice([0, 0, 0, 1, -1, 15]))
            clocks.append(float(left[i % 2]))
        games.append((clocks, base, inc, kind))
    rows = [(f"g{n}", i + 1, c, base, inc, kind) for n, (clocks, base, inc, kind) in enumerate(games) for i, c in enumerate(clocks)]
    df = spark.createDataFrame(rows, "game_id string, ply int, clk double, base_s int, increment_s int, tc_class string")
    got = {}
    for x in timing.move_timings(df).orderBy("game_id", "ply").collect():
        got.setdefault(x.game_id, []).append((x.time_spent_s, x.own_clk_before_s, x.opp_clk_s, x.berserk, x.time_added, x.premove_suspect, x.low_clock))
    assert got == {f"g{n}": clocked(*g) for n, g in enumerate(games)}
    # a null clock gives null times on both moves that it is part of
    lost = spark.createDataFrame([("g", i + 1, c, 60, 0, "blitz") for i, c in enumerate([60.0, 60.0, None, 50.0, 40.0, 45.0])], df.schema)
    assert [x.time_spent_s for x in timing.move_timings(lost).orderBy("ply").collect()] == [None, None, None, 10, 0, 5]


def population(spark):
    games = spark.createDataFrame([(f"g{i:02d}", "2024-01", "blitz", 180, 0, 800 + 50 * i, 825 + 50 * i) for i in range(12)], "game_id string, month string, tc_class string, base_s int, increment_s int, white_elo int, black_elo int")
    moves = spark.createDataFrame([(f"g{i:02d}", p, 180.0 - p - (p % 3), 180, 0, "blitz") for i in range(12) for p in range(1, 41)], "game_id string, ply int, clk double, base_s int, increment_s int, tc_class string")
    return games, timing.move_timings(moves)


def test_sampling(spark):
    games, moves = population(spark)
    everything = Config.from_dict({"sampling": {"positions_per_game": 1000}})
    c = sampling.game_candidates(moves, games, everything)
    n = sampling.eligible(moves).count()
    whole = sampling.stratified(c, 10**6).agg(F.sum("sampling_weight").alias("w"), F.count("*").alias("n")).first()
    assert whole.n == n and whole.w == pytest.approx(n)
    one = lambda seed: {(r.game_id, r.ply) for r in sampling.stratified(sampling.game_candidates(moves, games, Config.from_dict({"seed": seed})), 20).collect()}
    assert one(1) == one(1) != one(2)
    per = sampling.game_candidates(moves, games).groupBy("game_id").count().collect()
    assert all(r["count"] <= 3 for r in per) and len(per) == 12


def test_budgets(spark):
    rows = []
    for kind, slow in (("blitz", 1), ("rapid", 2)):
        for elo in (1000, 1500, 2000):
            rows += [(kind, "tactical", "balanced", elo, float(slow * (i + 1) * 3), i % 4 != 3, 1.0, False, 1.0) for i in range(8)]
    rows += [("blitz", "forced", "balanced", 1000, 1.0, True, 0.0, False, 1.0), ("blitz", "tactical", "winning", 1000, 1.0, True, 0.0, False, 1.0), ("blitz", "tactical", "balanced", 1000, 1.0, True, 0.0, True, 1.0), ("blitz", "tactical", "balanced", 1000, 1.0, True, None, False, 1.0)]
    obs = spark.createDataFrame(rows, "tc_class string, category string, position_state string, mover_elo int, time_spent_s double, y boolean, loss_win_pct double, low_clock boolean, sampling_weight double")
    cfg = Config.from_dict({"budget": {"grid": [1000, 2000, 500], "min_successes": 5, "max_half_width": 200}})
    assert survival.training_rows(obs, cfg).count() == 48
    table = survival.fit_budgets(obs, cfg).cache()
    assert table.count() == 2 * 6 * 3
    got = {(r.tc_class, r.rating): r for r in table.where("category = 'tactical'").collect()}
    assert all(r.n_obs == 8 and r.n_success == 6 and r.p_inf == pytest.approx(0.75) and not r.sparse and r.half_width == 50 for r in got.values())
    assert all(got["rapid", x].budget_s >= got["blitz", x].budget_s >= got["blitz", x].budget_strict_s for x in (1000, 1500, 2000))
    assert {r.problem for r in survival.violations(table.where("category = 'tactical'"), cfg).collect()} == set()
    assert {r.problem for r in survival.violations(table, cfg).collect()} == {"missing values"}
    report = survival.budget_report(survival.training_rows(obs, cfg), table, cfg)
    assert report["training_rows"] == 48 and report["rows"] == 36 and report["sparse"] == 30


LABEL = "position_id string, epd string, best_uci string, best_win_pct float, lines array<struct<uci:string,cp:int,mate:int,win_pct:float>>, depth smallint, best_move_first_depth smallint, best_move_stable_depth smallint, played array<struct<uci:string,win_pct:float,in_multipv:boolean,loss_win_pct:float>>"
POSITION = "position_id string, epd string, fen string, played_uci string, game_id string, ply int, phase string, n_legal_moves int, opp_prev_was_capture boolean, opp_prev_uci string, time_spent_s double, sampling_weight double"


def labelled(spark):
    rows = [
        ("A", "ea", "e2e4", 60.0, [("e2e4", 90, None, 60.0), ("d2d4", 60, None, 57.0), ("a2a3", 0, None, 52.0)], 20, 1, 3, [("d2d4", 57.0, True, 3.0), ("h2h4", 40.0, False, 20.0)]),
        ("B", "eb", "g1f3", 95.0, [("g1f3", 900, None, 95.0)], 20, 1, 1, [("g1f3", 95.0, True, 0.0)]),
        ("C", "ec", "d4e5", 8.0, [("d4e5", -700, None, 8.0), ("a2a3", -900, None, 2.0)], 20, 1, 1, [("d4e5", 8.4, False, -0.4)]),
    ]
    positions = [("A", "ea", "f", "d2d4", "g1", 12, "middlegame", 30, False, "a7a6", 4.0, 1.0), ("A", "ea", "f", "h2h4", "g2", 14, "middlegame", 30, False, "a7a6", 6.0, 1.0), ("B", "eb", "f", "g1f3", "g3", 20, "middlegame", 1, False, None, 1.0, 2.0), ("C", "ec", "f", "d4e5", "g4", 30, "endgame", 20, True, "f6e5", 2.0, 1.0), ("D", "ed", "f", "a2a3", "g5", 30, "endgame", 20, True, "f6e5", 2.0, 1.0)]
    return spark.createDataFrame(positions, POSITION), spark.createDataFrame(rows, LABEL)


def test_observations(spark):
    positions, lab = labelled(spark)
    obs = labels.observations(positions, lab).cache()
    got = {(r.position_id, r.played_uci): r for r in obs.collect()}
    a, b, c, d = got["A", "d2d4"], got["B", "g1f3"], got["C", "d4e5"], got["D", "a2a3"]
    assert (a.y, got["A", "h2h4"].y, b.y, c.y, d.y) == (True, False, True, True, None)
    assert (a.n_lines, a.n_acceptable_lines, a.gap_1_2, a.gap_1_3, a.category, a.position_state) == (3, 2, 3.0, 8.0, "tactical", "balanced")
    assert (b.category, b.position_state, b.gap_1_2) == ("forced", "winning", None)
    assert (c.category, c.position_state, c.best_is_recapture) == ("recapture", "losing", True) and d.category in ("quiet", "endgame")
    by = labels.acceptance_by(obs, "position_state").collect()
    assert {r.position_state: r.n for r in by} == {"balanced": 2, "winning": 1, "losing": 1}
    assert [r.category for r in labels.category_mix(obs).collect()] == ["forced", "recapture", "tactical"]
    assert [r.position_state for r in labels.state_share(obs).collect()] == ["losing", "balanced", "winning"]


def test_evaluations(spark):
    from tickmill.operators.replay import first_legal_move

    start = "rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq -"
    black = "rnbqkbnr/pppppppp/8/8/4P3/8/PPPP1PPP/RNBQKBNR b KQkq -"
    recs = [
        {"fen": start, "evals": [{"pvs": [{"cp": 30, "line": "e2e4 e7e5"}], "knodes": 50000, "depth": 40}, {"pvs": [{"cp": 10, "line": "g1f3"}, {"cp": 25, "line": "d2d4"}, {"cp": 1, "line": "e2e5"}], "knodes": 20000, "depth": 30}]},
        {"fen": black, "evals": [{"pvs": [{"cp": 40, "line": "e7e5"}], "knodes": 2000, "depth": 20}]},
        {"fen": "4k3/8/8/8/8/8/8/4K2R w K -", "evals": [{"pvs": [{"mate": 3, "line": "e1h1"}], "knodes": 2000, "depth": 20}]},
        {"fen": "shallow", "evals": [{"pvs": [{"cp": 1, "line": "a2a3"}], "knodes": 5, "depth": 2}]},
        {"fen": "unwanted", "evals": []},
    ]
    lines = spark.createDataFrame([(json.dumps(r, separators=(",", ":")),) for r in recs] + [('{"fen":"cut',)], "value string")
    wanted = spark.createDataFrame([(r["fen"],) for r in recs[:4]], "epd string")
    kept = labels.wanted_records(lines, wanted)
    assert kept.count() == 4
    got = {r.epd: r for r in labels.parse_evaluations(kept, first_move=first_legal_move).collect()}
    s = got[start]
    assert len(got) == 3 and (s.best_uci, s.best_cp, s.best_knodes, s.n_evals, s.multi_knodes) == ("e2e4", 30, 50000, 2, 20000) and [p.uci for p in s.pvs] == ["d2d4", "g1f3"]
    assert got[black].best_cp == -40 and got["4k3/8/8/8/8/8/8/4K2R w K -"].best_uci == "e1g1" and got["4k3/8/8/8/8/8/8/4K2R w K -"].best_win_pct == pytest.approx(97.55, abs=0.01)
    db = labels.parse_evaluations(kept, first_move=first_legal_move)
    positions = spark.createDataFrame([("p", start, "f", "d2d4", 20), ("q", black, "f", "c7c5", 20), ("r", "none", "f", "c7c5", 20)], "position_id string, epd string, fen string, played_uci string, n_legal_moves int")
    cov = labels.coverage_by(labels.covered(positions, db, 2)).first()
    assert cov.n == 3 and cov.covered == pytest.approx(2 / 3) and cov.covered_multipv == pytest.approx(1 / 3) and cov.played_in_pvs == pytest.approx(1 / 3)
    assert {r.position_id for r in labels.positions_to_label(positions, db, 2).collect()} == {"q", "r"}


def test_depths(spark):
    tops = [(1, "d2d4"), (2, "e2e4"), (3, "e2e4"), (4, "g1f3"), (5, "e2e4"), (6, "e2e4")]
    df = spark.createDataFrame([(tops, "e2e4"), (tops, "a2a3")], "t array<struct<depth:int,uci:string>>, b string")
    first, stable = labels.depth_profile(F.col("t"), F.col("b"))
    assert [tuple(r) for r in df.select(first, stable).collect()] == [(2, 5), (None, None)]


def test_store(spark, tmp_path):
    old = spark.createDataFrame([("A", 1, True), ("B", 1, True)], "id string, v int, active boolean")
    new = spark.createDataFrame([("A", 2), ("C", 3)], "id string, v int")
    assert store.upsert_counts(old, new, "id") == {"added": 1, "updated": 1, "deactivated": 1}
    merged = store.upsert(old, new, "id")
    assert sorted(tuple(r) for r in merged.collect()) == [("A", 2, True), ("B", 1, False), ("C", 3, True)]
    path = str(tmp_path / "b")
    store.replace_partition(spark.createDataFrame([("m0", 1), ("m1", 2)], "model string, v int"), path, "model")
    store.replace_partition(spark.createDataFrame([("m0", 9)], "model string, v int"), path, "model")
    assert sorted((r.model, r.v) for r in spark.read.parquet(path).collect()) == [("m0", 9), ("m1", 2)]
    store.check_manifest(spark, str(tmp_path / "run"), {"seed": 1})
    store.check_manifest(spark, str(tmp_path / "run"), {"seed": 1})
    with pytest.raises(ValueError, match="seed"):
        store.check_manifest(spark, str(tmp_path / "run"), {"seed": 2})
    assert "| id | v |" in store.markdown("t", new)
    with pytest.raises(ValueError):
        store.markdown("t", spark.range(5), 4)
    assert store.migrate(spark, "tickmill_app", 1) == []
    spark.sql("INSERT INTO tickmill_app.users VALUES (7, timestamp'2024-01-01')")
    assert store.migrate(spark, "tickmill_app") == [] and store.migrate(spark, "tickmill_app") == []
    assert [(r.user_id, r.name, r.rating) for r in spark.table("tickmill_app.users").collect()] == [(7, None, None)]
    store.downgrade(spark, "tickmill_app")
    users = spark.createDataFrame([(1,)], "user_id long")
    store.check_references({"users": users, "user_settings": users})
    with pytest.raises(ValueError, match="attempts.user_id refers to missing users: 2"):
        store.check_references({"users": users, "attempts": spark.createDataFrame([(1, "p"), (2, "p"), (None, "p")], "user_id long, position_id string")})
    store.write_report(spark, str(tmp_path / "reports"), "job", {"n": 3, "rates": {"a": 0.5}, "rows": [{"x": 1, "y": None}], "none": []})
    assert json.loads((tmp_path / "reports/job.json").read_text())["rates"] == {"a": 0.5}
    assert (tmp_path / "reports/job.md").read_text().split("\n")[2:4] == ["- n: 3", "- none: "] and "| 1 |  |" in (tmp_path / "reports/job.md").read_text()
    assert [r["n"] for r in records.read_sidecars(spark, str(tmp_path / "reports"))] == [3]


def test_sources(spark, tmp_path):
    import zstandard

    dump = "\n\n".join(r.strip() for r, _ in CASES) + "\n"
    packed = zstandard.ZstdCompressor().compress(dump.encode())
    (tmp_path / "whole.pgn.zst").write_bytes(packed)
    games = records.read_games(spark, str(tmp_path / "whole.pgn.zst"))
    assert games.count() == len(CASES) and all(r.value.startswith("[Event ") for r in games.collect())
    (tmp_path / "plain.pgn").write_text(dump)
    assert sorted(r.value.strip() for r in records.read_games(spark, str(tmp_path / "plain.pgn")).collect()) == sorted(r.value.strip() for r in games.collect())
    (tmp_path / "lines.jsonl.zst").write_bytes(zstandard.ZstdCompressor().compress(b'{"fen":"a"}\n{"fen":"b"}\n{"fen'))
    assert [r.value for r in records.read_lines(spark, str(tmp_path / "lines.jsonl.zst")).collect()] == ['{"fen":"a"}', '{"fen":"b"}', '{"fen']


def test_ingest(spark, tmp_path):
    src, out, chk = (str(tmp_path / x) for x in ("in", "out", "chk"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.pgn").write_text("\n\n".join(r.strip() for r, _ in CASES) + "\n")
    ingest.ingest(spark, src, out, chk)
    want = {}
    for _, reason in CASES:
        want[reason] = want.get(reason, 0) + 1
    assert {r.reason: r.n for r in ingest.report(spark, out).collect()} == want
    ingest.ingest(spark, src, out, chk)  # nothing new
    assert {r.reason: r.n for r in ingest.report(spark, out).collect()} == want
    (tmp_path / "in" / "b.pgn").write_text(made(id="secondgm"))
    ingest.ingest(spark, src, out, chk)
    assert {r.reason: r.n for r in ingest.report(spark, out).collect()}["kept"] == want["kept"] + 1
    with pytest.raises(ValueError, match="other settings"):
        ingest.ingest(spark, src, out, chk, Config.from_dict({"filter": {"min_elo": 5}}))
    assert ingest.players_by_band(spark.read.parquet(out + "/games")).agg(F.sum("n")).first()[0] == 2 * (want["kept"] + 1)


def test_ecdf(spark):
    df = spark.createDataFrame([("a", float(v), 1.0 if v < 5 else 3.0) for v in range(10)], "k string, v double, w double")
    got = {r.at: r.share for r in survival.weighted_ecdf(df, ["k"], "v", "w", [4, 20]).collect()}
    assert got == {4.0: 0.25, 20.0: 1.0} and math.isclose(sum(got.values()), 1.25)
