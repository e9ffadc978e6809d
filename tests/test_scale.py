"""Steps whose cost once grew out of proportion to the tables: how they are planned and dealt."""

import pytest
from tickmill.operators.board import Board
from tickmill.plans import registry

from .test_queries import tables  # noqa: F401


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_condition_on_the_reason_stays_above_the_parsing(spark, tables):  # noqa: F811
    plan = optimized(registry.queries()["kept_games"](spark, tables[0]))
    above = plan.split("Generate explode")[0]
    assert "= kept)" in above and "substring_index" not in above
    assert plan.count("substring_index") < 100


@pytest.mark.parametrize("name", ["kept_games", "flt_reason_cascade", "board_replay", "san_to_uci"])
def test_rows_of_one_file_are_dealt_over_all_cores(spark, tables, name):  # noqa: F811
    assert registry.queries()[name](spark, tables[0]).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_pool_replays_the_samples_once(spark, tables):  # noqa: F811
    assert optimized(registry.queries()["trainer_pool"](spark, tables[0])).count("replayed(") <= 1


@pytest.mark.parametrize(
    "fen, moves, tried",
    [("rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1", 20, 0), ("4k3/4r3/8/8/8/8/4N3/4K3 w - - 0 1", 4, 4), ("4k3/8/8/8/7b/8/5B2/4K3 w - - 0 1", 6, 4), ("8/8/8/K2pP2r/8/8/8/7k w - d6 0 1", 6, 6)],
)
def test_moves_are_tried_only_where_a_line_does_not_tell(monkeypatch, fen, moves, tried):
    """Pinned knights and bishops are ruled out by the line; king's moves and captures en passant are tried."""
    calls, copy = [], Board.copy
    monkeypatch.setattr(Board, "copy", lambda b: calls.append(1) or copy(b))
    board = Board(fen)
    assert len(board.legal()) == moves and len(calls) == tried
    assert sorted(board.legal()) == sorted(m for m in board._pseudo() if board._safe(m))
