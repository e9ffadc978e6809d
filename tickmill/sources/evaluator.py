"""External position evaluators: a UCI engine as a process of its own, and how its answers become labels."""

from __future__ import annotations

import glob
import math
import os
import subprocess
import time

from ..config import Config
from ..operators.board import Board


def find_binary(explicit: str = "", patterns: tuple[str, ...] = ("/usr/games/*fish*", "/usr/local/bin/*fish*")) -> str:
    """The configured path if it is set, else the first hit of the patterns; an error if there is none."""
    if explicit:
        if not os.path.exists(explicit):
            raise FileNotFoundError(explicit)
        return explicit
    for p in patterns:
        if found := sorted(glob.glob(p)):
            return found[0]
    raise FileNotFoundError("no evaluator; set TICKMILL_EVALUATOR")


def win_pct(cp: int | None, mate: int | None, cfg: Config) -> float:
    a = cfg.acceptability
    x = (a.cp_ceiling if mate > 0 else -a.cp_ceiling) if mate is not None else max(-a.cp_ceiling, min(a.cp_ceiling, cp or 0))
    return 50 + 50 * (2 / (1 + math.exp(-a.win_pct_k * x)) - 1)


def parse_info(line: str) -> dict | None:
    """depth, multipv, cp or mate, nodes and the first move of a UCI `info` line that has a line of play; bounds don't count."""
    words = line.split()
    if words[:1] != ["info"] or "pv" not in words or "lowerbound" in words or "upperbound" in words:
        return None
    after = lambda k, d=None: int(words[words.index(k) + 1]) if k in words else d
    return {"depth": after("depth", 0), "rank": after("multipv", 1), "cp": after("cp"), "mate": after("mate"), "nodes": after("nodes", 0), "uci": words[words.index("pv") + 1]}


def depth_profile(tops: dict[int, str], best: str) -> tuple[int | None, int | None]:
    """(first depth at which best leads, depth from which it stays)."""
    lead = [d for d, m in tops.items() if m == best]
    last_other = max((d for d, m in tops.items() if m != best), default=-1)
    stays = [d for d in lead if d > last_other]
    return (min(lead, default=None), min(stays, default=None))


class UciEvaluator:
    """One engine process; `label` searches a position and, if need be, the moves played there."""

    def __init__(self, path: str, nodes: int = 500_000, played_nodes: int = 100_000, hash_mb: int = 64, cfg: Config | None = None):
        self.cfg, self.nodes, self.played_nodes = cfg or Config(), nodes, played_nodes
        self.process = subprocess.Popen([path], stdin=subprocess.PIPE, stdout=subprocess.PIPE, text=True, bufsize=1)
        self._say("uci", "setoption name Threads value 1", f"setoption name Hash value {hash_mb}", "isready")
        self._until("readyok")

    def _say(self, *lines: str) -> None:
        for x in lines:
            print(x, file=self.process.stdin, flush=True)

    def _until(self, word: str) -> list[str]:
        out = []
        while line := self.process.stdout.readline():
            out.append(line.strip())
            if out[-1].startswith(word):
                return out
        raise RuntimeError("the evaluator ended")

    def search(self, fen: str, lines: int, nodes: int, moves: tuple[str, ...] = ()) -> list[dict]:
        self._say("ucinewgame", f"setoption name MultiPV value {lines}", f"position fen {fen}", f"go nodes {nodes}" + (" searchmoves " + " ".join(moves) if moves else ""))
        return [x for x in map(parse_info, self._until("bestmove")) if x]

    def label(self, fen: str, played: list[str]) -> dict:
        began = time.time()
        k = min(self.cfg.multipv, len(Board(fen).legal()))
        infos = self.search(fen, k, self.nodes)
        last = {x["rank"]: x for x in infos}
        tops = {x["depth"]: x["uci"] for x in infos if x["rank"] == 1}
        lines = sorted(({"uci": x["uci"], "cp": x["cp"], "mate": x["mate"], "win_pct": win_pct(x["cp"], x["mate"], self.cfg)} for x in last.values()), key=lambda x: -x["win_pct"])
        best, known = lines[0], {x["uci"]: x for x in lines}
        graded = []
        for move in played:
            x = known.get(move)
            if x is None:
                found = self.search(fen, 1, self.played_nodes, (move,))[-1]
                x = {"uci": move, "cp": found["cp"], "mate": found["mate"], "win_pct": win_pct(found["cp"], found["mate"], self.cfg)}
            graded.append({**x, "in_multipv": move in known, "loss_win_pct": best["win_pct"] - x["win_pct"]})
        first, stable = depth_profile(tops, best["uci"])
        return {"best_uci": best["uci"], "best_win_pct": best["win_pct"], "lines": lines, "depth": max(tops), "nodes": max(x["nodes"] for x in infos), "best_move_first_depth": first, "best_move_stable_depth": stable, "played": graded, "seconds": time.time() - began}

    def close(self) -> None:
        try:
            self._say("quit")
            self.process.wait(timeout=5)
        except (OSError, subprocess.TimeoutExpired):
            self.process.kill()
