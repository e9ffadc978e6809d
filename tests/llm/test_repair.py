"""Repaired conversations against an exhaustive search over edits."""

import hashlib
import heapq
import random
import re
from zlib import crc32

import pytest
from tickmill.llm import repair

WHITE = " \t\n\x0b\x0c\r"
GOAL = re.compile(r"(s?(ua)+)?")


def searched(rows):
    """(cost, audit, repaired lines) by uniform-cost search over edit strings, with up to three insertions in a row; rows: (role, text, fault)."""
    queue, best = [(0, "", 0, 0, ())], None
    while queue:
        cost, audit, i, run, made = heapq.heappop(queue)
        if best and cost > best[0]:
            break
        initials = "".join(r[:1] or "?" for r, _ in made)  # a row without a role can't be kept
        if not GOAL.fullmatch(initials) and not GOAL.fullmatch(initials + "a") and not GOAL.fullmatch(initials + "ua"):
            continue
        if i == len(rows) and GOAL.fullmatch(initials):
            best = min(best or (cost, audit, made), (cost, audit, made))
            continue
        if run < 3:
            for role in ("user", "assistant"):
                heapq.heappush(queue, (cost + 5, audit + "I", i, run + 1, (*made, (role, ""))))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(queue, (cost + 2, audit + "D", i + 1, 0, made))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                heapq.heappush(queue, (cost + more, audit + "K", i + 1, 0, (*made, (role, text))))
                for new in ("user", "assistant"):
                    heapq.heappush(queue, (cost + more + 1, audit + "R", i + 1, 0, (*made, (new, text))))
    return best


def brute(conversations):
    kept, out = {}, {}
    for conv, turn, role, text in conversations:
        kept.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        code = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        kept[conv] += [(turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    for conv, rows in kept.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, marked, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in rows:
            bare = text.strip(WHITE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            marked.append((role, text, fault))
            if fault:
                counts[fault] += 1
        turns = [t for t, *_ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, made = searched(marked)
        out[conv] = (gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest())
    return out


def registered(spark, folder, rows, more=""):
    spark.createDataFrame([(*r, *["x"] * (1 if more else 0)) for r in rows], f"conv_id long, turn long, role string, text string{more}").write.parquet(f"{folder}/conversations.parquet")
    got = [tuple(r) for r in repair.op12(spark, str(folder)).collect()]
    assert len({r[0] for r in got}) == len(got)
    return {r[0]: r[1:] for r in got}


def test_against_search(spark, tmp_path):
    r = random.Random(3)
    texts = ["Yes.", "No!", "Why?", "so on", " ", "", None, "ends . \n", "é.", "Yes.", " "]
    rows = []
    for conv in range(250):
        for turn in range(r.randrange(1, 7)):
            rows.append((conv, r.choice([turn, turn, turn, turn + 3, None]), r.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "u"]), r.choice(texts)))
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (10**12, None, "system", "x.")]
    rows += rows[:5]
    r.shuffle(rows)
    assert registered(spark, tmp_path, rows, ", audit string") == brute(rows)


def test_edges(spark, tmp_path):
    assert registered(spark, tmp_path / "none", []) == {}
    turns = range(300)  # a conversation of which nothing stays
    lost = next(t for t in turns if crc32(f"4:{t}".encode()) % 20 == 0)
    assert registered(spark, tmp_path / "lost", [(4, lost, "user", "a.")]) == {4: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    # over several Arrow batches, and one very long text
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(c, t, ("user", "assistant")[t % 2], f"{c} {t}" + "." * (200_000 if (c, t) == (1, 1) else 1)) for c in range(3) for t in range(60 if c == 1 else 4)]
        got = registered(spark, tmp_path / "long", rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = brute([x for x in rows if x[0] != 1])
    assert {c: got[c] for c in want} == want and len(got[1][6]) >= 50


def test_trie_shares_layers():
    """A layer is worked out once for a prefix that signatures share, and answers don't depend on what was inserted before."""
    r = random.Random(1)
    signatures = sorted({"".join(r.choice("suaoSUAOx") for _ in range(r.randrange(9))) for _ in range(400)})
    trie = repair.Trie()
    got = [trie.answer(s) for s in signatures]
    assert got == [repair.Trie().answer(s) for s in signatures]
    assert trie.nodes == len({s[:i] for s in signatures for i in range(1, len(s) + 1)})


@pytest.mark.parametrize("signature", ["", "ua", "sua", "su", "s", "a", "xx", "uA", "UAUA"])
def test_signatures_by_search(signature):
    roles = {"s": "system", "u": "user", "a": "assistant", "o": "tool", "x": "user"}
    rows = [(roles[c.lower()], "t", "blank" if c == "x" else "truncated" if c.isupper() else None) for c in signature]
    cost, audit, _ = searched(rows)
    assert repair.Trie().answer(signature) == (audit, cost)
