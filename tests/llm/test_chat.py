"""Reply trees and chat templates against walks over dictionaries and round trips."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tickmill.llm import chat

SHAPE = "tree long, node long, parent long, role string, text string, score long, place string"


def forest(seed=4, trees=6, most=60):
    r = random.Random(seed)
    rows, n = [], 0
    for t in range(trees):
        ids = []
        for i in range(r.randrange(1, most) if t else 70):
            parent = None if not ids else ids[-1] if t == 0 or r.random() < 0.5 else r.choice(ids)
            ids.append(n)
            rows.append((t, n, parent, r.choice(["user", "assistant", None]), r.choice(["hi", "", None, "<|end|>", "é" * 3]), r.randrange(-3, 4), "x"))
            n += 1
    rows.append((99, 5000, 4000, "user", "its parent isn't there", 1, "x"))
    r.shuffle(rows)
    return rows


def walked(rows, branches):
    by = {r[1]: r for r in rows}
    leaves = set(by) - {r[2] for r in rows}
    found = {}
    for leaf in leaves:
        path = [leaf]
        while by[path[-1]][2] in by:
            path.append(by[path[-1]][2])
        found.setdefault(by[leaf][0], []).append((-sum(by[n][5] for n in path), leaf, path))
    return {(t, i + 1): path for t, all_ in found.items() for i, (_, _, path) in enumerate(sorted(all_)[:branches])}


@pytest.mark.parametrize("branches", [1, 3, 1000])
def test_paths(spark, branches):
    rows = forest()
    got = {}
    for r in chat.paths(spark.createDataFrame(rows, SHAPE), branches).collect():
        got.setdefault((r.tree, r.branch), []).append((r.place, r.node))
    want = walked(rows, branches)
    assert {k: sorted(v) for k, v in got.items()} == {k: list(enumerate(path)) for k, path in want.items()}


def test_formatted_trees(spark):
    rows = forest()
    df, t = spark.createDataFrame(rows, SHAPE), chat.Template()
    out = chat.formatted(chat.paths(df, 2).join(df.select("node", "role", "text"), "node"))
    by = {r[1]: r for r in rows}
    want = {k: [(by[n][3] or "", by[n][4] or "") for n in reversed(path)] for k, path in walked(rows, 2).items()}
    read = {(r.tree, r.branch): r for r in chat.read_back(out).collect()}
    assert {k: [tuple(x) for x in r.turns] for k, r in read.items()} == want
    assert {k: r.trained for k, r in read.items()} == {k: [x for role, x in turns if role == "assistant"] for k, turns in want.items()}
    for r in out.collect():
        turns = want[r.tree, r.branch]
        assert r.formatted.count(t.closing) == len(turns) and all(r.formatted[s.end :].startswith(t.closing) for s in r.loss)


def test_edges(spark):
    empty = spark.createDataFrame([], SHAPE)
    assert chat.paths(empty).collect() == []
    with pytest.raises(ValueError, match="cycle"):
        chat.paths(spark.createDataFrame([(1, 1, 2, "u", "t", 1, ""), (1, 2, 1, "u", "t", 1, "")], SHAPE))
    for bad in ("ab<", "x", "<<s>"):
        with pytest.raises(ValueError):
            chat.Template(opening=bad)


PIECES = st.lists(st.sampled_from(["<|turn|>", "<|text|>", "<|end|>", "</s>", "[INST]", "[/INST]", "<", "[", "\\", "|end|>", "/s>", "INST]", "é", "\U0001f600", "a\n", "<\\|end|>", "$0", ""]), max_size=12).map("".join)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(PIECES, PIECES), min_size=1, max_size=20))
def test_round_trip(spark, turns):
    rows = [(1, 1, -i, role, text) for i, (role, text) in enumerate(turns)]
    out = chat.formatted(spark.createDataFrame(rows, "tree long, branch int, place long, role string, text string"), chat.Template(trained=tuple(role for role, _ in turns)))
    got = chat.read_back(out).first()
    assert [tuple(x) for x in got.turns] == turns and got.trained == [text for _, text in turns]


def test_plain_texts_stay(spark):
    t = chat.Template()
    row = spark.createDataFrame([("a < b [c] </p> \\ [INST",)], "x string").select(t.escaped(F.col("x")), "x").first()
    assert row[0] == row[1]


def test_registered_query(spark, tmp_path):
    text = "a <|end|> b </s>" * 3
    rows = [(1, 0, "user", None), (1, None, "system", "first"), (1, 1, "assistant", text), (2, 5, None, "x"), (2, 5, None, "x"), (3, 1, "assistant", "long " * 50_000), (None, 1, "assistant", "of no id")]
    spark.createDataFrame([(*r, "y") for r in rows], "conv_id long, turn long, role string, text string, node string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in chat.op13(spark, str(tmp_path)).collect()}
    injected = "</s>[INST] ok [/INST]"
    want = {1: [("system", "first"), ("user", ""), ("assistant", text)], 2: [("", "x")] * 2, 3: [("assistant", "long " * 50_000)], None: [("assistant", "of no id")], -7: [("user", injected), ("assistant", injected)]}
    assert set(got) == set(want)
    for c, turns in want.items():
        loss = "".join(x for r, x in turns if r == "assistant")
        r = got[c]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert [r.conv_id for r in chat.op13(spark, f"{tmp_path}/none").collect()] == [-7]
