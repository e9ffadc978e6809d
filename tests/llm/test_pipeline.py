"""The corpus pipeline stage by stage against brute force, on a small corpus."""

import random

import corpus_pipeline

from .conftest import prose
from .test_joins import components, removed


def made(spark, folder):
    r = random.Random(21)
    rows, labels = [], []
    passage = prose(r, 60)
    bench = [(k, prose(r, 30, 5000)) for k in range(4)]
    for i in range(260):
        text, junk = prose(r, r.randrange(30, 160), 3000), r.random() < 0.25
        if i % 10 == 0:
            text += " " + passage
        if i % 17 == 0:
            text += " " + bench[i % 4][1]
        if junk:
            text = " ".join(w + "%%%" for w in text.split())
        rows.append((i, text, "en", "s", len(text)))
        if i % 2:
            labels.append((i, int(not junk), 0))
    for k in range(20):
        i = r.randrange(260)
        rows.append((300 + k, rows[i][1] + (" tail" if k % 2 else ""), None, None, None))
    rows += [(400, None, None, None, None), (401, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, labels, bench


def test_stages(spark, tmp_path):
    folder = str(tmp_path / "t")
    rows, labels, bench = made(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    held, columns = [docs], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, held[-1], folder).write.parquet(f"{tmp_path}/{name}")
        held.append(spark.read.parquet(f"{tmp_path}/{name}"))
    assert all(h.columns == columns for h in held[:-1])
    accepted, single, cut, clean, tokens = ([(r.doc_id, r.text) for r in h.collect()] if "text" in h.columns else h.collect() for h in held[1:])
    truth = {i: q for i, q, _ in labels}
    kept = {i for i, _ in accepted}
    assert sum((i in kept) == bool(q) for i, q in truth.items()) / len(truth) > 0.95 and all(i in kept for i, q in truth.items() if q)
    assert {i for i, _ in single} == {i for i, (_, c) in components(accepted).items() if i == c}
    want = removed(single)
    assert dict(cut) == {i: (want[i][2] if want[i][1] else t) for i, t in single if not want[i][1] or want[i][1] < want[i][0]}
    assert {i for i, _ in clean} == {i for i, t in cut if not any(b in (t or "") for _, b in bench)}
    assert {r.doc_id for r in tokens} == {i for i, _ in clean} and all(r.n_tokens == len(r.ids) for r in tokens)
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(r.doc_id for r in whole.collect()) == sorted(i for i, _ in clean)


def test_stages_take_other_columns(spark, make, tmp_path):
    """Columns that the operators use themselves, whatever their names, come through every stage but the last."""
    docs = make([(1, "a b c d e f g"), (2, "a b c d e f g"), (3, None), (None, "x y"), (None, "x y")])
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "not here at all")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        assert all(r["node"] == "x" for r in out.collect())
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 5
