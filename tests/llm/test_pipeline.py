"""The pipeline's stages one by one, and its rows as a whole."""

from __future__ import annotations

import sys
from pathlib import Path

import brute
import numpy as np

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from compare import connect, duck_bag, spark_bag  # noqa: E402
from ledgerops.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(number))
        before = docs.toPandas()
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        after = docs.toPandas()
        if name != "byte_bpe":
            assert docs.columns == columns
        pairs = list(zip(before["doc_id"], before["text"]))
        if name == "toxicity":
            assert 0.8 * len(before) < len(after) < len(before)
        elif name == "line_dedup":
            want = brute.lines(pairs)
            assert {d: brute.sha(t.encode()) for d, t in zip(after["doc_id"], after["text"])} == {d: x[2] for d, x in want.items()}
        elif name == "simhash_near_dedup":
            assert sorted(after["doc_id"]) == sorted({root for _, root in brute.simhash(pairs).values()})
        elif name == "mixing":
            assert after["doc_id"].value_counts().max() <= 3 and set(after["doc_id"]) <= set(before["doc_id"])
        else:
            assert len(after) == len(before)
            assert sorted(after["doc_id"]) == sorted(before["doc_id"])
            assert (after["n_tokens"] == [len(np.frombuffer(x, "<u4")) for x in after["ids"]]).all()
            want = {d: brute.sha(t.encode()) for d, t in pairs}
            assert all(want[d] == s for d, s in zip(after["doc_id"], after["decoded_sha256"]))


def test_oracles(spark):
    con = connect("/root/testdata/sf0.001")
    for name, sql in queries.ORACLES.items():
        got = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
        assert spark_bag(got) == duck_bag(con, sql)[0], name


def test_run_against_plain_forms(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    models, kept = [], {}
    train, write = corpus_pipeline.toxicity.train, corpus_pipeline.stored

    def noted_model(docs, labels):
        models.append(train(docs, labels))
        return models[-1]

    def noted_stage(frame, name):
        kept[name] = write(frame, name)
        return kept[name]

    monkeypatch.setattr(corpus_pipeline.toxicity, "train", noted_model)
    monkeypatch.setattr(corpus_pipeline, "stored", noted_stage)
    last = corpus_pipeline.run(spark, folder).toPandas()
    docs = spark.read.parquet(f"{folder}/documents.parquet").toPandas()
    stages = {name: frame.toPandas() for name, frame in kept.items()}

    (model,) = models
    scores = model.scores([(t or "").encode() for t in docs["text"]])
    limits = [model.limits.get(lang or "", 0.5) for lang in docs["lang"]]
    clean = docs[[s < limit for s, limit in zip(scores, limits)]]
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = lambda frame: sorted(frame[columns].itertuples(index=False, name=None))
    assert rows(stages["toxicity"]) == rows(clean) and 0 < len(clean) < len(docs)

    want = brute.lines(list(zip(clean["doc_id"], clean["text"])))
    lined = stages["line_dedup"]
    assert {d: brute.sha(t.encode()) for d, t in zip(lined["doc_id"], lined["text"])} == {d: x[2] for d, x in want.items()}
    roots = {root for _, root in brute.simhash(list(zip(lined["doc_id"], lined["text"]))).values()}
    apart = stages["simhash_near_dedup"]
    assert rows(apart) == rows(lined[lined["doc_id"].isin(roots)])

    words = lambda frame: frame["text"].map(lambda t: len(brute.WORD.findall(t)))
    mixed = stages["mixing"]
    assert set(rows(mixed)) <= set(rows(apart)) and mixed["doc_id"].value_counts().max() <= 3
    names = sorted(apart["source"].unique())
    sizes = [int(words(apart[apart["source"] == name]).sum()) for name in names]
    for name, goal in zip(names, brute.goals(sizes)):
        taken = int(words(mixed[mixed["source"] == name]).sum())
        assert abs(taken - goal) <= words(apart[apart["source"] == name]).max()

    assert sorted(zip(last["doc_id"], last["decoded_sha256"])) == sorted(
        (d, brute.sha(t.encode())) for d, t in zip(mixed["doc_id"], mixed["text"])
    )


def test_stages_on_odd_and_empty_tables(spark, odd_docs, no_docs, tmp_path):
    """Null ids, null and empty texts, repeated rows, an extra column: toxicity, with no
    label that fits, keeps all rows; lines change no count; one row with an id of equal texts
    stays after SimHash; the mix takes known rows; all are encoded."""
    for label, docs in (("odd", odd_docs.drop("_lines")), ("none", no_docs.drop("_lines"))):
        for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
            before = docs.collect()
            path = str(tmp_path / f"{label}{number}")
            stage(spark, docs, str(tmp_path_with_labels(spark, tmp_path, label))).write.mode("overwrite").parquet(path)
            docs = spark.read.parquet(path)
            after = docs.collect()
            if label == "none":
                assert after == []
            elif name in ("toxicity", "line_dedup"):
                assert sorted(str(r.doc_id) for r in after) == sorted(str(r.doc_id) for r in before)
            elif name == "simhash_near_dedup":
                known = [r for r in after if r.doc_id is not None]
                assert len({r.text or "" for r in before}) >= len(known) > 0
            elif name == "mixing":
                assert {str(r.doc_id) for r in after} <= {str(r.doc_id) for r in before}
            else:
                assert len(after) == len(before)


def tmp_path_with_labels(spark, folder, label):
    path = folder / f"tables_{label}"
    if not path.exists():
        none = spark.createDataFrame([(900, 1, 0)], "doc_id long, quality int, toxic int")
        none.write.parquet(str(path / "labels.parquet"))
    return path
