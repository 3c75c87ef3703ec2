"""The classifier against a plain forward pass, on long texts, and its sample."""

from __future__ import annotations

import re
import subprocess
import sys

import numpy as np
import pytest
import xxhash
from ledgerops.llm import repeats, toxicity


def plain_score(model, text):
    """Word by word: hash, embeddings, every window of every filter, one number."""
    words = re.findall(rb"[^\x20\x09-\x0d]+", text.lower())
    base, second = repeats._BASES

    def mix(x):
        x = np.array([x % 2**64], np.uint64)
        return int(repeats._mix(x)[0])

    def bucket(part, number):
        total = sum(int(repeats._TABLE[b]) * pow(base, i, 2**64) for i, b in enumerate(part))
        return (mix(mix(total) + (len(part) + 131 * number) * second) >> 40) % toxicity.BUCKETS

    vectors = [
        sum(model.words[bucket(w[:cut], i)].astype(np.float64) for i, cut in enumerate((None, *toxicity.PREFIXES))) for w in words
    ] + [np.zeros(toxicity.SIZE)] * toxicity.PADS
    hidden = []
    for kernel, bias in zip(model.filters, model.biases):
        for f in range(toxicity.FILTERS):
            best = max(
                sum(float(vectors[at + j] @ kernel[j, :, f]) for j in range(len(kernel))) for at in range(len(words) + 1)
            )
            hidden.append(max(0.0, best + float(bias[f])))
    return 1 / (1 + np.exp(-(np.array(hidden) @ model.out.astype(np.float64) + model.bias)))


@pytest.fixture(scope="module")
def model():
    found = toxicity.Classifier.new(5)
    draw = np.random.default_rng(6)
    found.biases = [draw.normal(0, 0.2, toxicity.FILTERS).astype(np.float32) for _ in toxicity.WIDTHS]
    found.bias = 0.3
    return found


TEXTS = ["", " \n", "one", "Zwei Wörter", "a b c d e f", "wort " * 40 + "STUPID, idiotisch!", "é中文 x\ty\x0bz " * 9, "lang" * 300 + " end"]


def test_scores_are_those_of_a_plain_pass(model):
    texts = [t.encode() for t in TEXTS]
    assert np.allclose(model.scores(texts), [plain_score(model, t) for t in texts], atol=1e-5)


@pytest.mark.parametrize("size", [1, 7, 64])
def test_slices_give_the_same_scores(model, monkeypatch, size):
    """Texts cut into slices, and words longer than a slice, score as whole ones do."""
    texts = [t.encode() for t in TEXTS] + [b"x" * 200 + b" y " + b"Z" * 90, b"   ", b"a" * 65]
    whole = model.scores(texts)
    monkeypatch.setattr(toxicity, "SLICE", size)
    assert np.allclose(model.scores(texts), whole, atol=1e-6)


@pytest.mark.parametrize("text", ["b'ein Wort und ' * 8_000_000", "b'x' * 100_000_000"])
def test_a_very_long_text_needs_little_memory(text):
    code = (
        "import resource, numpy as np\nfrom ledgerops.llm import toxicity\nm = toxicity.Classifier.new(1)\nm.scores([b'warm up'])\n"
        f"t = {text}\nbefore = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\nm.scores([t])\n"
        "print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd="/", env={"PYTHONPATH": sys.path[0] + ":" + ":".join(sys.path)})
    assert int(out.stdout) < 300, out.stderr[-500:]


def test_one_row_of_an_id_and_bounded_bytes(spark):
    rows = [(7, f"text {i}", "en") for i in range(3000)] + [(i, "x" * 1000, "de") for i in range(100, 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r, 0, r % 2) for r in {r[0] for r in rows}], "doc_id long, quality int, toxic int")
    found = toxicity.sample_of(docs, labels, sample=50)
    assert len(found) == found["doc_id"].nunique() <= 100 and (found["fold"] != 0).all()
    seven = [r.text for r in found.itertuples() if r.doc_id == 7]
    best = min((xxhash.xxh64_intdigest(t.encode(), 42) + 2**63) % 2**64 for _, t, _ in rows[:3000])
    assert all((xxhash.xxh64_intdigest(t.encode(), 42) + 2**63) % 2**64 == best for t in seven)
    few = toxicity.sample_of(docs, labels, sample=50, most_bytes=20_000)
    assert 0 < few["text"].str.len().groupby(few["toxic"]).sum().max() <= 10_000


def test_nothing_learned_rejects_nothing(spark, hard_docs):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(hard_docs, labels)
    rows = toxicity.score(hard_docs, model).collect()
    assert len({r.score for r in rows}) == 1 and not any(r.rejected or r.predicted for r in rows)


def test_limits_by_language(spark):
    model = toxicity.Classifier.new(1)
    truth = np.array([0] * 10 + [1] * 10 + [0, 1], np.float32)
    scores = np.array([0.1] * 9 + [0.62] + [0.7] * 10 + [0.1, 0.9])
    model.calibrate(scores, truth, ["de"] * 20 + ["en"] * 2)
    assert model.limits == {"de": 0.65}  # too few labels to set one for "en"
    model.out[:], model.bias, model.learned = 0, 0.4, True  # every score is 0.599
    docs = spark.createDataFrame([(1, "a", "de"), (2, "a", "en"), (3, None, None)], "doc_id long, text string, lang string")
    found = {r.doc_id: (r.predicted, r.rejected) for r in toxicity.score(docs, model).collect()}
    assert found == {1: (1, False), 2: (1, True), 3: (1, True)}


def test_all_labelled_rows_are_learned_from(spark, monkeypatch):
    """Words of rows that a sample of the first ids by hash leaves out are learned too."""
    ids = list(range(1, 4001))
    rows = [(i, f"word{i % 7} " + (f"bad{i % 40}" if i % 2 else f"good{i % 40}") + f" end{i % 5}", "en") for i in ids]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 0, i % 2) for i in ids], "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 500)  # several shards
    epoch = toxicity._epoch
    monkeypatch.setattr(toxicity, "sample_of", lambda *_: pytest.fail("a sample"))
    monkeypatch.setattr(toxicity, "_epoch", lambda dealt, *rest: seen.append((dealt.count(), dealt.select("shard").distinct().count())) or epoch(dealt, *rest))
    model = toxicity.train(docs, labels)
    learned = docs.where((toxicity.fold(docs.doc_id) != 0) & (toxicity.fold(docs.doc_id) != toxicity.CALIBRATION_FOLD)).count()
    assert seen == [(learned, -(-learned // 500))] * toxicity.EPOCHS and learned > 2000
    found = toxicity.score(docs, model).join(labels, "doc_id").where("predicted = toxic").count()
    assert found > 0.95 * len(ids)
    again = toxicity.train(docs, labels)
    assert np.allclose(again.words, model.words, atol=1e-6) and again.limits == model.limits


def test_a_long_text_is_learned_from_by_its_windows(monkeypatch):
    model = toxicity.Classifier.new(3)
    text = b"some words and more " * 30
    whole = toxicity.features([text])[0]
    monkeypatch.setattr(toxicity, "SLICE", 64)
    rows = model._look_at(text)
    assert len(rows) <= (len(toxicity.WIDTHS) * toxicity.FILTERS + 1) * toxicity.PADS < len(whole) + 200
