"""Importance resampling against zlib, plain counting and the SQL form."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from ledgerops.llm import resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def runs(text, least, most, buckets):
    w = words(text)
    grams = [" ".join(w[i : i + n]) for n in range(least, most + 1) for i in range(len(w) - n + 1)]
    return [zlib.crc32(g.encode()) % buckets for g in grams]


def plain(docs, target, least, most, buckets, seed, percent, min_words):
    own = [runs(text, least, most, buckets) for _, text in docs]
    s, t = Counter(b for x in own for b in x), Counter(b for x in target for b in runs(x, least, most, buckets))
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (S + buckets) / ((s[b] + 1.0) * (T + buckets)))) for b in s}
    rows = []
    for (doc_id, text), found in zip(docs, own):
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(found), weight, score, len(words(text)) >= min_words))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = len(able) * percent // 100
    ranked = [(*r[:4], i + 1 if i < drawn else None) for i, r in enumerate(able)]
    return Counter(ranked + [(*r[:4], None) for r in rows if not r[4]])


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", ["hard_docs", "odd_docs", "no_docs", "sample"])
@pytest.mark.parametrize("least, most, buckets", [(1, 1, 10_000), (1, 3, 70_000), (2, 2, 7)])
def test_against_zlib(spark, request, name, least, most, buckets):
    docs = request.getfixturevalue(name)
    target = spark.createDataFrame([("one two three", 1), (None, 2), ("Hot line hot", 3), ("", 4)], "text string, weight int")
    how = {"least": least, "most": most, "buckets": buckets, "seed": 2024, "percent": 40, "min_words": 3}
    found = resampling.importance(docs, target, **how)
    got = Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in found.collect())
    assert got == plain(pairs(docs), [r.text for r in target.collect()], **how)


def test_an_empty_target_and_bad_parameters(spark, hard_docs):
    none = spark.createDataFrame([], "text string")
    how = {"least": 1, "most": 1, "buckets": 50, "seed": 1, "percent": 100, "min_words": 0}
    found = resampling.importance(hard_docs, none, **how)
    got = Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in found.collect())
    assert got == plain(pairs(hard_docs), [], **how)
    with pytest.raises(ValueError):
        resampling.importance(hard_docs, none, least=2, most=1)


def test_running_crcs_over_lanes():
    draw = np.random.default_rng(1)
    data = draw.integers(0, 256, 9 * resampling.LANE + 17, dtype=np.uint8)
    running = resampling.Running(data)
    starts = np.concatenate([draw.integers(0, len(data), 800), [0, 0, len(data), resampling.LANE, 0]])
    ends = np.concatenate([np.minimum(starts[:800] + draw.integers(0, 5000, 800), len(data)), [0, len(data), len(data), 2 * resampling.LANE, resampling.LANE]])
    raw = data.tobytes()
    assert running.between(starts, ends).tolist() == [zlib.crc32(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]


@pytest.mark.parametrize("least, most", [(1, 1), (1, 4), (3, 3)])
def test_long_texts_in_parts(least, most):
    draw = random.Random(4)
    text = " ".join(draw.choice(["a", "Bc", "dé", "x" * 90, "中文"]) for _ in range(4000))
    normal = resampling.words_of(text)
    for size in (1, 50, 3000):
        parts = list(resampling.parts_of(normal, most, size))
        found, sizes, counts = resampling.buckets_of(parts, least, most, 997)
        assert Counter(found.tolist()) == Counter(runs(text, least, most, 997))
        assert counts.sum() == 4000 and sizes.sum() == len(found)


def test_resample_gives_rows_back(spark, odd_docs):
    target = spark.createDataFrame([("hot",)], "text string")
    drawn = resampling.resample(odd_docs.withColumn("rank", odd_docs["doc_id"]), target, percent=50, min_words=1)
    rows = drawn.collect()
    assert drawn.columns == [*odd_docs.columns, "weight", "score", "rank"]
    assert sorted(r["rank"] for r in rows) == [*range(1, len(rows) + 1)] and len(rows) == 8
