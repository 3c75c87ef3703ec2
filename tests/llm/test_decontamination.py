"""Exact and loose matches against plain search, and the index itself."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from ledgerops.llm import decontamination as dc
from pyspark.sql import functions as F

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, window):
    tests = [(i, words(t)) for i, t in items]
    rows = []
    for doc_id, text in docs:
        w, hit, ids = words(text), set(), set()
        for item_id, t in tests:
            n = min(window, len(t))
            keys = {tuple(t[k : k + n]) for k in range(len(t) - n + 1)} if n else set()
            for at in range(len(w) - n + 1):
                if tuple(w[at : at + n]) in keys:
                    hit |= set(range(at, at + n))
                    ids.add(item_id)
        rows.append((doc_id, len(w), len(hit), tuple(sorted(str(i) for i in ids if i is not None))))
    return Counter(rows)


def got(docs, items, window):
    return Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in dc.decontaminate(docs, items, window).collect())


@pytest.fixture(scope="module")
def planted(spark):
    """Few words, so that windows overlap, repeat and miss by little; odd ids and texts."""
    draw = random.Random(8)
    item = lambda n: [draw.choice("abcdefgh") + draw.choice("xyé1") for _ in range(n)]
    items = [(i, item(draw.randint(1, 18))) for i in range(14)] + [(3, item(12)), (None, item(6)), (50, []), (51, ["ax"] * 12), (52, ["ax"])]
    items += items[:2]
    docs = []
    for i in range(90):
        text = item(draw.randint(0, 25))
        for _ in range(draw.randint(0, 3)):
            part = list(draw.choice(items)[1])
            if part and draw.random() < 0.4:
                part[draw.randrange(len(part))] = "zz"
            at = draw.randint(0, len(text))
            text[at:at] = part
        docs.append((draw.choice([i, i, 7, None]), draw.choice([" ", ", ", "\n"]).join(text).replace("ax", draw.choice(["ax", "AX"]))))
    docs += [(200, None), (201, ""), (202, "--"), (203, "ax " * 400), docs[0], docs[0]]
    texts = [(i, " ".join(t), 1) for i, t in items] + [(60, None, 1)]
    return (
        spark.createDataFrame([(d, t, "q") for d, t in docs], "doc_id long, text string, mark string"),
        spark.createDataFrame(texts, "item_id long, text string, doc_id int"),
    )


def pairs(frame, key):
    return [(r[key], r.text) for r in frame.select(key, "text").collect()]


@pytest.mark.parametrize("window", [1, 3, 10])
def test_exact_matches(planted, window):
    docs, items = planted
    assert got(docs, items, window) == plain(pairs(docs, "doc_id"), pairs(items, "item_id"), window)


@pytest.mark.parametrize("name", ["hard_docs", "odd_docs", "no_docs"])
def test_odd_tables(spark, request, name):
    docs = request.getfixturevalue(name)
    items = docs.select(F.col("doc_id").alias("item_id"), "text")
    assert got(docs, items, 10) == plain(pairs(docs, "doc_id"), pairs(items, "item_id"), 10)
    assert got(docs, items.limit(0), 10) == plain(pairs(docs, "doc_id"), [], 10)


def test_matches_tell_where(planted):
    docs, items = planted
    index = dc.build_index(docs, items)
    texts, tests = defaultdict(list), defaultdict(list)
    for doc_id, text in pairs(docs, "doc_id"):
        texts[doc_id].append(words(text))
    for item_id, text in pairs(items, "item_id"):
        tests[item_id].append(words(text))
    rows = dc.phrases(index, 4).collect()
    assert rows
    for r in rows:
        doc = [w[r.doc_from - 1 : r.doc_from - 1 + r.n_words] for w in texts[r.doc_id]]
        item = [w[r.item_from - 1 : r.item_from - 1 + r.n_words] for w in tests[r.item_id]]
        assert any(d == i and len(d) == r.n_words for d in doc for i in item)


@pytest.mark.parametrize("window, reach", [(3, 5), (4, 9)])
def test_proximity(planted, window, reach):
    docs, items = planted
    docs = docs.where("doc_id != 203 or doc_id is null").dropDuplicates(["doc_id"])
    index = dc.build_index(docs, items)
    got = {(r.doc_id, r.item_id, r.item, r.start) for r in dc.proximity(index, window, reach).collect()}
    names = {(r.item_id, tuple(words(r.text))): r.item for r in items.select("item_id", "text", F.xxhash64("item_id", dc.words_of()).alias("item")).collect()}
    want = set()
    for doc_id, text in pairs(docs, "doc_id"):
        w = words(text)
        for item_id, t in pairs(items, "item_id"):
            t = words(t)
            n = min(window, len(t))
            for k in range(len(t) - n + 1 if n else 0):
                need = Counter(t[k : k + n])
                if any(not need - Counter(w[at : at + reach]) for at in range(len(w))):
                    want.add((doc_id, item_id, names[item_id, tuple(t)], k + 1))
    assert got == want
    exact = {(r.doc_id, r.item_id, r.item, r.item_from) for r in dc.phrases(index, window).collect()}
    assert exact <= got


def test_plan_is_native(planted):
    docs, items = planted
    text = dc.decontaminate(docs, items)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", text)


def test_the_index_moves_only_for_documents_with_an_alignment(spark):
    rows = [(term, i, 1000 + 7 * i, k) for i in range(300) for k, term in enumerate(("a", "b", "a"))]
    rows.append(("a", None, -5, 1))
    postings = spark.createDataFrame(rows, "term string, doc_id long, mark long, pos int")
    aligned = spark.createDataFrame([(7,), (7,), (63,), (64,), (299,), (None,)], "doc_id long").withColumn(
        "mark", F.coalesce(F.lit(1000) + 7 * F.col("doc_id"), F.lit(-5))
    )
    near = dc._near(postings, aligned)
    assert near.columns == postings.columns
    assert Counter(r.doc_id for r in near.collect()) == {7: 3, 63: 3, 64: 3, 299: 3, None: 1}
