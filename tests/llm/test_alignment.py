"""Aligned tokens against the two libraries and a plain walk over byte offsets."""

from __future__ import annotations

import hashlib
import json
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from ledgerops.llm import alignment, queries
from tokenizers import Tokenizer

A, B = public_tokenizers.path(queries.BYTE_BPE), public_tokenizers.path(queries.PIECES)
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def plain(rows):
    """The contract word by word: both libraries on whole texts, all overlapping ranges."""
    model = json.load(open(A))["model"]["vocab"]
    of = alignment.byte_alphabet()
    names = {i: bytes(of[c] for c in t) for t, i in model.items()}
    library = Tokenizer.from_file(A)
    library.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)

    def piece(i):
        text = pieces.id_to_piece(i)
        return bytes([int(text[3:-1], 16)]) if pieces.is_byte(i) else text.replace("▁", " ").encode()

    docs = []
    for doc_id, text in rows:
        links, groups, a, b = [], [], [], []
        if text:
            a, b = library.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
            parts = [names[i] for i in a], [piece(i) for i in b]
            if any(b"".join(p) != (" " + text).encode() for p in parts):
                a, b = [], []
        if a:
            ends = [list(accumulate(map(len, p))) for p in parts]
            starts = [[0, *e[:-1]] for e in ends]
            for i, (s, e) in enumerate(zip(starts[0], ends[0])):
                j = next(j for j, x in enumerate(ends[1]) if x > s)
                while j < len(b) and starts[1][j] < e:
                    links.append((a[i], b[j]))
                    j += 1
            last = [0, 0]
            for cut in sorted(set(ends[0]) & set(ends[1])):
                stop = [e.index(cut) + 1 for e in ends]
                groups.append("|".join(",".join(map(str, ids[x:y])) for ids, x, y in zip((a, b), last, stop)))
                last = stop
        docs.append((doc_id, a, b, groups, links))
    counts = Counter(pair for *_, links in docs for pair in set(links))
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    found = [
        (
            doc_id, len(a), len(b), len(groups), len(links), sum(counts[p] == most[p[0]] for p in links),
            sum(counts[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for doc_id, a, b, groups, links in docs
    ]
    return Counter(found), counts


def got(docs):
    found = alignment.align(docs, A, B, public_tokenizers.PATTERN)
    rows = Counter(tuple(r[c] for c in COLUMNS) for r in found.documents.collect())
    return rows, {(r.a, r.b): r["count"] for r in found.links.collect()}


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", ["hard_docs", "odd_docs", "no_docs", "sample"])
def test_against_the_libraries(request, name):
    docs = request.getfixturevalue(name)
    rows, counts = plain(pairs(docs))
    assert got(docs) == (rows, dict(counts))


def test_special_strings_marks_and_odd_bytes(spark):
    texts = ["<|endoftext|> x <s> y</s><unk>", "a▁b", "▁", "  lead", "trail  ", "a\r\nb\t\x00c", "\x00", "éé ﬁ ½ Ａ", "中文 字", "😀😀 x",
             "don't  we'll 123 45", "a" * 3000, "ab " * 2000, " ", "\n", "x y z w"]
    rows = list(enumerate(texts)) + [(None, "don't")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want, counts = plain(rows)
    assert got(docs) == (want, dict(counts))


def test_lanes_batches_and_blocks_change_nothing(spark, sample, monkeypatch):
    """Short lanes, batches and blocks: documents over several of each. Executors import
    the module afresh, so the parts are run here, by hand."""
    rows = pairs(sample)[:40] + [(1000, "one two " * 900)]
    recipe = alignment.Recipe(alignment.read_byte_bpe(A), public_tokenizers.PATTERN, open(B, "rb").read(), "t")
    pair = alignment.Pair(recipe)
    monkeypatch.setattr(alignment, "LANE_CHARS", 50)
    want, _ = plain(rows)
    digests = {row[0]: (*row[1:5], row[7]) for row in want}
    aligner = alignment.Aligner(pair)
    for doc_id, text in rows:
        doc, lanes = alignment.Document(doc_id), list(pair.lanes(text)) if text else []
        assert " ".join(lanes) == (text or "")
        for at in range(0, len(lanes), 3):
            part = lanes[at : at + 3]
            aligner.run([doc] * len(part), part)
        ids, times = doc.linked()
        assert (np.diff(ids) > 0).all() and times.sum() == doc.counts[3]
        assert (*doc.counts.tolist(), doc.digest.hexdigest() if doc.digest else "") == digests[doc_id]


def test_vocabularies_whose_ids_are_no_ranks_are_refused(tmp_path):
    model = {"vocab": {"a": 0, "b": 1, "c": 2, "bc": 3, "abc": 4}, "merges": [["b", "c"], ["a", "bc"]]}
    path = tmp_path / "v.json"
    path.write_text(json.dumps({"model": model}))
    assert alignment.read_byte_bpe(str(path))[b"abc"] == 4
    model["merges"] = [["a", "bc"], ["b", "c"]]
    path.write_text(json.dumps({"model": model}))
    with pytest.raises(ValueError):
        alignment.read_byte_bpe(str(path))
