"""Vector operators against comparison of all with all."""

from __future__ import annotations

import brute
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from ledgerops.llm import ann, embedding_dedup
from ledgerops.llm.graph import components
from pyspark.sql import functions as F

ROWS = "vec_id long, embedding array<float>, id string, vector string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "clash", "clash") for i, v in rows], ROWS)


@pytest.fixture(scope="module")
def vectors():
    draw = np.random.default_rng(8)
    base = draw.normal(size=(900, 16)).astype(np.float32)
    for start, size, noise in ((100, 150, 0.05), (300, 60, 0.0), (400, 2, 0.01), (410, 3, 0.08), (500, 40, 0.09)):
        base[start : start + size] = base[start] + noise * draw.normal(size=(size, 16))
    ids = draw.permutation(5 * len(base))[: len(base)]
    return [(int(i), v.tolist()) for i, v in zip(ids, base)]


BAD = [(7_000_000, None), (7_000_020, [0.0] * 16), (7_000_040, [float("nan")] * 16), (7_000_060, [None] + [1.0] * 15),
       (7_000_080, [float("inf")] * 16), (7_000_100, []), (7_000_120, [1.0, 2.0])]


def answers(got):
    out = {}
    for r in sorted(got.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_neighbours_are_exact_on_few_rows(spark, vectors):
    got = answers(ann.nearest_neighbours(frame(spark, vectors + BAD), F.col("vec_id") % 20 == 0))
    assert got == brute.neighbours(vectors)


def test_neighbours_of_fewer_rows_than_asked_for(spark):
    rows = [(20, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 1.0]), (3, [1.0, 0.0])]
    assert answers(ann.nearest_neighbours(frame(spark, rows), F.col("vec_id") % 20 == 0)) == brute.neighbours(rows)
    assert ann.nearest_neighbours(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0


def test_a_vector_of_odd_length_takes_no_part(spark, vectors):
    few = vectors[:60]
    every = range(6_000_000, 6_000_400)
    for first in spark.createDataFrame([(i,) for i in [*every, *(i for i, _ in few)]], "id long").orderBy(F.xxhash64("id")).take(1):
        assert first.id in every  # the row whose id hashes first
    got = answers(ann.nearest_neighbours(frame(spark, few + [(first.id, [1.0, 2.0])]), F.col("vec_id") % 2 == 0))
    want = answers(ann.nearest_neighbours(frame(spark, few), F.col("vec_id") % 2 == 0))
    assert want and got == want


def test_recall_of_the_index(spark, monkeypatch):
    draw = np.random.default_rng(1)
    base = draw.normal(size=(4000, 32)).astype(np.float32)
    base[1000:2400] = base[1000]  # a hot vector
    rows = [(i, v) for i, v in enumerate(base.tolist())]
    monkeypatch.setattr(ann, "LEAST_RERANKED", 64)
    monkeypatch.setattr(ann, "ROWS_PER_BLOCK", 1500)
    monkeypatch.setattr(ann, "QUERIES_PER_BLOCK", 90)
    got, want = answers(ann.nearest_neighbours(frame(spark, rows), F.col("vec_id") % 20 == 0)), brute.neighbours(rows)
    assert got.keys() == want.keys() and all(len(x) == 20 for x in got.values())
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.9
    for q, found in got.items():
        truth = dict(zip(range(len(rows)), base.astype(np.float64) @ base[q].astype(np.float64)))
        assert all(np.isclose(score, truth[i]) for i, score in found)


@pytest.mark.parametrize("varied", [False, True])
def test_recall_beside_a_large_group_of_near_copies(spark, tmp_path, varied):
    draw = np.random.default_rng(6)
    base = draw.normal(size=(16_000, 64))
    group = draw.permutation(len(base))[: len(base) // 3]
    base[group] = base[group[0]] + 0.15 * draw.normal(size=(len(group), 64))
    base /= np.linalg.norm(base, axis=1)[:, None]
    if varied:
        base *= draw.lognormal(0, 0.4, size=len(base))[:, None]
    columns = [pa.array(np.arange(len(base))), pa.FixedSizeListArray.from_arrays(pa.array(base.ravel()), 64).cast(pa.list_(pa.float64()))]
    pq.write_table(pa.table(columns, ["vec_id", "embedding"]), tmp_path / "vectors.parquet", row_group_size=2_000)
    table = spark.read.parquet(str(tmp_path / "vectors.parquet"))
    got = ann.nearest_neighbours(table, F.col("vec_id") % 50 == 0).toPandas().groupby("query_id")["vec_id"].agg(set)
    near = base[::50] @ base.T
    near[np.arange(len(near)), np.arange(0, len(base), 50)] = -np.inf
    want = np.argpartition(-near, 20, axis=1)[:, :20]
    hits = np.array([len(got[50 * k] & set(w.tolist())) / 20 for k, w in enumerate(want)])
    outside = ~np.isin(np.arange(0, len(base), 50), group)
    print("recall:", hits.mean(), "outside the group:", hits[outside].mean())
    assert hits.mean() >= 0.9 and hits[outside].mean() >= 0.9


def test_near_vectors(spark, vectors):
    got = embedding_dedup.near_duplicates(frame(spark, vectors + BAD)).collect()
    want = brute.near_vectors(vectors) | {i: (0, i) for i, _ in BAD}
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_near_vectors_in_small_blocks(spark, vectors, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "ROWS_PER_BLOCK", 32)
    got = embedding_dedup.near_duplicates(frame(spark, vectors)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute.near_vectors(vectors)


def test_near_vectors_of_odd_tables(spark):
    assert embedding_dedup.near_duplicates(frame(spark, [])).count() == 0
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (3, None)]
    got = sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(frame(spark, rows)).collect())
    assert got == [(-1, 0, None, False), (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (3, 0, 3, True)]


def test_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(table).collect()}
    assert got == brute.near_vectors(rows)


def test_components(spark):
    draw = np.random.default_rng(2)
    links = [(i, i + 1) for i in range(1000, 1300)] + [(0, int(x)) for x in draw.integers(1, 400, 300)]
    links += [(int(a), int(b)) for a, b in draw.integers(2000, 2600, (250, 2))] + [(1300, 5), (9, 9)]
    nodes = {x for a, b in links if a != b for x in (a, b)}
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == brute.reach(nodes, [x for x in links if x[0] != x[1]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_isolated_pairs_of_a_long_table(spark, tmp_path):
    draw = np.random.default_rng(4)
    base = draw.normal(size=(50_000, 64))
    base /= np.linalg.norm(base, axis=1)[:, None]
    for a in range(0, 500, 2):  # 1 % of the vectors are linked, each with one other
        aside = base[a + 1] - (base[a + 1] @ base[a]) * base[a]
        cosine = draw.uniform(0.951, 0.97)
        base[a + 1] = cosine * base[a] + np.sqrt(1 - cosine**2) * aside / np.linalg.norm(aside)
    ids = draw.permutation(len(base))
    columns = [pa.array(ids), pa.FixedSizeListArray.from_arrays(pa.array(base.ravel()), 64).cast(pa.list_(pa.float64()))]
    pq.write_table(pa.table(columns, ["vec_id", "embedding"]), tmp_path / "vectors.parquet", row_group_size=5_000)
    got = embedding_dedup.near_duplicates(spark.read.parquet(str(tmp_path / "vectors.parquet"))).toPandas().set_index("vec_id")
    assert len(got) == len(base) and got.index.is_unique
    linked = got.loc[ids[:500], "n_links"].to_numpy()
    print("links found:", linked.mean())
    assert linked.mean() >= 0.97 and linked.max() == 1
    roots = got.loc[ids[:500], "component_id"].to_numpy().reshape(-1, 2)
    assert (roots[:, 0] == roots[:, 1])[linked[::2] > 0].all()
    assert (got.loc[ids[500:], "n_links"] == 0).all()


def test_repeated_rows_and_null_ids(spark):
    """A row without an id is no query, and rows that repeat one id are found once."""
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (3, [1.0, 0.1]), (3, [1.0, 0.1]), (None, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = ann.nearest_neighbours(frame, F.col("vec_id") % 20 == 0, nearest=4).collect()
    mine = sorted((r.rank, r.vec_id) for r in found if r.query_id == 0)
    assert {r.query_id for r in found} == {0, 20}
    assert [v for _, v in mine if v is not None][:2] == [3, 20]
