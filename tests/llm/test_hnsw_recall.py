"""Recall against brute force on hard data: no structure, uneven lengths, tight clusters, several shards."""

import numpy as np
import pytest

from lendscope.llm import hnsw, url_filter


def vectors(kind, n, dims=64):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, dims))
    if kind == "lengths":
        return x * np.exp(0.5 * rng.normal(size=(n, 1)))
    if kind in ("clusters", "shuffled clusters"):
        x = 3 * rng.normal(size=(n // 40 + 1, dims))[np.arange(n) // 40] + 0.05 * x
        return x[rng.permutation(n)] if kind == "shuffled clusters" else x
    return x


@pytest.mark.parametrize("kind", ["gaussian", "lengths", "clusters", "shuffled clusters"])
def test_one_shard(kind):
    x = vectors(kind, 4096)
    asked = np.arange(0, len(x), 16)
    index = hnsw.build_graph(x)
    found = hnsw.search_graph(index, x[asked], 21)
    true = np.argsort(-(x[asked] @ x.T), axis=1, kind="stable")[:, :20]
    recall = np.array([len(set(f) & set(t)) / 20 for f, t in zip(found.tolist(), true.tolist(), strict=True)])
    assert recall.mean() >= 0.95 and recall.min() > 0
    links, starts = index["links0"], index["starts"]
    assert set(starts.tolist()) | set(links[starts].ravel().tolist()) >= set(range(len(x)))


@pytest.mark.parametrize("kind", ["gaussian", "shuffled clusters"])
def test_several_shards(spark, kind):
    x = vectors(kind, 3000, 32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in hnsw.nearest(df, query_step=30, shard_rows=1000).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    recall = []
    for q in range(0, len(x), 30):
        scores = x @ x[q]
        scores[q] = -np.inf
        recall.append(len(got[q] & set(np.argsort(-scores, kind="stable")[:20].tolist())) / 20)
    assert np.mean(recall) >= 0.95 and min(recall) > 0


@pytest.mark.parametrize("kind", ["gaussian", "shuffled clusters"])
def test_searches_do_not_multiply_with_the_table(spark, monkeypatch, kind):
    """Every query searches every shard, so their number must not follow the table (F1); recall holds
    in the larger shards, and a block of queries takes all of them in slices."""
    stored, write = {}, hnsw.materialize
    monkeypatch.setattr(hnsw, "materialize", lambda df, name: stored.setdefault(name, write(df, name)))
    x = vectors(kind, 3000, 32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in hnsw.nearest(df, query_step=10, shard_rows=100, query_rows=16).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert stored["hnsw-index"].count() <= 8
    recall = []
    for q in range(0, len(x), 10):
        scores = x @ x[q]
        scores[q] = -np.inf
        recall.append(len(got[q] & set(np.argsort(-scores, kind="stable")[:20].tolist())) / 20)
    assert np.mean(recall) >= 0.95 and min(recall) > 0


def test_shards_grow_before_their_number():
    per_shard = hnsw.SHARD_COMPONENTS // 64
    counts = [hnsw.shard_count(n, 64 * n, 8192) for n in (0, 1, 8192, 8193, 51200, 8 * 8192, 8 * per_shard, 9 * per_shard)]
    assert counts == [1, 1, 1, 2, 7, 8, 8, 9]


def test_a_wider_beam_goes_on(monkeypatch):
    """No query compares itself with a point of the lowest layer twice, however often its beam doubles (F1)."""
    x = vectors("gaussian", 2000)
    index, seen, compared = hnsw.build_graph(x), [], hnsw._Beams._products

    def spy(beams, p, q):
        if beams.data is index["data"]:
            asked = beams.queries[q, 0].tolist()
            seen.extend(zip(asked, p.tolist(), strict=True))
        return compared(beams, p, q)

    monkeypatch.setattr(hnsw._Beams, "_products", spy)
    hnsw.search_graph(index, x[::100], 21)
    assert len(seen) == len(set(seen)) > 0


def test_url_fit_counts_distinct_urls(spark):
    """Sixty distinct labelled URLs with thousands of copies each: all of them are fitted on."""
    rows = [(i, f"http://x{i % 30}.{'net' if i % 2 else 'org'}/{'a' if i % 2 else 'fr'}/{i % 60}") for i in range(60)]
    copies = spark.createDataFrame(rows * 400, "page_id long, url string")
    fresh = spark.createDataFrame([(1000 + i, f"http://y{i}.{'net' if i % 2 else 'org'}.com/a/{i}") for i in range(10)], "page_id long, url string")
    few = url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string").unionByName(fresh), fit_rows=200)
    many = url_filter.judge_urls(copies.unionByName(fresh), fit_rows=200)
    want = {r.url_id: r.verdict for r in few.selectExpr("page_id AS url_id", "verdict").collect()}
    got = {r.url_id: r.verdict for r in many.selectExpr("page_id AS url_id", "verdict").distinct().collect()}
    assert len(got) == len(want) == 70 and len({want[i] for i in range(60)}) == 2
    assert all(got[i] == want[i] for i in range(60))
