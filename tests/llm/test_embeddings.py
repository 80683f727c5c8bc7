import numpy as np
import pytest

from triagelake.llm import embeddings
from triagelake.llm.embeddings import (
    MARGIN, SLACK, audit, audited_links, build_graph, centroids, classes_of, merged, near_links, near_pairs, near_vectors,
    op2_pruned_graph, range_pairs, recall, robust_prune, shards_of, tiles_of, unit)


def slow(ids, x, limit=0.9):
    """n_links and component of every row, by comparing all."""
    x = unit(x)
    near = x @ x.T >= limit
    label = np.arange(len(ids))
    while True:
        low = np.where(near, label[None, :], len(ids)).min(1)
        low = np.minimum(low, low[low])
        if (low == label).all():
            break
        label = low
    first = {}
    for i in np.argsort(ids):
        first.setdefault(label[i], ids[i])
    return {int(ids[i]): (int(near[i].sum() - 1), int(first[label[i]])) for i in range(len(ids))}


def test_prune_keeps_what_others_do_not_stand_for():
    x = unit(np.array([[1, 0], [0.9, 0.1], [0.8, 0.2], [0, 1.0]]))
    assert robust_prune(x, np.array([0]), np.array([[1, 2, 3, 1, 0]]), 3, 1.0).tolist() == [[1, 4, 4]]
    assert robust_prune(x, np.array([1]), np.array([[0, 3]]), 3, 1.2).tolist() == [[0, 3, 4]]


def test_graph_search_equals_brute_force():
    rnd = np.random.default_rng(2)
    centre = rnd.normal(size=(30, 32))
    x = unit(np.concatenate([c + rnd.normal(size=(n, 32)) * 0.15 for c, n in zip(centre, [1] * 15 + [5] * 10 + [150] * 5)]))
    i, j = range_pairs(x, build_graph(x))
    a, b = np.nonzero(np.triu(x @ x.T >= 0.9, 1))
    found, true = set(zip(i.tolist(), j.tolist())), set(zip(a.tolist(), b.tolist()))
    assert found <= true and len(found) >= 0.99 * len(true)


def test_whole_table(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = vectors.collect()
    want = slow(np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows]))
    got = {r.vec_id: (r.n_links, r.component_id) for r in op2_pruned_graph(spark, sf_dir).collect()}
    assert got == want
    classes = classes_of(vectors.select("vec_id", "embedding"))
    pairs = near_pairs(classes, shard=100, tile=64)  # shards in tiles
    assert audit(classes, pairs) >= 0.97


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 0.0], [2.0, 0.0], [2.0, 0.0], None, [], [0.0, 0.0], [nan, 1.0], [inf, 1.0], [1.0, None], [1.0], [0.99, 0.1], [0.0, 1e38], [-1.0, 0.0]]
    rows = [(i, v, 1) for i, v in enumerate(vectors)] + [(None, [1.0, 0.0], 1), (11, [0.0, 1e38], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links int")
    got = sorted(map(tuple, near_vectors(df).collect()), key=str)
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 12)]
    want = [*alone, (0, 3, 0, True), (1, 3, 0, False), (2, 3, 0, False), (10, 3, 0, False), (11, 1, 11, True), (11, 1, 11, True), (None, 0, None, False)]
    assert got == sorted(want, key=str)
    assert near_vectors(df.limit(0)).count() == 0


def with_group(n, cosine=0.955, d=64):
    """``n`` distinct vectors, a third of them one group of near ones."""
    rnd = np.random.default_rng(n)
    centre = unit(rnd.normal(size=(1, d)))
    group = centre + rnd.normal(size=(n // 3, d)) * np.sqrt((1 / cosine - 1) / d)
    return unit(np.concatenate([rnd.normal(size=(n - n // 3, d)), group]))[rnd.permutation(n)]


@pytest.mark.parametrize("margin", [MARGIN, 1.0])
def test_links_of_a_large_group_meet(margin):
    x = with_group(60_000)
    centres = merged(centroids(x[:20_000], 60))
    some = shards_of(x[:100], *centres, margin)
    links = met = 0
    for at in range(0, len(x), 10_000):
        near = x[:100] @ x[at : at + 10_000].T >= 0.9
        both = some.astype(np.float32) @ shards_of(x[at : at + 10_000], *centres, margin).T.astype(np.float32) > 0
        links, met = links + near.sum(), met + (near & both).sum()
    assert links > 30 * 15_000 and met >= 0.99 * links
    assert margin < 1 or met == links


def test_large_group_equals_brute_force(spark):
    x = with_group(4_000).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    classes = classes_of(df)
    rep = {r.cid: r.rep for r in classes.select("cid", "rep").collect()}
    near = unit(x) @ unit(x).T >= 0.9
    for tile in (2_048, 400):  # about 27 centroids lie in the group
        links, edges = near_links(classes, shard=50, tile=tile)
        got = np.zeros(len(x))
        for r in links.collect():
            got[rep[r.cid]] = r.near
            assert r.near == r.links
        want = near.sum(1) - 1
        assert (got <= want).all() and got.sum() >= 0.99 * want.sum()
        assert edges.count() < 40 * len(x)


def test_all_numbers_of_centroids_are_fitted(spark, monkeypatch):
    rnd = np.random.default_rng(4)
    true = unit(rnd.normal(size=(1_100, 16)))
    x = unit(np.repeat(true, 4, axis=0) + rnd.normal(size=(4_400, 16)) * 0.1)[rnd.permutation(4_400)]
    fitted, raw = centroids(x, 1_100), centroids(x, 1_100, rounds=0)
    assert (x @ fitted.T).max(1).mean() > (x @ raw.T).max(1).mean() + 0.01
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x[:200])]
    classes = spark.createDataFrame(rows, "cid long, embedding array<double>, copies long")
    monkeypatch.setattr(embeddings, "SAMPLE", 10)
    assert tiles_of(classes, shard=5).select("shard").distinct().count() > 20  # of 40 centroids


def test_search_is_audited_and_widened(spark, monkeypatch, caplog):
    x = with_group(600)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want = (unit(x) @ unit(x).T >= 0.9).sum(1) - 1
    monkeypatch.setattr(embeddings, "merged", lambda centres, limit: (centres, np.arange(len(centres))))
    classes = classes_of(df)
    poor, whole = (0.0, SLACK, False), (1.0, SLACK, True)
    with pytest.raises(RuntimeError, match="recall 0"):
        audited_links(classes, shard=10, steps=(poor,))
    links, _, found = audited_links(classes, shard=10, steps=(poor, whole))
    assert found == 1.0 and links.agg({"near": "sum"}).first()[0] == want.sum()
    caplog.clear()
    got = {r.vec_id: r.n_links for r in near_vectors(df).collect()}
    assert "recall 1.0000" in caplog.text and [got[i] for i in range(len(x))] == want.tolist()


def test_a_large_group_does_not_hide_lost_links(spark):
    true = {i: 9_000 for i in range(30)} | {100 + i: 1 for i in range(60)} | {200: 40, 300: 0}
    rows = [(i, 9_000) for i in range(30)] + [(100 + i, 1) for i in range(51)] + [(100, 0), (999, 5)]
    links = spark.createDataFrame(rows, "cid long, near long")
    assert recall(true, links) == 0.85  # of the pairs; 0.9996 of all links; class 200 is a stratum of one
    assert recall({300: 0}, links) == recall({}, links) == 1.0
    assert recall({100 + i: 1 for i in range(10)}, links) == 1.0
