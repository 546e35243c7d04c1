import numpy as np
import pytest
from pyspark.sql import functions as F

from prepwise.llm import hnsw, vectors

from .brute import roots

SCHEMA = "vec_id long, embedding array<float>"


def data(n=700, dim=16, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x[:150] = x[0] + rng.normal(size=(150, dim)) * 0.12        # a dense group
    for k in range(200, 300, 2):                               # pairs
        x[k] = x[k + 1] + rng.normal(size=dim) * 0.1
    x[400:420] = x[400]                                        # equal vectors
    return x.astype(np.float32)


def brute(ids, x, threshold=0.9):
    v = x.astype(float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    hit = np.argwhere(np.triu(v @ v.T >= threshold, 1))
    comp = roots(ids, [(ids[a], ids[b]) for a, b in hit])
    links = dict.fromkeys(ids, 0)
    for a, b in hit:
        links[ids[a]] += 1
        links[ids[b]] += 1
    return links, comp


def test_links_and_components(spark):
    x = data()
    ids = list(range(1000, 1000 + len(x)))
    df = spark.createDataFrame([(i, [float(y) for y in v]) for i, v in zip(ids, x)], SCHEMA).withColumn("label", F.lit(1)).withColumn("node", F.lit("c"))
    links, comp = brute(ids, x)
    for beam, shards in ((16, 4), (64, 1)):
        got = vectors.near_vectors(df.repartition(5), beam=beam, shards=shards).collect()
        assert len(got) == len(ids)
        found = sum(r["n_links"] for r in got)
        assert 0.98 * sum(links.values()) <= found <= sum(links.values())
        assert all(r["n_links"] <= links[r["vec_id"]] for r in got)
        assert np.mean([r["component_id"] == comp[r["vec_id"]] for r in got]) > 0.98
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1.0, None]),
            (None, [3.0, 0.1]), (None, None), (9, [0.0, 1.0]), (10, [1.0, 0.0, 0.0]), (11, [-1.0, 0.0]), (12, [1e30, 1e-30]), (13, [-0.0, 5.0])]
    got = sorted((tuple(r) for r in vectors.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 10, 11)] + [(None, 0, None, True)]
    want = alone + [(1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False), (None, 4, 1, False), (12, 4, 1, False), (9, 1, 9, True), (13, 1, 9, False)]
    assert got == sorted(want, key=repr)
    assert vectors.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_links_of_a_chain_are_not_those_of_its_component(spark):
    rows, links = [], {}
    for k in range(12):                                        # chains of five, 20 degrees apart, each in its own plane
        for j in range(5):
            v = [0.0] * 24
            v[2 * k], v[2 * k + 1] = float(np.cos(np.radians(20 * j))), float(np.sin(np.radians(20 * j)))
            rows.append((10 * k + j, v))
            links[10 * k + j] = 1 + (0 < j < 4)
    for r in vectors.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect():
        assert (r["n_links"], r["component_id"]) == (links[r["vec_id"]], r["vec_id"] // 10 * 10)


@pytest.mark.parametrize("n", [1, 2, 31, 33, 500, 2500])
def test_graph_finds_neighbours(n):
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    layers = hnsw.build(x)
    near = x.astype(np.float32)
    assert [len(g) for g in layers] == hnsw.layer_sizes(n)
    ask = near[: min(n, 200)]
    nodes, sims = hnsw.beam_search(near, layers[0], ask, hnsw.descend(near, layers, ask, 0), min(64, n))
    assert (nodes[:, 0] == np.arange(len(ask))).mean() > 0.98
    top = np.argsort(-(ask @ near.T), axis=1)[:, :5]
    assert np.mean([len(set(a.tolist()) & set(b.tolist())) / len(b) for a, b in zip(nodes[:, :5], top)]) > 0.9
