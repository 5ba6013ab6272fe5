"""The vector index with thousands of cells: recall, links seen from both sides, bounded memory."""

import tracemalloc
from collections import Counter

import numpy as np
import pytest

from tablesync.llm import vectors
from tablesync.llm.common import bounded_sample


def near(r, x, cosine):
    """Vectors at exactly this cosine from unit vectors, in random directions."""
    noise = r.normal(size=x.shape)
    noise -= (noise * x).sum(1, keepdims=True) * x
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    return cosine * x + np.sqrt(1 - cosine ** 2) * noise


@pytest.mark.parametrize("cells,clusters", [(4096, 0), (4096, 300), (65536, 0)])
def test_recall_of_many_cells(cells, clusters):
    r = np.random.default_rng(3)
    make = lambda n: r.normal(size=(n, 48))
    if clusters:
        centre = r.normal(size=(clusters, 48)) * 3
        make = lambda n: centre[r.integers(clusters, size=n)] + r.normal(size=(n, 48))
    index = vectors.MultiIndex(make(vectors.SAMPLE), cells * vectors.CELL_ROWS, vectors.COSINE, vectors.RECALL)
    assert len(index.books[0]) * len(index.books[1]) == cells
    x = make(3000)  # none of the sample
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    visits = list(index.traverse(x))
    for cosine, least in ((0.98, 0.95), (0.99, 0.99)):
        homes = list(zip(*index.home(near(r, x, cosine))))
        found = np.mean([h in set(v) for h, v in zip(homes, visits)])
        print(f"{cells} cells, {clusters} clusters, cosine {cosine}: recall {found:.4f}, {np.mean([len(v) for v in visits]):.1f} cells a vector")
        assert found >= least


def test_links_count_for_both_sides(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CELL_ROWS", 3)
    r = np.random.default_rng(5)
    base = r.normal(size=(1500, 16))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    x = np.vstack([base, near(r, base, 0.981), near(r, base[:500], 0.985)]).astype("f4")
    d = spark.createDataFrame([(k, [float(e) for e in v], 0) for k, v in enumerate(x)], "vec_id bigint, embedding array<float>, label int").repartition(4)
    got = {g.vec_id: g for g in vectors.near_duplicates(d, block=64).collect()}
    y = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1)[:, None]
    want = (y @ y.T >= 0.98).sum(axis=1) - 1
    size = Counter(g.component_id for g in got.values())
    assert all((g.n_links == 0) == (size[g.component_id] == 1) for g in got.values())
    assert sum(g.n_links for g in got.values()) % 2 == 0 and all(got[k].n_links <= n for k, n in enumerate(want))
    assert sum(g.n_links for g in got.values()) >= 0.97 * want.sum()


def test_memory_of_many_near_copies():
    r = np.random.default_rng(6)
    x = near(r, np.repeat(np.eye(64)[:1], vectors.SAMPLE, axis=0), 0.999)
    tracemalloc.start()
    try:
        vectors.MultiIndex(x, 20_000, vectors.COSINE, vectors.RECALL)
        assert tracemalloc.get_traced_memory()[1] < 500 << 20
    finally:
        tracemalloc.stop()


def test_bounded_sample(spark):
    from pyspark.sql import functions as F

    df = spark.range(100000).repartition(200)
    some = bounded_sample(df, F.col("id"), 1000)
    assert some.count() == 1000 and bounded_sample(df, F.col("id"), 200000).count() == 100000
    h = F.shiftrightunsigned(F.xxhash64("id"), 1)
    assert df.where(h <= int((1.1 * 1000 + 100) / 100000 * ((1 << 63) - 1))).count() < 1500
    assert sorted(r.id for r in some.collect()) == sorted(r.id for r in bounded_sample(df.repartition(7), F.col("id"), 1000).collect())
