from collections import Counter

import numpy as np
import pytest

from tidelog.llm.vectors import near_vectors


def brute(rows):
    ok = [k for k, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    size = max((len(v) for _, v in rows if v), default=1)
    x = np.zeros((len(rows), size))
    for k in ok:
        v = np.array(rows[k][1], float)
        v /= np.abs(v).max()
        x[k, : len(v)] = v / np.linalg.norm(v)
    good = np.zeros(len(rows), bool)
    good[ok] = True
    linked = (x @ x.T >= 0.95) & good & good[:, None]
    np.fill_diagonal(linked, False)
    comp = np.arange(len(rows))
    while True:
        new = np.minimum(comp, np.where(linked, comp, len(rows)).min(1))
        if (new == comp).all():
            break
        comp = new
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[comp[k]] = min(i, least.get(comp[k], i))
    return Counter((i, int(linked[k].sum()), least.get(comp[k])) for k, (i, _) in enumerate(rows))


def run(df, **more):
    return Counter(tuple(r) for r in near_vectors(df, **more).select("vec_id", "n_links", "component_id").collect())


def test_awkward_vectors(spark):
    r = np.random.default_rng(1)
    base = r.normal(size=(6, 7))
    rows = [(k, (base[k % 6] + 0.12 * r.normal(size=7)).tolist()) for k in range(120)]
    rows += [(200, None), (201, []), (202, [0.0] * 7), (203, [1.0, None]), (204, [float("nan")] * 7), (205, [float("inf")] + [0.0] * 6), (206, [1.0]), (207, [2.0, 0.0, 0.0]), (208, [1e-300]), (209, [1e300, 0.0])]
    rows += [(300 + k, rows[5][1]) for k in range(40)] + [(5, rows[5][1]), (None, rows[5][1]), (None, None)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, n_links int").repartition(4)
    assert run(df) == brute(rows)
    assert run(df, recall=1.0) == brute(rows)
    assert near_vectors(df.limit(0)).count() == 0
    assert [r["kept"] for r in near_vectors(df.where("vec_id = 206")).collect()] == [True]


@pytest.mark.parametrize("block", [16, 2048])
def test_sample_table(spark, monkeypatch, block):
    monkeypatch.setattr("tidelog.llm.vectors.BLOCK", block)
    monkeypatch.setattr("tidelog.llm.vectors.PER_CELL", 20)
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").limit(1500)
    rows = [tuple(r) for r in df.select("vec_id", "embedding").collect()]
    rows += [(100_000 + k, (np.array(rows[k % 7][1]) + 1e-3 * k / 300).tolist()) for k in range(300)]
    got, want = run(spark.createDataFrame(rows, "vec_id long, embedding array<float>")), brute([(i, np.array(v, np.float32).astype(float).tolist()) for i, v in rows])
    assert got == want


@pytest.mark.parametrize("more", [{}, {"recall": 0.9999}])
def test_cloud_does_not_set_the_limit(spark, monkeypatch, more):
    """A third of the rows lies in one spread cloud, the others in pairs whose members are much farther apart."""
    monkeypatch.setattr("tidelog.llm.vectors.BLOCK", 64)
    monkeypatch.setattr("tidelog.llm.vectors.PER_CELL", 20)
    r = np.random.default_rng(6)
    one = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    cloud = one(one(r.normal(size=16)) + 0.013 * r.normal(size=(800, 16)))
    a = one(r.normal(size=(800, 16)))
    side = r.normal(size=a.shape)
    side = one(side - (side * a).sum(1)[:, None] * a)
    cos = r.uniform(0.951, 0.97, (800, 1))
    rows = [(k, v.tolist()) for k, v in enumerate(np.concatenate((cloud, a, cos * a + np.sqrt(1 - cos**2) * side)))]
    got, want = run(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), **more), brute(rows)
    if more:
        assert sum((got & want).values()) >= 0.99 * len(rows)
    else:
        assert got == want
