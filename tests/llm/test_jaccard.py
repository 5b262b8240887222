import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm.components import components
from tidelog.llm.jaccard import Shape, jaccard_join, traverse


def shingles(text, k=4):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                up[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return Counter((i, len(sets[k]), least.get(find(k))) for k, (i, _) in enumerate(rows))


def run(df):
    return Counter(tuple(r) for r in jaccard_join(df).select("doc_id", "n_shingles", "component_id").collect())


def test_awkward_corpus(docs, corpus):
    assert run(docs.withColumn("set_id", F.lit("clash")).withColumn("component_id", F.lit("clash"))) == brute([r[:2] for r in corpus])


def test_empty_table(no_docs):
    assert jaccard_join(no_docs).count() == 0


def test_sample_table(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    assert run(df) == brute([tuple(r) for r in df.select("doc_id", "text").collect()])


@pytest.mark.parametrize("seed", [1, 2])
def test_chains_of_near_copies(spark, seed):
    """Groups whose members link only with some of the others, and one set that is shared by many."""
    r = random.Random(seed)
    rows, n = [], 0
    for _ in range(6):
        w = [f"w{r.randrange(5000)}" for _ in range(r.choice([9, 25, 60, 140]))]
        for _ in range(40):
            w = list(w)
            for _ in range(r.randrange(0, 3)):
                i = r.randrange(len(w))
                w[i : i + 1] = [f"w{r.randrange(5000)}"] * r.choice([1, 1, 1, 2, 0])
            rows.append((n, " ".join(w)))
            n += 1
    rows += [(n + k, rows[3][1]) for k in range(100)]
    assert run(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)) == brute(rows)


def test_linked_sets_share_enough_parts():
    shape = Shape(4, 85, 100)
    r = np.random.default_rng(3)
    for n in (6, 7, 12, 40, 123, 124, 700):
        a = r.integers(0, 1 << 63, n, dtype=np.uint64)
        for _ in range(20):
            k = int(r.integers(0, n // 6 + 1))
            b = np.concatenate((a[k:], r.integers(0, 1 << 63, int(r.integers(0, n // 8 + 1)), dtype=np.uint64)))
            common = n - k
            if not shape.linked(common, n, len(b)):
                continue
            x = np.concatenate((np.sort(a), np.sort(b)))
            keys, owner, _, least = shape.keys(x, np.array([0, n, n + len(b)]))
            shared = set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist())
            assert len(shared) >= max(least.min(), 1)


def test_sets_with_many_empty_parts(spark):
    """A set that sends its empty parts links with one that does not, though they share few keys."""
    shape, r = Shape(4, 85, 100), random.Random(11)
    words = [[f"w{r.randrange(10**6)}" for _ in range(10)] for _ in range(20_000)]
    pairs = [(" ".join(w[:9]), " ".join(w)) for w in words]
    x, at = shape.of([t.encode() for p in pairs for t in p])
    keys, owner, _, least = shape.keys(x, at)
    order = np.argsort(owner, kind="stable")
    ends = np.searchsorted(owner[order], np.arange(2 * len(pairs) + 1))
    sent = [set(keys[order[i:j]].tolist()) for i, j in zip(ends[:-1], ends[1:], strict=True)]
    few = []
    for k in range(len(pairs)):
        shared = sent[2 * k] & sent[2 * k + 1]
        most = max(sum(bool(s & 256) == g for s in shared) for g in (False, True))
        assert most >= max(least[2 * k], least[2 * k + 1])
        if most == 1:
            few.append(pairs[k])
    assert few
    rows = list(enumerate(t for p in few for t in p))
    got = run(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute(rows)


def test_traversal_finds_every_pair_that_may_link():
    shape = Shape(4, 85, 100)
    r = np.random.default_rng(4)
    sets = []
    for _ in range(12):
        base = r.integers(0, 1 << 63, int(r.integers(30, 90)), dtype=np.uint64)
        for _ in range(9):
            s = base[r.random(len(base)) > 0.05]
            sets.append(np.unique(np.concatenate((s, r.integers(0, 1 << 63, 2, dtype=np.uint64)))))
    sizes = np.array([len(s) for s in sets])
    comps = np.arange(len(sets)) // 5
    yes = np.ones(len(sets), bool)
    a, b, _ = traverse(shape, sizes, [shape.bitmap(s) for s in sets], comps, yes, yes)
    found = {frozenset(p) for p in zip(a.tolist(), b.tolist(), strict=True)}
    wanted = {frozenset((i, j)) for i in range(len(sets)) for j in range(i) if comps[i] != comps[j] and shape.linked(len(np.intersect1d(sets[i], sets[j])), sizes[i], sizes[j])}
    assert wanted and wanted <= found and len(found) < len(sets) ** 2 / 4


def test_components(spark):
    r = random.Random(5)
    edges = [(k, k + 1) for k in range(100, 160)] + [(r.randrange(1000, 1100), r.randrange(1000, 1100)) for _ in range(70)] + [(5000, k) for k in range(5001, 5300)] + [(7, 7)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        p, q = find(a), find(b)
        up[max(p, q)] = min(p, q)
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "a long, b long").repartition(6)).collect()}
    assert got == {x: find(x) for x in up if x != 7}
