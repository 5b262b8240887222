import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm.substring import EDGE, LONGEST, SHORTEST, remove_repeats, symbols


def brute(rows, width=35):
    words = [(t or "").encode().split() for _, t in rows]
    n = Counter(tuple(w[k : k + width]) for w in words for k in range(len(w) - width + 1))
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if n[tuple(w[k : k + width])] > 1:
                gone[k : k + width] = [True] * width
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return Counter(out)


def run(df, **more):
    out = remove_repeats(df, **more)
    return Counter(tuple(r) for r in out.select("doc_id", "n_words", "n_removed", "kept_text").collect())


def test_awkward_corpus(docs, corpus):
    clash = docs.withColumn("n_words", F.lit("x")).withColumn("block", F.lit("y")).withColumn("first", F.lit(2))
    out = remove_repeats(clash)
    assert {"block", "first", "extra", "n_removed"} <= set(out.columns)
    assert Counter(tuple(r) for r in out.select("doc_id", "n_words", "n_removed", "kept_text").collect()) == brute([r[:2] for r in corpus])


def test_empty_table(no_docs):
    assert remove_repeats(no_docs).count() == 0
    with pytest.raises(ValueError):
        remove_repeats(no_docs, width=SHORTEST - 1)


def test_sample_table(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    assert run(df) == brute([tuple(r) for r in df.select("doc_id", "text").collect()])


@pytest.mark.parametrize("seed", range(4))
def test_repeats_at_any_place(spark, seed):
    """Few different words, runs, and passages of just under, exactly and over the window's length."""
    r = random.Random(seed)
    words = [f"w{k}" for k in range(r.choice([3, 50, 2000]))]
    passages = [[r.choice(words) for _ in range(n)] for n in (34, 35, 36, 60)] + [["run"] * 50, ["a", "b"] * 25]
    rows = []
    for k in range(30):
        w = [r.choice(words) for _ in range(r.randrange(0, 60))]
        for p in r.sample(passages, r.randrange(0, 3)):
            i = r.randrange(len(w) + 1)
            w[i:i] = p
        rows.append((k, " ".join(w)))
    assert run(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute(rows)


def test_equal_windows_are_cut_alike():
    r = np.random.default_rng(1)
    for kinds in (2, 3, 1000):
        alphabet = r.integers(0, 1 << 63, kinds, dtype=np.uint64)
        inner = alphabet[r.integers(0, kinds, 35)]
        seen = set()
        for _ in range(30):
            before, after = (alphabet[r.integers(0, kinds, int(r.integers(0, 20)))] for _ in range(2))
            h = np.concatenate((before, inner, after))
            name, start = symbols(h, np.zeros(len(h), np.int64))
            at = start - len(before)
            inside = (at >= EDGE) & (at < 35 - EDGE - LONGEST + 1)
            assert inside.any() and np.diff(np.append(start, len(h))).max() <= LONGEST
            seen.add(tuple(zip(at[inside].tolist(), name[inside].tolist(), strict=True)))
        assert len(seen) == 1
