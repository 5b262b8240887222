import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from tidelog.llm.codes import BOUND, Search, compress, digest

KIND = "vec_id long, embedding array<double>, label int, code int"


def plain(rows, parts=16, entries=64, rounds=2):
    """The contract with Python's own integers."""
    kept = [(i, [min(max(math.floor(256 * x), -BOUND), BOUND) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    wide = len(kept[0][1]) // parts
    cut = [[v[p * wide : (p + 1) * wide] for p in range(parts)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            mine = defaultdict(list)
            for c in cut:
                mine[near(p, c[p])[1]].append(c[p])
            for k, xs in mine.items():
                books[p][k] = [sum(col) // len(xs) for col in zip(*xs)]
    found = [[near(p, c[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = defaultdict(int)
    for (_, _, label), e in zip(kept, errors):
        by_label[label] += e
    rows = [(i, "".join(f"{k:02x}" for _, k in f), e, by_label[label]) for (i, _, label), f, e in zip(kept, found, errors)]
    text = ",".join(str(x) for b in books for e in b for x in e)
    return sorted(rows, key=str), hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("kind", ["spread", "ties", "few"])
def test_like_plain_integers(spark, kind):
    r = np.random.default_rng(3)
    n = {"spread": 300, "ties": 200, "few": 20}[kind]
    values = r.normal(0, 1, (n, 32)) if kind != "ties" else r.integers(-1, 2, (n, 32)) / 256
    rows = [(int(i) * 3 - 50, v.tolist(), None if i % 7 == 0 else int(i % 3)) for i, v in enumerate(values)]
    rows += [(5000, rows[4][1], 1), (5000, rows[4][1], 1), (None, rows[5][1], 2), (9, [0.0] * 32, 0), (7, [1e300] * 16 + [-1e300] * 16, 0)]
    dirty = [(-999, None, 0), (-998, [float("nan")] + [0.0] * 31, 0), (-997, [None] + [0.0] * 31, 1), (-996, [math.inf] * 32, 1), (-995, [1.0] * 3, 1), (-994, [], 1)]
    df = spark.createDataFrame([(*x, 77) for x in rows + dirty], KIND).repartition(4)
    out, books = compress(df)
    want, name = plain(rows)
    assert sorted(map(tuple, out.collect()), key=str) == want and digest(books) == name
    assert books.shape == (16, min(64, len(rows)), 2)


def test_search_equals_trying_all():
    r = np.random.default_rng(5)
    for spread in (2, 50, 1 << 20):
        book, x = r.integers(-spread, spread, (40, 3)), r.integers(-spread, spread, (2000, 3))
        book[7] = book[30]
        gap = ((x[:, None] - book[None]) ** 2).sum(2)
        for before in (None, r.integers(0, 40, 2000)):
            best, far = Search(book).nearest(x, before)
            assert (best == gap.argmin(1)).all() and (far == gap.min(1)).all()


def test_odd_tables(spark):
    empty, books = compress(spark.createDataFrame([], KIND))
    assert empty.count() == 0 and books.size == 0 and empty.columns == ["vec_id", "code", "error", "label_error"]
    short, _ = compress(spark.createDataFrame([(1, [0.5, -0.5, 0.25], None, 0), (2, [0.5, -0.5, 0.75], None, 0)], KIND))
    assert sorted(r["error"] for r in short.collect()) == [0, 0]
    huge, _ = compress(spark.createDataFrame([(k, [(-1.0) ** k * 1e9] * 512, 0, 0) for k in range(70)], KIND), entries=1)
    assert all(r["label_error"] > 0 for r in huge.collect())
