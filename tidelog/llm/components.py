"""Connected components of an edge table, as Spark joins and aggregations."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.shared import drop, keep, new_path

_EDGES = "a long, b long"


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the edges of a batch by a star for each of its own components."""
    for batch in batches:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            p, q = find(a), find(b)
            if p != q:
                root[max(p, q)] = min(p, q)
        pairs = [(find(x), x) for x in root]
        pairs = [(p, x) for p, x in pairs if p != x]
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """The component of every node that an edge touches.

    ``edges`` has two long columns ``a`` and ``b``; repeated edges, loops and either direction do no harm.
    Returns ``node`` and ``component``, the smallest node of its component. Rows with a null are left out.

    Each batch of edges is first replaced by stars (the same connectivity, fewer edges). Then large-star and
    small-star steps alternate: every node's neighbours are linked to the smallest of them, which ends with
    one star per component after a number of rounds that grows with the logarithm of its size. Each round is
    two aggregations with map-side combine and two joins; a node with very many neighbours makes a skewed
    join partition, which adaptive execution splits. Rounds are written to the shared folder, so lineage
    stays short and only a count comes to the driver.
    """
    spark = edges.sparkSession
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b")
    path = new_path(spark, "edges")
    now = keep(edges.mapInArrow(_contract, _EDGES).distinct(), "edges", path)
    for _ in range(max_rounds):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.join(least, both.u == least.w).where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a < b").distinct()
        lower = large.groupBy("b").agg(F.min("a").alias("m")).select(F.col("b").alias("w"), "m")
        small = large.join(lower, large.b == lower.w)
        small = small.select(F.col("m").alias("a"), F.col("a").alias("b")).union(small.select("m", "b")).where("a < b").distinct()
        there = new_path(spark, "edges")
        new = keep(small, "edges", there)
        drop(path, spark)
        path, now = there, new
        ends = now.select(F.col("a").alias("x"), F.lit(1).alias("of")).union(now.select("b", F.lit(0))).groupBy("x").agg(F.max("of").alias("center"), F.count_if(F.col("of") == 0).alias("times"))
        if not ends.where("times > 1 or (center = 1 and times > 0)").limit(1).count():  # each edge is of a star of its own
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).union(now.select("a", "a").distinct())
