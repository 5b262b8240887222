"""Near-duplicate embeddings by an inverted multi-index.

Each half of the unit vectors has its own codebook; pairs of codewords form a grid of cells, and each distinct
vector lies in the cell of its two nearest codewords. A vector compares itself with its own cell and with further
cells in the order of a bound: a member of cell (i, j) is at least as far away as the planes that separate its
codewords from the vector's, so LB = l1(i)^2 + l2(j)^2. Traversal takes both halves' codewords in ascending order and
stops where LB exceeds a limit. The limit is the largest squared distance that linked unit vectors can have, so nothing
can be missed. Only if a share of the links below 1 is asked for is it set from the data: QUERIES vectors are compared
with all vectors, in blocks, and the limit is such that this share of the links found so lies within it, where each
query counts alike, however many links it has. Every candidate is verified in double precision.

The codebooks are fitted on a sample (SAMPLE vectors, or SAMPLE_A_WORD per codeword, of which there are about as many as the
root of the number of cells); all vectors are indexed and compared. Equal vectors are one
entry with a count. Cells of more than BLOCK entries are split, and each pair of their blocks is a task of its own;
links are summed up and turned into stars where they are found, never listed as pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.components import components
from tidelog.llm.shared import keep, small_batches

#: Vectors that the codebooks are fitted on, or SAMPLE_A_WORD for each codeword of a half if these are more.
SAMPLE, SAMPLE_A_WORD, QUERIES = 16_384, 32, 1_024
#: Entries for a cell on average; if all links are wanted, so many cells are visited that they hold BLOCK.
PER_CELL = 512
BLOCK = 2048
#: Visits that a task lists at once.
LISTED = 1 << 20
BINS = 2000
#: Codewords nearer than this have no plane between them that rounding leaves in place; what rounding adds to a bound.
TOUCHING, ROUNDING = 1e-6, 1e-9


def unit(raw: pa.ListArray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors (shorter ones end with zeros), and which rows have one."""
    n = raw.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    out = np.zeros((len(n), size))
    out[row, place] = raw.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null components become nan
    top = np.abs(out).max(1, initial=0)
    ok = np.isfinite(top) & (top > 0)  # nan and infinity come through
    out[~ok] = 0
    out[ok] /= top[ok, None]
    out[ok] /= np.sqrt(np.einsum("ij,ij->i", out[ok], out[ok]))[:, None]
    return out, ok


def _entries(size: int):
    """vec_id, the entry's name (null if it links with nothing) and its unit vector."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, ok = unit(batch.column(1), size)
            v += 0.0  # no negative zeros
            names = [xxhash.xxh3_64_intdigest(x.tobytes()) - (1 << 63) if o else None for x, o in zip(v, ok, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.int64()), pa.array([x.tobytes() if o else None for x, o in zip(v, ok, strict=True)], pa.binary())], ["id", "entry", "vector"])

    return run


def codebook(x: np.ndarray, words: int, rounds: int = 12) -> np.ndarray:
    """k-means from evenly spaced starts; an empty codeword stays where it was."""
    c = x[np.linspace(0, len(x) - 1, words).astype(int)].copy()
    for _ in range(rounds):
        of = ((c**2).sum(1) - 2 * x @ c.T).argmin(1)
        n = np.bincount(of, minlength=words)
        total = np.zeros_like(c)
        np.add.at(total, of, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return np.unique(c, axis=0)


class Index:
    def __init__(self, sample: np.ndarray, words: int):
        self.half = sample.shape[1] // 2
        self.books = [codebook(p, min(words, len(p))) for p in (sample[:, : self.half], sample[:, self.half :])]
        self.gaps = [np.sqrt(((b[:, None] - b[None]) ** 2).sum(2)) for b in self.books]
        self.columns = len(self.books[1])
        self.limit = 0.0

    def bounds(self, v: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Nearest codewords of both halves, and squared distances to what belongs to each codeword, at least."""
        near, low = [], []
        for part, book, gap in zip((v[:, : self.half], v[:, self.half :]), self.books, self.gaps, strict=True):
            d = np.maximum((part**2).sum(1)[:, None] + (book**2).sum(1) - 2 * part @ book.T, 0)
            a = d.argmin(1)
            g = gap[a]
            b = np.divide(d - d[np.arange(len(d)), a][:, None], 2 * g, out=np.zeros_like(d), where=g > TOUCHING)
            near.append(a)
            low.append(np.maximum(b, 0) ** 2)
        return near, low

    def cells(self, v: np.ndarray) -> np.ndarray:
        near, _ = self.bounds(v)
        return near[0] * self.columns + near[1]

    def visits(self, v: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The cell of each vector, and the later ones that it visits."""
        near, low = self.bounds(v)
        cell = near[0] * self.columns + near[1]
        first, second = (np.argsort(x, axis=1, kind="stable") for x in low)
        out = []
        for k in range(len(v)):
            l1, l2 = low[0][k, first[k]], low[1][k, second[k]]
            i = first[k][l1 <= self.limit]
            # multi-sequence: for each i in order, as many j as the limit leaves
            n = np.searchsorted(l2, self.limit - l1[: len(i)], side="right")
            found = np.concatenate([x * self.columns + second[k][:m] for x, m in zip(i, n, strict=True)]) if len(i) else i
            out.append(found[found > cell[k]])
        return cell, out


def _vectors(column, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, size)


def _stars(a: np.ndarray, b: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges with the components of the links between a and b."""
    edges = []
    left, right = np.ones(len(a), bool), linked.any(0)
    left &= linked.any(1)
    while left.any():
        k = int(left.argmax())
        rows, cols = np.zeros(len(a), bool), linked[k].copy()
        rows[k] = True
        while True:
            more = linked[:, cols].any(1)
            cols = linked[more].any(0)
            if (more == rows).all():
                break
            rows = more
        center = int(a[k])
        edges += [(center, int(x)) for x in a[rows]] + [(center, int(x)) for x in b[cols]]
        left &= ~rows
        right &= ~cols
    return [e for e in edges if e[0] != e[1]]


def _link(size: int, threshold: float):
    """Rows sorted by cell, i, j and role: members of the block (0), then those that are compared with it (1).
    Yields edges (kind 1) and numbers of links (kind 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict | None = None

        def out(edges, names, sums):
            a = [e[0] for e in edges] + names.tolist()
            b = [e[1] for e in edges] + sums.tolist()
            return pa.RecordBatch.from_arrays([pa.array([1] * len(edges) + [0] * len(names), pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["kind", "a", "b"])

        def inside(o):
            v, e, n = np.concatenate(o["v"]), np.concatenate(o["e"]), np.concatenate(o["n"])
            o |= {"v": [v], "e": [e], "n": [n], "closed": True}
            if o["key"][1] == o["key"][2]:
                for k in range(0, len(v), BLOCK):
                    linked = v[k : k + BLOCK] @ v.T >= threshold
                    linked[np.arange(len(linked)), k + np.arange(len(linked))] = False
                    yield out(_stars(e[k : k + BLOCK], e, linked), e[k : k + BLOCK], linked @ n)

        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("cell", "i", "j", "role")), strict=True))
            v, e, n = _vectors(batch.column("vector"), size), batch.column("entry").to_numpy(), batch.column("copies").to_numpy()
            at = 0
            while at < len(keys):
                end = at
                while end < len(keys) and keys[end] == keys[at]:
                    end += 1
                key, role = keys[at][:3], keys[at][3]
                if own is None or own["key"] != key:
                    if own is not None and not own["closed"]:
                        yield from inside(own)
                    own = {"key": key, "v": [], "e": [], "n": [], "closed": False}
                if role == 0:
                    own["v"].append(v[at:end])
                    own["e"].append(e[at:end])
                    own["n"].append(n[at:end])
                elif own["v"]:
                    if not own["closed"]:
                        yield from inside(own)
                    for k in range(at, end, BLOCK):
                        to = min(k + BLOCK, end)
                        linked = v[k:to] @ own["v"][0].T >= threshold
                        if linked.any():
                            yield out(_stars(e[k:to], own["e"][0], linked), np.concatenate((e[k:to], own["e"][0])), np.concatenate((linked @ own["n"][0], linked.T @ n[k:to])))
                at = end
        if own is not None and not own["closed"]:
            yield from inside(own)

    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95, recall: float = 1) -> DataFrame:
    """Links and components of all vectors by cosine of ``threshold`` or more.

    Returns one row per input row: the id, ``n_links`` (other rows linked directly), ``component_id`` (smallest id
    reachable by links, itself included) and ``kept`` (the id is the component's). Vectors that are null, empty,
    zero or hold null or non-finite components link with nothing. A shorter vector counts as ending with zeros.
    Repeated rows are links of each other. Rows with a null id take part, have a null ``kept``, and a null component
    only if nothing with an id is linked. Other columns are ignored; an empty table gives an empty result. With a
    ``recall`` below 1 about that share of the links is found, with fewer comparisons.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    size = rows.agg(F.max(F.size("v"))).first()[0] or 0
    size = max(size + size % 2, 2)
    all_rows = keep(rows.mapInArrow(_entries(size), "id long, entry long, vector binary"), "vectors")
    entries = all_rows.where("entry is not null").groupBy("entry").agg(F.first("vector").alias("vector"), F.count("*").alias("copies"), F.min("id").alias("least"))
    entries = keep(entries, "entries")
    total = entries.count()

    edges = None
    if total:
        # cells grow in number with the vectors, not in size
        words = max(2, math.isqrt(max(total // (BLOCK if recall >= 1 else PER_CELL), 1)))
        # entry names are hashes, so the smallest are a fair sample; the queries are not of those that codebooks are fitted on
        n = max(SAMPLE, SAMPLE_A_WORD * words)
        sample = [r[0] for r in entries.orderBy("entry").limit(n + QUERIES * (recall < 1)).select("vector").collect()]
        sample = np.frombuffer(b"".join(sample), np.float64).reshape(-1, size)
        index = Index(sample[QUERIES * (recall < 1) :] if len(sample) > QUERIES else sample, words)
        farthest = 2 - 2 * threshold + ROUNDING
        index.limit = farthest if recall >= 1 else _limit(entries, index, sample[:QUERIES], size, threshold, recall, farthest)
        edges, degrees = _pairs(entries, index, size, threshold)
    names = entries.select("entry", "copies", "least")
    if edges is None:
        named = names.withColumn("links", F.lit(0).cast("long")).withColumn("component", F.col("entry"))
    else:
        named = names.join(degrees, "entry", "left").join(components(edges), F.col("entry") == F.col("node"), "left").withColumn("component", F.coalesce("component", "entry"))
    best = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(best, "component").select("entry", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = all_rows.drop("vector").join(named, "entry", "left")
    out = out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.col(id_col) == F.col("component_id"))


def _limit(entries: DataFrame, index: Index, queries: np.ndarray, size: int, threshold: float, recall: float, farthest: float) -> float:
    """The bound within which traversal finds the wanted share of the links of the queries, each of which has the same
    weight. Queries are compared with all entries in blocks; only a histogram comes back."""
    shared = entries.sparkSession.sparkContext.broadcast((index, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idx, q = shared.value
        q_cell, (q1, q2) = idx.cells(q), idx.bounds(q)[1]
        for batch in batches:
            v = _vectors(batch.column(0), size)
            near, (l1, l2) = idx.bounds(v)
            cell = near[0] * idx.columns + near[1]
            a, b = np.nonzero(v @ q.T >= threshold)
            other = cell[a] != q_cell[b]
            a, b = a[other], b[other]
            # the one in the earlier cell visits the other's
            mine = l1[a, q_cell[b] // idx.columns] + l2[a, q_cell[b] % idx.columns]
            theirs = q1[b, cell[a] // idx.columns] + q2[b, cell[a] % idx.columns]
            low = np.where(cell[a] < q_cell[b], mine, theirs)
            bins = np.minimum((low / farthest * BINS).astype(np.int64), BINS - 1)
            at, n = np.unique(b * BINS + bins, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(at // BINS), pa.array(at % BINS), pa.array(n)], ["query", "bin", "n"])

    found = entries.select("vector").mapInArrow(run, "query long, bin long, n long").groupBy("query", "bin").agg(F.sum("n").alias("n"))
    found = keep(found, "bounds")
    links = found.groupBy("query").agg(F.sum("n").alias("links"))
    if links.count() < 100:  # too few queries with links across cells to learn from
        return farthest
    n = np.zeros(BINS)
    for r in found.join(links, "query").groupBy("bin").agg(F.sum(F.col("n") / F.col("links")).alias("n")).collect():
        n[r[0]] = r[1]
    reached = np.cumsum(n) / n.sum()
    return farthest * (int(np.searchsorted(reached, recall)) + 2) / BINS


def _pairs(entries: DataFrame, index: Index, size: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Edges with the links' components, and the number of rows that each entry links with, itself aside."""
    shared = entries.sparkSession.sparkContext.broadcast(index)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _vectors(batch.column(1), size)
            step = max(1, min(BLOCK, LISTED // math.prod(map(len, shared.value.books))))
            for k in range(0, len(v), step):
                cell, visits = shared.value.visits(v[k : k + step])
                part = [c.slice(k, step) for c in batch.columns]
                yield pa.RecordBatch.from_arrays([*part, pa.array(cell, pa.int64()), pa.array([x.tolist() for x in visits], pa.list_(pa.int64()))], ["entry", "vector", "copies", "cell", "visits"])

    placed = keep(entries.select("entry", "vector", "copies").mapInArrow(place, "entry long, vector binary, copies long, cell long, visits array<long>"), "placed")
    blocks = keep(placed.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "blocks")
    base = placed.join(blocks, "cell").withColumn("own", F.pmod(F.xxhash64("entry"), "blocks").cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    own = base.withColumn("other", every)
    # a block meets itself, and of two blocks the later one is compared with the earlier
    own = own.select("cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("role"), "entry", "copies", "vector")
    guests = placed.select("entry", "copies", "vector", F.explode("visits").alias("cell")).join(blocks, "cell").withColumn("i", every)
    guests = guests.select("cell", "i", F.col("i").alias("j"), F.lit(1).alias("role"), "entry", "copies", "vector")
    dealt = own.unionByName(guests).repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j", "role")
    found = keep(dealt.mapInArrow(_link(size, threshold), "kind int, a long, b long"), "links")
    degrees = found.where("kind = 0").groupBy(F.col("a").alias("entry")).agg(F.sum("b").alias("links"))
    return found.where("kind = 1").select("a", "b"), degrees
