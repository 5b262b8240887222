"""Vector codes: each part of a vector as the number of its nearest entry in that part's codebook.

Entries are found by exponion search. A part starts at the entry that it had before, at distance d. Any entry as near as that lies
within 2 d of it, by the triangle inequality, so only the entry's neighbours inside that radius are tried, in
the order of their distance. All is done in integers: squared distances, a radius of 4 d * d, ties to the lower number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.shared import drop, keep, new_path, small_batches

#: Integers of a component per unit.
SCALE = 256
#: Components of more than this many integers count as this many, so that squared distances fit 64 bits (parts up to 256 wide).
BOUND = 1 << 26
#: Vectors that are worked on together.
ROWS = 1 << 14
_HEX = np.array([b"%02x" % k for k in range(256)], "S2")
_ROWS = "vector binary, code binary, sums array<bigint>"


class Search:
    """Nearest entries in one part's codebook."""

    def __init__(self, book: np.ndarray):
        self.book = book
        gap = ((book[:, None, :] - book[None, :, :]) ** 2).sum(2)
        self.near = np.argsort(gap, axis=1, kind="stable")
        #: A part at squared distance d of an entry needs its neighbours of up to 4 d; rounded up, so that 4 d need not fit.
        self.least = (np.take_along_axis(gap, self.near, 1) + 3) >> 2
        self.by_first = np.argsort(book[:, 0], kind="stable")

    def start(self, parts: np.ndarray) -> np.ndarray:
        """An entry to begin with where there was none before: one whose first component is close."""
        at = np.searchsorted(self.book[self.by_first, 0], parts[:, 0])
        return self.by_first[np.minimum(at, len(self.book) - 1)]

    def nearest(self, parts: np.ndarray, before: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each part, and its squared distance."""
        before = self.start(parts) if before is None else before.astype(np.int64)
        own = ((parts - self.book[before]) ** 2).sum(1)
        best, far = before.copy(), own.copy()
        live = np.arange(len(parts))
        for k in range(len(self.book)):
            live = live[self.least[before[live], k] <= own[live]]
            if not len(live):
                break
            entry = self.near[before[live], k]
            d = ((parts[live] - self.book[entry]) ** 2).sum(1)
            better = (d < far[live]) | ((d == far[live]) & (entry < best[live]))
            at = live[better]
            best[at], far[at] = entry[better], d[better]
        return best, far


def integers(values: np.ndarray, width: int) -> np.ndarray:
    """Vectors of one length as integers, filled up with zeros to a width."""
    with np.errstate(over="ignore"):
        x = np.clip(np.floor(values.astype(np.float64) * SCALE), -BOUND, BOUND).astype(np.int64)
    return np.pad(x, ((0, 0), (0, width - x.shape[1])))


def _encode(x: np.ndarray, books: np.ndarray, codes: np.ndarray | None, searches: list[Search]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of integer vectors and their squared errors."""
    parts, _, wide = books.shape
    out, error = np.empty((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
    for p in range(parts):
        best, far = searches[p].nearest(x[:, p * wide : (p + 1) * wide], None if codes is None else codes[:, p])
        out[:, p] = best
        error += far
    return out, error


def _stored(column: pa.Array, dtype, width: int) -> np.ndarray:
    """Binary values of equal length as rows of a table."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), width)


def _assign(books: np.ndarray):
    """A function over (id, label, vector, code) that gives each vector's code, and a task's sums and numbers of the parts of
    each entry in one more row. Vectors come as lists at first, then as stored integers with the codes that they had."""
    parts, entries, wide = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [Search(b) for b in books]
        sums = np.zeros((parts, entries, wide + 1), np.int64)
        kinds = None
        for whole in batches:
            for at in range(0, len(whole), ROWS):
                batch = whole.slice(at, ROWS)
                kinds = batch.schema
                x, before = _vectors(batch, parts, parts * wide)
                codes, _ = _encode(x, books, before, searches)
                for p in range(parts):
                    mine, code = x[:, p * wide : (p + 1) * wide], codes[:, p]
                    order = np.argsort(code, kind="stable")
                    found, first = np.unique(code[order], return_index=True)
                    sums[p, found, :wide] += np.add.reduceat(mine[order], first, axis=0)
                    sums[p, found, wide] += np.diff(np.append(first, len(code)))
                rows = [pa.array([v.tobytes() for v in x.astype(np.int32)], pa.binary()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.nulls(len(batch), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], *rows], ["id", "label", "vector", "code", "sums"])
        if kinds is not None:
            rows = [pa.nulls(1, kinds.field(k).type) for k in range(2)] + [pa.nulls(1, pa.binary())] * 2 + [pa.array([sums.ravel()], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(rows, ["id", "label", "vector", "code", "sums"])

    return run


def _vectors(batch: pa.RecordBatch, parts: int, width: int) -> tuple[np.ndarray, np.ndarray | None]:
    """Integer vectors of a batch, and their codes if they have some."""
    column = batch.column(2)
    if pa.types.is_binary(column.type):
        return _stored(column, np.int32, width).astype(np.int64), _stored(batch.column(3), np.uint8, parts)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return integers(flat.reshape(len(batch), -1), width), None


def _final(books: np.ndarray):
    parts, _, wide = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [Search(b) for b in books]
        for whole in batches:
            for at in range(0, len(whole), ROWS):
                batch = whole.slice(at, ROWS)
                x, before = _vectors(batch, parts, parts * wide)
                codes, error = _encode(x, books, before, searches)
                text = _HEX[codes].view(f"S{2 * parts}").ravel().astype(str)
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(text, pa.string()), pa.array(error)], ["id", "label", "code", "error"])

    return run


def _means(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks with each entry at the mean of its parts, rounded down. Sums are added up by Spark; what reaches the driver has
    the size of the codebooks, whatever the number of vectors."""
    sums = rows.where("sums is not null").select(F.posexplode("sums").alias("at", "x")).groupBy("at").agg(F.sum(F.col("x").cast("decimal(20,0)")).alias("x"))
    parts, entries, wide = books.shape
    total = [0] * (parts * entries * (wide + 1))
    for at, x in sums.collect():
        total[at] = int(x)
    out = books.copy()
    for k in range(parts * entries):
        *x, n = total[k * (wide + 1) : (k + 1) * (wide + 1)]
        if n:
            out[k // entries, k % entries] = [v // n for v in x]
    return out


def digest(books: np.ndarray) -> str:
    """SHA-256 of all integers of the codebooks by part, entry and place, as text with commas between."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2) -> tuple[DataFrame, np.ndarray]:
    """Codes of all vectors, and the codebooks (part, entry, place) that they refer to.

    The rows have the id, ``code`` (two hexadecimal digits for each part), ``error`` (squared distance of the integer vector, floor(256 x), to
    its entries) and ``label_error``, the sum over the vectors of equal labels (null is one). The codebooks start as the parts of
    the vectors with the smallest ids (of equal ids, the smallest vector; null is last), and are fitted in rounds over all vectors.

    Left out are vectors that are null or hold null or non-finite components, and those of another length than most have (of
    lengths that are equally frequent the smaller counts). A length that ``parts`` does not divide is filled up with zeros. Components
    beyond 2**18 count as that, so that distances fit; a label's sum that does not fit is the largest long. Fewer vectors than entries
    make smaller codebooks, an empty table gives no rows. Repeated rows count as often as they are there. Other columns are
    ignored.

    A round reads and writes each vector once, with its code, from which the next one starts. Tasks get the codebooks, of
    entries x length integers, and add up their own sums, so nothing is shuffled but one such row for each task.
    """
    spark = vectors.sparkSession
    if entries > 256:
        raise ValueError("a code has two hexadecimal digits: at most 256 entries")
    small_batches(spark)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    rows = rows.where(F.coalesce(F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))), F.lit(False)))
    lengths = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.col("count").desc(), "length").first()
    ids, labels = (rows.schema[c].dataType.simpleString() for c in ("id", "label"))
    if lengths is None:
        return spark.createDataFrame([], f"`{id_col}` {ids}, code string, error long, label_error long"), np.zeros((parts, 0, 1), np.int64)
    rows = rows.where(F.size("vector") == lengths["length"])
    wide = max(1, -(-lengths["length"] // parts))
    seeds = np.array([r[0] for r in rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()], np.float64)
    books = integers(seeds.reshape(len(seeds), -1), parts * wide).reshape(len(seeds), parts, wide).transpose(1, 0, 2).copy()

    now, path = rows.withColumn("code", F.lit(None).cast("binary")), None
    for _ in range(rounds):
        there = new_path(spark, "vectors")
        done = keep(now.mapInArrow(_assign(books), f"id {ids}, label {labels}, {_ROWS}"), "vectors", there)
        books = _means(done, books)
        if path:
            drop(path, spark)
        path, now = there, done.where("sums is null").drop("sums")
    codes = keep(now.mapInArrow(_final(books), f"id {ids}, label {labels}, code string, error long"), "codes")
    if path:
        drop(path, spark)
    total = F.least(F.sum(F.col("error").cast("decimal(20,0)")), F.lit(Decimal(2**63 - 1))).cast("long")
    by_label = codes.groupBy(F.col("label").alias("of")).agg(total.alias("label_error"))
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(F.col("id").alias(id_col), "code", "error", "label_error"), books
