"""Removal of long word sequences that occur more than once, found by recompression.

Documents are packed into blocks of a few MB (Arrow batches, compressed), written to the shared folder, so every
pass sees the same blocks under the same numbers.

1. Recompression: words become 64-bit symbols. Runs of two equal symbols, then in two rounds the pairs whose
   left and right symbols fall in the halves of the alphabet of that round, are renamed. A name is a hash of
   what it stands for, so it is the same in all documents without a dictionary. Each decision depends on the
   two symbols (for runs, also their neighbours), so two equal word sequences are cut alike inside: at most
   EDGE words at either end can differ, and no symbol has more than LONGEST words.
2. Of the symbols that start in the sure inside of a window, the one with the smallest name represents it.
   Only those representatives are counted over all blocks: a window whose representative occurs once occurs
   once itself.
3. The other windows are named as wholes and counted the same way, which verifies each repeat.

What goes through the shuffle is packed arrays: names by bucket, and back one bit for each. A name is sent
once per block however often it occurs, so a passage that all documents share weighs no more than the number
of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidelog.llm.shared import bucket_count, by_place, keep, release, small_batches, split_by_bucket
from tidelog.llm.words import _STEP, Words, as_bytes, chunks, mix, powers

#: Words at either end of a window whose symbols may depend on what lies outside: 2 for a run, then 2 and 4.
EDGE = 8
#: Words that a symbol of the last round can have.
LONGEST = 8
#: Shortest window of which the inside certainly begins a symbol that also ends inside.
SHORTEST = 2 * EDGE + 2 * LONGEST - 1
_U = np.uint64
_LAST = _U(0xFFFFFFFFFFFFFFFF)
_back = np.ones(1, np.uint64)


def _inverse_powers(n: int) -> np.ndarray:
    global _back
    if len(_back) < n:
        _back = np.full(max(n, 2 * len(_back)), pow(_STEP, -1, 1 << 64), np.uint64)
        _back[0] = 1
        _back = np.cumprod(_back)
    return _back[:n]


def symbols(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and first words of the symbols that recompression leaves of the words h."""
    name, start = h, np.arange(len(h))
    for turn in range(3):
        if len(name) < 2:
            break
        beside = doc[start[1:]] == doc[start[:-1]]
        if turn == 0:
            same = beside & (name[1:] == name[:-1])
            merge = same.copy()
            merge[1:] &= ~same[:-1]
            merge[:-1] &= ~same[1:]
        else:
            right = ((name >> _U(10 * turn)) & _U(1)).astype(bool)
            merge = beside & ~right[:-1] & right[1:]
        at = np.flatnonzero(merge)
        new = mix(name[at] * _U(0x9E3779B97F4A7C15) + (name[at + 1] ^ _U(0xD6E8FEB86659FD93 + turn)) * _U(0xC2B2AE3D27D4EB4F))
        name = name.copy()
        name[at] = new
        stay = np.ones(len(name), bool)
        stay[at + 1] = False
        name, start = name[stay], start[stay]
    return name, start


def representatives(h: np.ndarray, doc: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The representative of each window that begins at the words ``at``, and the names of all symbols."""
    name, start = symbols(h, doc)
    value = np.full(len(h), _LAST, np.uint64)
    value[start] = name
    reach = width - 2 * EDGE - LONGEST + 1  # starts from which a symbol ends inside
    least, span = value, 1
    while span * 2 <= reach:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    at = at + EDGE
    return np.minimum(least[at], least[at + reach - span]), name


def whole_windows(h: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """A name for the words of each window."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * powers(len(h)), dtype=np.uint64)))
    return mix((total[at + width] - total[at]) * _inverse_powers(len(h) + 1)[at])


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return zstandard.ZstdCompressor(level=1).compress(sink.getvalue().to_pybytes())


def _batch(raw: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(raw)) as stream:
        return stream.read_next_batch()


def _pack(text: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = as_bytes(batch.column(text))
            for i, j in chunks(texts):
                number += 1
                words = sum(len(x.split()) for x in texts[i:j])
                part = pa.RecordBatch.from_arrays([pa.concat_arrays([c.slice(i, j - i)]) for c in batch.columns], schema=batch.schema)
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([words], pa.int64()), pa.array([_ipc(part)], pa.binary())], ["block", "words", "packed"])

    return run


class _Block:
    """A block's windows, and those of them that may repeat."""

    def __init__(self, packed: bytes, text: int, width: int):
        self.rows = _batch(packed)
        self.words = Words(as_bytes(self.rows.column(text)))
        self.h, self.width = self.words.hashes(), width
        self.at, _ = self.words.windows(width)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Names of all representatives, those that the block has twice, and the name of each window."""
        if not len(self.at):
            return np.empty(0, np.uint64), np.empty(0, bool), np.empty(0, np.int64)
        least, every = representatives(self.h, self.words.docs(), self.at, self.width)
        names, of = np.unique(least, return_inverse=True)
        every = np.sort(every)
        return names, np.searchsorted(every, names, "right") - np.searchsorted(every, names) > 1, of

    def candidates(self, repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same of whole windows, given which representatives repeat; last, the windows' first words."""
        _, _, of = self.anchors()
        at = self.at[repeated[of]] if len(of) else self.at
        names, of, n = np.unique(whole_windows(self.h, at, self.width) if len(at) else np.empty(0, np.uint64), return_inverse=True, return_counts=True)
        return names, n > 1, of, at


_SENT = "block long, bucket long, names binary, twice binary"


def _rows(block: int, names: np.ndarray, twice: np.ndarray, buckets: int) -> list[tuple]:
    order, found, ends = split_by_bucket(names, buckets)
    return [(block, int(b), names[order[lo:hi]].tobytes(), np.packbits(twice[order[lo:hi]]).tobytes()) for b, lo, hi in zip(found, ends[:-1], ends[1:], strict=True)]


def _out(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["block", "bucket", "names", "twice"])


def _flags(names: np.ndarray, parts: list[dict] | None, buckets: int) -> np.ndarray:
    """The bits that came back for names, in their order."""
    flags = np.zeros(len(names), bool)
    if parts:
        order, found, ends = split_by_bucket(names, buckets)
        bits = {p["bucket"]: p["bits"] for p in parts}
        for b, lo, hi in zip(found, ends[:-1], ends[1:], strict=True):
            flags[order[lo:hi]] = np.unpackbits(np.frombuffer(bits[int(b)], np.uint8), count=hi - lo).astype(bool)
    return flags


def _send_anchors(text: int, width: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("packed"), strict=True):
                names, twice, _ = _Block(packed.as_py(), text, width).anchors()
                yield _out(_rows(block, names, twice, buckets))

    return run


def _send_windows(text: int, width: int, buckets: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packed, first in zip(batch.column("block").to_pylist(), batch.column("packed"), batch.column("first"), strict=True):
                b = _Block(packed.as_py(), text, width)
                names, twice, _, _ = b.candidates(_flags(b.anchors()[0], first.as_py(), buckets[0]))
                yield _out(_rows(block, names, twice, buckets[1]))

    return run


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one bucket: a bit for each name, set if it occurs again anywhere."""
    blocks, buckets, names, twice = [], [], [], []
    for batch in batches:
        blocks += batch.column("block").to_pylist()
        buckets += batch.column("bucket").to_pylist()
        names += [np.frombuffer(x, np.uint64) for x in batch.column("names").to_pylist()]
        twice += batch.column("twice").to_pylist()
    if not blocks:
        return
    sizes = [len(x) for x in names]
    flat = np.concatenate(names)
    del names
    order = np.argsort(flat, kind="stable")
    ranked = flat[order]
    again = np.zeros(len(flat), bool)
    again[1:] = ranked[1:] == ranked[:-1]
    again[:-1] |= again[1:]
    flags = np.empty(len(flat), bool)
    flags[order] = again
    bits, at = [], 0
    for size, own in zip(sizes, twice, strict=True):
        bits.append((np.packbits(flags[at : at + size]) | np.frombuffer(own, np.uint8)).tobytes())
        at += size
    yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(buckets, pa.int64()), pa.array(bits, pa.binary())], ["block", "bucket", "bits"])


def _finish(text: int, width: int, buckets: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed, first, second in zip(batch.column("packed"), batch.column("first"), batch.column("second"), strict=True):
                b = _Block(packed.as_py(), text, width)
                names, _, of, at = b.candidates(_flags(b.anchors()[0], first.as_py(), buckets[0]))
                flags = _flags(names, second.as_py(), buckets[1])
                at = at[flags[of]] if len(of) else at
                edge = np.zeros(len(b.h) + 1, np.int64)
                edge[at] += 1
                np.subtract.at(edge, at + width, 1)
                stay = np.cumsum(edge[:-1]) == 0
                w = b.words
                lost = np.concatenate(([0], np.cumsum(~stay)))
                removed = lost[w.first[1:]] - lost[w.first[:-1]]
                kept = []
                for d in range(len(w.counts)):
                    own = w.data[w.at[d] : w.at[d + 1]].split()
                    if removed[d]:
                        own = [own[k] for k in np.flatnonzero(stay[w.first[d] : w.first[d + 1]])]
                    kept.append(b" ".join(own).decode())
                yield pa.RecordBatch.from_arrays([*b.rows.columns, pa.array(w.counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], [*b.rows.schema.names, "n_words", "n_removed", "kept_text"])

    return run


def remove_repeats(docs: DataFrame, text_col: str = "text", width: int = 35) -> DataFrame:
    """Every row of docs with the words that repeated windows leave.

    A window is ``width`` consecutive words (runs of characters other than \\x20 and \\x09-\\x0D, compared
    unchanged) of one row; each word covered by a window whose words also start anywhere else, in the same row
    or another, is removed. All occurrences go, the first included; windows are judged on the input.
    Returns the columns of docs and ``n_words``, ``n_removed`` and ``kept_text``, the words that stay, joined
    by one space; columns of docs with these names are replaced. A null text has no words and keeps an empty
    text; rows with fewer words than the width lose nothing; repeated rows remove each other's windows; very
    long texts are worked on whole; an empty table gives an empty one. Other columns stay. ``width`` is at least SHORTEST.
    """
    if width < SHORTEST:
        raise ValueError(f"width must be {SHORTEST} or more")
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.drop("n_words", "n_removed", "kept_text")
    text, names = docs.columns.index(text_col), docs.columns
    docs = by_place(docs)
    blocks = keep(docs.mapInArrow(_pack(text), "block long, words long, packed binary"), "blocks")
    total = blocks.agg(F.sum("words")).first()[0] or 0
    buckets = bucket_count(spark, total // 4), bucket_count(spark, total)

    def repeated(sent: DataFrame, name: str) -> DataFrame:
        bits = sent.groupBy("bucket").applyInArrow(_repeats, "block long, bucket long, bits binary")
        return keep(bits.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias(name)), name)

    release(spark)
    first = repeated(blocks.select("block", "packed").mapInArrow(_send_anchors(text, width, buckets[0]), _SENT), "first")
    pairs = blocks.select("block", "packed").join(first, "block", "left")
    release(spark)
    second = repeated(pairs.mapInArrow(_send_windows(text, width, buckets), _SENT), "second")
    schema = StructType([*docs.schema.fields, StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_text", StringType())])
    out = pairs.join(second, "block", "left").mapInArrow(_finish(text, width, buckets), schema)
    return out.toDF(*names, "n_words", "n_removed", "kept_text")
