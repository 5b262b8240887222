"""Collocations by hierarchical pair naming.

Texts are read in blocks, each of one language: the block's own numbers of its distinct words, and its words as a sequence of
these. Words that are frequent over all blocks get a global id. Then, length by length, two neighbouring frequent (k-1)-grams
make a pair of ids; pairs are counted in each block and summed over all, the frequent ones get ids of their own by a join, and
take the places of the first of the two in the sequences. Whatever part of a frequent phrase is frequent too, so nothing
that counts is lost on the way.

The two ids of a pair are also its parents, the phrase without its last and without its first word. Through them a phrase
inherits the counts of all its beginnings and ends, which the cuts need, and gives its own count to the phrases inside it.

A block's sequence stands in the form from which its next items follow: for words, numbers by how frequent they are in the block; for
pairs, the frequent (k-1)-grams, of which the block makes the same pairs again when their ids arrive.

Items (words, or pairs of ids) travel packed: a row has a block's items of one bucket, sorted and compressed, and their numbers in
the block are those that follow its ``base``. A bucket's rows meet in one place, where its items are summed and named; the
answer to a row has the places and ids of its frequent items and goes back to the block. There are so many buckets that one holds
about BUCKET_ITEMS, so rows get shorter as blocks and buckets grow, down to an item each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.shared import bucket_count, drop, keep, new_path, small_batches
from tidelog.llm.words import as_bytes, mix

#: Bytes of text in a block at most, unless one piece is longer, and in all the blocks that a task fills.
BLOCK_BYTES, TASK_BYTES = 8 << 20, 32 << 20
#: Items that one bucket holds at most, about.
BUCKET_ITEMS = 1 << 20
#: Texts with A-Z lower-cased and every character that ends a piece as a dot.
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\x0a\x0b\x0c\x0d", b"abcdefghijklmnopqrstuvwxyz.........")
#: Items of a block in one bucket (its sequence if bucket is null): base is the number of the first, size how many there are (of a
#: sequence of words, its words).
_BLOCKS = "bucket long, lang string, block long, base long, size long, items binary"
#: A frequent item by name, or (block not null) the answer to a row of items.
_NAMES = "id long, left long, right long, lang string, word string, f long, block long, base long, items binary"
#: Parts that the ranking of a language is first cut into.
RANKS = 16
#: An id is its bucket and, in so many bits, its rank there.
_RANK_BITS = 36
_RANK = (1 << _RANK_BITS) - 1
_U = np.uint64


def _pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays of one length, byte by byte of all their numbers, compressed."""
    planes = [np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes() for x in arrays]
    return zstandard.compress(b"".join(planes), 1)


def _unpack(data: bytes, *types) -> list[np.ndarray]:
    widths = [np.dtype(t).itemsize for t in types]
    flat = np.frombuffer(zstandard.decompress(data), np.uint8)
    n, at, out = len(flat) // sum(widths), 0, []
    for t, w in zip(types, widths, strict=True):
        out.append(np.ascontiguousarray(flat[at : at + n * w].reshape(w, n).T).view(t).ravel())
        at += n * w
    return out


def _pack_pairs(left: np.ndarray, right: np.ndarray, n: np.ndarray) -> bytes:
    """Pairs in the order of left: its ids, of which few of the possible ones are used, as differences of denser numbers."""
    dense = 1 + int((left & _RANK).max())
    return dense.to_bytes(8, "little") + _pack(np.diff((left >> _RANK_BITS) * dense + (left & _RANK), prepend=0), right, n)


def _unpack_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    dense = int.from_bytes(data[:8], "little")
    left, right, n = _unpack(data[8:], np.int64, np.int64, np.int64)
    left = np.cumsum(left)
    return (left // dense << _RANK_BITS) + left % dense, right, n


def _cut(text: bytes) -> Iterator[bytes]:
    """A plain text in parts of about BLOCK_BYTES that end with a piece."""
    at = 0
    while len(text) - at > BLOCK_BYTES:
        end = text.rfind(b".", at, at + BLOCK_BYTES)
        end = text.find(b".", at + BLOCK_BYTES) if end < 0 else end
        if end < 0:
            break
        yield text[at:end]
        at = end + 1
    yield text[at:]


def _runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of runs of equal values, with the end, and the values."""
    found, first = np.unique(sorted_values, return_index=True)
    return np.append(first, len(sorted_values)), found


def _flow(values: np.ndarray, seq: np.ndarray) -> bytes:
    """A sequence of numbers (-1 for a gap) and what each number stands for."""
    first = _pack(values.astype(np.int64))
    return len(first).to_bytes(8, "little") + first + _pack(seq.astype(np.int32))


def _flowing(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    cut = 8 + int.from_bytes(data[:8], "little")
    return _unpack(data[8:cut], np.int64)[0], _unpack(data[cut:], np.int32)[0]


def _rows(lang: str | None, block: int, buckets: np.ndarray, starts: np.ndarray, packed: list[bytes], size: int | None, flow: bytes | None) -> pa.RecordBatch:
    """The rows of a block: its items bucket by bucket, then its sequence."""
    more = flow is not None
    base = [*starts[:-1].tolist(), *[None] * more]
    rows = [
        pa.array([*buckets.tolist(), *[None] * more], pa.int64()),
        pa.array([lang] * (len(buckets) + more), pa.string()),
        pa.array([block] * (len(buckets) + more), pa.int64()),
        pa.array(base, pa.int64()),
        pa.array([*np.diff(starts).tolist(), *[size] * more], pa.int64()),
        pa.array([*packed, *([flow] if more else [])], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(rows, ["bucket", "lang", "block", "base", "size", "items"])


def _read(buckets: int):
    """A function over (lang, text) rows that makes the rows of their blocks. In a sequence -1 ends a piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def block(lang: str) -> Iterator[pa.RecordBatch]:
            nonlocal number
            del sizes[lang]
            text = b".".join(held.pop(lang)).replace(b".", b" . ").strip()
            if not text:
                return
            # split by Arrow: as objects of their own the words would take twenty times their text
            words = pc.ascii_split_whitespace(pa.array([text], pa.large_string())).flatten().dictionary_encode()
            del text
            seq, names = words.indices.to_numpy(), words.dictionary.cast(pa.large_binary()).to_pylist()
            n = np.bincount(seq, minlength=len(names))
            bucket = np.fromiter((zlib.crc32(w) % buckets for w in names), np.int64, len(names))
            stop = words.dictionary.index(".").as_py()
            if stop >= 0:
                bucket[stop] = buckets  # the last of all, which is no item
            by_word = pc.sort_indices(words.dictionary).to_numpy()
            order = by_word[np.argsort(bucket[by_word], kind="stable")]
            real = len(names) - (stop >= 0)
            if not real:
                return
            code = np.empty(len(names), np.int64)
            code[order] = np.arange(len(names))
            ranked = np.argsort(-n, kind="stable")
            ranked = ranked[ranked != stop]
            rank = np.full(len(names), -1, np.int32)
            rank[ranked] = np.arange(real)
            starts, found = _runs(bucket[order[:real]])
            packed = []
            for i, j in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                mine = order[i:j].tolist()
                packed.append(zstandard.compress(n[order[i:j]].astype(np.int64).tobytes() + b" ".join([names[k] for k in mine]), 1))
            yield _rows(lang, number, found, starts, packed, int(n[order[:real]].sum()), _flow(code[ranked], rank[seq]))
            number += 1

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
                for part in _cut(text.translate(_PLAIN)):
                    held.setdefault(lang, []).append(part)
                    sizes[lang] = sizes.get(lang, 0) + len(part) + 1
                    if sizes[lang] >= BLOCK_BYTES:
                        yield from block(lang)
            if sum(sizes.values()) >= TASK_BYTES:
                for lang in list(held):
                    yield from block(lang)
        for lang in list(held):
            yield from block(lang)

    return run


class _Group:
    """The rows of one bucket (and language, for words)."""

    def __init__(self, words: bool, least: int):
        self.words, self.least, self.rows, self.items, self.n = words, least, [], [], []

    def add(self, block: int, base: int, size: int, data: bytes) -> None:
        if self.words:
            data = zstandard.decompress(data)
            self.n.append(np.frombuffer(data, np.int64, size))
            self.items.append(data[8 * size :])
        else:
            left, right, n = _unpack_pairs(data)
            self.n.append(n)
            self.items.append((left, right))
        self.rows.append((block, base, size))

    def names(self, lang: str | None, first: int) -> tuple[int, Iterator[pa.RecordBatch]]:
        """How many items are frequent, and the rows that name them and that answer."""
        if self.words:
            whole = pc.split_pattern(pa.array([b" ".join(self.items)], pa.large_string()), " ").flatten().dictionary_encode()
            m, of, keys = len(whole.dictionary), whole.indices.to_numpy(), whole.dictionary
        else:
            left, right = (np.concatenate([x[k] for x in self.items]) for k in range(2))
            a, ia = np.unique(left, return_inverse=True)
            b, ib = np.unique(right, return_inverse=True)
            keys, of = np.unique(ia * len(b) + ib, return_inverse=True)
            m = len(keys)
        order = np.argsort(of, kind="stable")
        f = np.add.reduceat(np.concatenate(self.n)[order], np.searchsorted(of[order], np.arange(m)))
        often = np.flatnonzero(f >= self.least)
        if self.words:  # the most frequent first, so that the ids in pairs are mostly small ones
            often = often[np.argsort(-f[often], kind="stable")]
        ids = np.full(m, -1, np.int64)
        ids[often] = first + np.arange(len(often))
        if self.words:
            named = [pa.nulls(len(often), pa.int64())] * 2 + [pa.array([lang] * len(often), pa.string()), keys.take(pa.array(often)).cast(pa.string())]
        else:
            named = [pa.array(a[keys[often] // len(b)]), pa.array(b[keys[often] % len(b)])] + [pa.nulls(len(often), pa.string())] * 2
        return len(often), self._made(named, ids, often, f, of)

    def _made(self, named: list[pa.Array], ids: np.ndarray, often: np.ndarray, f: np.ndarray, of: np.ndarray) -> Iterator[pa.RecordBatch]:
        names = ["id", "left", "right", "lang", "word", "f", "block", "base", "items"]
        if not len(often):
            return
        yield pa.RecordBatch.from_arrays([pa.array(ids[often]), *named, pa.array(f[often]), *[pa.nulls(len(often), pa.int64())] * 2, pa.nulls(len(often), pa.binary())], names)
        at, answers = 0, []
        for block, base, size in self.rows:
            mine = ids[of[at : at + size]]
            at += size
            there = np.flatnonzero(mine >= 0)
            if len(there):
                there = there[np.argsort(mine[there], kind="stable")]
                answers.append((block, base, _pack(np.diff(there, prepend=0).astype(np.int32) if not self.words else there.astype(np.int32), np.diff(mine[there], prepend=0))))
        n = len(answers)
        columns = [pa.array([x[k] for x in answers], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.binary()))]
        yield pa.RecordBatch.from_arrays([*[pa.nulls(n, pa.int64())] * 3, *[pa.nulls(n, pa.string())] * 2, pa.nulls(n, pa.int64()), *columns], names)


def _name(words: bool, least: int):
    """A function over rows of items, by bucket and language, that names frequent items and answers each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group, next_id = None, _Group(words, least), 0
        for batch in batches:
            for bucket, lang, block, base, size, items in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != (bucket, lang):
                    if now is not None:
                        n, rows = group.names(now[1], next_id)
                        yield from rows
                        next_id = next_id + n if now[0] == bucket else bucket << _RANK_BITS
                    else:
                        next_id = bucket << _RANK_BITS
                    now, group = (bucket, lang), _Group(words, least)
                group.add(block, base, size, items)
        if now is not None:
            yield from group.names(now[1], next_id)[1]

    return run


def _pair(ids: np.ndarray, seq: np.ndarray, buckets: int):
    """Neighbours among the frequent items of a block. Of the distinct pairs, by bucket, left and right: bucket, left, right, n; of each
    place but the last, the number of its pair in that order, -1 for none."""
    there = (seq[:-1] >= 0) & (seq[1:] >= 0)
    key, of, n = np.unique((seq[:-1].astype(np.int64) * len(ids) + seq[1:])[there], return_inverse=True, return_counts=True)
    left, right = ids[key // max(len(ids), 1)], ids[key % max(len(ids), 1)]
    bucket = (mix(left.astype(_U) * _U(0x9E3779B97F4A7C15) + right.astype(_U)) % _U(buckets)).astype(np.int64)
    order = np.lexsort((right, left, bucket))
    code = np.empty(len(key), np.int64)
    code[order] = np.arange(len(key))
    places = np.full(len(there), -1, np.int64)
    places[there] = code[of]
    return bucket[order], left[order], right[order], n[order].astype(np.int64), places


def _frequent(codes: np.ndarray, ids: np.ndarray, of: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of frequent items only, numbered by how frequent they are, with runs of others as one gap; and their ids. ``of`` has
    the item of each place (-1 for none), ``codes`` and ``ids`` are the frequent ones of ``size`` items."""
    id_of = np.full(size + 1, -1, np.int64)
    id_of[codes] = ids
    id_of[size] = -1
    n = np.bincount(of[of >= 0], minlength=size + 1)
    often = np.flatnonzero(id_of >= 0)
    often = often[np.argsort(-n[often], kind="stable")]
    rank = np.full(size + 1, -1, np.int32)
    rank[often] = np.arange(len(often))
    seq = rank[of]  # -1 reads the last place, which no item has
    gap = seq < 0
    return id_of[often], seq[~(gap & np.concatenate(([False], gap[:-1])))]


def _pairs(words: bool, buckets: int, last: bool):
    """A function over (block, base, items): each block's answers, then its sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for block, base, items in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if base is not None:
                    there, ids = _unpack(items, np.int32, np.int64)
                    there = there.astype(np.int64) if words else np.cumsum(there.astype(np.int64))
                    held.append((there + base, np.cumsum(ids)))
                    continue
                if held:
                    values, seq = _flowing(items)
                    if words:
                        of, size = np.append(values, -1)[seq], len(values)
                    else:
                        bucket, *_, of = _pair(values, seq, buckets)
                        size = len(bucket)
                    ids, seq = _frequent(*(np.concatenate([x[k] for x in held]) for k in range(2)), of, size)
                    bucket, left, right, n, _ = _pair(ids, seq, buckets)
                    if len(n):
                        starts, found = _runs(bucket)
                        packed = [_pack_pairs(left[i:j], right[i:j], n[i:j]) for i, j in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
                        yield _rows(None, block, found, starts, packed, None, None if last else _flow(ids, seq))
                held = []

    return run


def _exact(name: str):
    return F.col(name).cast("decimal(20,0)")


def phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 4, least: int = 30) -> list[DataFrame]:
    """Frequent phrases of each length from 1 to ``longest``, per language: id, left, right (the parents' ids; null for words), lang,
    phrase, last (its last word), f (its occurrences), heads and tails (the occurrences of its beginnings and ends, by
    length), and, as a last table, lang and n, the number of all its words.

    A null text is empty, a null language is ``und``. Other columns are ignored. Repeated rows count as often as they are
    there. An empty table gives empty ones. Very long texts are cut into blocks between pieces; a longer piece makes a block
    of its own.

    A task holds a block's few MB of text, or a bucket's items. An item is there once in a block, so no item has more
    occurrences in its bucket than there are blocks. Only the joins of frequent pairs with their parents meet a hot key, where a
    word is in very many of them; adaptive execution splits these.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = bucket_count(spark, size // 6, BUCKET_ITEMS)  # words have some six bytes, and a block's items are fewer
    nobody = F.lit(None).cast("long")
    path, found, totals = new_path(spark, "blocks"), [], None
    now = keep(rows.mapInArrow(_read(buckets), _BLOCKS), "blocks", path)
    totals = keep(now.where("bucket is null").groupBy("lang").agg(F.sum("size").alias("n")), "totals")
    for k in range(1, longest + 1):
        items = now.where("bucket is not null").repartition(buckets, "bucket").sortWithinPartitions("bucket", "lang", "block", "base")
        named_at = new_path(spark, "names")
        named = keep(items.mapInArrow(_name(k == 1, least), _NAMES), "names", named_at)
        new = named.where("block is null")
        if k == 1:
            new = new.select("id", nobody.alias("left"), nobody.alias("right"), "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", F.array("f").alias("heads"), F.array("f").alias("tails"))
        else:
            before = found[-1]
            first = before.select(F.col("id").alias("left"), "lang", F.col("phrase").alias("_begin"), F.col("heads").alias("_heads"))
            second = before.select(F.col("id").alias("right"), "last", F.col("tails").alias("_tails"))
            add = lambda c: F.concat(F.col(c), F.array("f"))
            both = new.select("id", "left", "right", "f").join(first, "left").join(second, "right")
            new = both.select("id", "left", "right", "lang", F.concat_ws(" ", "_begin", "last").alias("phrase"), "last", "f", add("_heads").alias("heads"), add("_tails").alias("tails"))
        found.append(keep(new, "phrases"))
        if k < longest:
            back = named.where("block is not null").select("block", "base", "items").union(now.where("bucket is null").select("block", "base", "items"))
            back = back.repartition("block").sortWithinPartitions("block", F.col("base").asc_nulls_last())
            there = new_path(spark, "blocks")
            pairs = keep(back.mapInArrow(_pairs(k == 1, buckets, k + 1 == longest), _BLOCKS), "blocks", there)
        drop(path, spark)
        drop(named_at, spark)
        if k < longest:
            path, now = there, pairs
    return [*found, totals]


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 4, least: int = 30, share: int = 80, most: int = 2000) -> DataFrame:
    """The first ``most`` phrases of 2 to ``longest`` words of each language: lang, rank, phrase, a (its occurrences), l and r (those of
    the two sides of its weakest cut), n (all words of the language) and score, floor(2000000 a / (l + r)).

    Phrases that occur ``least`` times are candidates (see ``phrases`` for nulls, blanks, repeats and long texts). One that lies inside
    a longer candidate which occurs at least ``share`` percent as often is left out. Of cuts with equal scores the first counts;
    of phrases with equal scores the more frequent comes first, then the one that is first in byte order. Arithmetic is exact.
    """
    *found, totals = phrases(docs, text_col, lang_col, longest, least)
    parts = []
    for k in range(2, longest + 1):
        rows = found[k - 1]
        if k < longest:  # of all longer candidates around a phrase, one with a single word more is the most frequent
            above = found[k]
            inside = above.select(F.col("left").alias("_of"), "f").union(above.select("right", "f")).groupBy("_of").agg(F.max("f").alias("_above"))
            rows = rows.join(inside, F.col("id") == F.col("_of"), "left")
            rows = rows.where(F.col("_above").isNull() | (_exact("_above") * 100 < _exact("f") * share))
        cuts = []
        for j in range(1, k):
            left, right = f"heads[{j - 1}]", f"tails[{k - j - 1}]"
            score = F.expr(f"(cast(f as decimal(20,0)) * 2000000) div (cast({left} as decimal(20,0)) + cast({right} as decimal(20,0)))")
            cuts.append(F.struct(score.alias("score"), F.lit(j).alias("cut"), F.expr(left).alias("l"), F.expr(right).alias("r")))
        parts.append(rows.select("lang", "phrase", F.col("f").alias("a"), F.array_min(F.array(*cuts)).alias("c")))
    rows = parts[0]
    for x in parts[1:]:
        rows = rows.union(x)
    rows = rows.select("lang", "phrase", "a", "c.l", "c.r", "c.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # first within parts, so that what meets in one task does not grow with the number of candidates
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANKS))
    rows = rows.withColumn("_part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("rank") <= most)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= most)
    return rows.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
