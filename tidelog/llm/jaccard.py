"""Similarity join of word-shingle sets with signature trees.

Sets of hashed shingles are compared by Jaccard similarity, exactly, without comparing all pairs.

1. Every distinct set (documents with equal sets share one) falls in a size band; linked sets lie in the same
   or adjacent bands. For two bands the number of shingles by which linked sets differ is at most some H.
   The shingles of a set are dealt by hash into H + 1 + S parts, so linked sets have at least 1 + S equal
   parts. Sets with an equal part form a tree of a forest; sets in different trees cannot link, nor can a set
   that shares fewer than 1 + S parts of one such division with others. Empty parts are left out (and taken
   off the 1 + S), but for sets that have more than S of them. Those may link with sets that leave out theirs, so one
   equal part is enough for them.
2. Each set is first compared with one other: the smallest id of its trees. Then, twice, the search of step 3 gives
   a spanning forest of the likeliest pairs between components, so at most one pair for each member of a block.
   Groups of near copies become components that way, without their pairs being listed.
3. Trees that still hold several components get nodes with OR-combined token bitmaps, size ranges and the
   excess of tokens over bits. A dual traversal descends from the root paired with itself and drops node
   pairs whose largest possible overlap is too small for their sizes, or that lie within one component.
   Trees with many members are split into blocks, and pairs of blocks are separate tasks. A component that fills
   a block has blocks of its own, which are not paired with each other.
4. Surviving pairs are compared shingle by shingle, from the texts.

Set ids and shingles are 64-bit hashes; the parts' keys are shorter, as a collision there only costs a
comparison.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.components import components
from tidelog.llm.shared import by_key_blocks, keep, new_path, release, small_batches
from tidelog.llm.words import Words, as_bytes, chunks, mix

#: Members of a tree that one task traverses; larger trees are split.
BLOCK = 512
#: Comparisons with one set that one task makes; more are dealt over several tasks.
STAR = 2048
#: Keys that a bucket holds, about.
BUCKET = 1 << 20
#: Keys that a task gathers before it sends them on.
SEND = 1 << 19
_U = np.uint64
_PAIR = "a long, b long"


class Shape:
    """What follows from the shingle length k and the threshold num/den."""

    def __init__(self, k: int, num: int, den: int):
        self.k, self.num, self.den = k, num, den
        # below this size only equal sets link
        self.least = 1
        while self.least * den < num * (self.least + 1):
            self.least += 1
        lows = [self.least]
        while lows[-1] < 1 << 40:
            lows.append(lows[-1] * den // num + 1)
        self.lows = np.array(lows)
        high = self.lows[1:] - 1
        partner = np.minimum(high[1:], high[:-1] * den // num)
        most = high[:-1] + np.maximum(high[:-1], partner)
        # |x ^ y| <= (|x| + |y|) (den - num) / (den + num) for linked sets
        differ = most * (den - num) // (den + num)
        self.spare = 2 + differ // 6
        self.parts = differ + 1 + self.spare

    def buckets(self, sets: dict[int, int]) -> np.ndarray:
        """Buckets of each group's keys, from the number of sets in each band."""
        n = np.array([sets.get(g, 0) + sets.get(g + 1, 0) for g in range(len(self.parts))])
        return 1 + n * self.parts // BUCKET

    def linked(self, common, a, b):
        return common * self.den >= self.num * (a + b - common)

    def need(self, total):
        """Smallest overlap with which sets of that total size link."""
        return -(-self.num * total // (self.num + self.den))

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles of each text, flat, and where each text's begin."""
        words = Words([x.lower() for x in texts])
        h, n = words.hashes(), words.counts
        at, doc = words.windows(self.k)
        x = np.zeros(len(at), np.uint64)
        for j in range(self.k):
            x = x * _U(0x9E3779B97F4A7C15) + h[at + j]
        x = mix(x)
        for d in np.flatnonzero((n > 0) & (n < self.k)):  # the whole sequence is one shingle
            y = np.full(1, n[d], np.uint64)
            for j in range(words.first[d], words.first[d + 1]):
                y = y * _U(0xC2B2AE3D27D4EB4F) + h[j]
            x, doc = np.append(x, mix(y)), np.append(doc, d)
        order = np.lexsort((x, doc))
        x, doc = x[order], doc[order]
        new = np.ones(len(x), bool)
        new[1:] = (x[1:] != x[:-1]) | (doc[1:] != doc[:-1])
        x, doc = x[new], doc[new]
        return x, np.searchsorted(doc, np.arange(len(texts) + 1))

    def ids(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The id of each set; of an empty one, 0."""
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(x + _U(77)), dtype=np.uint64)))
        n = np.diff(at).astype(np.uint64)
        return np.where(n > 0, mix(total[at[1:]] - total[at[:-1]] + n), 0).astype(np.int64)

    def bitmap(self, x: np.ndarray) -> bytes:
        bits = min(max(256, 1 << (4 * len(x) - 1).bit_length()), 1 << 17)
        on = np.zeros(bits, np.uint8)
        on[(x & _U(bits - 1)).astype(np.int64)] = 1
        return np.packbits(on, bitorder="little").tobytes()

    def keys(self, x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Keys of the parts of each set, the set and the group (pair of bands) of each key, and how many keys each set
        shares if it links."""
        n = np.diff(at)
        band = np.searchsorted(self.lows, n, side="right") - 1
        doc = np.repeat(np.arange(len(n)), n)
        value = mix(x ^ _U(0x2545F4914F6CDD1D))
        place = mix(x + _U(0x5851F42D4C957F2D)) >> _U(33)
        found, owners, groups, least = [], [], [], np.full(len(n), 255)
        for shift in (0, 1):
            group = band - shift
            parts = np.where(group >= 0, self.parts[np.maximum(group, 0)], 0)
            first = np.concatenate(([0], np.cumsum(parts)))
            use = group[doc] >= 0
            d = doc[use]
            slot = first[d] + (place[use] % parts[d].astype(np.uint64)).astype(np.int64)
            total = np.zeros(first[-1], np.uint64)
            np.add.at(total, slot, value[use])
            filled = np.zeros(first[-1], bool)
            filled[slot] = True
            owner = np.repeat(np.arange(len(n)), parts)
            number = np.arange(first[-1]) - first[owner]
            empties = np.bincount(owner, ~filled, len(n))
            spare = self.spare[np.maximum(group, 0)]
            many = empties > spare
            send = filled | many[owner]
            least = np.where(group >= 0, np.minimum(least, 1 + spare - np.minimum(empties, spare)), least)
            key = mix(total + (group[owner].astype(np.uint64) << _U(32)) * _U(0x9E3779B97F4A7C15) + mix(number.astype(np.uint64)))
            # bit 8 tells the set's two groups apart
            key = (key & ~_U(256)) | ((group[owner] & 1).astype(np.uint64) << _U(8))
            found.append(key[send])
            owners.append(owner[send])
            groups.append(group[owner[send]])
        return np.concatenate(found), np.concatenate(owners), np.concatenate(groups), least.astype(np.uint8)


def _planes(x: np.ndarray) -> bytes:
    """32-bit numbers as four planes of bytes, of which the higher ones compress well if the numbers are small."""
    return x.view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(4, n).T.copy().view(np.uint32).ravel()


def _sets(shape: Shape):
    """Each row's set, with its bitmap and its compressed text once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            texts = as_bytes(batch.column(1))
            for i, j in chunks(texts):
                x, at = shape.of(texts[i:j])
                ids = shape.ids(x, at)
                n = np.diff(at)
                first = [n[d] >= shape.least and not (ids[d] in seen or seen.add(int(ids[d]))) for d in range(j - i)]
                if len(seen) > 1 << 20:
                    seen.clear()
                maps = [pack(shape.bitmap(x[at[d] : at[d + 1]])) if first[d] else None for d in range(j - i)]
                packed = [pack(texts[i + d]) if first[d] else None for d in range(j - i)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array(n, pa.int64()), pa.array(ids, pa.int64()), pa.array(maps, pa.binary()), pa.array(packed, pa.binary())], ["id", "n_shingles", "set_id", "bitmap", "z"])

    return run


def _send(shape: Shape, buckets: np.ndarray):
    """Packed (key, set) pairs by bucket of the key. Each group has so many buckets of its own, so a set's keys meet in
    few buckets, to each of which its id goes once."""
    before = np.concatenate(([0], np.cumsum(buckets)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sets, needs, size = [], [], [], 0

        def flush():
            nonlocal keys, sets, needs, size
            k, s, least = np.concatenate(keys), np.concatenate(sets), np.concatenate(needs)
            order = np.argsort(k, kind="stable")
            k, s, least = k[order], s[order], least[order]
            found, starts = np.unique(k >> _U(32), return_index=True)
            rows = []
            for lo, hi in zip(starts, np.append(starts[1:], len(k)), strict=True):
                own, first, index = np.unique(s[lo:hi], return_index=True, return_inverse=True)
                steps = np.diff(k[lo:hi].astype(np.uint32), prepend=np.uint32(0))
                raw = own.tobytes() + least[lo:hi][first].tobytes() + _planes(steps) + _planes(index.astype(np.uint32))
                rows.append(np.array([len(own), hi - lo], np.int64).tobytes() + pack(raw))
            keys, sets, needs, size = [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(rows, pa.binary())], ["bucket", "packed"])

        seen: set[int] = set()
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            texts = as_bytes(batch.column(0))
            for i, j in chunks(texts):
                x, at = shape.of(texts[i:j])
                ids, n = shape.ids(x, at), np.diff(at)
                use = [d for d in range(j - i) if n[d] >= shape.least and not (ids[d] in seen or seen.add(int(ids[d])))]
                if len(seen) > 1 << 20:
                    seen.clear()
                if not use:
                    continue
                cut = np.concatenate([np.arange(at[d], at[d + 1]) for d in use])
                k, owner, group, least = shape.keys(x[cut], np.concatenate(([0], np.cumsum(n[use]))))
                bucket = before[group].astype(np.uint64) + (k >> _U(40)) % buckets[group].astype(np.uint64)
                keys.append((bucket << _U(32)) | ((k >> _U(8)) & _U(0xFFFFFFFF)))
                sets.append(ids[use][owner])
                needs.append(least[owner])
                size += len(k)
                if size >= SEND:
                    yield flush()
        if keys:
            yield flush()

    return run


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of two or more sets with an equal key, from one bucket; equal groups once, with their number."""
    keys, sets, needs = [], [], []
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for packed in batch.column("packed").to_pylist():
            n_own, n = np.frombuffer(packed, np.int64, 2)
            raw = unpack(packed[16:])
            own = np.frombuffer(raw, np.int64, n_own)
            least = np.frombuffer(raw, np.uint8, n_own, 8 * n_own)
            at = 9 * n_own
            keys.append(np.cumsum(_from_planes(raw[at : at + 4 * n], n), dtype=np.uint32))
            index = _from_planes(raw[at + 4 * n :], n)
            sets.append(own[index])
            needs.append(least[index])
    if not keys:
        return
    k, s, least = np.concatenate(keys), np.concatenate(sets), np.concatenate(needs)
    del keys, sets, needs
    order = np.argsort(k, kind="stable")
    k = k[order]
    more = np.zeros(len(k), bool)  # keys that occur twice at least
    more[1:] = k[1:] == k[:-1]
    more[:-1] |= more[1:]
    k, s, least = k[more], s[order[more]], least[order[more]]
    order = np.lexsort((s, k))
    k, s, least = k[order], s[order], least[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (s[1:] != s[:-1])
    k, s, least = k[new], s[new], least[new]
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.empty(0, np.int64)
    size = np.diff(np.append(first, len(k)))
    if not len(first):
        return
    name = np.add.reduceat(mix(s.view(np.uint64)), first) + size.astype(np.uint64)
    _, keep_one, same = np.unique(name, return_index=True, return_inverse=True)
    times = [np.bincount(same, (k[first] & 1) == g, len(keep_one)).astype(np.int64)[size[keep_one] > 1] for g in (0, 1)]
    keep_one = keep_one[size[keep_one] > 1]
    if not len(keep_one):
        return
    lens = size[keep_one]
    rows = np.repeat(first[keep_one], lens) + np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)
    out = pa.table({"tree": pa.array(np.repeat(name[keep_one].view(np.int64), lens)), "center": pa.array(np.repeat(s[first[keep_one]], lens)), "set_id": pa.array(s[rows]), "keys_0": pa.array(np.repeat(times[0], lens)), "keys_1": pa.array(np.repeat(times[1], lens)), "least": pa.array(least[rows].astype(np.int32))})
    yield from out.to_batches(1 << 16)


def _fold(raw: bytes, size: int) -> np.ndarray:
    return np.bitwise_or.reduce(np.frombuffer(raw, np.uint8).reshape(-1, size))


class _Node:
    """Level of a signature tree over members sorted by size: each node covers FAN of the level below."""

    FAN = 8

    def __init__(self, bits, low, high, excess, one, many):
        self.bits, self.low, self.high, self.excess, self.one, self.many = bits, low, high, excess, one, many

    def up(self) -> _Node:
        at = np.arange(0, len(self.low), self.FAN)
        one = self.one[at]
        alike = np.logical_and.reduceat(self.one == one[np.arange(len(self.one)) // self.FAN], at)
        return _Node(np.bitwise_or.reduceat(self.bits, at), np.minimum.reduceat(self.low, at), np.maximum.reduceat(self.high, at), np.maximum.reduceat(self.excess, at), one, np.logical_or.reduceat(self.many, at) | ~alike)


def traverse(shape: Shape, sizes: np.ndarray, bitmaps: list[bytes], comps: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of members (one marked left, the other right) of different components that may link, and the
    similarity that each has at most.

    Dual traversal of the signature tree: a pair of nodes goes on only if their largest possible overlap,
    min(largest sizes, common bits + excess tokens), reaches what their smallest sizes need."""
    order = np.argsort(sizes, kind="stable")
    width = min(map(len, bitmaps))
    bits = np.stack([_fold(bitmaps[i], width) for i in order]).view(np.uint64)
    n = sizes[order]
    excess = n - np.bitwise_count(bits).sum(1)
    level = _Node(bits, n, n, excess, comps[order], np.zeros(len(n), bool))
    levels = [level]
    while len(levels[-1].low) > 1:
        levels.append(levels[-1].up())
    p = q = np.zeros(1, np.int64)
    for depth in range(len(levels) - 1, -1, -1):
        t = levels[depth]
        common = np.empty(len(p), np.int64)
        step = max(64, (1 << 19) // t.bits.shape[1])
        for i in range(0, len(p), step):
            common[i : i + step] = np.bitwise_count(t.bits[p[i : i + step]] & t.bits[q[i : i + step]]).sum(1)
        most = np.minimum(np.minimum(t.high[p], t.high[q]), common + np.minimum(t.excess[p], t.excess[q]))
        go = (most >= shape.need(t.low[p] + t.low[q])) & (t.high[p] * shape.den >= t.low[q] * shape.num)
        go &= t.many[p] | t.many[q] | (t.one[p] != t.one[q])
        p, q, most = p[go], q[go], most[go]
        if depth:
            below = len(levels[depth - 1].low)
            p = (p[:, None] * _Node.FAN + np.arange(_Node.FAN)).ravel().repeat(_Node.FAN)
            q = (np.repeat(q, _Node.FAN).reshape(-1, _Node.FAN) * _Node.FAN + np.arange(_Node.FAN)).repeat(_Node.FAN, axis=0).ravel()
            inside = (p <= q) & (q < below)
            p, q = p[inside], q[inside]
    a, b = order[p], order[q]
    ok = (a != b) & ((left[a] & right[b]) | (left[b] & right[a]))
    a, b, most = a[ok], b[ok], most[ok]
    return a, b, most / (sizes[a] + sizes[b] - most)


def forest(p: np.ndarray, q: np.ndarray, score: np.ndarray) -> np.ndarray:
    """Which of the edges between p and q make a spanning forest of the highest scores."""
    order = np.lexsort((q, p, -score))
    p, q = p[order], q[order]
    _, best = np.unique(np.minimum(p, q) * np.int64(max(p.max(initial=0), q.max(initial=0)) + 1) + np.maximum(p, q), return_index=True)
    best.sort()
    root = list(range(int(max(p.max(initial=-1), q.max(initial=-1))) + 1))
    used = []
    for i, x, y in zip(best.tolist(), p[best].tolist(), q[best].tolist(), strict=True):
        while root[x] != x:
            root[x] = x = root[root[x]]
        while root[y] != y:
            root[y] = y = root[root[y]]
        if x != y:
            root[x] = y
            used.append(i)
    return order[used]


def _search(shape: Shape, spanning: bool):
    """Pairs (a, b), a < b, from rows sorted by tree and block; if spanning, only a forest of them over the components
    of each pair of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        unpack = zstandard.ZstdDecompressor().decompress

        def one(t: pa.Table):
            ids, sizes, comps = (t.column(c).to_numpy() for c in ("set_id", "n_shingles", "comp"))
            side = t.column("side").to_numpy()
            a, b, score = traverse(shape, sizes, [unpack(x) for x in t.column("bitmap").to_pylist()], comps, side != 2, side != 1)
            if spanning:
                _, group = np.unique(comps, return_inverse=True)
                some = forest(group[a], group[b], score)
                a, b = a[some], b[some]
            x, y = ids[a], ids[b]
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y), pa.int64()), pa.array(np.maximum(x, y), pa.int64())], ["a", "b"])

        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]) if held is not None else t
            tree, pair = (t.column(c).to_numpy() for c in ("tree", "pair"))
            cut = np.flatnonzero((tree[1:] != tree[:-1]) | (pair[1:] != pair[:-1])) + 1
            for lo, hi in zip(np.append(0, cut[:-1]), cut, strict=False) if len(cut) else ():
                yield one(t.slice(lo, hi - lo))
            held = t.slice(cut[-1]) if len(cut) else t
        if held is not None and held.num_rows:
            yield one(held)

    return run


def _compare(shape: Shape):
    """Rows sorted by (a, salt), that of a itself (b is null) first: the linked pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, own_id = None, None
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            raw = [unpack(z) for z in batch.column("z").to_pylist()]
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            linked = []
            for i, j in chunks(raw):
                x, at = shape.of(raw[i:j])
                for d in range(j - i):
                    mine = x[at[d] : at[d + 1]]
                    if b[i + d] is None:
                        own, own_id = mine, a[i + d]
                    elif own_id == a[i + d]:
                        common = len(np.intersect1d(own, mine, assume_unique=True))
                        if shape.linked(common, len(own), len(mine)):
                            linked.append((a[i + d], b[i + d]))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in linked], pa.int64()) for k in (0, 1)], ["a", "b"])

    return run


def _verified(shape: Shape, texts: DataFrame, pairs: DataFrame, path: str) -> DataFrame:
    """The pairs (a, b) of set ids that link, compared by their shingles. A set with very many partners is
    dealt over several tasks."""
    counts = pairs.groupBy("a").agg(F.count("*").alias("n")).select("a", F.ceil(F.col("n") / STAR).cast("int").alias("salts"))
    own = texts.join(counts, texts.set_id == counts.a).select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("long").alias("b"), "z")
    others = pairs.join(counts, "a").join(texts, pairs.b == texts.set_id).select("a", F.pmod(F.xxhash64("b"), "salts").cast("int").alias("salt"), "b", "z")
    rows = own.unionByName(others).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return keep(rows.mapInArrow(_compare(shape), _PAIR), "linked", path)


def _candidates(shape: Shape, trees: DataFrame, comps: DataFrame, facts: DataFrame, spanning: bool) -> DataFrame:
    """Pairs to compare, from the trees whose members are not yet one component.

    Members of a tree's large components (a block or more) are dealt into blocks of that component, the others into
    common blocks. Two blocks of one large component hold nothing to compare."""
    member = trees.join(comps.select(F.col("node").alias("set_id"), F.col("component").alias("comp")), "set_id", "left").withColumn("comp", F.coalesce("comp", "set_id"))
    mixed = member.groupBy("tree").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("members")).where("lo < hi")
    large = member.join(mixed.where(F.col("members") > BLOCK).select("tree"), "tree").groupBy("tree", "comp").agg(F.count("*").alias("members")).where(F.col("members") >= BLOCK)
    blocks = F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks")
    large = large.groupBy("tree").agg(F.collect_list(F.struct(F.col("comp").alias("part"), blocks)).alias("parts"), F.sum("members").alias("inside"))
    rest = F.col("members") - F.coalesce("inside", F.lit(0))
    common = F.when(rest > 0, F.array(F.struct(F.lit(None).cast("long").alias("part"), F.ceil(rest / BLOCK).cast("int").alias("blocks"))))
    mixed = mixed.join(large, "tree", "left").select("tree", F.concat(F.coalesce("parts", F.array()), F.coalesce(common, F.array())).alias("parts"))
    member = member.join(mixed, "tree")
    mine = F.coalesce(F.get(F.filter("parts", lambda p: p.part == F.col("comp")), F.lit(0)), F.get(F.filter("parts", lambda p: p.part.isNull()), F.lit(0)))
    member = member.withColumn("mine", mine).withColumn("here", F.struct("mine.part", F.pmod(F.xxhash64("set_id", "tree"), "mine.blocks").cast("int").alias("own")))
    # a member meets all blocks but those of its own large component
    meets = F.filter("parts", lambda p: p.part.isNull() | F.col("mine.part").isNull() | (p.part != F.col("mine.part")))
    there = F.flatten(F.transform(meets, lambda p: F.transform(F.sequence(F.lit(0), p.blocks - 1), lambda k: F.struct(p.part.alias("part"), k.alias("own")))))
    member = member.withColumn("there", F.explode(there))
    i, j = F.least("here", "there"), F.greatest("here", "there")
    side = F.when(F.col("here") == F.col("there"), 0).when(F.col("here") == i, 1).otherwise(2)
    member = member.select("tree", F.xxhash64(i, j).alias("pair"), "set_id", "comp", side.alias("side")).join(facts, "set_id")
    found = by_key_blocks(member, "tree", "pair").mapInArrow(_search(shape, spanning), _PAIR)
    return found.distinct()


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """Components of documents whose sets of word shingles have a Jaccard similarity of num/den or more.

    Texts are lower-cased (A-Z), words are runs of characters other than white space (\\x20, \\x09-\\x0D), a
    set holds the distinct shingles of ``shingle`` words; a shorter text is one shingle. Null or blank texts
    have an empty set and link with nothing. Returns one row per input row: the id, ``n_shingles``,
    ``set_id`` (equal for equal sets, null for empty ones) and ``component_id``, the smallest id of all rows
    it is linked with, directly or not, itself included. Rows with a null id take part; they only get a null
    ``component_id`` if all of their component have. Repeated rows are linked copies, very long texts are
    taken whole. Further columns of docs are ignored, an empty table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shape = Shape(shingle, num, den)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    paths = {x: new_path(spark, x) for x in ("sets", "trees", "trees_live", "members", "facts", "star", "linked")}
    sets = keep(rows.mapInArrow(_sets(shape), "id long, n_shingles long, set_id long, bitmap binary, z binary"), "sets", paths["sets"])

    # linked sets share a tree; the number of sets in each size band, of which there are few, gives the buckets
    band = F.size(F.filter(F.array(*[F.lit(int(x)) for x in shape.lows]), lambda x: x <= F.col("n_shingles"))) - 1
    buckets = shape.buckets({r["band"]: r["count"] for r in sets.where("z is not null").groupBy(band.alias("band")).count().collect()})
    sent = rows.select("text").mapInArrow(_send(shape, buckets), "bucket long, packed binary")
    trees = sent.groupBy("bucket").applyInArrow(_trees, "tree long, center long, set_id long, keys_0 long, keys_1 long, least int")
    sums = [F.sum("keys_0").alias("keys_0"), F.sum("keys_1").alias("keys_1"), F.max("least").alias("least")]
    trees = keep(trees.groupBy("tree", "center", "set_id").agg(*sums), "trees", paths["trees"])
    # sets that share enough parts, and the trees in which two of them are left
    live = trees.groupBy("set_id").agg(*sums).where("keys_0 >= least or keys_1 >= least").select("set_id")
    trees = trees.select("tree", "set_id").join(live, "set_id")
    whole = trees.groupBy("tree").agg(F.min("set_id").alias("center"), F.count("*").alias("members")).where("members > 1")
    trees = keep(trees.join(whole.select("tree", "center"), "tree"), "trees", paths["trees_live"])
    release(spark, paths.pop("trees"))
    members = keep(trees.select("set_id").distinct(), "members", paths["members"])
    known = sets.where("z is not null").join(members, "set_id").groupBy("set_id")
    facts = keep(known.agg(F.first("n_shingles").alias("n_shingles"), F.max(F.struct("z", "bitmap")).alias("best")).select("set_id", "n_shingles", "best.bitmap", "best.z"), "facts", paths["facts"])
    # of each row only the name of its set is needed from here on
    sets = keep(sets.select("id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("set_id")).alias("set_id")), "sets")
    release(spark, paths.pop("sets"), paths.pop("members"))
    texts, facts = facts.select("set_id", "z"), facts.select("set_id", "n_shingles", "bitmap")

    # a few pairs that settle most copies: one for each set by id, then one by likeness
    star = trees.where("set_id != center").groupBy("set_id").agg(F.min("center").alias("a")).select("a", F.col("set_id").alias("b"))
    tested = keep(star, "star", paths["star"])
    links = _verified(shape, texts, tested, paths["linked"])
    comps = keep(components(links), "comps")
    trees = trees.select("tree", "set_id")
    # the last round compares all pairs that are left, of sets in different components; those before it only spare
    # it work, for which some of the trees are enough
    for spanning in (1, 2, 0):
        some = trees.where(F.pmod(F.xxhash64("tree"), F.lit(8)) == spanning) if spanning else trees
        for x in ("found", "linked"):
            paths[f"{x}_{spanning}"] = new_path(spark, x)
        found = keep(_candidates(shape, some, comps, facts, spanning > 0).join(tested, ["a", "b"], "left_anti"), "found", paths[f"found_{spanning}"])
        release(spark)
        if not found.limit(1).count():
            continue
        tested = tested.union(found)
        links = links.union(_verified(shape, texts, found, paths[f"linked_{spanning}"]))
        comps = keep(components(links), "comps")
    del trees, some, found, tested, links, texts, facts
    release(spark, *paths.values())

    least = sets.where("set_id is not null").groupBy("set_id").agg(F.min("id").alias("least"))
    named = least.join(comps, least.set_id == comps.node, "left").withColumn("component", F.coalesce("component", "set_id"))
    best = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_set = named.select("set_id", "component").join(best, "component").select("set_id", "component_id")
    out = sets.join(of_set, "set_id", "left").withColumn("component_id", F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", "set_id", "component_id")
