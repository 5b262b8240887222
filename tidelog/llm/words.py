"""Words of many texts at once, as flat numpy arrays.

A word is a maximal run of bytes other than space and \\x09-\\x0D, which are also the separators of
``bytes.split``. Texts are worked on in chunks of a few MB, so memory does not follow the table;
a single text longer than a chunk makes a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

CHUNK_BYTES = 1 << 21
_U = np.uint64
_RNG = np.random.default_rng(20240611)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_STEP = int(_RNG.integers(1, 1 << 62)) * 4 + 3
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first n powers of a fixed odd multiplier, modulo 2**64."""
    global _powers
    if len(_powers) < n:
        _powers = np.full(max(n, 2 * len(_powers)), _STEP, np.uint64)
        _powers[0] = 1
        _powers = np.cumprod(_powers)
    return _powers[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the splitmix64 finaliser)."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class Words:
    """Words of several texts: byte ``starts`` and ``ends`` in ``data``, and ``first``, the index of
    each text's first word with the number of all words at its end."""

    def __init__(self, texts: list[bytes]):
        self.data = b"\n".join(texts) + b"\n"
        self.bytes = np.frombuffer(self.data, np.uint8)
        self.space = _SPACE[self.bytes]
        edge = np.empty(len(self.space), bool)
        edge[0] = not self.space[0]
        np.greater(self.space[:-1], self.space[1:], out=edge[1:])
        self.starts = np.flatnonzero(edge)
        np.less(self.space[:-1], self.space[1:], out=edge[1:])
        edge[0] = False
        self.ends = np.flatnonzero(edge)
        at = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(x) + 1 for x in texts], out=at[1:])
        self.at = at
        self.first = np.searchsorted(self.starts, at)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def docs(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self.starts):
            return np.empty(0, np.uint64)
        s0 = self.starts[0]
        sizes = np.diff(np.append(self.starts, len(self.bytes)))
        rel = np.arange(s0, len(self.bytes))
        rel -= np.repeat(self.starts, sizes)
        longest = int((self.ends - self.starts).max())
        np.minimum(rel, longest, out=rel)
        x = _BYTE[self.bytes[s0:]]
        x *= powers(longest + 1)[rel]
        x[self.space[s0:]] = 0
        return mix(np.add.reduceat(x, self.starts - s0))

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The first word and the text of every run of ``width`` words within one text."""
        n = np.maximum(self.counts - (width - 1), 0)
        docs = np.repeat(np.arange(len(n)), n)
        skipped = self.first[:-1] - np.concatenate(([0], np.cumsum(n)[:-1])) if len(n) else n
        return np.arange(len(docs)) + skipped[docs], docs


def size_chunks(sizes: Iterable[int], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of items of about ``limit`` in all, one item at least."""
    at, total, i = 0, 0, -1
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield at, i
            at, total = i, 0
        total += n + 1
    if at <= i:
        yield at, i + 1


def chunks(texts: list, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes or characters, one text at least."""
    return size_chunks(map(len, texts), limit)


def as_bytes(column) -> list[bytes]:
    """The UTF-8 of an Arrow string column; null is empty."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
