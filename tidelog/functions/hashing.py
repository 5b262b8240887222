"""The partition of a key on a broker: xxHash32, which Spark has no expression for, in arithmetic of columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTITIONS = 64
# Fixed values of xxHash32.
_P1, _P2, _P3, _P4, _P5 = 2654435761, 2246822519, 3266489917, 668265263, 374761393
_MASK = 0xFFFFFFFF


def _once(x: Column, step) -> Column:
    """step(x) with x worked out once, as the variable of a fold over one element."""
    return F.aggregate(F.array(x), F.lit(0).cast("long"), lambda _, v: step(v))


def _times(x: Column, prime: int) -> Column:
    """x * prime modulo 2**32, of which no part product reaches 2**63."""
    low, high = prime & 0xFFFF, prime >> 16
    return _once(x, lambda v: (v * low + F.shiftleft((v * high).bitwiseAND(0xFFFF), 16)).bitwiseAND(_MASK))


def _turn(x: Column, bits: int) -> Column:
    return _once(x, lambda v: F.shiftleft(v, bits).bitwiseAND(_MASK).bitwiseOR(F.shiftright(v, 32 - bits)))


def _add(*xs) -> Column:
    total = xs[0]
    for x in xs[1:]:
        total = total + x
    return total.bitwiseAND(_MASK)


def _word(text: Column, at: Column) -> Column:
    """Four bytes at a place (from 0), the first one lowest, of bytes as hexadecimal text."""
    pair = lambda k: F.substring(text, (at + k) * 2 + 1, F.lit(2))
    return F.conv(F.concat(pair(3), pair(2), pair(1), pair(0)), 16, 10).cast("long")


def _hash(text: Column) -> Column:
    """xxHash32 of bytes as hexadecimal text."""
    n = F.length(text) / 2
    stripes, words = F.floor(n / 16).cast("int"), F.floor(n % 16 / 4).cast("int")

    def places(start: Column, count: Column, step: int) -> Column:
        return F.when(count > 0, F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda k: start + k * step)).otherwise(F.array().cast("array<int>"))

    def stripe(acc: Column, at: Column) -> Column:
        return F.array(*[_times(_turn(_add(acc[k], _times(_word(text, at + 4 * k), _P2)), 13), _P1) for k in range(4)])

    begin = F.array(*[F.lit(x & _MASK).cast("long") for x in (_P1 + _P2, _P2, 0, -_P1)])
    joined = lambda acc: _add(_turn(acc[0], 1), _turn(acc[1], 7), _turn(acc[2], 12), _turn(acc[3], 18))
    head = F.aggregate(places(F.lit(0), stripes, 16), begin, stripe, joined)
    h = _add(F.when(stripes > 0, head).otherwise(F.lit(_P5).cast("long")), n.cast("long"))
    h = F.aggregate(places(stripes * 16, words, 4), h, lambda acc, at: _times(_turn(_add(acc, _times(_word(text, at), _P3)), 17), _P4))
    byte = lambda at: F.conv(F.substring(text, at * 2 + 1, F.lit(2)), 16, 10).cast("long")
    h = F.aggregate(places(stripes * 16 + words * 4, (n % 4).cast("int"), 1), h, lambda acc, at: _times(_turn(_add(acc, _times(byte(at), _P5)), 11), _P1))
    h = _once(h, lambda v: _times(v.bitwiseXOR(F.shiftright(v, 15)), _P2))
    h = _once(h, lambda v: _times(v.bitwiseXOR(F.shiftright(v, 13)), _P3))
    return _once(h, lambda v: v.bitwiseXOR(F.shiftright(v, 16)))


def xxhash32(key: Column | str) -> Column:
    """xxHash32 (seed 0) of the UTF-8 of a key, as an unsigned number in a long; null stays null. It stays in the JVM: the
    steps of 16, 4 and 1 bytes are folds over the places that they begin at."""
    key = F.col(key) if isinstance(key, str) else key
    return F.when(key.isNotNull(), _once(F.hex(F.encode(key, "UTF-8")), _hash))


def broker_partition(key: Column | str, partitions: int = PARTITIONS) -> Column:
    return F.pmod(xxhash32(key), F.lit(partitions))
