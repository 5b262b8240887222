"""MessagePack bodies as JSON text. The wire format has one leading byte for each value that tells its kind and, for small
values, its size; others have their size in the bytes that follow."""

from __future__ import annotations

import base64
import json
import struct
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the format: leading byte, what follows it.
_NUMBERS = {0xCA: ">f", 0xCB: ">d", 0xCC: ">B", 0xCD: ">H", 0xCE: ">I", 0xCF: ">Q", 0xD0: ">b", 0xD1: ">h", 0xD2: ">i", 0xD3: ">q"}
_SIZED = {0xC4: ("bin", ">B"), 0xC5: ("bin", ">H"), 0xC6: ("bin", ">I"), 0xC7: ("ext", ">B"), 0xC8: ("ext", ">H"), 0xC9: ("ext", ">I"),
          0xD9: ("str", ">B"), 0xDA: ("str", ">H"), 0xDB: ("str", ">I"), 0xDC: ("array", ">H"), 0xDD: ("array", ">I"), 0xDE: ("map", ">H"), 0xDF: ("map", ">I")}
_CONSTANTS = {0xC0: None, 0xC2: False, 0xC3: True}
_TIME, _DEPTH = -1, 200


class _Reader:
    """Values of one message, one after the other; ValueError where the bytes are none."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def take(self, n: int) -> bytes:
        part = self.data[self.at : self.at + n]
        if len(part) < n:
            raise ValueError("the message is torn")
        self.at += n
        return part

    def number(self, form: str):
        return struct.unpack(form, self.take(struct.calcsize(form)))[0]

    def value(self, depth: int = 0):
        if depth > _DEPTH:
            raise ValueError("nested too deeply")
        first = self.take(1)[0]
        if first < 0x80 or first >= 0xE0:
            return first if first < 0x80 else first - 0x100
        if first in _CONSTANTS:
            return _CONSTANTS[first]
        if first in _NUMBERS:
            return self.number(_NUMBERS[first])
        if first < 0xC0:
            kind, size = ("map", first & 15) if first < 0x90 else ("array", first & 15) if first < 0xA0 else ("str", first & 31)
        elif 0xD4 <= first <= 0xD8:
            kind, size = "ext", 1 << (first - 0xD4)
        elif first in _SIZED:
            kind, size = _SIZED[first][0], self.number(_SIZED[first][1])
        else:
            raise ValueError("no value has this byte")
        if kind == "str":
            return self.take(size).decode()
        if kind == "bin":
            return base64.b64encode(self.take(size)).decode()
        if kind == "array":
            return [self.value(depth + 1) for _ in range(size)]
        if kind == "map":
            return {self.key(depth + 1): self.value(depth + 1) for _ in range(size)}
        return self.extension(self.number(">b"), size)

    def key(self, depth: int) -> str:
        k = self.value(depth)
        return k if isinstance(k, str) else json.dumps(k)

    def extension(self, kind: int, size: int):
        """A time as ISO text; other extensions as their bytes in base 64."""
        data = self.take(size)
        if kind != _TIME or size not in (4, 8, 12):
            return base64.b64encode(data).decode()
        if size == 12:
            nanos, seconds = struct.unpack(">Iq", data)
        else:
            whole = int.from_bytes(data, "big")
            nanos, seconds = (whole >> 34, whole & (1 << 34) - 1) if size == 8 else (0, whole)
        return (datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=seconds, microseconds=nanos // 1000)).isoformat()


def to_json(data: bytes) -> str:
    """The JSON text of a message that is one value; binary is base 64, as in JSON bodies."""
    r = _Reader(bytes(data))
    value = r.value()
    if r.at < len(r.data):
        raise ValueError("something follows the value")
    return json.dumps(value, ensure_ascii=False, allow_nan=False)


@F.pandas_udf(T.StringType())
def msgpack_text(values: pd.Series) -> pd.Series:
    """JSON text of MessagePack bodies; null for null and for what is none."""

    def one(x: bytes | None) -> str | None:
        try:
            return None if x is None else to_json(x)
        except (ValueError, OverflowError):
            return None

    return values.map(one)
