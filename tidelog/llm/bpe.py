"""Byte-pair encoding of whole texts with a published vocabulary, and decoding.

Texts are split into pieces by the vocabulary's own rules; each different piece of a chunk is encoded once, all of
them together: their symbols lie in one flat array, and in each round every piece has its lowest-rank pair merged
wherever it occurs, ranks and products being found by binary search over sorted pair keys. A few very long pieces
(over HEAP symbols) would make many rounds, so they are merged with a priority queue instead.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField

from tidelog.llm.shared import map_rows, small_batches
from tidelog.llm.words import chunks

HEAP = 512
#: Characters that are encoded together: the more, the fewer pieces are met again.
ENCODED = 2 << 20
NONE = np.int64(1) << 40
#: Characters that Unicode gives the property White_Space.
SPACES = r"\t-\r \x85\xa0  -     　"
#: Up to here all versions of Unicode agree on letters, numbers and lower case.
PLAIN = 0x52F
#: Letters and numbers that Unicode 16.0 has beyond those of Python's tables (15.1).
NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEW_NUMBERS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]
#: Lower case that newer versions of Unicode add.
NEW_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
NEW_LOWER |= {0x10D50 + k: 0x10D70 + k for k in range(22)} | {0x16EA0 + k: 0x16EBB + k for k in range(25)}

#: Marks that newer versions of Unicode reorder and the library's normaliser leaves in place.
UNORDERED = [
    (0x7FD, 0x7FD), (0x898, 0x89F), (0x8CA, 0x8D3), (0x9FE, 0x9FE), (0xC3C, 0xC3C), (0xD3B, 0xD3C), (0xEBA, 0xEBA), (0x1715, 0x1715), (0x1ABF, 0x1ACE),
    (0x1DF6, 0x1DFA), (0xA82C, 0xA82C), (0x10D24, 0x10D27), (0x10EAB, 0x10EAC), (0x10EFD, 0x10EFF), (0x10F46, 0x10F50), (0x10F82, 0x10F85), (0x11070, 0x11070),
    (0x1133B, 0x1133B), (0x1145E, 0x1145E), (0x11839, 0x1183A), (0x1193D, 0x1193E), (0x11943, 0x11943), (0x119E0, 0x119E0), (0x11A34, 0x11A34), (0x11A47, 0x11A47),
    (0x11A99, 0x11A99), (0x11D42, 0x11D42), (0x11D44, 0x11D45), (0x11D97, 0x11D97), (0x11F41, 0x11F42), (0x16FF0, 0x16FF1), (0x1E08F, 0x1E08F), (0x1E130, 0x1E136),
    (0x1E2AE, 0x1E2AE), (0x1E2EC, 0x1E2EF), (0x1E4EC, 0x1E4EF),
]
_MARKS = re.compile("([" + "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in UNORDERED) + "])")


def unicode_class(kind: str, more: list[tuple[int, int]]) -> str:
    """The inside of a character class: characters whose category begins with kind, and more."""
    here = [c for c in range(0x110000) if unicodedata.category(chr(c))[0] == kind] + [c for a, b in more for c in range(a, b + 1)]
    out: list[list[int]] = []
    for c in sorted(here):
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in out)


def byte_characters() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte: itself where it prints, else the
    next unused one from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Vocabulary:
    """A byte-level BPE vocabulary with word ends, from a JSON file of the tokenizers library.

    Supported: NFC and lower-casing, a pattern whose matches are the pieces, a suffix on each piece's last symbol,
    special tokens that are matched in the raw text, and no decoder (tokens are joined by spaces). Other settings
    raise ValueError.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, steps = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        norm = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split, level = steps
        if norm != ["NFC", "Replace", "Lowercase"] or spec["decoder"] or spec["post_processor"] or split["behavior"] != "Removed" or not split["invert"] or level["add_prefix_space"] or model["unk_token"] or model["byte_fallback"] or model["ignore_merges"]:
            raise ValueError(f"{path}: not a vocabulary of the kind that this encoder reads")
        self.pattern = split["pattern"]["Regex"].replace(r"[^\s", f"[^{SPACES}")
        # of texts beyond PLAIN, with the classes spelt out
        letters, numbers = unicode_class("L", NEW_LETTERS), unicode_class("N", NEW_NUMBERS)
        self.exact = self.pattern.replace(r"\p{L}", letters).replace(r"\p{N}", numbers)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = model["vocab"]
        self.tokens: list[bytes] = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for t, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = t.encode()
        end = model["end_of_word_suffix"] or ""
        chars = byte_characters()
        self.single = np.array([vocab[c] for c in chars], np.int64)
        self.final = np.array([vocab[c + end] for c in chars], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self._pairs = None
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each pair (NONE if it does not merge) and its place in the table."""
        key = (left << np.int64(32)) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE), at

    def _between_bytes(self, sym: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """find() for each symbol and the next of its piece, while symbols are single bytes."""
        if self._pairs is None:
            codes = np.concatenate((self.single, self.final))
            self._code = np.zeros(codes.max() + 1, np.int64)
            self._code[codes] = np.arange(512)
            self._pairs = self.find(*(x.ravel() for x in np.meshgrid(codes, codes, indexing="ij")))
        code = self._code[sym]
        pair = code[:-1] * 512 + code[1:]
        rank, at = self._pairs[0][pair], self._pairs[1][pair]
        rank[piece[1:] != piece[:-1]] = NONE
        end = len(sym) > 0
        return np.append(rank, [NONE] * end), np.append(at, [0] * end)

    def merge(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces given as flat bytes: piece i is data[starts[i]:starts[i + 1]], not empty.
        Returns the ids, flat, and where each piece's begin."""
        n = np.diff(starts)
        sym = self.single[data]
        sym[starts[1:] - 1] = self.final[data[starts[1:] - 1]]
        piece = np.repeat(np.arange(len(n)), n)
        done_sym, done_piece = [], []
        if len(n) and n.max() > HEAP:
            for w in np.flatnonzero(n > HEAP):
                ids = self._merge_one(sym[starts[w] : starts[w + 1]].tolist())
                done_sym.append(np.array(ids, np.int64))
                done_piece.append(np.full(len(ids), w))
            small = n[piece] <= HEAP
            sym, piece = sym[small], piece[small]
        rank, at = self._between_bytes(sym, piece)
        while len(sym):
            first = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
            size = np.diff(np.append(first, len(piece)))
            lowest = np.minimum.reduceat(rank, first)
            least = np.repeat(lowest, size)
            over = least == NONE
            if over.any():
                done_sym.append(sym[over])
                done_piece.append(piece[over])
            hit = (rank == least) & ~over
            # of equal pairs that overlap (a a a), every second one from the left
            run = hit.copy()
            run[1:] &= hit[:-1]
            run[:1] = False
            if run.any():
                place = np.arange(len(hit))
                begin = np.maximum.accumulate(np.where(hit & ~run, place, 0))
                hit &= (place - begin) % 2 == 0
            where = np.flatnonzero(hit)
            sym[where] = self.made[at[where]]
            stay = ~over
            stay[where + 1] = False
            moved = np.cumsum(stay)[where] - 1
            sym, piece, rank, at = sym[stay], piece[stay], rank[stay], at[stay]
            # only pairs with a new symbol have a new rank
            changed = np.zeros(len(sym), bool)
            changed[moved] = True
            changed[moved[moved > 0] - 1] = True
            fresh = np.flatnonzero(changed)
            after = np.minimum(fresh + 1, len(sym) - 1)
            new, where = self.find(sym[fresh], sym[after])
            new[(piece[after] != piece[fresh]) | (after == fresh)] = NONE
            rank[fresh], at[fresh] = new, where
        if not done_sym:
            return np.empty(0, np.int64), np.zeros(len(n) + 1, np.int64)
        sym, piece = np.concatenate(done_sym), np.concatenate(done_piece)
        order = np.argsort(piece, kind="stable")
        return sym[order], np.concatenate(([0], np.cumsum(np.bincount(piece, minlength=len(n)))))

    def _merge_one(self, sym: list[int]) -> list[int]:
        """The same for one long piece: pairs wait in a queue by rank, then place."""
        n = len(sym)
        left, right, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
        queue: list[tuple[int, int, int, int, int]] = []

        def offer(places: list[int]) -> None:
            places = [i for i in places if i >= 0 and right[i] < n]
            rank, at = self.find(np.array([sym[i] for i in places], np.int64), np.array([sym[right[i]] for i in places], np.int64))
            for i, r, k in zip(places, rank.tolist(), at.tolist(), strict=True):
                if r < NONE:
                    heapq.heappush(queue, (r, i, sym[i], sym[right[i]], int(self.made[k])))

        offer(list(range(n - 1)))
        while queue:
            _, i, a, b, made = heapq.heappop(queue)
            j = right[i]
            if not alive[i] or j >= n or sym[i] != a or sym[j] != b:
                continue
            sym[i], alive[j], right[i] = made, False, right[j]
            if right[j] < n:
                left[right[j]] = i
            offer([left[i], i])
        return [s for s, a in zip(sym, alive, strict=True) if a]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, flat, and where each text's begin."""
        import regex

        quick, exact, beyond = regex.compile(self.pattern), regex.compile(self.exact), regex.compile(f"[^\\x00-\\u{PLAIN:04x}]")

        def cut(text: str) -> list[str]:
            text = self.normal(text)
            return (exact if beyond.search(text) else quick).findall(text)

        special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        pieces: list[str] = []
        ends, marks = [0], []
        for text in texts:
            at = 0
            for m in special.finditer(text) if special and "<" in text else ():
                pieces += cut(text[at : m.start()])
                marks.append((len(pieces), self.special[m[0]]))
                pieces.append(" ")
                at = m.end()
            pieces += cut(text[at:] if at else text)
            ends.append(len(pieces))
        if not pieces:
            return np.empty(0, np.int64), np.zeros(len(ends), np.int64)
        coded = pa.array(pieces, pa.string()).dictionary_encode()
        del pieces
        index, words = coded.indices.to_numpy(), coded.dictionary
        starts = np.frombuffer(words.buffers()[1], np.int32)[: len(words) + 1].astype(np.int64)
        data = np.frombuffer(words.buffers()[2], np.uint8)[: starts[-1]]
        ids, first = self.merge(data, starts)
        n = np.diff(first)[index]
        for k, _ in marks:
            n[k] = 1
        place = np.concatenate(([0], np.cumsum(n)))
        out = ids[np.minimum(np.repeat(first[index] - place[:-1], n) + np.arange(place[-1]), max(len(ids) - 1, 0))]
        for k, i in marks:
            out[place[k]] = i
        return out, place[np.array(ends)]

    @staticmethod
    def normal(text: str) -> str:
        """NFC, then lower case character by character (no special case of a final sigma)."""
        if text.isascii():
            return text.lower()
        if max(text) <= chr(PLAIN):
            text = unicodedata.normalize("NFC", text)
        else:
            text = "".join(unicodedata.normalize("NFC", x) for x in _MARKS.split(text)).translate(NEW_LOWER)
        return text.replace("\u03a3", "\u03c3").lower()

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids, in UTF-8: their tokens joined by spaces."""
        return b" ".join(map(self.tokens.__getitem__, ids.tolist()))


def encode_texts(docs: DataFrame, path: str, text_col: str = "text", decode: bool = True) -> DataFrame:
    """Every row of docs with the ids of its text.

    Adds ``n_tokens``, ``ids`` (unsigned 32-bit little-endian integers as binary) and, if asked for, ``decoded``,
    the text that the ids stand for; columns of docs with these names are replaced. A null or empty text has no
    ids and decodes to an empty text; repeated rows are encoded alike; very long texts are encoded whole; an empty table gives
    an empty one; other columns stay. ``path`` is a vocabulary file on the driver; it is broadcast (a few MB, whatever the table). One pass without a shuffle; chunks bound the memory of a task.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("n_tokens", "ids", "decoded")
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))
    text = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            texts = [x or "" for x in batch.column(text).to_pylist()]
            for i, j in chunks(texts, ENCODED):
                ids, at = vocabulary.encode(texts[i:j])
                small = ids.astype("<u4")
                new = [pa.array(np.diff(at), pa.int64()), pa.array([small[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())]
                names = ["n_tokens", "ids"]
                if decode:
                    new.append(pa.array([vocabulary.decode(ids[a:b]).decode() for a, b in zip(at[:-1], at[1:], strict=True)], pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in batch.columns), *new], [*batch.schema.names, *names])

    fields = [StructField("n_tokens", LongType()), StructField("ids", BinaryType())] + [StructField("decoded", StringType())] * decode
    return map_rows(docs, run, fields)


def decode_ids(rows: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """Every row with ``decoded``, the text of its ids (as encode_texts makes them).

    Null and no ids are an empty text; repeated rows are decoded alike, very long ones whole; an empty table gives an empty one. A column
    ``decoded`` is replaced, others stay.
    """
    rows = rows.drop("decoded")
    shared = rows.sparkSession.sparkContext.broadcast(Vocabulary(path))
    at = rows.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [shared.value.decode(np.frombuffer(x or b"", "<u4")).decode() for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(text, pa.string())], [*batch.schema.names, "decoded"])

    return map_rows(rows, run, [StructField("decoded", StringType())])


def digests(rows: DataFrame) -> list:
    """Digest columns of encoded rows."""
    return [F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")]
