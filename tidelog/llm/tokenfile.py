"""Token ids in Arrow IPC files of equal-length sequences, read back without copying.

A shard holds a range of documents, in ascending order of their ids, as one stream of token ids cut into rows of SEQUENCE
ids. ``tokens-NNNNN.arrow`` is an Arrow IPC file (random access by record batch) with two fixed-size-list columns:
``ids`` (the smallest unsigned type that holds the vocabulary) and ``mask`` (booleans, a bit each): true for ids, false
for the padding of the last row.
All record batches but the last have ROWS rows, so row k is found without a scan, and a memory-mapped file gives its
ids as a view. ``index-NNNNN.arrow`` has the documents: id, start in the shard, number of ids. Files are not
compressed, so that they can be mapped.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.shared import keep, new_path, small_batches
from tidelog.llm.words import size_chunks

SEQUENCE = 2048
#: Bytes of text that are encoded together: the more, the fewer words are met again.
ENCODED = 4 << 20
#: Words that are given to the library together.
ENCODED_WORDS = 1 << 13
#: Words whose ids a worker remembers at most (some 100 MB).
REMEMBERED = 600_000
ROWS = 256
#: Texts whose ids show whether white space, and marks after letters, separate pieces in a vocabulary.
PROBES = [
    "Two words", "a. b, c; d: e! f? g|", "A.B,c!?;:|", "end...", "end.' end.) end.\"", "don't. DON'T! we'll?", "x1. 1.5, 3:", "é. ß! Ωα? 日本. ı.", "a\tb\nc\x0bd\x0ce\rf",
    " lead  and trail ", "<|x.|> <y.", "#a.# $b,$ a|b| |", "A", ".", "?!", "word.word word,word", "e\u0301. a\u00a0b. a\u3000b",
]


def _schema(kind: pa.DataType, length: int) -> pa.Schema:
    return pa.schema([pa.field("ids", pa.list_(pa.field("item", kind, False), length), False), pa.field("mask", pa.list_(pa.field("item", pa.bool_(), False), length), False)])


_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def _halves(words: pa.StringArray) -> tuple[pa.StringArray, pa.StringArray]:
    """Words as two parts that have the word's ids together: without the marks that follow its last letter, and these. The
    vocabulary separates letters from marks and lower-cases; words with what begins a special token stay whole."""
    stems = pc.ascii_rtrim(words, characters=".,;:!?|")
    cut = pc.and_(pc.match_substring_regex(stems, "[A-Za-z]$"), pc.invert(pc.match_substring(words, "<|")))
    stems = pc.if_else(cut, stems, words)
    stems = pc.if_else(pc.and_(cut, pc.string_is_ascii(stems)), pc.ascii_lower(stems), stems)
    longer = np.flatnonzero(np.not_equal(pc.binary_length(words).to_numpy(), pc.binary_length(stems).to_numpy()))
    tails = np.full(len(words), "", object)
    tails[longer] = [w[len(s) :] for w, s in zip(words.take(longer).to_pylist(), stems.take(longer).to_pylist(), strict=True)]
    return stems, pa.array(tails, pa.string())


class LibraryEncoder:
    """Ids of texts by the tokenizers library, one thread per task.

    White space separates pieces in the vocabularies used here, so a text's ids are those of its words (split at ASCII
    white space). Each word is encoded once per chunk of texts, and up to REMEMBERED words are remembered by a worker.
    The vocabulary travels as JSON; one whose ids of whole texts (PROBES) are not those of their parts is refused.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.json = f.read()
        library = self._load()
        self.size = max(library.get_vocab(with_added_tokens=True).values()) + 1
        ids, at = LibraryEncoder.encode(self, pa.array(PROBES))
        if any(library.encode(t, add_special_tokens=False).ids != ids[at[k] : at[k + 1]].tolist() for k, t in enumerate(PROBES)):
            raise ValueError(f"{path}: words do not have ids of their own in this vocabulary")
        del self.tokenizer, self.known

    def _load(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(self.json)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    def __getstate__(self):
        return {"json": self.json, "size": self.size}

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, flat, and where each text's begin."""
        if not hasattr(self, "tokenizer"):
            self.tokenizer, self.known = self._load(), {}
        words = pc.ascii_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        halves = [x.dictionary_encode() for x in _halves(coded.dictionary)]
        if len(self.known) > REMEMBERED:
            self.known = {}
        known, parts = self.known, []
        for half in halves:
            each = half.dictionary.to_pylist()
            new = [w for w in each if w not in known]
            for k in range(0, len(new), ENCODED_WORDS):  # what the library returns takes a KB or two for each
                some = new[k : k + ENCODED_WORDS]
                for w, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                    known[w] = array("I", e.ids).tobytes()
            parts += [known[w] for w in each]
        size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        first = np.cumsum(size) - size
        ids = np.frombuffer(b"".join(parts), np.uint32)
        # each word is its stem, then its tail
        index = coded.indices.to_numpy()
        pair = np.empty((len(index), 2), np.int64)
        pair[:, 0] = halves[0].indices.to_numpy()[index]
        pair[:, 1] = halves[1].indices.to_numpy()[index] + len(halves[0].dictionary)
        pair = pair.ravel()
        n = size[pair]
        place = np.concatenate(([0], np.cumsum(n)))
        out = ids[np.repeat(first[pair] - place[:-1], n) + np.arange(place[-1])]
        return out, place[2 * words.offsets.to_numpy()]


def arrow_uri(folder: str) -> str:
    """A folder as Spark names it, as Arrow names it: s3a and s3n are s3, dbfs is a mounted path."""
    for spark, arrow in (("s3a://", "s3://"), ("s3n://", "s3://"), ("dbfs:/", "file:///dbfs/")):
        if folder.startswith(spark):
            return arrow + folder[len(spark) :].lstrip("/" if arrow.startswith("file") else "")
    if folder.startswith("file:/") and not folder.startswith("file://"):
        return "file://" + folder[len("file:") :]
    return folder if "://" in folder else f"file://{folder}"


class ShardWriter:
    """Writes one shard as ids come; holds ROWS sequences at most. The files get their names when they are whole,
    so a task that is repeated replaces them by the same."""

    def __init__(self, folder: str, number: int, kind: pa.DataType, length: int = SEQUENCE):
        self.fs, self.folder = pa.fs.FileSystem.from_uri(arrow_uri(folder))
        self.fs.create_dir(self.folder, recursive=True)
        self.number, self.kind, self.length, self.tag = number, kind, length, uuid.uuid4().hex[:8]
        self.tokens = pa.ipc.new_file(self._sink("tokens"), _schema(kind, length))
        self.index = pa.ipc.new_file(self._sink("index"), _INDEX)
        self.held: list[np.ndarray] = []
        self.n_held = self.total = self.docs = 0

    def name(self, what: str) -> str:
        return f"{what}-{self.number:05d}.arrow"

    def _sink(self, what: str):
        sink = self.fs.open_output_stream(f"{self.folder}/.{self.name(what)}.{self.tag}")
        setattr(self, f"_{what}", sink)
        return sink

    def add(self, doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        """Append documents: all their ids, flat, and how many each has."""
        starts = self.total + np.cumsum(counts) - counts
        self.index.write_batch(pa.record_batch([doc_ids, pa.array(starts, pa.int64()), pa.array(counts, pa.int64())], schema=_INDEX))
        self.total += len(ids)
        self.docs += len(doc_ids)
        self.held.append(ids.astype(self.kind.to_pandas_dtype()))
        self.n_held += len(ids)
        if self.n_held >= ROWS * self.length:
            flat = np.concatenate(self.held)
            whole = len(flat) // (ROWS * self.length) * ROWS * self.length
            for at in range(0, whole, ROWS * self.length):
                self._write(flat[at : at + ROWS * self.length])
            self.held, self.n_held = [flat[whole:]], len(flat) - whole

    def _write(self, flat: np.ndarray) -> None:
        rows = -(-len(flat) // self.length)
        ids = np.zeros(rows * self.length, flat.dtype)
        ids[: len(flat)] = flat
        mask = np.arange(len(ids)) < len(flat)
        schema = _schema(self.kind, self.length)
        self.tokens.write_batch(pa.record_batch([pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type) for x, f in zip((ids, mask), schema, strict=True)], schema=schema))

    def close(self) -> None:
        if self.n_held:
            self._write(np.concatenate(self.held))
        for what in ("tokens", "index"):
            getattr(self, what).close()
            getattr(self, f"_{what}").close()
            self.fs.move(f"{self.folder}/.{self.name(what)}.{self.tag}", f"{self.folder}/{self.name(what)}")


class ShardReader:
    """Random access to a shard. On a local or mounted file system it is mapped, and rows are views."""

    def __init__(self, folder: str, number: int):
        fs, path = pa.fs.FileSystem.from_uri(arrow_uri(folder))

        def opened(name: str):
            whole = f"{path}/{name}-{number:05d}.arrow"
            return pa.ipc.open_file(pa.memory_map(whole) if isinstance(fs, pa.fs.LocalFileSystem) else fs.open_input_file(whole))

        self.file, self.documents = opened("tokens"), opened("index")
        self.length = self.file.schema.field("ids").type.list_size
        self._last: tuple[int, np.ndarray] | None = None

    def batch(self, k: int) -> np.ndarray:
        """The ids of record batch k, rows by length, without a copy. The last one asked for is remembered."""
        if self._last is None or self._last[0] != k:
            self._last = k, self.file.get_batch(k).column("ids").flatten().to_numpy(zero_copy_only=True).reshape(-1, self.length)
        return self._last[1]

    def sequence(self, k: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of row k, both views of the file."""
        mask = self.file.get_batch(k // ROWS).column("mask").flatten()
        return self.batch(k // ROWS)[k % ROWS], mask.slice(k % ROWS * self.length, self.length)

    def span(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The n ids from ``start`` on, in parts that lie in one record batch each."""
        size = ROWS * self.length
        while n > 0:
            flat = self.batch(start // size).ravel()
            part = flat[start % size : start % size + n]
            yield part
            start, n = start + len(part), n - len(part)


def write_tokens(docs: DataFrame, path: str, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, length: int = SEQUENCE) -> DataFrame:
    """Encode all texts and write them, each with ``end_id`` after it, in ascending order of their ids.

    Returns the manifest: shard, docs, tokens and ``base``, the ids in all shards before it. Rows with a null id come
    first, rows with equal ids follow each other by the hash of their text, then by text, and a null or empty text is just ``end_id``. An
    empty table makes no shard. Documents are dealt out in ranges of their id and that hash, so different texts of one id may lie in
    several; ranges are sorted, and written while they are read. Very long texts are encoded whole. Further columns are
    ignored. Only one row per shard is summed up in one task.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(LibraryEncoder(path))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    by = [F.col("id").asc_nulls_first(), F.xxhash64("text").asc()]
    rows = rows.repartitionByRange(*by).sortWithinPartitions(*by, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, writer = shared.value, None
        number = TaskContext.get().partitionId()
        for batch in batches:
            texts, doc_ids = batch.column(1).fill_null(""), batch.column(0)
            for i, j in size_chunks(pc.binary_length(texts).to_pylist(), ENCODED):
                if writer is None:
                    kind = pa.uint16() if max(vocabulary.size - 1, end_id) < 1 << 16 else pa.uint32()
                    writer = ShardWriter(folder, number, kind, length)
                ids, at = vocabulary.encode(texts.slice(i, j - i))
                ids = np.insert(ids, at[1:], end_id)
                writer.add(doc_ids.slice(i, j - i), ids, np.diff(at) + 1)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (number, writer.docs, writer.total)], ["shard", "docs", "tokens"])

    manifest = keep(rows.mapInArrow(run, "shard long, docs long, tokens long"), "manifest")
    upto = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    return keep(manifest.withColumn("base", F.sum("tokens").over(upto) - F.col("tokens")), "manifest")


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """Every document in the files of a manifest: doc_id, start (ids of all documents before it), n_tokens and
    ids_crc32, the CRC-32 of its ids as unsigned 32-bit little-endian integers. One task per shard reads it; documents longer
    than a record batch are read in parts; an empty manifest gives no rows, and its further columns are ignored."""
    shards = max(manifest.count(), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = ShardReader(folder, number)
                for k in range(shard.documents.num_record_batches):
                    index = shard.documents.get_batch(k)
                    sums = []
                    for start, n in zip(index.column("start").to_pylist(), index.column("n_tokens").to_pylist(), strict=True):
                        crc = 0
                        for part in shard.span(start, n):
                            crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                        sums.append(crc)
                    starts = pa.array(index.column("start").to_numpy(zero_copy_only=False) + base, pa.int64())
                    yield pa.RecordBatch.from_arrays([index.column("doc_id"), starts, index.column("n_tokens"), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return manifest.select("shard", "base").repartitionByRange(shards, "shard").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def new_folder(spark) -> str:
    """A folder for shards under the one that all executors share."""
    return new_path(spark, "tokens")
