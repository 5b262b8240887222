"""Token counts from a cache of digests: a text that was counted before, in any run, is not encoded again.

The cache is a table of content digest and count, in a folder for each tokenizer version. A version is the digest of the
tokenizer's file, of the library and of how it is called, so a new one finds no counts of an old one. Contents are normalised by
what cannot change a count: null is empty and, for vocabularies in which white space only separates pieces, a run of
ASCII white space is one space and none is left at the ends.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.shared import columns, drop, keep, new_path, small_batches, unused
from tidelog.llm.tokenfile import ENCODED, LibraryEncoder
from tidelog.llm.words import size_chunks

#: Digests of missing contents (32 bytes each) that are sent to all tasks at most; more are joined by a shuffle.
BROADCAST_MISSES = 100_000


class WordCounter:
    """Counts by the tokenizers library, each distinct word once (see LibraryEncoder)."""

    blanks = True

    def __init__(self, path: str):
        self.encoder = LibraryEncoder(path)

    def counts(self, texts: pa.StringArray) -> np.ndarray:
        return np.diff(self.encoder.encode(texts)[1])


class TextCounter:
    """Counts of whole texts by the tokenizers library."""

    blanks = False

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.json = f.read()

    def __getstate__(self):
        return {"json": self.json}

    def counts(self, texts: pa.StringArray) -> np.ndarray:
        if not hasattr(self, "tokenizer"):
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_str(self.json)
            self.tokenizer.no_truncation()
            self.tokenizer.no_padding()
        found = self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)
        return np.fromiter((len(e.ids) for e in found), np.int64, len(texts))


class PieceCounter:
    """Counts of whole texts by the sentencepiece library."""

    blanks = False

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.model = f.read()

    def __getstate__(self):
        return {"model": self.model}

    def counts(self, texts: pa.StringArray) -> np.ndarray:
        if not hasattr(self, "processor"):
            from sentencepiece import SentencePieceProcessor

            self.processor = SentencePieceProcessor(model_proto=self.model)
        found = self.processor.encode(texts.to_pylist(), num_threads=1)
        return np.fromiter(map(len, found), np.int64, len(texts))


def counter(path: str):
    """What counts the tokens of a tokenizer's file: .json by tokenizers, .model by sentencepiece."""
    if path.endswith(".model"):
        return PieceCounter(path)
    try:
        return WordCounter(path)
    except ValueError:  # words have no ids of their own in this vocabulary
        return TextCounter(path)


def version(path: str) -> str:
    """Digest of a tokenizer's file, its library and how that is called."""
    name = "sentencepiece" if path.endswith(".model") else "tokenizers"
    told = f"{name} {__import__(name).__version__}, no special tokens added, no truncation\n"
    with open(path, "rb") as f:
        return hashlib.sha256(told.encode() + f.read()).hexdigest()


class CountCache:
    """Counts by content digest, in a folder that all executors share. Rows are only added; a digest that two runs have added
    at the same time is there twice, with the same count, and read once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, version: str) -> str:
        return f"{self.folder}/tokenizer={version}"

    def has(self, version: str) -> bool:
        """Whether a count was ever stored for this version."""
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._path(version))
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where)

    def read(self, version: str) -> DataFrame:
        """digest (32 bytes) and n_tokens of all contents counted by this version."""
        if not self.has(version):
            return self.spark.createDataFrame([], "digest binary, n_tokens long")
        rows = self.spark.read.schema("digest binary, n_tokens long").parquet(self._path(version))
        return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    def add(self, rows: DataFrame, version: str) -> None:
        rows.write.mode("append").parquet(self._path(version))


def content(text: Column, blanks: bool) -> Column:
    """The normalised content of a text; ``blanks`` if white space only separates pieces."""
    text = F.coalesce(text, F.lit(""))
    return F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")) if blanks else text


def token_counts(docs: DataFrame, path: str, cache: CountCache, text_col: str = "text", limit: int = 2048) -> DataFrame:
    """Every row of docs without its text, with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than limit).

    Special tokens are not added; their strings inside a text are what the library takes them for. A null text is empty, very
    long texts are counted whole, repeated rows and copies are encoded once, an empty table gives an empty one. Other columns,
    whatever their names, stay; those with the names of new ones are replaced.

    Digests are worked out without moving a text. Those that the cache lacks select the texts to encode: up to
    BROADCAST_MISSES of them are sent to all tasks, so that only missing texts are shuffled; more are joined. Copies within a
    task are dropped before the shuffle, so a text that a third of all rows have arrives once from each task.
    """
    spark = docs.sparkSession
    small_batches(spark)
    tokens, of = counter(path), version(path)
    blanks, text = tokens.blanks, F.col(f"`{text_col}`")
    others = docs.drop(text_col, "n_bytes", "n_tokens", "over_limit")
    (key,) = unused(others, "digest")
    digest = F.unhex(F.sha2(content(text, blanks), 256))
    kept = new_path(spark, "digests")
    keyed = keep(docs.select(*columns(others), digest.alias(key), F.octet_length(F.coalesce(text, F.lit(""))).cast("long").alias("n_bytes")), "digests", kept)
    wanted, cold = keyed.select(F.col(key).alias("digest")).distinct(), not cache.has(of)
    gone = new_path(spark, "misses")
    misses = keep(wanted if cold else wanted.join(cache.read(of), "digest", "left_anti"), "misses", gone)
    n = misses.count()
    if n:
        texts = docs.select(digest.alias("digest"), content(text, blanks).alias("content"))
        if n <= BROADCAST_MISSES:
            texts = texts.join(F.broadcast(misses), "digest", "left_semi")
        texts = texts.groupBy("digest").agg(F.first("content").alias("content"))
        if n > BROADCAST_MISSES and not cold:
            texts = texts.join(misses, "digest", "left_semi")
        shared = spark.sparkContext.broadcast(tokens)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                column = batch.column(1)
                for i, j in size_chunks(pc.binary_length(column).to_pylist(), ENCODED):
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(shared.value.counts(column.slice(i, j - i)), pa.int64())], ["digest", "n_tokens"])

        cache.add(texts.mapInArrow(run, "digest binary, n_tokens long"), of)
    drop(gone, spark)
    (right, count) = unused(keyed, "right", "n_tokens")
    # a table of its own, so that the join can split a digest that very many rows have
    counts = keep(wanted.join(cache.read(of), "digest").select(F.col("digest").alias(right), F.col("n_tokens").alias(count)), "counts")
    out = keyed.join(counts, F.col(key) == F.col(right), "left")
    return out.select(*columns(others), "n_bytes", F.col(count).alias("n_tokens"), (F.col(count) > limit).alias("over_limit"))
