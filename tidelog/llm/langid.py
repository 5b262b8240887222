"""Language identification with bit-sliced Bloom filters over character n-grams.

Training counts all n-grams of the labelled texts by language. An n-gram belongs to each language in which it is at
least SHARE times as frequent as in the language where it is most frequent. The filter is an array of bit masks, one bit
per language: an n-gram sets its languages' bits in HASHES slots, and the AND of its slots returns all languages that
contain it at once.
A text's score for a language is the share of its n-grams that the filter assigns to it, corrected for the share
that a filter so full assigns by chance. The filter has as many slots as its n-grams need. One that is larger than tasks should
hold lies in shards by the n-gram's hash: each is sent to all tasks in turn, and a text's hits in all of them are added up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from tidelog.llm.shared import keep, map_rows, small_batches, unused
from tidelog.llm.words import chunks, mix

SIZES = (2, 3, 4)
#: Slots of the filter for each n-gram of the largest language, and at least (powers of two).
SLOTS_A_GRAM = 16
LEAST_SLOTS = 1 << 16
#: Bytes of a filter, or of one shard of a larger one, that tasks get at a time.
SHARD_BYTES = 64 << 20
#: Distinct labels beyond which a column is not one of languages.
MOST_LABELS = 1 << 16
HASHES = 3
SHARE = 0.5
#: Distinct n-grams that a training task holds before it sends their counts on.
HELD = 1 << 18
_U = np.uint64
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """For each code point: whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.array([chr(c).isalpha() for c in range(0x110000)])
    return _letters


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams of the texts' lower-cased words (each with a space before and after it; other
    characters than letters are spaces), the text of each, and how many letters each text has."""
    low = [f" {t.lower()} " for t in texts]
    # the separator keeps n-grams from running over two texts
    data = np.frombuffer(("\n".join(low) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    newline = data == 10
    is_letter = letters()[data]
    sizes = np.array([len(t) + 1 for t in low])
    text = np.repeat(np.arange(len(texts)), sizes)
    count = np.bincount(text, is_letter, len(texts)).astype(np.int64)
    x = np.where(is_letter, data, 32).astype(np.uint64)
    stay = is_letter.copy()  # runs of spaces become one
    stay[1:] |= is_letter[:-1]
    stay[:1] |= True
    starts = np.append(True, text[1:] != text[:-1])
    stay |= starts | newline
    x, text = x[stay], text[stay]
    found, owners = [], []
    for n in SIZES:
        if len(x) < n:
            continue
        h = np.full(len(x) - n + 1, n, np.uint64)
        for k in range(n):
            h = h * _U(0x100000001B3) + x[k : len(x) - n + 1 + k]
        # inner characters are letters; not all are spaces
        ok = text[n - 1 :] == text[: len(text) - n + 1]
        for k in range(1, n - 1):
            ok &= x[k : len(x) - n + 1 + k] != 32
        if n == 2:
            ok &= (x[:-1] != 32) | (x[1:] != 32)
        found.append(mix(h[ok]))
        owners.append(text[: len(text) - n + 1][ok])
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64), count
    return np.concatenate(found), np.concatenate(owners), count


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by (lang, n-gram) of each task, a bounded number at a time."""
    for batch in batches:
        texts, langs = [x or "" for x in batch.column(0).to_pylist()], batch.column(1).to_pylist()
        order = sorted(range(len(texts)), key=lambda k: langs[k])
        at = 0
        while at < len(order):
            lang, end = langs[order[at]], at
            while end < len(order) and langs[order[end]] == lang:
                end += 1
            own = [texts[k] for k in order[at:end]]
            held: list[tuple[np.ndarray, np.ndarray]] = []
            for i, j in chunks(own, 1 << 20):
                held.append(np.unique(ngrams(own[i:j])[0], return_counts=True))
            names = np.concatenate([a for a, _ in held])
            names, of = np.unique(names, return_inverse=True)
            counts = np.bincount(of, np.concatenate([b for _, b in held]), len(names)).astype(np.int64) if len(names) else np.empty(0, np.int64)
            for k in range(0, len(names), HELD):
                part = names[k : k + HELD].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), pa.array(part), pa.array(counts[k : k + HELD])], ["lang", "gram", "n"])
            at = end


def shard_of(grams: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each n-gram; ``shards`` is a power of two."""
    return (mix(grams ^ _U(0x9E3779B97F4A7C15)) & _U(shards - 1)).astype(np.int64)


def slots_of(grams: np.ndarray, k: int, slots: int) -> np.ndarray:
    """The slot in its shard of each n-gram by the k-th hash; ``slots`` is a power of two."""
    return ((grams + _U(k) * ((grams >> _U(32)) | _U(1))) & _U(slots - 1)).astype(np.int64)


def _set(langs: list[str], slots: int, shards: int = 1):
    """(lang, gram) rows as the bits that they set: shard, slot, word of the mask, and mask, OR-ed within a batch."""
    place = {x: i for i, x in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = batch.column(0).dictionary_encode()
            lang = np.array([place[x] for x in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy()]
            grams = batch.column(1).to_numpy().view(np.uint64)
            words = max(len(langs) - 1, 0) // 64 + 1
            first = np.tile(shard_of(grams, shards) * slots, HASHES) if shards > 1 else 0
            at = (first + np.concatenate([slots_of(grams, k, slots) for k in range(HASHES)])) * words + np.tile(lang // 64, HASHES)
            bits = np.tile(_U(1) << (lang % 64).astype(np.uint64), HASHES)
            order = np.argsort(at, kind="stable")
            found, first = np.unique(at[order], return_index=True)
            masks = np.bitwise_or.reduceat(bits[order], first) if len(found) else bits
            slot = found // words
            yield pa.RecordBatch.from_arrays([pa.array(slot // slots), pa.array(slot % slots), pa.array(found % words), pa.array(masks.view(np.int64))], ["shard", "slot", "word", "mask"])

    return run


class Filter:
    """The trained filter: masks[slot, word] holds bits of the languages, 64 to a word; of a filter in shards, the rows of ``bits``
    (shard, slot, word, mask) do."""

    def __init__(self, langs: list[str], slots: int, bits: DataFrame | None, shards: int = 1):
        self.langs, self.slots, self.shards, self.bits = langs, slots, shards, bits
        self.words = max(len(langs) - 1, 0) // 64 + 1
        self.masks = self.load(0) if shards == 1 else None
        if shards == 1:
            self.bits = None
            full = [np.count_nonzero((self.masks[:, i // 64] >> _U(i % 64)) & _U(1)) for i in range(len(langs))]
        else:
            # a language's bits are counted where they are; its numbers reach the driver
            ones = bits.select("word", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: F.call_function("getbit", F.col("mask"), k).cast("int"))).alias("bit", "one"))
            full = [0] * (64 * self.words)
            for r in ones.groupBy("word", "bit").agg(F.sum("one").alias("n")).collect():
                full[64 * r["word"] + r["bit"]] = r["n"]
            full = full[: len(langs)]
        self.chance = (np.array(full, np.float64) / (slots * shards)) ** HASHES

    def __getstate__(self):
        return {**self.__dict__, "bits": None}

    def load(self, shard: int) -> np.ndarray:
        """The masks of a shard, of SHARD_BYTES at most."""
        masks = np.zeros((self.slots, self.words), np.uint64)
        if self.bits is not None:
            found = self.bits.where(F.col("shard") == shard).select("slot", "word", "mask").toPandas()
            masks[found["slot"].to_numpy(np.int64), found["word"].to_numpy(np.int64)] = found["mask"].to_numpy(np.int64).view(np.uint64)
        return masks

    def languages(self, grams: np.ndarray, masks: np.ndarray) -> np.ndarray:
        """The mask of all languages that contain each n-gram."""
        mask = masks[slots_of(grams, 0, len(masks))]
        for k in range(1, HASHES):
            mask &= masks[slots_of(grams, k, len(masks))]
        return mask

    def hits(self, texts: list[str], masks: np.ndarray, shard: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text, its n-grams of a shard that belong to each language; all its n-grams; its letters."""
        grams, text, count = ngrams(texts)
        n = np.bincount(text, minlength=len(texts))
        if self.shards > 1:
            mine = shard_of(grams, self.shards) == shard
            grams, text = grams[mine], text[mine]
        mask = self.languages(grams, masks)
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        for i in range(len(self.langs)):
            out[:, i] = np.bincount(text[((mask[:, i // 64] >> _U(i % 64)) & _U(1)).astype(bool)], minlength=len(texts))
        return out, n, count

    def scores(self, hits: np.ndarray, n: np.ndarray) -> np.ndarray:
        """A score for each text and language."""
        return np.clip((hits / np.maximum(n, 1)[:, None] - self.chance) / np.maximum(1 - self.chance, 1e-12), 0, 1)

    def best(self, hits: np.ndarray, n: np.ndarray, letters: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The language of each text, and its score."""
        if not self.langs:
            return ["und"] * len(n), np.zeros(len(n))
        scores = self.scores(hits, n)
        best = scores.argmax(1)
        return [self.langs[b] if c else "und" for b, c in zip(best, letters, strict=True)], np.where(letters > 0, scores[np.arange(len(n)), best], 0.0)


def train(docs: DataFrame, text_col: str, lang_col: str, shard_bytes: int = SHARD_BYTES) -> Filter:
    """A filter from all labelled texts (null text or language: not used).

    N-grams are counted over all of them, per task first, then by a Spark aggregation; all that belong to a language set its
    bits, whichever counts are equal or small. The filter has SLOTS_A_GRAM slots for each n-gram of the largest language, however many
    these are, in shards of ``shard_bytes``. Bits are OR-ed by a Spark aggregation; a filter of one shard comes to the driver,
    one of several stays a table. Languages are the distinct labels, of which there may be MOST_LABELS; an empty table gives a
    filter without any. Repeated rows count as often as they occur, very long texts are counted whole.
    """
    rows = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    small_batches(docs.sparkSession)
    counts = keep(rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    rates = counts.join(F.broadcast(totals) if totals.limit(10_001).count() <= 10_000 else totals, "lang").withColumn("rate", F.col("n") / F.col("total"))
    belongs = rates.withColumn("top", F.max("rate").over(Window.partitionBy("gram"))).where(F.col("rate") >= SHARE * F.col("top"))
    belongs = keep(belongs.select("lang", "gram"), "belongs")
    sizes = {r["lang"]: r["count"] for r in belongs.groupBy("lang").count().limit(MOST_LABELS + 1).collect()}
    if len(sizes) > MOST_LABELS:
        raise ValueError(f"{lang_col} has more than {MOST_LABELS} labels: it is no column of languages")
    langs = sorted(sizes)
    slots = max(LEAST_SLOTS, 1 << (SLOTS_A_GRAM * max(sizes.values(), default=1) - 1).bit_length())
    shards = 1
    while slots > 64 and 8 * slots * (max(len(langs) - 1, 0) // 64 + 1) > shard_bytes:
        slots, shards = slots // 2, shards * 2
    bits = belongs.mapInArrow(_set(langs, slots, shards), "shard long, slot long, word long, mask long").groupBy("shard", "slot", "word").agg(F.bit_or("mask").alias("mask"))
    return Filter(langs, slots, bits if shards == 1 else keep(bits, "bits"), shards)


def predict(docs: DataFrame, model: Filter, text_col: str = "text") -> DataFrame:
    """Every row of docs with ``lang_pred`` and ``score`` (0 to 1); columns of docs with these names are replaced.

    Whole texts are scored, in chunks. A null text or one without a letter is ``und`` with score 0; so is every
    text if the model knows no language. Ties go to the language that is first by code point. Repeated rows are
    scored alike, an empty table stays empty. Tasks get SHARD_BYTES of the filter at a time. With a filter of several shards
    the texts are read once for each of them, from a table of their own.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("lang_pred", "score")
    if model.shards > 1:
        return _predict_in_turns(docs, model, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = [x or "" for x in batch.column(text).to_pylist()]
            for i, j in chunks(texts, 1 << 20):
                pred, score = m.best(*m.hits(texts[i:j], m.masks))
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in batch.columns), pa.array(pred, pa.string()), pa.array(score, pa.float64())], [*batch.schema.names, "lang_pred", "score"])

    return map_rows(docs, run, [StructField("lang_pred", StringType()), StructField("score", DoubleType())])


def _predict_in_turns(docs: DataFrame, model: Filter, text_col: str) -> DataFrame:
    """predict with one shard of the filter after the other."""
    spark = docs.sparkSession
    row, of = unused(docs, "row", "of")
    kept = keep(docs.withColumn(row, F.monotonically_increasing_id()), "texts")
    texts = kept.select(F.col(row).alias("row"), F.col(f"`{text_col}`").alias("text"))
    parts = None
    for shard in range(model.shards):
        masks = spark.sparkContext.broadcast(model.load(shard))

        def run(batches: Iterator[pa.RecordBatch], masks=masks, shard=shard) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = [x or "" for x in batch.column(1).to_pylist()]
                for i, j in chunks(own, 1 << 20):
                    hits, n, letters = light.hits(own[i:j], masks.value, shard)
                    rows = np.concatenate([hits, n[:, None], letters[:, None]], axis=1)
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(list(rows), pa.list_(pa.int64()))], ["row", "hits"])

        light = Filter.__new__(Filter)
        light.__dict__.update(model.__getstate__())
        part = keep(texts.mapInArrow(run, "row long, hits array<bigint>"), "hits")
        masks.destroy()
        parts = part if parts is None else parts.union(part)
    width = len(model.langs)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # each text's hits in all shards; its n-grams and letters are the same in each
            sums = np.array([np.sum(x, axis=0) for x in batch.column(1).to_pylist()], np.int64).reshape(batch.num_rows, width + 2)
            pred, score = light.best(sums[:, :width], sums[:, width] // light.shards, sums[:, width + 1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["row", "lang_pred", "score"])

    found = parts.groupBy("row").agg(F.collect_list("hits").alias("hits")).mapInArrow(decide, "row long, lang_pred string, score double")
    found = found.select(F.col("row").alias(of), F.col("lang_pred"), "score")
    return kept.join(found, F.col(row) == F.col(of)).drop(row, of)
