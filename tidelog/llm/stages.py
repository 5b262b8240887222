"""Stages of the corpus pipeline: what the operators decide, done to the documents.

A stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of docs; the last one returns token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.bpe import digests, encode_texts
from tidelog.llm.jaccard import jaccard_join
from tidelog.llm.mixing import WORD, mix, shuffle_key
from tidelog.llm.quality import quality_rules
from tidelog.llm.registry import table
from tidelog.llm.shared import columns, keep, release, unused
from tidelog.llm.substring import remove_repeats


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, with cutoffs from the labels of sf_dir.

    Null and short texts fail the base rules and go; repeated rows are judged alike; very long texts are measured whole; an empty
    table stays empty; other columns, whatever their names, stay as they are.
    """
    mine = [c for c in docs.columns if c not in ("doc_id", "lang", "text")]
    (row,) = unused(docs.select("doc_id", "lang", "text"), "row")
    rest = F.struct(*[F.col(c) for c, name in zip(columns(docs), docs.columns, strict=True) if name in mine]).alias(row)
    kept = quality_rules(docs.select("doc_id", "lang", "text", rest), table(spark, sf_dir, "labels")).where("kept")
    return kept.select("doc_id", "lang", "text", f"{row}.*").select(*columns(docs))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (0.8 of their five-word shingles), the document with the smallest id.

    Rows that share that id are told apart by their text, of which one stays. Rows without an id stay: no other stage
    could name them. So do null and blank texts, which are near nothing. Very long texts are compared whole; an empty table stays
    empty. Other columns, whatever their names, stay.
    """
    release(spark)
    found = jaccard_join(docs.select("doc_id", "text"), shingle=5, num=80, den=100).where("doc_id = component_id")
    (n,) = unused(docs, "rows")
    joined = docs.where("doc_id is not null").join(found.groupBy("doc_id").agg(F.count("*").alias(n)), "doc_id")
    once = joined.where(F.col(n) == 1).drop(n)
    more = joined.where(F.col(n) > 1).dropDuplicates(["doc_id", "text"]).drop(n)
    return once.unionByName(more).unionByName(docs.where("doc_id is null")).select(*columns(docs))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated 35-word windows; those left without a word go. Texts that lose nothing
    stay as they are, null and blank ones too. Repeated rows lose all that is long enough. Very long texts are cut like
    others; an empty table stays empty. Other columns, whatever their names, stay."""
    release(spark)
    own = dict(zip(("n_words", "n_removed", "kept_text"), unused(docs, "words", "removed", "kept"), strict=True))
    (row,) = unused(docs.select("text"), "row")
    others = F.struct(*[F.col(c) for c in columns(docs) if c != "`text`"]).alias(row)
    out = remove_repeats(docs.select(others, "text"), width=35).where("n_removed = 0 or n_removed < n_words")
    out = out.select(*[F.col(c).alias(a) for c, a in own.items()], "text", f"{row}.*")
    cut = F.col(own["n_removed"]) > 0
    out = out.withColumn("text", F.when(cut, F.col(own["kept_text"])).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*columns(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: words taken by size, rounded. A document cut by the end of its source's
    share is whole or absent, one without words (null, blank) is absent. Very long documents are like others; an empty table stays empty.

    Rows alike in id, source and size share a key. Mostly all rows of a key are taken equally often; where a source's share
    ends among them, some are taken once more, which are those that come first in the parts that docs is read in. Other columns,
    whatever their names, stay.
    """
    release(spark)
    _, taken = mix(docs.select("doc_id", "source", "text"))
    key, part, nth, base, n, copy, low, high, more = unused(docs, *(f"mix_{x}" for x in ("key", "part", "nth", "base", "n", "copy", "low", "high", "more")))
    times = F.floor(F.try_divide("taken", "size") + 0.5).cast("int")
    counts = taken.where("size > 0").select(F.col("key").alias(key), times.alias(n))
    # along a source's stream the number changes by one at most once, so a key has two neighbouring numbers at most
    counts = counts.groupBy(key).agg(F.min(n).alias(low), F.max(n).alias(high), F.sum(n).alias(n), F.count("*").alias(more))
    counts = counts.where(F.col(high) > 0).select(key, low, high, (F.col(n) - F.col(low) * F.col(more)).alias(more))
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.withColumn(key, shuffle_key(F.col("doc_id"), F.col("source"), size)).withColumn(part, F.spark_partition_id())
    # the few keys at which a share ends have a table of their own, which Spark broadcasts if its files are small
    split = keep(counts.where(F.col(low) < F.col(high)), "split")
    plain = rows.join(counts.where(F.col(low) == F.col(high)), key).withColumn(n, F.col(low))
    cut = rows.join(split, key)
    before = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    parts = cut.groupBy(key, part).agg(F.count("*").alias(base)).withColumn(base, F.coalesce(F.sum(base).over(before), F.lit(0)))
    cut = cut.withColumn(nth, F.row_number().over(Window.partitionBy(key, part).orderBy("text"))).join(parts, [key, part])
    cut = cut.withColumn(n, F.when(F.col(nth) + F.col(base) <= F.col(more), F.col(high)).otherwise(F.col(low))).drop(nth, base)
    rows = plain.unionByName(cut).where(F.col(n) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n))))
    return rows.select(*columns(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document (32-bit little-endian), with their number, their digest and that of the text that they decode to.
    A null or empty text has none; repeated rows are encoded alike, very long texts whole; an empty table gives an empty one. Other columns are
    left out."""
    import public_tokenizers

    rows = encode_texts(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return rows.select("doc_id", "lang", "source", "n_tokens", "ids", *digests(rows))
