import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidelog.llm import tokencount
from tidelog.llm.tokencount import CountCache, content, token_counts

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"]


def plain(path, texts):
    """Whole texts through the library."""
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        return [len(SentencePieceProcessor(model_file=path).encode(t)) for t in texts]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


@pytest.mark.parametrize("name", FILES)
def test_like_the_library(spark, corpus, tmp_path, monkeypatch, name):
    path = public_tokenizers.path(name)
    rows = [(x[0], x[1], 7) for x in corpus] + [(200, "a  <|endoftext|>b\t\tc ", 7), (201, " a <|endoftext|>b c", 7), (202, "Á   x", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest int").withColumns({"`a.b`": F.lit(1), "n_bytes": F.lit(0)}).repartition(3)
    cache = CountCache(spark, str(tmp_path / "cache"))
    want = sorted((str(i), len((t or "").encode()), n, n > 100) for (i, t, _), n in zip(rows, plain(path, [t or "" for _, t, _ in rows])))
    seen = []
    real = CountCache.add
    monkeypatch.setattr(CountCache, "add", lambda self, df, of: (seen.append(1), real(self, df, of))[1])
    for most in (100_000, 0):  # the second time all is in the cache
        monkeypatch.setattr(tokencount, "BROADCAST_MISSES", most)
        out = token_counts(docs, path, cache, limit=100)
        assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in out.collect()) == want
        assert out.where("digest = 7").count() == len(rows) and len(seen) == 1
    blanks = tokencount.counter(path).blanks
    assert blanks == name.startswith("word")
    distinct = docs.select(content(F.col("text"), blanks)).distinct().count()
    stored = spark.read.parquet(f"{tmp_path}/cache")
    assert stored.count() == distinct and stored.select("tokenizer").distinct().count() == 1


def test_only_misses_are_encoded(spark, tmp_path, monkeypatch):
    path = public_tokenizers.path(FILES[0])
    cache = CountCache(spark, str(tmp_path / "cache"))
    first = spark.createDataFrame([(1, "one two"), (2, "three")], "doc_id long, text string")
    more = spark.createDataFrame([(1, " one\ntwo"), (3, "four five six"), (4, "four  five six"), (5, None)], "doc_id long, text string")
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts(first, path, cache).collect()} == {1: 2, 2: 1}
    for most in (0, 10):
        monkeypatch.setattr(tokencount, "BROADCAST_MISSES", most)
        assert {r["doc_id"]: r["n_tokens"] for r in token_counts(more, path, cache).collect()} == {1: 2, 3: 3, 4: 3, 5: 0}
        assert spark.read.parquet(f"{tmp_path}/cache").count() == 4
    cache.add(spark.read.parquet(f"{tmp_path}/cache").select("digest", "n_tokens"), tokencount.version(path))  # as two runs at once would
    assert token_counts(more, path, cache).count() == 4
    assert token_counts(first.limit(0), path, cache).count() == 0
    assert tokencount.version(path) != tokencount.version(public_tokenizers.path(FILES[1]))
