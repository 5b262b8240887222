"""Every operator and stage beside columns that have the names that it uses inside."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidelog.llm import bpe, jaccard, langid, mixing, quality, quoting, substring, tokenfile, urlrules, vectors
from tidelog.llm.shared import keep, unused

NAMES = """of of_lang of_band key keys _n _rows _key rows row part nth base n copy low high more mix_key mix_part mix_n mix_copy group block blocks bucket
packed first second words kept kept_ removed n_words n_removed kept_text base_failed good step band size taken target want number slot set_id component_id
n_shingles tree center links n_links entry vector copies cell lang_pred score ids decoded n_tokens span own_span c node at lines own_text found source_ id
value place rank depth position rule verdict host path start total mask shard""".split() + ["back`tick", "dot.ted", "two words"]


@pytest.fixture(scope="module")
def beside(spark):
    """Documents among columns of all those names."""
    r = np.random.default_rng(8)
    say = lambda n: " ".join(f"w{k}" for k in r.integers(0, 400, n))
    passage = say(60)
    rows = [(k, say(80) + (" " + passage if k < 4 else ""), ["en", "de"][k % 2], f"s{k % 3}", 1) for k in range(40)]
    rows += [(100 + k, rows[7][1], "en", "s0", 1) for k in range(3)] + [(None, None, None, None, None), (5, "", "de", "s1", 0), (None, say(70), "en", "s1", 1), (None, say(70), "en", "s1", 1)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    return plain, plain.select("*", *[F.lit(77).alias(n) for n in NAMES])


def same(a, b, *columns):
    got = [sorted(map(str, df.select(*columns).collect())) for df in (a, b)]
    assert got[0] == got[1] and got[0]


def untouched(df, *but):
    """The columns that an operator passes on hold what they held."""
    mine = [n for n in NAMES if n in df.columns and n not in but]
    changed = df.select(*[F.count_if(F.col("`" + n.replace("`", "``") + "`") != 77).alias(f"c{k}") for k, n in enumerate(mine)]).first()
    assert not any(changed), [n for k, n in enumerate(mine) if changed[k]]


def test_operators(spark, beside, tmp_path):
    plain, more = beside
    labels = spark.createDataFrame([(k, 1, 77) for k in range(40)], "doc_id long, quality int, good int")
    columns = ["doc_id", "base_failed", "kept", *quality.MEASURES]
    out = quality.quality_rules(more, labels)
    same(quality.quality_rules(plain, labels), out, *columns)
    untouched(out, *columns)
    same(mixing.mix(plain)[1], mixing.mix(more)[1], "id", "size", "source_size", "target", "taken")
    found = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_join(more).collect()}
    assert found == {i: 7 if i in (7, 100, 101, 102) else i for i in [*range(40), 100, 101, 102, None]}
    out = substring.remove_repeats(more)
    same(substring.remove_repeats(plain), out, "doc_id", "n_words", "n_removed", "kept_text")
    untouched(out, "n_words", "n_removed", "kept_text")
    path = __import__("public_tokenizers").path("word_bpe_49k.json")
    out = bpe.encode_texts(more, path)
    same(bpe.encode_texts(plain, path), out, "doc_id", "n_tokens", "decoded")
    untouched(out, "n_tokens", "ids", "decoded")
    model = langid.train(more, "text", "lang")
    out = langid.predict(more, model)
    same(langid.predict(plain, langid.train(plain, "text", "lang")), out, "doc_id", "lang_pred", "score")
    untouched(out, "lang_pred", "score")
    read = [tokenfile.read_tokens(tokenfile.write_tokens(df, path, f"file://{tmp_path}/{k}"), f"file://{tmp_path}/{k}") for k, df in enumerate(beside)]
    same(*read, "doc_id", "start", "n_tokens", "ids_crc32")
    urls = plain.select(F.col("doc_id").alias("page_id"), F.concat(F.lit("http://a.example.com/en/"), "lang").alias("url"))
    rules = urlrules.rule_table(spark, [("example.com", "/en/d", "block"), ("com", "/", "allow")])
    same(urlrules.judge_urls(urls, rules), urlrules.judge_urls(urls.select("*", *[F.lit(77).alias(n) for n in NAMES]), rules), "page_id", "host", "path", "rule", "verdict")
    vecs = plain.select(F.col("doc_id").alias("vec_id"), F.array(F.coalesce("doc_id", F.lit(1)) % 3, F.lit(1)).cast("array<double>").alias("embedding"))
    same(vectors.near_vectors(vecs), vectors.near_vectors(vecs.select("*", *[F.lit(77).alias(n) for n in NAMES])), "vec_id", "n_links", "component_id", "kept")
    talk = plain.select(F.col("lang").alias("conv_id"), F.col("doc_id").alias("turn"), F.col("source").alias("role"), "text")
    out = quoting.link_quotes(talk.select("*", *[F.lit(77).alias(n) for n in NAMES])).collect()
    assert len(out) == talk.count() and all(r["own_text"] == (r["own_text"] or "").strip() and not r["n_linked"] for r in out)
    for conv in {r["conv_id"] for r in out}:
        assert sorted(r["position"] for r in out if r["conv_id"] == conv) == list(range(1, sum(r["conv_id"] == conv for r in out) + 1))


def test_stages(spark, beside, sf):
    plain, more = beside
    for name, stage in corpus_pipeline.STAGES:
        out = keep(stage(spark, more, sf), "t")
        if name == "jaccard_join":
            ids = sorted(r["doc_id"] for r in out.where("doc_id is not null").collect())
            assert ids == sorted([*range(40), 5]) and out.where("doc_id is null").count() == 3
        else:
            same(stage(spark, plain, sf), out, "doc_id", "n_tokens" if name == "bpe_encode" else "text")
        if name != "bpe_encode":
            assert out.columns == more.columns
            untouched(out)


def test_unused(spark):
    assert unused(spark.createDataFrame([], "A int, a_ int, b int"), "a", "c", "c") == ["a__", "c", "c_"]


def test_many_alike_rows_without_an_id(spark, sf):
    """Rows that nothing tells apart share one key of the mix; how many copies stay follows from the words taken."""
    rows = [(None, "a b c d", "en", "s0", 7)] * 50 + [(k, "a b c d e f", "en", f"s{k % 2}", 11) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    _, taken = mixing.mix(docs)
    want = {}
    for r in taken.collect():
        want[r["size"]] = want.get(r["size"], 0) + int(r["taken"] / r["size"] + 0.5)
    got = {len(r["text"].split()): r["count"] for r in dict(corpus_pipeline.STAGES)["source_mix"](spark, docs, sf).groupBy("text").count().collect()}
    assert got == {k: v for k, v in want.items() if v}
