import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidelog.llm import tokenfile
from tidelog.llm.bpe import Vocabulary, decode_ids, digests, encode_texts

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return Vocabulary(PATH)


ODD = ["", "  ", "aaaaaaaaa aaa aa", "it's I'LL we've 'dd 'S", "<|endoftext|>hello<|startoftext|> x<|endoftext|>", "<|ENDOFTEXT|>", "ΣΑΣ ΟΔΟΣ Σ", "İ ß ẞ ﬁ", "e\u0301 A\u030a \x1ca\x1fb \x85 \u180e \u200b\u3000x"]
ODD += ["日本語 テスト 123 ٣٤ ½ Ⅷ", "👩‍👩‍👧 ok!! ...---", "a" * 3000, "".join(random.Random(3).choices("abcdefghij", k=2000)), "\x00\x01 \ufeff a", "\U0001e900 \u1c89 \ua7dc"]


def same(own, library, texts):
    ids, at = own.encode(texts)
    for k, e in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        got = ids[at[k] : at[k + 1]]
        assert got.tolist() == e.ids, texts[k]
        assert own.decode(got).decode() == library.decode(e.ids, skip_special_tokens=False)


def test_odd_texts(own, library):
    same(own, library, ODD)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text(own, library, texts):
    same(own, library, texts)


def test_queue_equals_rounds(own):
    r = random.Random(1)
    for n in (2, 3, 17, 200):
        piece = bytes(r.choices(b"aabcdhetno", k=n))
        rounds, _ = own.merge(np.frombuffer(piece, np.uint8), np.array([0, n]))
        first = [*own.single[list(piece[:-1])], own.final[piece[-1]]]
        assert own._merge_one([int(x) for x in first]) == rounds.tolist()


def test_library_by_words(library):
    more = ["Foo., bar!? O'Neil's. 'S x'. don't, <|ENDOFTEXT|>, <|endoftext|>. <|endoftext|, É. É| a|b| The THE tHe, I'D! it's: x:'s", " \x0b\x0c a \x1c b\x1f "]
    texts = ODD + more
    encoder = tokenfile.LibraryEncoder(PATH)
    for _ in range(2):  # the second time from memory
        ids, at = encoder.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    ids, at = encoder.encode(pa.array(texts).slice(3, 4))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [e.ids for e in library.encode_batch(texts[3:7], add_special_tokens=False)]
    with pytest.raises(ValueError):
        tokenfile.LibraryEncoder(public_tokenizers.path("byte_bpe_50k.json"))


def test_other_vocabularies_are_refused():
    with pytest.raises((ValueError, KeyError, TypeError)):
        Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


def test_encoded_rows(docs, corpus, library):
    rows = encode_texts(docs.withColumn("ids", docs.doc_id), PATH)
    assert rows.columns[-3:] == ["n_tokens", "ids", "decoded"] and "extra" in rows.columns
    got = sorted(map(tuple, rows.select("text", "n_tokens", *digests(rows)).collect()), key=str)
    want = []
    for _, text, *_ in corpus:
        e = library.encode(text or "", add_special_tokens=False)
        want.append((text, len(e.ids), hashlib.sha256(np.array(e.ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(e.ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    back = decode_ids(rows.select("ids", rows.decoded.alias("was")), PATH)
    assert back.where("decoded != was").count() == 0


def test_empty_table(no_docs, spark, tmp_path):
    assert encode_texts(no_docs, PATH).count() == 0
    manifest = tokenfile.write_tokens(no_docs, PATH, f"file://{tmp_path}/t")
    assert manifest.count() == 0 and tokenfile.read_tokens(manifest, f"file://{tmp_path}/t").count() == 0


def test_token_files(spark, docs, corpus, library, tmp_path):
    folder = f"file://{tmp_path}/t"
    hashes = [r[0] for r in spark.createDataFrame([(k, x[1]) for k, x in enumerate(corpus)], "k long, text string").orderBy("k").select(F.xxhash64("text")).collect()]
    corpus = [r for r, _ in sorted(zip(corpus, hashes), key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1], (x[0][1] or "").encode()))]
    manifest = tokenfile.write_tokens(docs, PATH, folder, length=64)
    got = sorted(map(tuple, tokenfile.read_tokens(manifest, folder).collect()), key=lambda r: r[1])
    start, want = 0, []
    for i, text, *_ in corpus:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want
    stream = np.concatenate([np.array([*library.encode(t or "", add_special_tokens=False).ids, 2]) for _, t, *_ in corpus])
    for shard, _, tokens, base in map(tuple, manifest.collect()):
        reader = tokenfile.ShardReader(folder, shard)
        rows = -(-tokens // 64)
        for k in (0, rows // 2, rows - 1):
            ids, mask = reader.sequence(k)
            n = min(64, tokens - 64 * k)
            assert mask.to_pylist() == [True] * n + [False] * (64 - n) and ids[:n].tolist() == stream[base + 64 * k : base + 64 * k + n].tolist()
        before = pa.total_allocated_bytes()
        view = reader.batch(0)
        assert not view.flags.owndata and pa.total_allocated_bytes() - before < view.nbytes


def test_names_of_folders():
    names = ["s3a://b/x", "s3n://b/x", "dbfs:/m/x", "file:/t/x", "file:///t/x", "/t/x", "hdfs://h/x"]
    assert [tokenfile.arrow_uri(n) for n in names] == ["s3://b/x", "s3://b/x", "file:///dbfs/m/x", "file:///t/x", "file:///t/x", "file:///t/x", "hdfs://h/x"]


def test_other_vocabularies_are_refused(tmp_path):
    """One whose pieces keep marks with letters, or whose words have no ids of their own."""
    import json

    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    for change in ({"pre_tokenizer": {"type": "WhitespaceSplit"}}, {"pre_tokenizer": None}, {"normalizer": None}):
        (tmp_path / "v.json").write_text(json.dumps(spec | change))
        with pytest.raises(ValueError):
            tokenfile.LibraryEncoder(str(tmp_path / "v.json"))


def test_spans_over_batches(tmp_path):
    writer = tokenfile.ShardWriter(f"file://{tmp_path}", 3, pa.uint16(), length=8)
    ids = np.arange(8 * tokenfile.ROWS * 2 + 5) % 60_000
    writer.add(pa.array([1, 2]), ids, np.array([10, len(ids) - 10]))
    writer.close()
    reader = tokenfile.ShardReader(f"file://{tmp_path}", 3)
    assert np.concatenate(list(reader.span(5, len(ids) - 5))).tolist() == ids[5:].tolist()
    assert reader.file.num_record_batches == 3
