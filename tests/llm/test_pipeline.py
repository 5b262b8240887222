from collections import Counter

import corpus_pipeline
from tidelog.llm import stages
from tidelog.llm.registry import ORACLES, QUERIES
from tidelog.llm.shared import keep, shared_folder


def test_names():
    assert [int(n[2:].split("_")[0]) for n in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def test_stages_on_awkward_documents(spark, docs, corpus, sf):
    now = docs.drop("extra")
    columns = now.columns
    kept = keep(stages.keep_good(spark, now, sf), "t")
    assert kept.columns == columns
    one = keep(stages.keep_one_of_each(spark, now, sf), "t")
    ids = Counter(r["doc_id"] for r in one.collect())
    assert one.columns == columns and ids[10] == 1 and ids[11] == ids[12] == ids[20] == 0 and ids[90] == 2 and ids[92] == 0 and ids[None] == 2
    cut = keep(stages.cut_repeats(spark, now, sf), "t")
    got = {r["doc_id"]: r for r in cut.collect()}
    assert cut.columns == columns and 10 not in got and got[4]["text"] == "one" and got[3]["text"] == " \n\t " and got[1]["text"] is None
    assert got[45]["n_chars"] == len(got[45]["text"])
    mixed = keep(stages.mix_sources(spark, now, sf), "t")
    assert mixed.columns == columns and 1 not in {r["doc_id"] for r in mixed.collect()}
    assert stages.encode(spark, now, sf).count() == len(corpus)


def test_near_copies_by_five_words(spark, sf):
    """A fifth appended (0.83), or two words of a hundred changed (0.811; 0.848 on four words)."""
    words = [f"w{k}" for k in range(200)]
    changed = list(words[:100])
    changed[30], changed[60] = "x", "y"
    texts = [words[:100], changed, words[100:], [*words[100:], *(f"z{k}" for k in range(20))]]
    rows = [(k, " ".join(w), "en", "s", 1) for k, w in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r["doc_id"] for r in stages.keep_one_of_each(spark, docs, sf).collect()} == {0, 2}


def test_stages_on_nothing(spark, no_docs, sf):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, sf).count() == 0


def test_run_against_plain_versions(spark, sf):
    """Each stage done one document, pair and window at a time; the first and the fourth by their SQL."""
    import hashlib

    import duckdb
    import numpy as np
    import pandas as pd
    import public_tokenizers
    from tokenizers import Tokenizer

    db = duckdb.connect()
    labels = pd.read_parquet(f"{sf}/labels.parquet")  # noqa: F841
    documents = pd.read_parquet(f"{sf}/documents.parquet")
    good = db.sql(ORACLES["op6_quality_rules"]).df().query("kept").doc_id
    now = documents[documents.doc_id.isin(good)].reset_index(drop=True)

    words = [t.encode().lower().split() for t in now.text]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in words]
    up = list(range(len(sets)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                up[find(a)] = find(b)
    least = {}
    for k, i in enumerate(now.doc_id):
        least[find(k)] = min(i, least.get(find(k), i))
    now = now[[least[find(k)] == i for k, i in enumerate(now.doc_id)]].reset_index(drop=True)

    words = [t.encode().split() for t in now.text]
    n = Counter(tuple(w[k : k + 35]) for w in words for k in range(len(w) - 34))
    texts = []
    for w, text in zip(words, now.text, strict=True):
        gone = [False] * len(w)
        for k in range(len(w) - 34):
            if n[tuple(w[k : k + 35])] > 1:
                gone[k : k + 35] = [True] * 35
        texts.append(b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode() if any(gone) else text)
    now = now.assign(text=texts)
    now = now[now.text.str.strip() != ""]

    documents = now
    taken = db.sql(ORACLES["op1_source_mix"]).df()
    times = {r.doc_id: int(r.taken / r.size_ + 0.5) for r in taken.rename(columns={"size": "size_"}).itertuples() if r.size_}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    want = Counter()
    for i, text in zip(now.doc_id, now.text, strict=True):
        ids = np.array(library.encode(text, add_special_tokens=False).ids, "<u4")
        want[i, hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(library.decode(ids.tolist(), skip_special_tokens=False).encode()).hexdigest()] += times[i]
    got = Counter((r["doc_id"], r["ids_sha256"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, sf).collect())
    assert got == +want


def test_run(spark, sf):
    rows = corpus_pipeline.run(spark, sf).collect()
    assert rows and all(r["n_tokens"] * 4 == len(r["ids"]) for r in rows)
    again = corpus_pipeline.run(spark, sf)
    assert Counter((r["doc_id"], r["ids_sha256"]) for r in rows) == Counter((r["doc_id"], r["ids_sha256"]) for r in again.collect())
    assert shared_folder(spark)
