import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def corpus(spark):
    """Texts with all that is awkward: nulls, blanks, copies, near copies, shared passages, long and odd ones."""
    import random

    r = random.Random(7)
    vocabulary = ["".join(r.choices("abcdefgh", k=r.randrange(2, 8))) for _ in range(900)]
    say = lambda n: [r.choice(vocabulary) for _ in range(n)]
    passage, base = say(60), say(300)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One two\x0bthree"), (6, "one two three"), (7, "word " * 400), (8, "a b " * 100)]
    rows += [(10 + k, " ".join(base)) for k in range(3)]
    for k in range(12):  # near copies, each with a few other words
        w = list(base)
        for i in r.sample(range(300), k):
            w[i] = r.choice(vocabulary)
        rows.append((20 + k, " ".join(w).upper() if k % 2 else " ".join(w)))
    for k in range(8):
        w = say(80)
        w[20:20] = passage[: 30 + 4 * k]
        rows.append((40 + k, " ".join(w)))
    rows.append((50, "x" * 40_000 + " " + " ".join(say(20_000))))
    rows += [(60 + k, " ".join(say(r.randrange(1, 200)))) for k in range(30)]
    rows += [(90, "same id"), (90, "other text"), (None, "no id at all"), (None, None), (91, "straße ŒUVRE 日本 \x1c x\u00a0y ■"), (92, "same id")]
    rows = [(i, t, None if k % 11 == 0 else ["en", "de"][k % 2], None if k % 9 == 0 else f"s{k % 4}", len(t or "")) for k, (i, t) in enumerate(rows)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    from pyspark.sql import functions as F

    return spark.createDataFrame(corpus, DOCUMENTS).repartition(5).withColumn("extra", F.lit(1))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)
