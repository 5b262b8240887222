import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidelog.llm import phrases
from tidelog.llm.phrases import collocations


def plain(rows, least, share, most):
    """The contract, word by word."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 5):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    candidates = {x: a for x, a in f.items() if a >= least and len(x) > 2}
    out = {}
    for (lang, *w), a in candidates.items():
        longer = [b for (other, *v), b in candidates.items() if other == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))]
        if any(100 * b >= share * a for b in longer):
            continue
        score, _, left, right = min((2000000 * a // (f[(lang, *w[:k])] + f[(lang, *w[k:])]), k, f[(lang, *w[:k])], f[(lang, *w[k:])]) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, rank, p.decode(), -a, left, right, total[lang], -score) for lang, found in out.items() for rank, (score, a, p, left, right) in enumerate(sorted(found)[:most], 1))


def say(r, words, n):
    return "".join(r.choice(words) + r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "!? "]) for _ in range(n))


@pytest.mark.parametrize("block", [1 << 22, 300])
def test_like_a_plain_count(spark, monkeypatch, block):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", block)
    monkeypatch.setattr(phrases, "TASK_BYTES", 3 * block)
    r = random.Random(block)
    words = ["the", "The", "a", "b", "c", "new york", "in spite of", "Ünder", "日本", "x"]
    rows = [(say(r, words, r.randrange(0, 60)), r.choice(["en", "de", None, "und"])) for _ in range(150)]
    rows += [(None, "en"), ("", None), (" \t\n", "en"), ("z" * 2000 + " the a " * 300, "de"), ("same words here now " * 40, "en")] + [rows[3]] * 9
    df = spark.createDataFrame(rows, "text string, lang string").withColumns({c: F.lit(7) for c in ("f", "id", "left", "phrase", "n", "block")}).repartition(3)
    for least, share, most in ((5, 80, 2000), (12, 50, 6), (1000, 80, 10)):
        got = sorted(map(tuple, collocations(df, least=least, share=share, most=most).collect()))
        assert got == plain(rows, least, share, most) and bool(got) == (least < 1000)


def test_empty(spark):
    assert collocations(spark.createDataFrame([], "text string, lang string")).count() == 0


def test_counts_beyond_64_bits(spark):
    """Scores of counts whose products with 2,000,000 do not fit a long."""
    row = spark.sql("select 9000000000000000000L f, array(9100000000000000000L) heads, array(9200000000000000000L) tails")
    score = F.expr("(cast(f as decimal(20,0)) * 2000000) div (cast(heads[0] as decimal(20,0)) + cast(tails[0] as decimal(20,0)))")
    assert row.select(score).first()[0] == 9000000000000000000 * 2000000 // (9100000000000000000 + 9200000000000000000)
