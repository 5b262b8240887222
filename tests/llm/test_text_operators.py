import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidelog.llm import langid, quality
from tidelog.llm.mixing import mix
from tidelog.llm.quoting import link_quotes
from tidelog.llm.urlrules import judge_urls, rule_table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# mixing


def wanted(rows):
    """Targets by pouring out what is cut off until nothing is, and takings of each source."""
    size = Counter()
    for _, text, _, source, _ in rows:
        size[source] += len(WORD.findall(text or ""))
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None] * (None in size)
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    target, left, open_ = {}, float(sum(size.values())), set(names)
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if share * weight[s] > 3 * size[s]}
        if not full:
            return size, target | {s: share * weight[s] for s in open_}
        for s in full:
            target[s] = 3.0 * size[s]
            left -= target[s]
        open_ -= full
    return size, target


def test_mix(docs, corpus):
    sequence, taken = mix(docs)
    rows = taken.collect()
    size, target = wanted(corpus)
    assert len(rows) == len(corpus)
    per = Counter()
    for r in rows:
        assert math.isclose(r["target"], target[r["source"]], rel_tol=1e-9) and r["source_size"] == size[r["source"]]
        assert 0 <= r["taken"] <= 3 * r["size"]
        per[r["source"]] += r["taken"]
    assert all(abs(per[s] - target[s]) <= 1 for s in target)
    assert Counter((r["id"], r["size"]) for r in rows) == Counter((i, len(WORD.findall(t or ""))) for i, t, *_ in corpus)
    again = mix(docs.repartition(2))[1]
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, rows))
    assert sequence.agg(F.sum("words")).first()[0] == sum(per.values())


def test_mix_is_even(spark):
    rows = [(k, "w " * 200, f"s{k % 3}") for k in range(600)]
    sequence, _ = mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    s = sequence.select("slot", "number", "words").toPandas().sort_values("slot")
    share = (s["words"].where(s["number"] == 2, 0).cumsum() / s["words"].cumsum()).to_numpy()
    assert np.abs(share[len(s) // 10 :] - 0.5).max() < 0.02  # by weight 3 of 6, from early on
    whole = s.groupby("slot")["words"].sum()
    assert (whole == whole.mode()[0]).mean() > 0.95


def test_mix_empty(no_docs, spark):
    assert mix(no_docs)[1].count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id long, text string, source string")
    assert [r["taken"] for r in mix(blank)[1].collect()] == [0, 0]


# URLs

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("EXAMPLE.org", "/a/b", "block"), ("example.org", "/a/", "allow"), ("x.y", "", "block"), ("dup", "/", "allow"), ("dup", "/", "block")]


def judge(url, rules=RULES):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.DOTALL).groups()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h) + len(p), len(h), v == "block", h.lower() + p, v) for h, p, v in rules if (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
    return (host, path, *max(fit)[3:]) if fit else (host, path, None, "allow")


URLS = [None, "", "no url", "http://", "http://com", "http://COM/", "http://a.com/en/", "http://example.com/en/x?y#z", "http://WWW.Example.com/en/", "http://w.www.example.com/en/1", "https://net/es/", "https://a.net/es", "http://notexample.com/en/"]
URLS += ["http://example.org/a/bc", "http://example.org/a/", "http://e.example.org/a/b", "http://x.y", "http://q.x.y?z", "http://dup/", "http://u@h.com:80/", "http://h.com?/en/", "x://example.com/en/://", "http://" + "a." * 3000 + "com/" + "p/" * 3000, "http://ü.com/é"]


@pytest.mark.parametrize("many", [False, True])
def test_urls(spark, monkeypatch, many):
    if many:
        monkeypatch.setattr("tidelog.llm.urlrules.BROADCAST_RULES", 2)
    rows = [(k, u, "x") for k, u in enumerate(URLS)] + [(None, "http://a.com/", "x"), (0, None, "x"), (7, "http://example.com/en/x?y#z", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = Counter(tuple(r) for r in judge_urls(df, rule_table(spark, RULES)).select("page_id", "host", "path", "rule", "verdict").collect())
    assert got == Counter((i, *judge(u)) for i, u, _ in rows)
    assert judge_urls(df.limit(0), rule_table(spark, RULES)).count() == 0
    assert judge_urls(df, rule_table(spark, RULES).limit(0)).where("rule is not null").count() == 0


# quality


def test_measures(corpus):
    texts = [t or "" for _, t, *_ in corpus] + ["a b c a b c", "x\n\nx\ny y y y", "#a* $%&|<> #\n#a* $%&|<> #"]
    got = quality.measure([t.encode() for t in texts])
    for k, t in enumerate(texts):
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        runs = Counter(zip(w, w[1:], w[2:]))
        covered = {i + j for i in range(len(w) - 2) if runs[tuple(w[i : i + 3])] > 1 for j in range(3)}
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        assert tuple(got[m][k] for m in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want, t[:60]


def test_exact_bound():
    for n, share, level in ((50, 0.1, 0.05), (300, 0.02, 0.001), (1000, 0.3, 0.01)):
        for k in range(0, n, max(1, n // 25)):
            tail = sum(math.comb(n, i) * share**i * (1 - share) ** (n - i) for i in range(k + 1))
            assert quality.upper_bound_holds(k, n, share, level) == (tail <= level)
    assert not quality.upper_bound_holds(0, 0, 0.1, 0.5)


def test_cutoffs_keep_good_documents(spark):
    rows, labels = [], []
    for k in range(4000):
        bad = k % 4 == 0
        rows.append((k, " ".join(f"w{(k * 31 + i * i) % 997}{'#$' if bad and i % 2 else ''}" for i in range(80)), "en" if k % 3 else None))
        labels.append((k, 0 if bad else 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame(labels + [(None, 1), (99999, 1), (8, None)], "doc_id long, quality int")
    out = quality.quality_rules(docs.withColumn("kept", F.lit("clash")), marks, alpha=0.04)
    assert out.columns[:3] == ["doc_id", "text", "lang"]
    got = {r["doc_id"]: r["kept"] for r in out.collect()}
    good = [got[k] for k, q in labels if q]
    assert sum(good) / len(good) >= 0.96 and not any(got[k] for k, q in labels if not q)
    few = quality.quality_rules(docs, marks.where("doc_id < 20"), keep_text=False)
    assert few.where("not kept and not base_failed").count() == 0 and "text" not in few.columns
    assert quality.quality_rules(docs.limit(0), marks).count() == 0
    assert quality.quality_rules(docs.limit(5), marks.limit(0)).where("kept").count() == 5


def test_awkward_quality(docs, spark):
    marks = spark.createDataFrame([], "doc_id long, quality int")
    out = quality.quality_rules(docs, marks)
    assert out.count() == docs.count()
    for r in out.collect():
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) and r["kept"] != r["base_failed"]


def test_rejections_only_where_labels_bound_them(spark):
    """Languages without, with few and with many labels; in each, half of the documents have a mark after every word."""
    word = lambda k, i: f"w{(k * 31 + i * 7) % 997}"
    marked = lambda k: " ".join(word(k, i) + " ##" for i in range(60))
    clean = lambda k: " ".join(word(k, i) for i in range(60))
    rows = [(n * 10_000 + k, lang, marked(k) if k % 2 else clean(k)) for n, lang in enumerate(["none", None, "few", "many", "mixed"]) for k in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    # few: 100 good ones, which bound nothing; many: marked ones are bad; mixed: a tenth of the good ones are marked
    labels = [(20_000 + k, 1) for k in range(0, 200, 2)] + [(20_000 + k, 0) for k in range(1, 200, 2)]
    labels += [(30_000 + k, 1 - k % 2) for k in range(500)]
    labels += [(40_000 + k, int(k % 2 == 0 or k % 20 == 1)) for k in range(500)]
    out = quality.quality_rules(docs, spark.createDataFrame(labels, "doc_id long, quality int").repartition(3))
    lost = {r["lang"]: (r["marked"], r["clean"]) for r in out.where("not kept").groupBy("lang").agg(F.count_if(F.col("doc_id") % 2 == 1).alias("marked"), F.count_if(F.col("doc_id") % 2 == 0).alias("clean")).collect()}
    assert lost == {"many": (350, 0)}
    assert out.where("base_failed").count() == 0 and out.count() == len(rows)


def test_strata_that_are_tried():
    """As many as there are, their tests together are no less certain than one."""
    for sizes in ([], [10], [149], [148], [200, 200], [149, 149], [180, 181, 90, 1000], [300] * 50 + [150] * 50):
        level, least = quality.tried(sizes, 0.02, 0.05)
        n = sum(x >= least for x in sizes)
        assert n * level <= 0.05 * (1 + 1e-12) and least == quality.least_trials(0.02, level)
    assert quality.tried([149], 0.02, 0.05)[1] == 149 and quality.tried([149, 149], 0.02, 0.05)[1] > 149


# language


def test_language(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = langid.train(docs.where(~held), "text", "lang")
    rows = langid.predict(docs.withColumn("score", F.lit("clash")), model).withColumn("held", held)
    assert rows.where("held and lang = lang_pred").count() >= 0.97 * rows.where("held").count()
    assert rows.where("score < 0 or score > 1 or score is null").count() == 0
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (4, "x"), (5, "12\u0663")], "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(odd, model).collect()}
    assert [got[k] for k in (1, 2, 3, 5)] == [("und", 0.0)] * 4 and got[4][0] in model.langs
    none = langid.train(docs.limit(0), "text", "lang")
    assert langid.predict(odd, none).where("lang_pred != 'und'").count() == 0


def all_hits(model, texts):
    """Hits in all shards, and n-grams."""
    found = [model.hits(texts, model.masks if model.shards == 1 else model.load(k), k) for k in range(model.shards)]
    return sum(h for h, _, _ in found), found[0][1]


def every_mask(model, grams):
    out = np.zeros((len(grams), model.words), np.uint64)
    for k in range(model.shards):
        mine = langid.shard_of(grams, model.shards) == k
        out[mine] = model.languages(grams[mine], model.masks if model.shards == 1 else model.load(k))
    return out


@pytest.mark.parametrize("shards", [1, 4])
def test_more_languages_than_a_word_has_bits(spark, shards):
    langs = [f"l{k:03d}" for k in range(70)]
    grams = np.concatenate([langid.ngrams([f"word{chr(97 + k % 26)}{chr(97 + k // 26)}q"])[0] for k in range(70)])
    of = np.repeat(np.arange(70), len(grams) // 70)
    batch = pa.RecordBatch.from_arrays([pa.array([langs[k] for k in of]), pa.array(grams.view(np.int64))], ["lang", "gram"])
    (bits,) = langid._set(langs, 1 << 14, shards)(iter([batch]))
    f = langid.Filter(langs, 1 << 14, spark.createDataFrame(bits.to_pandas(), "shard long, slot long, word long, mask long"), shards)
    scores = f.scores(*all_hits(f, [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}q" for k in (0, 65, 69)]))
    assert (scores[[0, 1, 2], [0, 65, 69]] > 0.99).all() and (f.chance > 0).all()


def test_a_language_of_many_ngrams(spark):
    """More than 262,144 n-grams in one language: scores are still those of exact sets, and those of several shards are the same."""
    r = np.random.default_rng(9)
    say = lambda n: " ".join("".join(map(chr, w)) for w in r.integers(0x4E00, 0x4E00 + 6000, (n, 3)))
    rows = [(say(500), "zh") for _ in range(110)] + [("some plain words of another language " * 20, "en")]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    sets = [set(langid.ngrams([t for t, x in rows if x == y])[0].tolist()) for y in ("en", "zh")]
    assert len(sets[1]) > 262_144
    texts = [rows[0][0][:200] + " " + say(n) for n in (1, 20, 50, 100)] + [say(60), "some other words", "x"]
    asked = spark.createDataFrame([(k, t, 5) for k, t in enumerate(texts)] + [(98, None, 5), (99, "1 2", 5)], "id long, text string, hits int")
    found = []
    for size in (langid.SHARD_BYTES, 1 << 23):
        model = langid.train(df, "text", "lang", size)
        assert (model.shards > 1) == (size < langid.SHARD_BYTES) and model.slots * model.shards >= 16 * len(sets[1])
        scores = model.scores(*all_hits(model, texts))
        for k, t in enumerate(texts):
            grams = langid.ngrams([t])[0].tolist()
            assert np.abs(scores[k] - [sum(g in own for g in grams) / len(grams) for own in sets]).max() < 0.05
        rows_of = {x["id"]: (x["lang_pred"], round(x["score"], 2), x["hits"]) for x in langid.predict(asked, model).collect()}
        assert rows_of[98] == rows_of[99] == ("und", 0.0, 5) and len(rows_of) == len(texts) + 2
        assert [rows_of[k][1] for k in range(len(texts))] == [round(float(x.max()), 2) for x in scores]
        found.append([rows_of[k][0] for k in range(len(texts))])
    assert found[0] == found[1]


@pytest.mark.parametrize("size", [langid.SHARD_BYTES, 1 << 17])
def test_language_against_exact_sets(spark, size):
    """The filter against sets of n-grams made one by one: it contains all of them, others as rarely as it says, and so
    scores are those of the sets."""
    import random

    r = random.Random(5)
    letters = {"aa": "abcdef", "bb": "cdefgh", "cc": "ghijkl"}
    say = lambda x, n: " ".join("".join(r.choices(letters[x], k=r.randrange(1, 6))) for _ in range(n))
    rows = [(say(x, r.randrange(1, 60)), x) for x in letters for _ in range(40)]
    rows += rows[:10] + [(None, "aa"), ("", "bb"), ("abc", None), ("x" * 5000, "cc")]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string").repartition(4), "text", "lang", size)
    assert (model.shards == 1) == (size == langid.SHARD_BYTES)
    counts = {x: Counter() for x in letters}
    for text, lang in rows:
        if text is not None and lang is not None:
            counts[lang].update(langid.ngrams([text])[0].tolist())
    rate = {x: {g: n / sum(c.values()) for g, n in c.items()} for x, c in counts.items()}
    top = Counter()
    for x in letters:
        for g, v in rate[x].items():
            top[g] = max(top[g], v)
    sets = [{g for g, v in rate[x].items() if v >= langid.SHARE * top[g]} for x in sorted(letters)]
    assert model.langs == sorted(letters)
    every = np.array(sorted(top), np.uint64)
    mask = every_mask(model, every)[:, 0]
    for i, own in enumerate(sets):
        has = ((mask >> np.uint64(i)) & np.uint64(1)).astype(bool)
        exact = np.array([int(g) in own for g in every])
        assert has[exact].all() and (has & ~exact).mean() <= model.chance[i] + 0.02
    texts = [say(x, 20) for x in letters for _ in range(10)] + [say("aa", 10) + " " + say("cc", 12)]
    scores = model.scores(*all_hits(model, texts))
    for k, t in enumerate(texts):
        grams = langid.ngrams([t])[0].tolist()
        want = [sum(g in own for g in grams) / len(grams) for own in sets]
        assert np.abs(scores[k] - want).max() < 0.05
        if sorted(want)[-1] - sorted(want)[-2] > 0.1:
            assert scores[k].argmax() == int(np.argmax(want))
    again = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(texts + texts)], "id long, text string, lang_pred string")
    got = {r["id"]: (r["lang_pred"], r["score"]) for r in langid.predict(again, model).collect()}
    assert all(got[k] == got[k + len(texts)] for k in range(len(texts)))


def test_ngrams():
    def plain(t):
        w = "".join(c if c.isalpha() else " " for c in t.lower()).split()
        return Counter((n, p) for n in langid.SIZES for x in w for s in [f" {x} "] for i in range(len(s) - n + 1) for p in [s[i : i + n]])

    for text in ("Hello world", "a", "x1y ß", "  ab  cd "):
        g, owner, _ = langid.ngrams([text, text, ""])
        assert Counter(g[owner == 0].tolist()) == Counter(g[owner == 1].tolist()) and not (owner == 2).any()
        assert sorted(Counter(g[owner == 0].tolist()).values()) == sorted(plain(text).values())


# quotations


def test_quotes(spark):
    rows = [
        ("a", 1, "u", "Hello there\nHow are you?\nFine?"),
        ("a", 2, "v", "On Monday u wrote:\n> how are  you?\n\nI am well."),
        ("a", 3, "w", "> Hello there\nhi"),
        ("a", 4, "v", "> > How are you?\n> I am well.\ngood"),
        ("a", 5, "x", "no quote"),
        ("a", 6, "y", ">nothing known\nwhat"),
        ("a", 7, "z", "> I am well.\nlate answer"),
        ("b", None, "u", None),
        ("b", 1, "u", ""),
        ("b", 1, "u", ""),
        (None, 3, "q", "> I am well.\nx"),
    ]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string").withColumn("position", F.lit("clash"))
    out = link_quotes(df)
    got = {(r["conv_id"], r["turn"]): (r["own_text"], r["n_quotes"], r["n_linked"], r["reply_turn"], r["depth"], r["position"]) for r in out.collect()}
    assert got == {
        ("a", 1): ("Hello there\nHow are you?\nFine?", 0, 0, None, 0, 1),
        ("a", 2): ("I am well.", 1, 1, 1, 1, 2),
        ("a", 4): ("good", 2, 2, 2, 2, 3),
        ("a", 5): ("no quote", 0, 0, 4, 3, 4),
        ("a", 6): ("what", 1, 0, 5, 4, 5),
        ("a", 7): ("late answer", 1, 1, 2, 2, 6),
        ("a", 3): ("hi", 1, 1, 1, 1, 7),
        ("b", None): ("", 0, 0, None, 0, 1),
        ("b", 1): ("", 0, 0, None, 1, 2),
        (None, 3): ("x", 1, 0, None, 0, 1),
    }
    assert out.where("copies = 2").count() == 1 and link_quotes(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_links_of_random_threads(spark, seed):
    """Against a linker that looks at all earlier messages."""
    import random

    r = random.Random(seed)
    rows, texts = [], []
    vocabulary = [f"Line {k}  of it" for k in range(40)]
    for turn in range(60):
        lines = []
        for _ in range(r.randrange(0, 3)):  # quoted passages, some of nobody
            level = r.choice([1, 1, 1, 2, 3])
            source = r.choice(texts)[1] if texts and r.random() < 0.8 else [f"nobody {r.random()}"]
            part = source[r.randrange(len(source)) :][: r.choice([1, 2, 9])] if source else ["?"]
            lines += [">" * level + " " + (x.upper() if r.random() < 0.3 else x.replace(" ", "  ")) for x in part]
            lines += [r.choice(["", ">", "aside " + str(r.randrange(5))])]
        own = [r.choice(vocabulary) for _ in range(r.randrange(0, 4))]
        lines += own
        if seed == 3 and turn == 20:
            lines += [f"long {k}" for k in range(3000)]
        text = "\n".join(lines)
        texts.append((turn * 10**6, [x for x in lines if not x.startswith(">") and x.strip()], lines))
        rows.append(("c", turn * 10**6, "u", text))
    norm = lambda x: " ".join(x.split()).lower()
    want = {}
    for turn, _, lines in texts:
        runs, last = [], None
        for x in lines:
            level = len(re.match(r"^(?:[ \t]*>)*", x)[0].replace(" ", ""))
            x = re.sub(r"^(?:[ \t]*>)+[ ]?", "", x)
            if level != last:
                runs.append((level, []))
            last = level
            if x.strip():
                runs[-1][1].append(x)
        runs = [(k, p) for k, p in runs if k and p]
        votes, linked = Counter(), 0
        for level, part in runs:
            hits = []
            for unit in {norm(x) for x in part} | {norm(" ".join(part))}:
                earlier = [t for t, own, _ in texts if t < turn and (unit in {norm(x) for x in own} or (own and unit == norm(" ".join(own))))]
                hits += [max(earlier)] if earlier else []
            linked += bool(hits)
            for t in hits:
                votes[level, t] += 1
        best = max(((-level, n, t) for (level, t), n in votes.items()), default=None)
        want[turn] = (len(runs), linked, best[2] if best else turn - 10**6 if turn else None)
    out = link_quotes(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string").repartition(5)).collect()
    assert {x["turn"]: (x["n_quotes"], x["n_linked"], x["reply_turn"]) for x in out} == want


def test_messages_of_one_turn(spark):
    """However many messages share a turn, or have none, they answer what comes before it and are read by name."""
    rows = [("c", None, "u", f"first {k}") for k in range(30)] + [("c", 5, "v", f"> first {k}\nanswer {k}") for k in range(30)]
    out = link_quotes(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string").repartition(4)).collect()
    assert sorted(x["position"] for x in out) == list(range(1, 61)) and all(x["depth"] == (x["turn"] is not None) for x in out)
    place = {x["own_text"]: x["position"] for x in out}
    assert all(place[f"answer {k}"] == place[f"first {k}"] + 1 for k in range(30))


def test_reading_order_of_a_long_conversation(spark):
    """Against a depth-first walk, with turns over several spans."""
    import random

    r = random.Random(2)
    text, parent, rows = {}, {}, []
    for k in range(150):
        own = f"line {k} of it"
        if k and r.random() < 0.4:
            parent[k] = r.randrange(k)
            rows.append(("c", k * 100, "u", f"> {text[parent[k]]}\n{own}"))
        else:
            parent[k] = k - 1
            rows.append(("c", k * 100, "u", own))
        text[k] = own
    order, stack = {}, [0]
    while stack:
        k = stack.pop()
        order[k] = len(order) + 1
        stack += sorted((c for c, p in parent.items() if p == k and c), reverse=True)
    out = link_quotes(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string"))
    assert {r["turn"] // 100: r["position"] for r in out.collect()} == order
