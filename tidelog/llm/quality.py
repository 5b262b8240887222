"""Quality rules with risk-controlled cutoffs.

Four ratios of a text (RULES) may reject it, each beyond a cutoff. How strict they are is a step on one fixed path: the first
rule takes its candidate cutoffs from the mildest to the strictest, then the second joins in with its own, and so on. In
each stratum of the labelled documents the steps are tried in that order, and one holds if it is certain enough that all rules
together reject at most a share ALPHA of good documents: the exact binomial (Clopper-Pearson) upper bound at level
DELTA / strata is at most ALPHA. The first failure ends the trial, so steps need no correction among themselves; the strata that
are tried are corrected for by Bonferroni's inequality. So with probability 1 - DELTA no stratum loses more than ALPHA of its good
documents. Of the steps that hold, the one is used that rejects the most bad documents in proportion, less the good
ones; of equals the mildest.

A stratum is a length band of a language. What its own labels can't bound is not rejected: a stratum with fewer good labels than any
certainty needs (a number that follows from ALPHA, DELTA and how many strata are tried), or with none, keeps all that pass the
base rules. Which strata are tried depends on how many good labels they have, not on what the rules say of these.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from tidelog.llm.shared import keep, map_rows, small_batches, unused
from tidelog.llm.words import Words, as_bytes, chunks, mix

ALPHA, DELTA = 0.02, 0.05
#: Strata with cutoffs that are sent to all tasks at most; more are joined by a shuffle.
BROADCAST_STRATA = 100_000
#: Lower ends of the length bands, in words.
BANDS = (0, 150)
#: Candidate cutoffs of a ratio, the mildest first.
CUTOFFS = (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.05)
#: Rule: measure over which other, in the order of the path.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "bangs": ("n_bangs", "word_chars"),
    "repeats": ("n_repeat_words", "n_words"),
    "lines": ("n_dup_lines", "n_lines"),
}
STEPS = len(RULES) * len(CUTOFFS)
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bangs", "n_lines"]
_U = np.uint64
_SYMBOL, _BANG = np.zeros(256, np.int64), np.zeros(256, np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1
_BANG[list(b"!?")] = 1
#: UTF-8 bytes that begin a character.
_LEAD = np.array([(b & 0xC0) != 0x80 for b in range(256)])


def _per_text(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return total[at[1:]] - total[at[:-1]]


def measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    """MEASURES of each text."""
    w = Words(texts)
    out = {"n_words": w.counts, "word_chars": _per_text(_LEAD[w.bytes] & ~w.space, w.at)}
    out |= {name: _per_text(table[w.bytes], w.at) for name, table in (("n_symbols", _SYMBOL), ("n_bangs", _BANG))}
    h, n = w.hashes(), len(texts)

    # words in runs of three that occur twice in their text
    at, doc = w.windows(3)
    name = mix(h[at] * _U(0x9E3779B97F4A7C15) + mix(h[at + 1]) * _U(3) + h[at + 2] * _U(0xC2B2AE3D27D4EB4F)) if len(at) else np.empty(0, np.uint64)
    name = mix(name + doc.astype(np.uint64) * _U(0xD6E8FEB86659FD93))
    _, of, count = np.unique(name, return_inverse=True, return_counts=True)
    twice = at[count[of] > 1] if len(at) else at
    covered = np.zeros(len(h), bool)
    for k in range(3):
        covered[twice + k] = True
    out["n_repeat_words"] = _per_text(covered, w.first)

    lines, again = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for d, text in enumerate(texts):
        full = [x for x in text.split(b"\n") if x.split(None, 1)]
        lines[d], again[d] = len(full), len(full) - len(set(full))
    out["n_lines"], out["n_dup_lines"] = lines, again
    return out


def with_measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Every row of docs with MEASURES of its text, which replace columns of these names. Null counts as empty."""
    small_batches(docs.sparkSession)
    docs = docs.drop(*MEASURES)
    text = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(text))
            for i, j in chunks(texts):
                found = measure(texts[i:j])
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in batch.columns), *(pa.array(found[m], pa.int64()) for m in MEASURES)], [*batch.schema.names, *MEASURES])

    return map_rows(docs, run, [StructField(m, LongType()) for m in MEASURES])


def upper_bound_holds(rejected: int, n: int, share: float, level: float) -> bool:
    """Whether the exact upper bound, at that level, of a binomial probability of which n trials had ``rejected``
    hits is at most share: P(X <= rejected) <= level for X ~ Binomial(n, share)."""
    if rejected >= n:
        return False
    k = np.arange(rejected + 1)
    logs = np.cumsum(np.concatenate(([n * math.log1p(-share)], np.log((n - k[:-1]) / (k[:-1] + 1)) + math.log(share / (1 - share)))))
    top = logs.max()
    return top + math.log(np.exp(logs - top).sum()) <= math.log(level)


def least_trials(share: float, level: float) -> int:
    """Trials without a hit from which on upper_bound_holds can hold."""
    return math.ceil(math.log(level) / math.log1p(-share))


def _band(words):
    return sum((words >= low).cast("int") for low in BANDS) - 1


def _ratio(rule: str):
    top, under = RULES[rule]
    return F.col(top) / F.greatest(F.col(under), F.lit(1))


def first_step():
    """The first step of the path that rejects a row, from 0; STEPS if none does."""
    milder = lambda r: F.size(F.filter(F.array(*[F.lit(c) for c in CUTOFFS]), lambda c: _ratio(r) <= c))
    return F.least(*[F.when(_ratio(r) > min(CUTOFFS), k * len(CUTOFFS) + milder(r)).otherwise(STEPS) for k, r in enumerate(RULES)])


def tried(sizes: list[int], alpha: float, delta: float) -> tuple[float, int]:
    """The level of each test and the good labels that a stratum needs to be tried, for strata with so many good labels: the
    highest level delta / k at which no more than k strata are."""
    k = 1
    while sum(n >= least_trials(alpha, delta / k) for n in sizes) > k:
        k += 1
    return delta / k, least_trials(alpha, delta / k)


def calibrate(facts: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> dict[tuple[str | None, int], int]:
    """How many steps of the path are used in each stratum (lang, band) that is tried.

    ``facts`` has id, lang, measures and base_failed, ``labels`` id and good. All labelled documents that pass the base rules
    count. What reaches the driver are counts by label and step of the strata with as many good labels as a single test
    needs, so dirty languages don't.
    """
    rows = facts.where("not base_failed").join(labels, "id").select("lang", _band(F.col("n_words")).alias("band"), "good", first_step().alias("step"))
    by_step = keep(rows.groupBy("lang", "band", "good", "step").count(), "steps")
    large = by_step.groupBy(F.col("lang").alias("_lang"), F.col("band").alias("_band")).agg(F.sum(F.when(F.col("good"), F.col("count")).otherwise(0)).alias("n")).where(F.col("n") >= least_trials(alpha, delta))
    counts: dict = {}
    for r in by_step.join(large, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("band") == F.col("_band"))).collect():
        counts.setdefault((r["lang"], r["band"]), np.zeros((2, STEPS + 1), np.int64))[int(r["good"]), r["step"]] += r["count"]
    level, least = tried([int(n[1].sum()) for n in counts.values()], alpha, delta)
    used = {}
    for stratum, n in counts.items():
        if n[1].sum() < least:
            continue
        bad, good = np.cumsum(n, axis=1).tolist()
        held = next((k for k in range(STEPS) if not upper_bound_holds(good[k], good[-1], alpha, level)), STEPS)
        gain = [0] + [bad[k] * good[-1] - good[k] * bad[-1] for k in range(held)]
        used[stratum] = gain.index(max(gain))
    return used


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "quality", alpha: float = ALPHA, delta: float = DELTA, keep_text: bool = True) -> DataFrame:
    """Every row of docs with MEASURES, ``base_failed`` and ``kept``.

    Base rules reject texts of fewer than 50 words or with over half of their words in repeated runs of three; the
    others are kept unless a step that is used in their stratum rejects them (see above); in a stratum that is not tried, all are. ``labels`` has one 0/1 label
    (1: good) per document; a document labelled twice is good if either label says so; labels of unknown documents and
    null labels don't count. A null text has no words, a null language is a language of its own, very long texts are
    measured whole, and repeated rows are judged alike. A ratio equal to a cutoff is not beyond it. Columns of docs with the
    names of new ones are replaced; others stay as they are. An empty table gives an empty one. With
    ``keep_text=False`` the text is left out of the result, and texts are measured once instead of twice.
    """
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = with_measures(docs.drop("base_failed", "kept"), text_col).withColumn("base_failed", base)
    if keep_text:  # measuring again costs less than a second copy of all texts
        facts = with_measures(docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")))
        facts = keep(facts.drop("text").withColumn("base_failed", base), "measures")
    else:
        judged = keep(judged.drop(text_col), "measures")
        facts = judged.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), *MEASURES, "base_failed")
    given = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg((F.max(label_col) == 1).alias("good"))
    steps = calibrate(facts, given, alpha, delta)

    lang, band, step = unused(judged, "of_lang", "of_band", "steps")
    limits = judged.sparkSession.createDataFrame([(*k, v) for k, v in steps.items()], f"{lang} string, {band} int, {step} int")
    limits = F.broadcast(limits) if len(steps) <= BROADCAST_STRATA else limits
    same = F.col(f"`{lang_col}`").eqNullSafe(F.col(lang)) & (_band(F.col("n_words")) == F.col(band))
    rows = judged.join(limits, same, "left")
    return rows.withColumn("kept", ~F.col("base_failed") & (first_step() >= F.coalesce(step, F.lit(0)))).drop(lang, band, step)
