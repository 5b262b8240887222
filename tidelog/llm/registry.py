"""Queries over the numbered operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op9_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents by 4-word shingles at 0.85."""
    from tidelog.llm.jaccard import jaccard_join

    return jaccard_join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated 35-word windows."""
    from tidelog.llm.substring import remove_repeats

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = remove_repeats(docs, width=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


#: Rules of op5: host, path, verdict.
OP5_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict of five fixed rules on every page's URL."""
    from tidelog.llm.urlrules import judge_urls, rule_table

    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rule_table(spark, OP5_RULES))


OP5_SQL = """
with cut as (
  select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end rest from pages),
parts as (
  select page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) path, row_number() over () n from cut),
rules(rule_host, rule_path, rule_verdict) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fit as (
  select p.*, rule_host || rule_path rule, rule_verdict,
         row_number() over (partition by p.n order by length(rule_host || rule_path) desc nulls last) best
  from parts p left join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path))
select page_id, host, path, rule, coalesce(rule_verdict, 'allow') verdict from fit where best = 1
"""

def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources takes of every document."""
    from tidelog.llm.mixing import mix

    _, taken = mix(table(spark, sf_dir, "documents"))
    return taken.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


OP1_SQL = r"""
with sized as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) size from documents),
src as (
  select source, cast(sum(size) as bigint) source_size, row_number() over (order by source nulls last) - 1 number from sized group by source),
lim as (select *, 3.0::double * source_size lim, (number % 3 + 1)::double weight from src),
cum as (
  select *, sum(source_size) over ()::double total, sum(weight) over () weights,
         coalesce(sum(lim) over (order by lim / weight, number rows between unbounded preceding and 1 preceding), 0) lim_before,
         coalesce(sum(weight) over (order by lim / weight, number rows between unbounded preceding and 1 preceding), 0) weight_before
  from lim),
capped as (select *, (total - lim_before) / (weights - weight_before) * weight > lim is_full from cum),
goal as (
  select source, source_size, case when is_full then lim else coalesce(weight * ((total - sum(case when is_full then lim else 0 end) over ())
         / nullif(weights - sum(case when is_full then weight else 0 end) over (), 0)), 0) end target from capped),
want as (select *, least(cast(round(target) as bigint), 3 * source_size) want from goal),
placed as (
  select s.doc_id, s.size, w.source_size, w.target, w.want,
         cast(sum(s.size) over (partition by s.source order by md5(concat_ws('|', coalesce(cast(s.doc_id as varchar), ''), coalesce('s' || s.source, 'n'), cast(s.size as varchar)))
           rows between unbounded preceding and current row) as bigint) - s.size start
  from sized s join want w on s.source is not distinct from w.source)
select doc_id, size, source_size, target,
       case when source_size = 0 then 0 else (want // source_size) * size + greatest(0, least(size, want % source_size - start)) end taken
from placed
"""

def op3_bpe_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text's token ids and of what they decode to."""
    import public_tokenizers

    from tidelog.llm.bpe import digests, encode_texts

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = encode_texts(docs, public_tokenizers.path("word_bpe_49k.json"))
    return rows.select("doc_id", "n_tokens", *digests(rows))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and risk-controlled cutoffs over every document."""
    from tidelog.llm.quality import quality_rules

    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    rows = quality_rules(docs, table(spark, sf_dir, "labels"), keep_text=False)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; a third of them is held out from training."""
    from tidelog.llm.langid import predict, train

    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = train(docs.where(~held_out), "text", "lang")
    rows = predict(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids as read back from Arrow files of equal-length sequences."""
    import public_tokenizers

    from tidelog.llm.tokenfile import new_folder, read_tokens, write_tokens

    folder = new_folder(spark)
    docs = table(spark, sf_dir, "documents")
    return read_tokens(write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), folder, end_id=2), folder)


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings by cosine of 0.95 or more."""
    from tidelog.llm.vectors import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"))


def op2_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message without its quotes, with the turn it answers and its place in reading order."""
    from tidelog.llm.quoting import link_quotes

    return link_quotes(table(spark, sf_dir, "conversations")).withColumn("own_sha256", F.sha2("own_text", 256)).drop("own_text")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of two to four words of each language."""
    from tidelog.llm.phrases import collocations

    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
with p as (
  select coalesce(lang, 'und') lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) piece
  from documents),
w as (select lang, row_number() over () piece, regexp_extract_all(piece, '[^\x20\x09]+') w from p),
total as (select lang, cast(sum(len(w)) as bigint) n from w group by lang),
word as (select lang, piece, unnest(w) word, generate_subscripts(w, 1) i from w),
run as (
  select lang, word a, lead(word) over o b, lead(word, 2) over o c, lead(word, 3) over o d from word window o as (partition by piece order by i)),
phrase as (
  select lang, a phrase from run union all select lang, a || ' ' || b from run where b is not null
  union all select lang, a || ' ' || b || ' ' || c from run where c is not null union all select lang, a || ' ' || b || ' ' || c || ' ' || d from run where d is not null),
often as materialized (select lang, phrase, count(*) a from phrase group by all having count(*) >= 30),
f as materialized (select lang, phrase, string_split(phrase, ' ') g, len(string_split(phrase, ' ')) k, a from often),
side as materialized (
  select lang, phrase, a, c, array_to_string(g[1:c], ' ') before, array_to_string(g[c + 1:k], ' ') after from f, unnest([1, 2, 3]) x(c) where c < k),
cut as (
  select side.lang, side.phrase, side.a, c, l.a l, r.a r, (2000000::hugeint * side.a) // (l.a + r.a) score
  from side join often l on l.lang = side.lang and l.phrase = before join often r on r.lang = side.lang and r.phrase = after),
weakest as (select * from (select *, row_number() over (partition by lang, phrase order by score, c) nth from cut) where nth = 1),
inside as materialized (
  select lang, array_to_string(g[s:s + m - 1], ' ') phrase, max(a) above from f, unnest([2, 3]) x(m), unnest([1, 2, 3]) y(s) where m < k and s + m - 1 <= k group by all),
left_over as (select weakest.* from weakest left join inside using (lang, phrase) where above is null or 100::hugeint * above < 80::hugeint * a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) rank from left_over)
select lang, rank, phrase, a, l, r, n, cast(score as bigint) score from ranked join total using (lang) where rank <= 2000
"""


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings by 16 codebooks of 64 entries."""
    from tidelog.llm.codes import compress, digest

    rows, books = compress(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("codebooks_sha256", F.lit(digest(books)))


# The rounds are written out, since each one's entries are sums over the one before.
_OP12_ROUND = """
near{n} as materialized (
  select rid, p, arg_min(e, (d, e)) e, min(d) d
  from (select x.rid, x.p, b.e, list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) d from part x join book{n} b using (p)) group by rid, p),"""
_OP12_NEXT = """
sum{n} as (select p, e, i, cast(sum(v[i]) as hugeint) s, count(*) c from near{n} join part using (rid, p), range(1, 5) z(i) group by p, e, i),
mean{n} as (select p, e, list(cast((s - ((s % c) + c) % c) // c as bigint) order by i) v from sum{n} group by p, e),
book{m} as materialized (select p, e, coalesce(mean{n}.v, book{n}.v) v from book{n} left join mean{n} using (p, e)),"""
OP12_SQL = (
    """
with ok as (
  select vec_id, label, list_transform(embedding, lambda x: cast(floor(256 * x::double) as bigint)) v, row_number() over (order by vec_id nulls last, embedding) rid
  from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
part as materialized (select rid, p, v[4 * p + 1:4 * p + 4] v from ok, range(16) y(p)),
book0 as materialized (select p, rid - 1 e, v from part where rid <= 64),"""
    + _OP12_ROUND.format(n=0) + _OP12_NEXT.format(n=0, m=1) + _OP12_ROUND.format(n=1) + _OP12_NEXT.format(n=1, m=2) + _OP12_ROUND.format(n=2)
    + """
coded as (select rid, string_agg(printf('%02x', e), '' order by p) code, cast(sum(d) as bigint) error from near2 group by rid),
name as (select sha256(string_agg(array_to_string(v, ','), ',' order by p, e)) codebooks_sha256 from book2)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) label_error, codebooks_sha256 from ok join coded using (rid), name
"""
)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, through a cache that is empty at first."""
    import public_tokenizers

    from tidelog.llm.shared import new_path
    from tidelog.llm.tokencount import CountCache, token_counts

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, public_tokenizers.path("word_bpe_49k.json"), CountCache(spark, new_path(spark, "counts")))


# Steps of the path: rule by rule, from the mildest cutoff on. One holds if the binomial sum up to its hits is at most 0.05 over
# the strata that are tried.
OP6_SQL = r"""
with d as (
  select doc_id, lang, row_number() over () rid, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
tri as (select rid, i, w[i:i + 2] g from d, unnest(range(1, len(w) - 1)) x(i)),
twice as (select rid, i from (select rid, i, count(*) over (partition by rid, g) n from tri) where n > 1),
cover as (select rid, count(distinct i + k) n from twice, unnest([0, 1, 2]) y(k) group by rid),
line as (select rid, l from d, unnest(string_split(t, chr(10))) y(l) where regexp_matches(l, '[^\x20\x09-\x0D]')),
lines as (select rid, count(*) n, count(*) - count(distinct l) dup from line group by rid),
m as (
  select doc_id, lang, d.rid, len(w) n_words, coalesce(length(array_to_string(w, '')), 0) word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) n_symbols, length(t) - length(regexp_replace(t, '[!?]', '', 'g')) n_bangs,
         coalesce(lines.dup, 0) n_dup_lines, coalesce(lines.n, 0) n_lines, coalesce(cover.n, 0) n_repeat_words
  from d left join lines using (rid) left join cover using (rid)),
j as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed, case when n_words >= 150 then 1 else 0 end band,
         {'symbols': n_symbols / greatest(word_chars, 1), 'bangs': n_bangs / greatest(word_chars, 1),
          'repeats': n_repeat_words / greatest(n_words, 1), 'lines': n_dup_lines / greatest(n_lines, 1)} ratio
  from m),
ratios as (
  select rid, doc_id, lang, band, base_failed, unnest(['symbols', 'bangs', 'repeats', 'lines']) rule,
         unnest([ratio.symbols, ratio.bangs, ratio.repeats, ratio.lines]) r from j),
given as (
  select doc_id, max(quality) = 1 good from labels where quality is not null and doc_id is not null group by doc_id),
cuts as (select unnest([0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.05])::double cut, unnest(range(15)) nth),
path as (select rule, cut, 15 * k + nth step from cuts, (select unnest(['symbols', 'bangs', 'repeats', 'lines']) rule, unnest(range(4)) k)),
first as (select rid, min(step) step from ratios r join path p using (rule) where r.r > p.cut group by rid),
held as (
  select j.lang, j.band, g.good, coalesce(f.step, 60) step from j join given g using (doc_id) left join first f using (rid) where not base_failed),
strata as (select lang, band, count(*) n from held where good group by lang, band),
level as (
  select 0.05 / min(k) p from range(1, 1 + (select greatest(count(*), 1) from strata)) x(k)
  where (select count(*) from strata where n >= ceil(ln(0.05 / k) / ln(0.98))) <= k),
own as (select lang, band from strata, level where n >= ceil(ln(p) / ln(0.98))),
hits as (
  select h.lang, h.band, p.step, count(*) filter (where good) n, count(*) filter (where good and h.step <= p.step) hits,
         count(*) filter (where not good) n_bad, count(*) filter (where not good and h.step <= p.step) bad
  from held h join own o on o.lang is not distinct from h.lang and o.band = h.band, path p group by h.lang, h.band, p.step),
tests as (
  select *, (select sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.02) + (n - i) * ln(0.98))) from unnest(range(hits + 1)) z(i)) tail
  from hits),
passed as (select *, min(case when hits >= n or tail > p then step else 60 end) over (partition by lang, band order by step) = 60 holds from tests, level),
used as (
  select lang, band, arg_max(step, (bad * n - hits * n_bad, -step)) + 1 steps from passed
  where holds and bad * n > hits * n_bad group by lang, band)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and coalesce(f.step, 60) >= coalesce(u.steps, 0) kept
from j left join first f using (rid) left join used u on u.lang is not distinct from j.lang and u.band = j.band
"""

OP7_SQL = r"""
with d as (
  select doc_id, row_number() over () rid, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
win as (select rid, i, array_to_string(w[i:i + 34], ' ') k from d, unnest(range(1, len(w) - 33)) t(i)),
often as (select k from win group by k having count(*) > 1),
dup as (select rid, i from win join often using (k)),
word as (select rid, p, w[p] word from d, unnest(range(1, len(w) + 1)) t(p)),
flag as (
  select word.rid, p, word, max(case when dup.i is not null then 1 else 0 end)
           over (partition by word.rid order by p rows between 34 preceding and current row) gone
  from word left join dup on dup.rid = word.rid and dup.i = word.p),
total as (
  select rid, count(*) n, cast(sum(gone) as bigint) gone, string_agg(word, ' ' order by p) filter (where gone = 0) kept from flag group by rid)
select doc_id, coalesce(n, 0) n_words, coalesce(gone, 0) n_removed, sha256(coalesce(kept, '')) kept_sha256 from d left join total using (rid)
"""

OP9_SQL = r"""
with recursive d as (
  select doc_id, row_number() over () rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents),
s as (
  select distinct rid, g from (
    select rid, array_to_string(w[i:i + 3], ' ') g from d, unnest(range(1, len(w) - 2)) t(i) where len(w) >= 4
    union all select rid, array_to_string(w, ' ') from d where len(w) between 1 and 3)),
n as (select rid, count(*) n from s group by rid),
pair as (select a.rid x, b.rid y, count(*) c from s a join s b on a.g = b.g and a.rid < b.rid group by all),
link as (select x, y from pair join n nx on nx.rid = x join n ny on ny.rid = y where 100 * c >= 85 * (nx.n + ny.n - c)),
edge as (select x, y from link union all select y, x from link),
reach(rid, other) as (select rid, rid from d union select r.rid, e.y from reach r join edge e on r.other = e.x),
comp as (select r.rid, min(o.doc_id) component_id from reach r join d o on o.rid = r.other group by r.rid)
select doc_id, coalesce(n, 0) n_shingles, component_id from d left join n using (rid) join comp using (rid)
"""

OP10_SQL = """
with recursive v as (select vec_id, row_number() over () rid, cast(embedding as double[]) e from embeddings),
ok as (select * from v where e is not null and len([x for x in e if x is null or not isfinite(x)]) = 0 and list_dot_product(e, e) > 0),
link as (select a.rid x, b.rid y from ok a join ok b on a.rid < b.rid and list_cosine_similarity(a.e, b.e) >= 0.95),
edge as (select x, y from link union all select y, x from link),
reach(rid, other) as (select rid, rid from v union select r.rid, e.y from reach r join edge e on r.other = e.x),
comp as (select r.rid, min(o.vec_id) component_id from reach r join v o on o.rid = r.other group by r.rid),
n as (select x rid, count(*) n from edge group by x)
select vec_id, coalesce(n, 0) n_links, component_id, vec_id = component_id kept from v join comp using (rid) left join n using (rid)
"""

QUERIES = {
    "op2_quote_links": op2_quote_links,
    "op10_near_vectors": op10_near_vectors,
    "op8_token_files": op8_token_files,
    "op4_language_id": op4_language_id,
    "op6_quality_rules": op6_quality_rules,
    "op3_bpe_encode": op3_bpe_encode,
    "op1_source_mix": op1_source_mix,
    "op5_url_filter": op5_url_filter,
    "op7_substring_dedup": op7_substring_dedup,
    "op9_jaccard_components": op9_jaccard_components,
    "op11_collocations": op11_collocations,
    "op12_vector_codes": op12_vector_codes,
    "op13_token_counts": op13_token_counts,
}

ORACLES: dict[str, str] = {
    "op1_source_mix": OP1_SQL,
    "op5_url_filter": OP5_SQL,
    "op6_quality_rules": OP6_SQL,
    "op7_substring_dedup": OP7_SQL,
    "op9_jaccard_components": OP9_SQL,
    "op10_near_vectors": OP10_SQL,
    "op11_collocations": OP11_SQL,
    "op12_vector_codes": OP12_SQL,
}
