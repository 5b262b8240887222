"""URL rules by host suffix and path prefix, as DataFrame operations only.

Each URL expands into expressions: every suffix of its host at a label boundary, with every prefix of its path
that ends with a slash, and with the empty path. A rule is filed under the expression of its host and its path
up to the last slash. Expressions and rules meet in an equi-join on the first 32 bits of their SHA-256; then the
full digests and what the rule's path has after its last slash are compared, and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: As many rules are broadcast at most (a few MB); more are joined by a salted shuffle.
BROADCAST_RULES = 20_000
SALTS = 32
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both are empty if it is null or has no ``://``."""
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _UPPER.lower())
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A DataFrame of (host, path, verdict) rules."""
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _prefix(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """The verdict on every row of pages.

    ``rules`` has host, path and verdict (allow or block). A rule fits its host and all subdomains if the path of
    the URL starts with the rule's. The rule with the longest host and path together wins, then that with the
    longer host, then block before allow. Without a fitting rule the verdict is ``default``.
    Returns one row per input row, repeated rows included: the id, ``host``, ``path``, ``rule`` (host and path of
    the rule, else null) and ``verdict``. A null URL or one without ``://`` has an empty host and path and fits no
    rule. Rules with a null in them fit nothing. Very long URLs are judged whole; an empty table of pages gives an empty one,
    one of rules the default. Other columns of pages are ignored.

    Rows are grouped by id and URL once; with few rules (BROADCAST_RULES at most, counted) they are broadcast
    and all else happens within that partitioning. With more, expressions of a host that very many URLs share
    are dealt over SALTS tasks, which each get the rules.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).groupBy("id", "url").agg(F.count("*").alias("copies"))
    urls = urls.select("id", host.alias("host"), path.alias("path"), "url", "copies")

    rules = rules.select("host", "path", "verdict").dropna()
    folder = F.regexp_extract("path", r"^(.*/)?", 0)
    digest = F.sha2(F.concat("host", F.lit("\n"), folder), 256)
    # the URL's host is lower-cased, so a rule's is too
    rules = rules.withColumn("host", F.translate("host", _UPPER, _UPPER.lower()))
    rules = rules.select(
        _prefix(digest).alias("rule_key"),
        digest.alias("rule_digest"),
        F.col("path").alias("rule_path"),
        F.struct((F.length("host") + F.length("path")).alias("length"), F.length("host").alias("host_length"), (F.col("verdict") == "block").alias("block"), F.concat("host", "path").alias("rule"), "verdict").alias("found"),
        F.size(F.split("host", r"\.")).alias("labels"),
        (F.size(F.split("path", "/")) - 1).alias("steps"),
    )

    # a.b.c -> a.b.c, b.c, c;  /x/y/z -> "", /, /x/, /x/y/; no more of either than the rules have
    n_rules, most_labels, most_steps = rules.agg(F.count("*"), F.coalesce(F.max("labels"), F.lit(1)), F.coalesce(F.max("steps"), F.lit(0))).first()
    rules = rules.drop("labels", "steps")
    labels, steps = F.split("host", r"\."), F.split("path", "/")
    hosts = F.transform(F.sequence(F.greatest(F.lit(1), F.size(labels) - (most_labels - 1)), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    ends = F.least(F.size(steps) - 1, F.lit(most_steps))
    ends = F.when(ends > 0, F.sequence(F.lit(1), ends)).otherwise(F.array().cast("array<int>"))
    folders = F.concat(F.array(F.lit("")), F.transform(ends, lambda i: F.concat(F.array_join(F.slice(steps, 1, i), "/"), F.lit("/"))))
    each = urls.withColumn("h", F.explode(hosts)).withColumn("digest", F.explode(F.transform(folders, lambda f: F.sha2(F.concat("h", F.lit("\n"), f), 256))))
    each = each.withColumn("key", _prefix(F.col("digest")))

    on = (each.key == rules.rule_key) & (each.digest == rules.rule_digest) & F.startswith(each.path, rules.rule_path)
    if n_rules <= BROADCAST_RULES:
        met = each.join(F.broadcast(rules), on, "left")
    else:
        each = each.withColumn("salt", F.pmod(F.xxhash64("id", "url", "digest"), F.lit(SALTS)).cast("int"))
        rules = rules.withColumn("rule_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = each.join(rules, on & (each.salt == rules.rule_salt), "left")
    best = met.groupBy("id", "url").agg(F.first("host").alias("host"), F.first("path").alias("path"), F.first("copies").alias("copies"), F.max("found").alias("found"))
    out = best.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return out.select(F.col("id").alias(id_col), "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", F.lit(default)).alias("verdict"))
