"""Quotation linking: which message answers which, from the passages that it quotes, and the order of reading.

Lines that begin with ``>`` are quotes; as many marks, as many levels. A line that introduces a quote ("... wrote:") and
the quotes themselves are left out of a message's own text. A quoted passage is a run of lines of one level; it is known
by the hash of its normalised text (white space made single, lower case), as are its lines. These hashes are joined to
the own lines and whole own texts of earlier messages of the conversation: an as-of join, each quote with the latest
earlier match, so a line that is quoted everywhere makes no pairs. A message answers the message that most of its
passages of the lowest matched level come from, the later one of equals; without a match it answers the message before it.
Replies are read depth first: a message, then the answers to it by turn, each with its own answers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.llm.shared import drop, keep, new_path

_MARKS = r"^(?:[ \t]*>)+"
_INTRODUCES = r"(?i)(wrote|writes|schrieb|escribió|a écrit)\s*:\s*$"
_FIRST = -(1 << 40)


def _normal(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def _hash(text: Column) -> Column:
    return F.unhex(F.md5(_normal(text)))


def parse(text: Column) -> Column:
    """Struct of ``own`` (the text without quotes and their introductions) and ``lines``, an array of (level, text,
    passage number) of all lines."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    level = lambda x: F.length(F.regexp_replace(F.regexp_extract(x, _MARKS, 0), "[^>]", ""))
    cut = F.transform(lines, lambda x: F.struct(level(x).alias("level"), F.regexp_replace(x, _MARKS + "[ ]?", "").alias("text")))
    following = lambda i: F.coalesce(F.get(cut, i + 1)["level"], F.lit(0))
    marked = F.transform(cut, lambda x, i: F.struct(x["level"].alias("level"), x["text"].alias("text"), ((x["level"] == 0) & (following(i) > 0) & x["text"].rlike(_INTRODUCES)).alias("intro")))
    return F.transform(marked, lambda x: F.struct(F.when(x["intro"], F.lit(-1)).otherwise(x["level"]).alias("level"), x["text"].alias("text")))


def _last_before(df: DataFrame, keys: list[str], value: Column, out: str, spans: DataFrame) -> DataFrame:
    """The greatest value of the rows of equal keys with a smaller turn. Rows of one turn are made one first; windows then go
    over the turns of a key in one span, and over a row per span."""
    turns = df.groupBy(*keys, "at").agg(F.max(value).alias("_v")).join(spans, ["c", "at"])
    inside = Window.partitionBy(*keys, "span").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    whole = turns.groupBy(*keys, "span").agg(F.max("_v").alias("_m"))
    whole = whole.withColumn("_before", F.max("_m").over(Window.partitionBy(*keys).orderBy("span").rowsBetween(Window.unboundedPreceding, -1))).drop("_m")
    turns = turns.withColumn("_in", F.max("_v").over(inside)).join(whole, [*keys, "span"])
    return df.join(turns.select(*keys, "at", F.coalesce("_in", "_before").alias(out)), [*keys, "at"])


def _jump(df: DataFrame, name: str) -> DataFrame:
    """Follow ``next`` to its end by doubling: adds up ``far`` on the way. df has node, next, far and end (the last node
    reached). Rows that have arrived take no part in a join any more."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df = keep(df, name, path)
    while df.where("next is not null").limit(1).count():
        to = df.select(F.col("node").alias("_n"), F.col("next").alias("_x"), F.col("far").alias("_f"), F.col("end").alias("_e"))
        moved = df.where("next is not null").join(to, F.col("next") == F.col("_n"))
        moved = moved.select("node", F.col("_x").alias("next"), (F.col("far") + F.col("_f")).alias("far"), F.col("_e").alias("end"))
        there = new_path(spark, name)
        new = keep(df.where("next is null").unionByName(moved), name, there)
        drop(path, spark)
        path, df = there, new
    return df


def link_quotes(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per message: conv_id, turn, role, ``own_text``, ``copies``, ``n_quotes`` (passages), ``n_linked`` (those found in
    an earlier message of the conversation), ``reply_turn`` (the turn it answers; null for a conversation's first), ``depth``
    (answers above it) and ``position`` (place in the reading order of its conversation, from 1).

    Equal rows are one message with their number of copies. A null text is empty; null turns come first, and messages of
    one turn answer what comes before that turn; a null conversation is one of its own; an empty table stays empty. All
    steps are joins, aggregations and windows over a bounded number of messages, so one conversation or turn may hold any share
    of the rows; very long texts are cut into their lines; further columns are ignored; replies are followed by doubling, in rounds that grow with the logarithm of the longest conversation.
    """
    conv, turn = F.col(conv_col), F.col(turn_col)
    rows = messages.groupBy(conv.alias("conv"), turn.cast("long").alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")).agg(F.count("*").alias("copies"))
    shown = [F.coalesce(F.concat(F.lit("v"), c.cast("string")), F.lit("n")) for c in (F.col("conv"), F.col("turn"), F.col("role"), F.col("text"))]
    rows = rows.withColumn("c", F.unhex(F.md5(shown[0]))).withColumn("node", F.unhex(F.md5(F.concat_ws("\x1f", *shown)))).withColumn("at", F.coalesce("turn", F.lit(_FIRST)))
    lines = parse(F.col("text"))
    rows = rows.withColumn("lines", lines).withColumn("own_text", F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["text"]), "\n"))
    rows = rows.withColumn("own_text", F.regexp_replace(F.regexp_replace("own_text", r"^\s+|\s+$", ""), r"\n\s*\n\s*\n+", "\n\n"))
    rows = rows.withColumn("lines", F.when(F.exists("lines", lambda x: x["level"] > 0), F.col("lines")))
    rows = keep(rows.select("conv", "turn", "role", "copies", "c", "node", "at", "own_text", "lines"), "messages")

    # spans: ranges of conversation, turn and name with about equally many messages, so windows within one are bounded
    # whatever turns look like; a turn belongs to the first span that has it
    placed = rows.select("c", "node", "at").repartitionByRange("c", "at", "node").withColumn("own_span", F.spark_partition_id())
    placed = keep(placed, "placed")
    spans = keep(placed.groupBy("c", "at").agg(F.min("own_span").alias("span")), "spans")

    # passages: runs of lines of one level
    each = rows.where("lines is not null").select("c", "node", "at", F.posexplode("lines").alias("k", "line"))
    each = each.select("c", "node", "at", "k", "line.level", "line.text")
    by_line = Window.partitionBy("node").orderBy("k")
    each = each.withColumn("new", F.coalesce((F.lag("level").over(by_line) != F.col("level")).cast("int"), F.lit(1)))
    each = each.withColumn("passage", F.sum("new").over(by_line)).where("level > 0 and trim(text) != ''")
    quoted = each.groupBy("c", "node", "at", "passage", "level").agg(F.array_sort(F.collect_list(F.struct("k", "text"))).alias("t"))
    quoted = quoted.withColumn("t", F.transform("t", lambda x: x["text"]))
    units = F.array_distinct(F.concat(F.transform("t", _hash), F.array(_hash(F.array_join("t", " ")))))
    asked = quoted.select("c", "node", "at", "passage", "level", F.explode(units).alias("hash"))
    own = F.filter(F.split("own_text", "\n"), lambda x: F.trim(x) != "")
    told = rows.where("trim(own_text) != ''").select("c", "node", "at", F.explode(F.array_distinct(F.concat(F.transform(own, _hash), F.array(_hash(F.col("own_text")))))).alias("hash"))
    told = told.join(asked.select("c", "hash").distinct(), ["c", "hash"], "left_semi")
    source = F.struct("at", "node")
    both = asked.withColumn("source", F.lit(None).cast("struct<at:bigint,node:binary>")).unionByName(told.withColumn("source", source), allowMissingColumns=True)
    matched = _last_before(both, ["c", "hash"], F.col("source"), "found", spans).where("level is not null and found is not null")
    votes = matched.groupBy("node", "level", "passage", "found").agg(F.count("*").alias("n"))
    linked = votes.groupBy("node").agg(F.countDistinct("passage").alias("n_linked"))
    best = votes.groupBy("node", "level", "found").agg(F.sum("n").alias("n")).groupBy("node").agg(F.max(F.struct((-F.col("level")).alias("low"), "n", "found")).alias("best"))
    passages = quoted.groupBy("node").agg(F.count("*").alias("n_quotes"))

    # texts are joined last: what moves until then are names
    tree = _last_before(placed, ["c"], source, "previous", spans)
    tree = tree.join(best.select("node", F.col("best.found").alias("answered")), "node", "left").join(linked, "node", "left").join(passages, "node", "left")
    tree = tree.withColumn("parent", F.coalesce("answered", "previous"))
    tree = keep(tree.drop("answered", "previous"), "tree")

    # reading order: first answer, else next answer to the same message, else that of the nearest message above that has one
    up = tree.select("c", "node", "at", F.coalesce("parent.node", "c").alias("above"), F.col("own_span").alias("span"))
    in_span = Window.partitionBy("above", "span").orderBy("at", "node")
    firsts = up.groupBy("above", "span").agg(F.min(F.struct("at", "node")).alias("first"))
    firsts = firsts.withColumn("later", F.lead("first.node").over(Window.partitionBy("above").orderBy("span"))).drop("first")
    beside = up.withColumn("next", F.lead("node").over(in_span)).join(firsts, ["above", "span"]).select("c", "node", "above", F.coalesce("next", "later").alias("beside"))
    beside = keep(beside, "beside")
    child = up.groupBy("above").agg(F.min(F.struct("at", "node")).alias("first")).select(F.col("above").alias("of"), F.col("first.node").alias("child"))
    climb = beside.select("node", F.when(F.col("beside").isNull() & (F.col("above") != F.col("c")), F.col("above")).alias("next"), F.lit(0).cast("long").alias("far"), F.col("node").alias("end"))
    climb = climb.withColumn("end", F.coalesce("next", "end"))
    over = _jump(climb, "climb").select("node", "end").join(beside.select(F.col("node").alias("end"), F.col("beside").alias("then")), "end")
    order = over.join(child, over.node == child.of, "left").select("node", F.coalesce("child", "then").alias("next"))
    order = order.select("node", "next", F.when(F.col("next").isNotNull(), 1).otherwise(0).cast("long").alias("far"), F.coalesce("next", "node").alias("end"))
    left = _jump(order, "order").select("node", F.col("far").alias("left"))
    depth = tree.select("node", F.col("parent.node").alias("next"), F.when(F.col("parent").isNotNull(), 1).otherwise(0).cast("long").alias("far"), F.coalesce("parent.node", "node").alias("end"))
    depth = _jump(depth, "depth").select("node", F.col("far").alias("depth"))
    size = tree.groupBy("c").agg(F.count("*").alias("size"))
    found = tree.select("c", "node", "parent", "n_quotes", "n_linked").join(left, "node").join(depth, "node").join(size, "c").drop("c")
    out = rows.select("conv", "turn", "role", "own_text", "copies", "node").join(found, "node")
    zero = F.lit(0).cast("long")
    answers = F.when(F.col("parent").isNotNull() & (F.col("parent.at") != _FIRST), F.col("parent.at"))
    return out.select(F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col), "own_text", "copies", F.coalesce("n_quotes", zero).alias("n_quotes"), F.coalesce("n_linked", zero).alias("n_linked"), answers.alias("reply_turn"), "depth", (F.col("size") - F.col("left")).alias("position"))
