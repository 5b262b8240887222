"""Mixing sources to target weights by a low-discrepancy schedule, as DataFrame operations only.

The documents of a source, shuffled by a hash, form one stream of words, cut into blocks of equally many words.
Slots of the mix are points of a golden-ratio sequence; where a point falls among the cumulative targets gives the
slot's source, and the slot's rank among those of its source gives its block, round after round. So any stretch of
the mix holds the sources nearly in proportion. A source whose slots run out before its target gets the missing
ones at the end, and the last slot is cut, so its words meet the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.llm.shared import keep

#: Words as the corpus counts them.
WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 1024
#: Documents that one task puts in order, and slots that one task ranks.
ORDERED = 4096
RANKED = 1 << 16
#: Pieces of the unit interval that points and targets are joined by.
BINS = 4096


def shuffle_key(id_col: Column, source: Column, size: Column) -> Column:
    """What documents are shuffled by; equal for rows that are alike in all three."""
    return F.md5(F.concat_ws("|", F.coalesce(id_col.cast("string"), F.lit("")), F.coalesce(F.concat(F.lit("s"), source), F.lit("n")), size.cast("string")))


def targets(sizes: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Words that each source is to give, of (source, source_size) rows.

    Sources in code point order, null last, weigh as ``cycle`` repeats. They share the sum of all sizes by weight;
    none gives more than ``most`` times its size, and what is cut off is shared again by weight until none is above.
    (In ascending order of limit by weight, a source is at its limit if the share left when all before it are at
    theirs exceeds it.) The table has one row per source, which one task orders.
    Returns source, source_size, number (from 0), target (double) and want, the target as a whole number of words.
    """
    every = Window.partitionBy()
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    weight = F.element_at(F.array(*[F.lit(w) for w in cycle]), F.pmod(F.col("number"), F.lit(len(cycle))) + 1)
    rows = sizes.withColumn("number", F.row_number().over(by_name) - 1).withColumn("weight", weight.cast("double"))
    rows = rows.withColumn("limit", (most * F.col("source_size")).cast("double"))
    before = Window.orderBy(F.col("limit") / F.col("weight"), "number").rowsBetween(Window.unboundedPreceding, -1)
    total, weights = F.sum("source_size").over(every), F.sum("weight").over(every)
    share = (total - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / (weights - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    rows = rows.withColumn("full", share * F.col("weight") > F.col("limit")).withColumn("total", total)
    full = [F.sum(F.when(F.col("full"), F.col(c)).otherwise(0.0)).over(every) for c in ("limit", "weight")]
    left = F.try_divide(F.col("total") - full[0], weights - full[1])
    rows = rows.withColumn("target", F.when(F.col("full"), F.col("limit")).otherwise(F.coalesce(F.col("weight") * left, F.lit(0.0))))
    return rows.select("source", "source_size", "number", "target", F.least(F.round("target").cast("long"), most * F.col("source_size")).alias("want"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cycle: tuple[int, ...] = (1, 2, 3), most: int = 3) -> tuple[DataFrame, DataFrame]:
    """The mix, and what it takes of every document.

    The first table has a row per slot and document in it: slot, epoch, source number, id, the document's place
    ``row`` in its source's order, ``from_word`` and ``words``. The second has a row per row of docs: id, source,
    key, size (words of the text; of a null one 0), source_size, target and taken.
    Null sources are a source of their own, null ids and repeated rows take part as rows. Documents without words
    are taken 0 times. No document gives more than ``most`` times its words. An empty table gives empty tables.
    Reruns give the same mix, as the order follows only id, source and size; rows alike in these are interchangeable. Very long
    texts are cut over several blocks. Other columns of docs are ignored.

    Documents are put in order in groups of about ORDERED by the first bits of their hash and slots are ranked in
    runs of RANKED, with sums over groups and runs added, so one source may hold any share of the rows.
    """
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), size.alias("size"))
    sized = keep(sized.withColumn("key", shuffle_key(F.col("id"), F.col("source"), F.col("size"))), "sized")
    goal = keep(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), cycle, most), "targets")
    rows, total = sized.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    block = max(16, min(BLOCK_WORDS, total // 1024))
    groups = max(1, rows // ORDERED)

    # each document's place in its source's stream
    slim = goal.select(F.col("source").alias("of"), "source_size", "number", "target", "want")
    at = sized.join(slim, sized.source.eqNullSafe(slim["of"])).drop("of")
    at = at.withColumn("group", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * groups / (1 << 32)).cast("int"))
    sums = at.groupBy("number", "group").agg(F.sum("size").alias("words"))
    base = sums.select("number", "group", (F.sum("words").over(Window.partitionBy("number").orderBy("group")) - F.col("words")).alias("base"))
    inside = Window.partitionBy("number", "group").orderBy("key")
    at = at.withColumn("row", F.row_number().over(inside)).withColumn("upto", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    at = at.join(base, ["number", "group"]).withColumn("start", F.col("base") + F.col("upto") - F.col("size")).drop("base", "upto")

    # its pieces, by block; a document without words has one in a block that no slot takes, of many so that they don't meet
    none = F.array(-1 - F.pmod(F.xxhash64("key"), F.lit(1 << 20)))
    blocks = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))).otherwise(none)
    pieces = at.withColumn("block", F.explode(blocks))
    edge = F.col("block") * block
    pieces = pieces.withColumn("lo", F.greatest(F.col("start") - edge, F.lit(0))).withColumn("hi", F.least(F.col("start") + F.col("size") - edge, F.lit(block).cast("long")))

    # the schedule
    cum = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    span = F.sum("target").over(Window.partitionBy())
    parts = goal.where("want > 0").select("number", "source_size", "want", (F.sum("target").over(cum) / span).alias("up"), F.col("target"), span.alias("span"))
    parts = parts.withColumn("down", F.col("up") - F.col("target") / F.col("span"))
    rounds = F.ceil(F.col("source_size") / block)
    slots_needed = F.floor(F.col("want") / F.col("source_size")) * rounds + F.ceil((F.col("want") % F.col("source_size")) / block)
    parts = parts.withColumn("rounds", rounds).withColumn("slots", slots_needed)
    n_slots = -(-total // block)
    point = F.pmod(F.pmod(F.col("slot"), F.lit(1 << 31)) * F.lit(2654435769), F.lit(1 << 32)) / F.lit(float(1 << 32))
    points = spark.range(n_slots).select(F.col("id").alias("slot")).withColumn("point", point).withColumn("bin", F.floor(F.col("point") * BINS))
    reach = F.sequence(F.floor(F.greatest(F.col("down"), F.lit(0.0)) * BINS), F.floor(F.least(F.col("up"), F.lit(1.0)) * BINS))
    last = F.col("number") == F.max("number").over(Window.partitionBy())
    bounds = parts.withColumn("up", F.when(last, F.lit(2.0)).otherwise(F.col("up"))).select("number", "down", "up", F.explode(reach).alias("bin"))
    lows = Window.partitionBy("bin").orderBy("down")
    bounds = bounds.withColumn("up", F.coalesce(F.lead("down").over(lows), F.lit(2.0))).withColumn("down", F.when(F.row_number().over(lows) == 1, F.lit(-1.0)).otherwise(F.col("down")))
    drawn = points.join(bounds, "bin").where("point >= down and point < up").select("slot", "number", F.floor(F.col("slot") / RANKED).alias("run"))
    runs = drawn.groupBy("number", "run").agg(F.count("*").alias("n"))
    runs = runs.select("number", "run", (F.sum("n").over(Window.partitionBy("number").orderBy("run")) - F.col("n")).alias("base"))
    ranked = drawn.withColumn("rank", F.row_number().over(Window.partitionBy("number", "run").orderBy("slot"))).join(runs, ["number", "run"])
    ranked = ranked.select("slot", "number", (F.col("rank") + F.col("base") - 1).alias("rank"))
    have = runs.join(drawn.groupBy("number", "run").agg(F.count("*").alias("n")), ["number", "run"]).groupBy("number").agg(F.max(F.col("base") + F.col("n")).alias("have"))
    short = parts.join(have, "number", "left").withColumn("have", F.coalesce("have", F.lit(0))).where("have < slots")
    short = short.withColumn("rank", F.explode(F.expr("sequence(have, slots - 1)"))).select((F.lit(n_slots) + F.col("rank") - F.col("have")).alias("slot"), "number", "rank")
    slots = ranked.unionByName(short).join(parts.select("number", "source_size", "want", "rounds", "slots"), "number").where("rank < slots")
    slots = slots.withColumn("epoch", F.floor(F.col("rank") / F.col("rounds"))).withColumn("block", F.col("rank") % F.col("rounds"))
    stop = F.col("want") - F.col("epoch") * F.col("source_size") - F.col("block") * block
    slots = slots.select("slot", "epoch", "number", "block", stop.alias("stop"))

    met = pieces.join(slots, ["number", "block"], "left").withColumn("words", F.coalesce(F.greatest(F.least(F.col("hi"), F.coalesce("stop", F.lit(0))) - F.col("lo"), F.lit(0)), F.lit(0)))
    sequence = met.where("words > 0").select("slot", "epoch", "number", "id", "group", "row", (F.col("block") * block + F.col("lo") - F.col("start")).alias("from_word"), "words")
    taken = met.groupBy("number", "group", "row").agg(*[F.first(c).alias(c) for c in ("id", "source", "key", "size", "source_size", "target")], F.sum("words").alias("taken"))
    return sequence, taken.select("id", "source", "key", "size", "source_size", "target", "taken")
