"""Mixing sources to target weights by weighted fair queueing. DataFrame functions only.

* Size of a document: its words. Sources in code point order, null last, weigh 5, 2, 1, repeating. They share a
  budget of 150 % of all words by weight; a target stops at twice its source's words (every document at most twice)
  and the excess goes to the others by weight until none is above (water filling, in closed form: a source is
  full if its limit over its weight lies below the water line).
* Each source's documents queue in shuffled order (a hash of seed, doc_id and text), first all of them once, then
  all of them again. A queue entry's virtual finish time is the words of its source up to and with it, over the
  source's target. Entries of all sources are sorted by finish time and taken while the words of the mix stay
  within the budget; time 1 is where each source meets its target.
* Running sums never need one source or one time span in one task: a source's queue is split by hash range into
  parts, times into bins; parts and bins are summed first and each adds the sum of those before it. Rows alike in
  source, order key, doc_id and size are one queue entry with a count.

Nulls: a null text has size 0, a null source is a source. Documents without words take 0. A source without words
has target 0. Empty table: no rows. Further columns are ignored. Reruns agree, whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickframe.llm.common import WORD, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2
#: Parts of each source's queue, and bins of a unit of virtual time.
PARTS = 256
BINS = 2048


def words(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, weight, target: one row a source."""
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    whole = Window.partitionBy()
    ranked = per.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("_rank") % len(WEIGHTS) + 1).cast("int")))
    ranked = ranked.withColumn("_limit", F.col("source_size") * LIMIT).withColumn("_ratio", F.col("_limit") / F.col("weight"))
    ranked = ranked.withColumn("_budget", F.sum("source_size").over(whole) * F.lit(SHARE)).withColumn("_weights", F.sum("weight").over(whole))
    before = Window.orderBy("_ratio", "_rank").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumn("_full", F.coalesce(F.sum("_limit").over(before), F.lit(0))).withColumn("_gone", F.coalesce(F.sum("weight").over(before), F.lit(0)))
    # the line if all sources before this one in order of ratio are full and this one is not
    ranked = ranked.withColumn("_line", (F.col("_budget") - F.col("_full")) / (F.col("_weights") - F.col("_gone")))
    first = F.min(F.when(F.col("_line") <= F.col("_ratio"), F.struct("_ratio", "_rank", "_line"))).over(whole)
    ranked = ranked.withColumn("_line", first["_line"])
    target = F.when(F.col("_line").isNull() | (F.col("_ratio") < F.col("_line")), F.col("_limit").cast("double")).otherwise(F.col("weight") * F.col("_line"))
    return ranked.select("source", "source_size", "weight", target.alias("target"), F.col("_budget").alias("budget"))


def mix(docs: DataFrame, seed: str = "mix", size=None) -> DataFrame:
    """doc_id, source, text_md5, size, source_size, target, taken for each row; taken / size is the times that it is taken."""
    key = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    rows = docs.select("doc_id", "source", key.alias("text_md5"), (words(F.col("text")) if size is None else size).alias("size"))
    # texts are read once: what is kept of them is small and stored where all executors can read it
    entries = written(rows.groupBy("doc_id", "source", "text_md5", "size").agg(F.count("*").alias("copies")))
    order = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text_md5"))
    plan = targets(entries)  # a row a source; the planner broadcasts it if it is small
    queue = entries.join(plan, entries["source"].eqNullSafe(plan["source"])).drop(plan["source"]).withColumn("_order", order)
    queue = queue.withColumn("_part", F.conv(F.substring("_order", 1, 2), 16, 10).cast("int") % PARTS).withColumn("_words", F.col("size") * F.col("copies"))
    parts = queue.groupBy("source", "_part").agg(F.sum("_words").alias("_sum"))
    w = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("source").alias("_s"), F.col("_part").alias("_p"), F.coalesce(F.sum("_sum").over(w), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("source", "_part").orderBy("_order", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, -1)
    queue = queue.withColumn("_inside", F.coalesce(F.sum("_words").over(inside), F.lit(0)))
    queue = queue.join(parts, queue["source"].eqNullSafe(parts["_s"]) & (queue["_part"] == parts["_p"]))
    # copies of one row: entry k of epoch e ends at offset + k * size
    queue = queue.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    queue = queue.withColumn("_ends", F.col("_offset") + F.col("_inside") + F.col("_copy") * F.col("size"))
    for_epochs = queue.withColumn("_epoch", F.explode(F.array(*[F.lit(e).cast("long") for e in range(LIMIT)])))
    finish = (F.col("_ends") + F.col("_epoch") * F.col("source_size")) / F.col("target")
    timed = for_epochs.filter("target > 0 and size > 0").withColumn("_time", finish)
    timed = timed.withColumn("_bin", F.least(F.floor(F.col("_time") * BINS), F.lit(2 * BINS)).cast("long"))
    # 2 * BINS + 1 bins at most; most of the mix is settled by whole ones, only the bin in which the budget ends is looked at entry by entry
    bins = timed.groupBy("_bin").agg(F.sum("size").alias("_sum"), F.first("budget").alias("budget"))
    running = Window.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("_before", F.coalesce(F.sum("_sum").over(running), F.lit(0)))
    last = bins.select(F.col("_bin").alias("_b"), F.col("_before"), (F.col("_before") + F.col("_sum") <= F.col("budget")).alias("_whole"), (F.col("_before") > F.col("budget")).alias("_none"))
    timed = timed.join(F.broadcast(last), F.col("_bin") == F.col("_b")).filter(~F.col("_none"))
    within = Window.partitionBy("_bin").orderBy("_time", F.col("source").asc_nulls_last(), "_order", F.col("doc_id").asc_nulls_last(), "_epoch", "_copy")
    in_bin = timed.filter("not _whole").withColumn("_run", F.col("_before") + F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    kept = timed.filter("_whole").unionByName(in_bin.filter("_run <= budget").drop("_run"))
    keys = ["doc_id", "source", "text_md5", "size"]
    times = kept.groupBy(*keys, "_copy").agg(F.count("*").alias("_times"))
    renamed = times.select(*[F.col(c).alias(f"_t_{c}") for c in keys], F.col("_copy").alias("_t_copy"), "_times")
    same = [queue[c].eqNullSafe(renamed[f"_t_{c}"]) for c in keys] + [queue["_copy"] == renamed["_t_copy"]]
    on = same[0]
    for c in same[1:]:
        on = on & c
    out = queue.join(renamed, on, "left")
    return out.select("doc_id", "source", "text_md5", "size", "source_size", "target", (F.coalesce("_times", F.lit(0)) * F.col("size")).cast("long").alias("taken"), F.col("_copy").alias("copy"))


def mixture(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The mix itself: the rows of docs, each as often as it is taken, with all columns of docs."""
    names = docs.columns
    plan = mix(docs, seed)
    # equal rows of docs are interchangeable: number them so that each meets one row of the plan
    key = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    times = plan.filter("taken > 0").groupBy("doc_id", "source", "text_md5").agg(F.sum(F.expr("taken div size")).alias("_n"), F.count("*").alias("_c"), F.max("copy").alias("_m"))
    times = times.select(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("text_md5").alias("_k"), "_n")
    copies = docs.withColumn("_key", key)
    numbered = copies.groupBy("doc_id", "source", "_key").agg(F.count("*").alias("_copies"), *[F.first(c).alias(f"_c_{i}") for i, c in enumerate(names) if c not in ("doc_id", "source")])
    on = numbered["doc_id"].eqNullSafe(times["_d"]) & numbered["source"].eqNullSafe(times["_s"]) & (numbered["_key"] == times["_k"])
    joined = numbered.join(times, on).withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    return joined.select(*[F.col(c) if c in ("doc_id", "source") else F.col(f"_c_{i}").alias(c) for i, c in enumerate(names)])


def mix_report(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")
