"""Reusable DataFrame patterns: runs, as-of joins, intervals, trees, keyed writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickframe.sources.shared import cut


def runs(df: DataFrame, keys: list[str], order: str, value: str, name: str = "run") -> DataFrame:
    """Numbers the runs of equal neighbouring values within keys."""
    w = Window.partitionBy(*keys).orderBy(order)
    change = F.when(F.lag(value).over(w).eqNullSafe(F.col(value)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    return df.withColumn("_change", change).withColumn(name, F.sum("_change").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_change")


def run_lengths(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """keys, value, first, last (inclusive positions), n: one row a run."""
    return runs(df, keys, order, value).groupBy(*keys, "run", value).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n")).drop("run")


def as_of(events: DataFrame, marks: DataFrame, keys: list[str], t: str, mark_t: str, value: str) -> DataFrame:
    """events with the value of the last mark at or before t (null before the first): one shuffle by keys, no range join."""
    extra = [c for c in events.columns if c not in keys]
    left = events.select(*keys, F.col(t).alias("_t"), F.lit(1).alias("_side"), F.struct(*extra).alias("_row"), F.lit(None).cast(dict(marks.dtypes)[value]).alias("_v"))
    right = marks.select(*keys, F.col(mark_t).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(left.schema["_row"].dataType).alias("_row"), F.col(value).alias("_v"))
    w = Window.partitionBy(*keys).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    held = left.unionByName(right).withColumn("_held", F.last("_v", ignorenulls=True).over(w)).filter("_side = 1")
    return held.select(*keys, "_row.*", F.col("_held").alias(value))


def next_of(events: DataFrame, marks: DataFrame, keys: list[str], t: str, mark_t: str, value: str) -> DataFrame:
    """events with the value of the first mark at or after t (null after the last)."""
    extra = [c for c in events.columns if c not in keys]
    left = events.select(*keys, F.col(t).alias("_t"), F.lit(0).alias("_side"), F.struct(*extra).alias("_row"), F.lit(None).cast(dict(marks.dtypes)[value]).alias("_v"))
    right = marks.select(*keys, F.col(mark_t).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(left.schema["_row"].dataType).alias("_row"), F.col(value).alias("_v"))
    w = Window.partitionBy(*keys).orderBy("_t", "_side").rowsBetween(0, Window.unboundedFollowing)
    held = left.unionByName(right).withColumn("_held", F.first("_v", ignorenulls=True).over(w)).filter("_side = 0")
    return held.select(*keys, "_row.*", F.col("_held").alias(value))


def merged(intervals: DataFrame, keys: list[str], start: str = "t0", end: str = "t1") -> DataFrame:
    """Overlapping and touching intervals as one."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = intervals.withColumn("_new", F.when(reach.isNull() | (F.col(start) > reach), 1).otherwise(0))
    marked = marked.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def complement(sessions: DataFrame, cuts: DataFrame, keys: list[str], duration: str) -> DataFrame:
    """What of [0, duration] no cut covers; the whole of it where there is no cut."""
    inside = cuts.join(sessions.select(*keys, duration), keys)
    inside = inside.select(*keys, F.greatest("t0", F.lit(0.0)).alias("t0"), F.least("t1", F.col(duration)).alias("t1")).filter("t1 > t0")
    islands = merged(inside, keys)
    w = Window.partitionBy(*keys).orderBy("t0")
    before = islands.select(*keys, F.lag("t1", 1, 0.0).over(w).alias("t0"), F.col("t0").alias("t1"))
    after = islands.groupBy(*keys).agg(F.max("t1").alias("t0"))
    last = sessions.select(*keys, F.col(duration).cast("double").alias("t1")).join(after, keys, "left").select(*keys, F.coalesce("t0", F.lit(0.0)).alias("t0"), "t1")
    return before.unionByName(last).filter("t1 > t0")


def top_roots(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """node, root, depth: up the parents, however many; a parent that is no node is a root. Each round doubles what is behind (pointer jumping).

    A round is stored, so plans do not grow; log2 of the greatest depth rounds. A cycle among parents is an error.
    """
    first = F.coalesce(F.col(parent), F.col(node)).alias("root")
    now = cut(nodes.select(F.col(node).alias("node"), first, F.when(F.col(parent).isNull(), 0).otherwise(1).alias("depth"), F.col(parent).isNotNull().alias("open")))
    reach, count = 1, None
    while now.filter("open").limit(1).count():
        if reach > 64:
            count = now.count() if count is None else count
            if reach > 2 * count:
                raise ValueError("a cycle among parents")
        up = now.select(F.col("node").alias("_n"), F.col("root").alias("_r"), F.col("depth").alias("_d"), F.col("open").alias("_o"))
        met = now.join(up, F.col("open") & (F.col("root") == F.col("_n")), "left")
        now = cut(met.select("node", F.coalesce("_r", "root").alias("root"), (F.col("depth") + F.coalesce("_d", F.lit(0))).alias("depth"), F.coalesce("_o", F.lit(False)).alias("open")))
        reach *= 2
    return now.drop("open")


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is last in order."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def insert_or_ignore(held: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows held stay; of new rows the first of each unknown key is added."""
    w = Window.partitionBy(*keys).orderBy(*order)
    first = new.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
    return held.unionByName(first.join(held.select(*keys), keys, "left_anti"))


def upsert(held: DataFrame, new: DataFrame, keys: list[str], keep: list[str]) -> DataFrame:
    """New rows replace held ones with their key; the columns keep stay as they were."""
    other = [c for c in held.columns if c not in keys]
    left = held.select(*keys, F.struct(*other).alias("_h"))
    right = new.select(*keys, F.struct(*other).alias("_n"))
    both = left.join(right, keys, "full_outer")
    pick = [F.coalesce(f"_h.{c}", f"_n.{c}") if c in keep else F.when(F.col("_n").isNotNull(), F.col(f"_n.{c}")).otherwise(F.col(f"_h.{c}")) for c in other]
    return both.select(*keys, *[p.alias(c) for p, c in zip(pick, other)])


def compare_and_set(held: DataFrame, wanted: DataFrame, keys: list[str], guard: str, column: str) -> DataFrame:
    """column takes the wanted value where the guard still has the expected one; an empty guard never matches."""
    w = wanted.select(*keys, F.col(guard).alias("_guard"), F.col(column).alias("_value"))
    same = (F.col("_guard") == F.col(guard)) & (F.col(guard) != "")
    return held.join(w, keys, "left").withColumn(column, F.when(same, F.col("_value")).otherwise(F.col(column))).drop("_guard", "_value")


def clusters(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, cluster (the least node reachable): least labels spread along edges until nothing changes."""
    both = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).union(edges.select(F.col(b), F.col(a))).distinct().checkpoint()
    label = both.select(F.col("x").alias("node")).distinct().withColumn("cluster", F.col("node"))
    while True:
        near = both.join(label, F.col("y") == F.col("node")).groupBy("x").agg(F.min("cluster").alias("_m"))
        new = label.join(near, F.col("node") == F.col("x")).select("node", F.least("cluster", "_m").alias("cluster"), (F.col("_m") < F.col("cluster")).alias("_c")).checkpoint()
        changed = new.filter("_c").limit(1).count()
        label = new.drop("_c")
        if not changed:
            return label
