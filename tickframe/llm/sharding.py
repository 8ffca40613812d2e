"""Sharding by a Feistel permutation with cycle walking over global row numbers. DataFrame functions only.

1. Rows get global row numbers 0 to n-1 in the order (bucket, doc_id, size, text_crc32), bucket being a hash of
   doc_id. Rows equal in all of these are interchangeable: they are counted as one group, numbered as a range and
   expanded again, so a key that holds a third of all rows stays one row until the last step. Numbers need the
   counts of the buckets only (a fixed number of them), never a sort on one machine.
2. A balanced Feistel network over Z_a x Z_b, a = ceil(sqrt(n)), b = ceil(n / a), permutes the numbers; a value
   outside 0 to n-1 is permuted again until it falls inside (cycle walking). a * b - n < a, so nearly all values
   need one walk. The permutation depends on n and seed only: anyone can compute a row's shard and slot.
3. shard = place mod shards, slot = place div shards: shard sizes differ by one row at most, slots have no gaps.

Nulls: a null text has size 8 and the checksum of nothing; a null doc_id is a value of its own. Empty table: no
rows. Further columns are ignored. Reruns agree, whatever the partitioning.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

ROUNDS = 4
#: After so many walks a value outside raises an error: with a > WALKS its chance is below WALKS ** -WALKS.
WALKS = 32
BUCKETS = 1024


def hashed(*parts: Column | str) -> Column:
    """48 bits of an MD5, the same in any SQL."""
    text = F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def permuted(number: Column, n: int, seed: str, rounds: int = ROUNDS) -> Column:
    """The place of a row number among 0 to n-1."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    b = max(1, -(-n // a))

    def once(x: Column) -> Column:
        # left lives in Z_a and right in Z_b; they change places every round
        state = F.struct(F.pmod(x, F.lit(a)).alias("l"), F.floor(x / F.lit(a)).cast("long").alias("r"))

        def step(s: Column, k: Column) -> Column:
            m = F.when(k % 2 == 0, F.lit(a)).otherwise(F.lit(b)).cast("long")
            return F.struct(s.r.alias("l"), F.pmod(s.l + hashed(seed, k, s.r), m).alias("r"))

        end = F.aggregate(F.array(*[F.lit(k) for k in range(rounds)]), state, step)
        return (end.l + F.lit(a).cast("long") * end.r).cast("long")

    walked = F.aggregate(F.array(*[F.lit(k) for k in range(min(WALKS, a * b - n + 1))]), once(number), lambda y, _: F.when(y < n, y).otherwise(once(y)))
    return F.when(walked < n, walked).otherwise(F.raise_error(F.lit("cycle walking did not end")).cast("long"))


def row_numbers(rows: DataFrame, key: str, order: list[str], buckets: int = BUCKETS) -> tuple[DataFrame, int]:
    """rows with a column row_number, 0 to n-1, and n. order must contain all columns of rows."""
    spark = rows.sparkSession
    bucket = F.pmod(hashed("bucket", F.coalesce(F.col(key).cast("string"), F.lit("null"))), F.lit(buckets))
    grouped = rows.groupBy(*order).agg(F.count("*").alias("_copies")).withColumn("_bucket", bucket)
    # one row a bucket at most comes to the driver
    counts = {r["_bucket"]: r["n"] for r in rows.select(key).groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("n")).collect()}
    starts, at = [], 0
    for k in sorted(counts):
        starts.append((k, at))
        at += counts[k]
    firsts = spark.createDataFrame(starts, T.StructType([T.StructField("_bucket", T.LongType()), T.StructField("_start", T.LongType())]))
    w = Window.partitionBy("_bucket").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    first = F.coalesce(F.sum("_copies").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = grouped.withColumn("_before", first).join(F.broadcast(firsts), "_bucket")
    at_first = F.col("_start") + F.col("_before")
    out = out.withColumn("row_number", F.explode(F.sequence(at_first, at_first + F.col("_copies") - 1)))
    return out.select(*order, F.col("row_number").cast("long")), at


def shard(docs: DataFrame, shards: int = 24, seed: str = "shards") -> DataFrame:
    """doc_id, size, text_crc32, law ('rows'), shard, slot, grown_shard (null: the law is not 'key')."""
    rows = docs.select(
        "doc_id",
        (F.octet_length(F.coalesce("text", F.lit(""))) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
    )
    numbered, n = row_numbers(rows, "doc_id", ["doc_id", "size", "text_crc32"])
    placed = numbered.withColumn("_place", permuted(F.col("row_number"), n, seed))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.pmod("_place", F.lit(shards)).cast("int").alias("shard"), F.floor(F.col("_place") / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
