"""The incremental side: polling files, state per session, reports counted once."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickframe.operators import patterns
from tickframe.sources.readers import parse_event_lines

POLL = "300 seconds"


def event_stream(spark: SparkSession, path: str, files: int = 100) -> DataFrame:
    """Lines of new files as events; at most so many files a trigger."""
    lines = spark.readStream.schema("session_id string, value string").option("maxFilesPerTrigger", files).json(path)
    return parse_event_lines(lines).drop("value")


def pressure(log: DataFrame, width: str = "10 minutes", slide: str = "1 minute", late: str = "30 minutes") -> DataFrame:
    """Refused requests in a trailing window."""
    return log.withWatermark("ts", late).filter("status = 429").groupBy(F.window("ts", width, slide)).agg(F.count("*").alias("n"))


def new_alerts(alerts: DataFrame, ttl: str = "60 minutes") -> DataFrame:
    """Alerts without repeats of their key within ttl."""
    return alerts.withWatermark("ts", ttl).dropDuplicatesWithinWatermark(["key"])


HELD = "session_id string, t long, token string, held string"


def held_keys(events: DataFrame) -> DataFrame:
    """What is held after each key event; the state per session survives micro-batches and is never dropped for lateness."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = set(state.get[0].split("|")) - {""} if state.exists else set()
        for pdf in batches:
            out = []
            for r in pdf.sort_values(["t"], kind="stable").itertuples():
                held = held | {r.token} if r.down else held - {r.token}
                out.append((key[0], int(r.t), r.token, "|".join(sorted(held))))
            yield pd.DataFrame(out, columns=["session_id", "t", "token", "held"])
        state.update(("|".join(sorted(held)),))

    return events.select("session_id", "t", "token", "down").groupBy("session_id").applyInPandasWithState(step, HELD, "held string", "append", GroupStateTimeout.NoTimeout)


def count_once(counted_path: str, hours_path: str):
    """A foreachBatch function: accepted pieces enter the counted store the first time they are seen, whenever that is.

    The store is written by batch id, so a batch that is run again replaces its own output.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        pieces = batch.groupBy("root_id", "session_id").agg(F.min("seconds").alias("seconds"))
        try:
            known = spark.read.parquet(counted_path).filter(F.col("batch_id") != batch_id).select("root_id", "session_id")
            pieces = pieces.join(known, ["root_id", "session_id"], "left_anti")
        except Exception as e:  # the store does not exist before the first batch
            if "PATH_NOT_FOUND" not in str(e):
                raise
        pieces = pieces.withColumn("batch_id", F.lit(batch_id)).persist()
        pieces.drop("batch_id").write.mode("overwrite").parquet(f"{counted_path}/batch_id={batch_id}")
        pieces.groupBy().agg(F.sum("seconds").alias("seconds")).write.mode("overwrite").parquet(f"{hours_path}/batch_id={batch_id}")
        pieces.unpersist()

    return each


def sessions_seen(store: DataFrame, new: DataFrame) -> DataFrame:
    """first_seen stays, last_seen moves."""
    return patterns.upsert(store, new, ["path"], keep=["first_seen"])


def autoscale(target, active, queue, cpu, refused, climbed, critical, low: int, high: int) -> F.Column:
    """The next pool size: refusals step down by 4, sustained load by 2, spare load steps up by 2 if work waits."""
    clamp = lambda n: F.greatest(F.lit(low), F.least(F.lit(high), n))
    return F.when((refused >= 1.0) | climbed, clamp(target - 4)).when((cpu > 95.0) & critical, clamp(target - 2)).when((cpu < 85.0) & (queue > active), clamp(target + 2)).otherwise(clamp(target))
