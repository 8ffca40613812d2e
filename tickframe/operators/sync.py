"""Lag between input and video motion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickframe.functions import tables as T


def smoothed(track: DataFrame, keys: list[str], order: str, value: str, width: int = T.SMOOTHING) -> DataFrame:
    """Box filter of even width, biased to the left by one, zeros beyond the ends; unchanged if shorter than width."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(width // 2), width - width // 2 - 1)
    n = F.count("*").over(Window.partitionBy(*keys))
    return track.withColumn(value, F.when(n < width, F.col(value)).otherwise(F.sum(value).over(w) / width))


def normalised(track: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Centred, and divided by the population's standard deviation unless that is 0."""
    w = Window.partitionBy(*keys)
    mean, std = F.avg(value).over(w), F.stddev_pop(value).over(w)
    return track.withColumns({"_m": mean, "_s": std}).withColumn(value, (F.col(value) - F.col("_m")) / F.when(F.col("_s") > 0, F.col("_s")).otherwise(1.0)).drop("_m", "_s")


def lag_scores(tracks: DataFrame, keys: list[str], most: int) -> DataFrame:
    """keys, lag, score: mean of a[i] * m[i - lag] over the overlap, for lags from -most to most. tracks: i, a, m."""
    a = tracks.select(*keys, F.col("i"), "a").withColumn("lag", F.explode(F.sequence(F.lit(-most), F.lit(most)))).withColumn("_j", F.col("i") - F.col("lag"))
    m = tracks.select(*keys, F.col("i").alias("_j"), "m")
    return a.join(m, [*keys, "_j"]).groupBy(*keys, "lag").agg(F.avg(F.col("a") * F.col("m")).alias("score"))


def best_lag(scores: DataFrame, keys: list[str]) -> DataFrame:
    """The lag with the largest absolute score, the least lag on ties."""
    w = Window.partitionBy(*keys).orderBy(F.desc(F.round(F.abs("score"), 9)), "lag")
    return scores.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def verdict(active: Column, corr: Column, lag_ms: Column) -> Column:
    return F.when(active < T.MIN_ACTIVE, "SKIP").when(F.abs(corr) < T.MIN_CORRELATION, "WARN").when(F.abs(lag_ms) > T.LAG_HARD_MS, "FAIL").otherwise("PASS")


def lag_scan_arrays(tracks: DataFrame, keys: list[str], most: int) -> DataFrame:
    """As lag_scores and best_lag for (keys, a, m) with tracks as arrays: one Arrow pass and one correlation a track, no join."""
    import numpy as np
    import pyarrow as pa

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tracks.select(*keys).schema)

    def best(a, m):
        a, m = np.asarray(a or [], float), np.asarray(m or [], float)
        n, lags = min(len(a), len(m)), np.arange(-most, most + 1)
        if n == 0:
            return 0, 0.0
        shared = n - np.abs(lags)
        full = np.correlate(a[:n], m[:n], "full")
        score = np.where(shared > 0, full[np.clip(lags + n - 1, 0, 2 * n - 2)] / np.maximum(shared, 1), 0.0)
        size = np.round(np.abs(score), 9)
        k = int(np.argmax(size))
        return int(lags[k]), float(score[k])

    def run(batches):
        for b in batches:
            found = [best(a, m) for a, m in zip(b.column(len(keys)).to_pylist(), b.column(len(keys) + 1).to_pylist())]
            lag, score = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keys)], pa.array(lag, pa.int32()), pa.array(score, pa.float64())], names=[*keys, "lag", "score"])

    return tracks.select(*keys, "a", "m").mapInArrow(run, f"{fields}, lag int, score double")
