"""Corrections: lag between input and video, shifts to be found again, headers, trims, records of windows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Limits of the measurement and of the correction.
MIN_ACTIVE, MIN_CORRELATION, TARGET_MS, MOST_MS, ROUNDS, SMOOTHING, MOST_LAG = 0.02, 0.15, 50.0, 150.0, 3, 8, 120


def active_share(dx: Column, dy: Column) -> Column:
    """Aggregate: share of frames in which either axis moves."""
    return F.avg(F.when((F.abs(dx) > 1e-4) | (F.abs(dy) > 1e-4), 1.0).otherwise(0.0))


def signal(mouse: Column, pose: Column, least: float = MIN_ACTIVE) -> Column:
    """Which track to measure by: the mouse if it is active enough, else the camera's pose, else none."""
    return F.when(mouse >= least, "mouse").when(pose >= least, "camera_pose").otherwise("none")


def best_lag(action: np.ndarray, motion: np.ndarray, most: int = MOST_LAG) -> tuple[int, float]:
    """Frames by which action lags behind motion, and the correlation there, of smoothed and normalised tracks."""
    n = min(len(action), len(motion))
    if n == 0:
        return 0, 0.0

    def norm(v):
        v = np.convolve(v[:n], np.ones(SMOOTHING) / SMOOTHING, "same") if n >= SMOOTHING else v[:n].astype(float)
        v = v - v.mean()
        return v / v.std() if v.std() > 1e-9 else v

    a, m = norm(action), norm(motion)
    most = min(most, n - 1)
    lags = np.arange(-most, most + 1)
    full = np.correlate(a, m, "full")[lags + n - 1] / (n - np.abs(lags))
    k = int(np.argmax(full))
    return int(lags[k]), float(full[k])


def shifted(track: np.ndarray, k: int) -> np.ndarray:
    """track later by k frames (earlier if negative); no motion comes in at the open end."""
    out = np.zeros_like(track)
    if k >= 0:
        out[k:] = track[: len(track) - k]
    else:
        out[:k] = track[-k:]
    return out


def corrected(sessions: DataFrame, key: str, rounds: int = ROUNDS) -> DataFrame:
    """key, shift, lag_was_ms, residual_ms, correlation, status of rows (key, action, motion: arrays of doubles, fps).

    Input is shifted against its measured lag and measured again, up to rounds times or until the lag is at most TARGET_MS.
    SKIP: input hardly moves; WARN: correlation too weak to tell; FAIL: more than MOST_MS left, so the lag is not constant.
    """

    def run(batches):
        for b in batches:
            out = {c: [] for c in ("shift", "lag_was_ms", "residual_ms", "correlation", "status")}
            for action, motion, fps in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                track, motion = np.array(action or [], float), np.array(motion or [], float)
                ms = lambda frames: frames / fps * 1000.0 if fps else 0.0  # noqa: E731, B023
                lag, corr = best_lag(track, motion)
                active = float(np.mean(np.abs(track) > 1e-4)) if len(track) else 0.0
                total, was, status = 0, ms(lag), "PASS"
                if active < MIN_ACTIVE:
                    status = "SKIP"
                elif abs(corr) < MIN_CORRELATION:
                    status = "WARN"
                else:
                    for _ in range(rounds):
                        if abs(ms(lag)) <= TARGET_MS or lag == 0:
                            break
                        total, track = total - lag, shifted(track, -lag)
                        lag, corr = best_lag(track, motion)
                    status = "FAIL" if abs(ms(lag)) > MOST_MS else "PASS"
                for c, v in zip(out, (total, was, ms(lag), corr, status)):
                    out[c].append(v)
            cols = [pa.array(out["shift"], pa.int32()), *[pa.array(out[c], pa.float64()) for c in ("lag_was_ms", "residual_ms", "correlation")], pa.array(out["status"], pa.string())]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["key", *out])

    kind = sessions.schema[key].dataType.simpleString()
    rows = sessions.select(key, F.col("action").cast("array<double>"), F.col("motion").cast("array<double>"), F.col("fps").cast("double"))
    return rows.mapInArrow(run, f"key {kind}, shift int, lag_was_ms double, residual_ms double, correlation double, status string").withColumnRenamed("key", key)


def constant_shift(given: DataFrame, fresh: DataFrame, key: str, place: str, value: str, most: int = 15, least: int = 3) -> DataFrame:
    """key, shift: the one shift of at most so many frames under which given equals fresh wherever both have frames; null if none or several do.

    fresh is repeated 2 * most + 1 times, a bound that does not depend on the data, and meets given by key and place.
    """
    moved = fresh.select(key, F.col(place), F.col(value).alias("_v")).withColumn("shift", F.explode(F.sequence(F.lit(-most), F.lit(most)))).withColumn(place, F.col(place) + F.col("shift"))
    met = given.select(key, place, value).join(moved, [key, place]).groupBy(key, "shift").agg(F.bool_and(F.col(value).eqNullSafe(F.col("_v"))).alias("same"), F.count("*").alias("n"))
    found = met.filter((F.col("n") >= least) & F.col("same")).groupBy(key).agg(F.count("*").alias("n"), F.min("shift").alias("shift"))
    return given.select(key).distinct().join(found, key, "left").select(key, F.when(F.col("n") == 1, F.col("shift")).alias("shift"))


def projected(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of a header in its order; those that rows lack are empty texts, others go."""
    have = set(rows.columns)
    return rows.select(*[F.col(c) if c in have else F.lit("").alias(c) for c in columns])


def blanked(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.withColumns({c: F.lit("") for c in columns if c in rows.columns})


def head_trimmed(rows: DataFrame, keep: DataFrame, key: str, order: str, t: str) -> DataFrame:
    """The last n rows (keep: key, n) of each session, with frame_id from 0 and times from the first row kept; a session with fewer rows stays whole."""
    w = Window.partitionBy(key)
    back = F.row_number().over(w.orderBy(F.desc(order)))
    kept = rows.join(keep, key).withColumn("_back", back).filter("_back <= n").drop("_back", "n")
    return kept.withColumns({"frame_id": F.row_number().over(w.orderBy(order)) - 1, t: F.col(t) - F.min(t).over(w)})


def windows_of_segments(windows: DataFrame, segments: DataFrame, key: str) -> DataFrame:
    """segment, t0, t1: the windows (key, t0, t1) of a recording on the clock of each of its segments (key, segment, s0, s1), cut at its ends."""
    met = windows.join(segments, key).filter((F.col("t0") < F.col("s1")) & (F.col("t1") > F.col("s0")))
    return met.select("segment", (F.greatest("t0", "s0") - F.col("s0")).alias("t0"), (F.least("t1", "s1") - F.col("s0")).alias("t1"))


def recomputed(claimed: Column, measured: Column, tolerance: Column) -> Column:
    """A claimed number if it is within tolerance of what was measured, else the measured one."""
    return F.when(F.abs(claimed - measured) <= tolerance, claimed).otherwise(measured)
