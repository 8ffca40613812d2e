"""Conformance checks: counts per session in one pass, and the problems they stand for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickframe.functions import tables as T
from tickframe.functions.numeric import upper_median


def problems(*pairs: tuple[Column, str]) -> Column:
    """The messages whose condition holds, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(m)) for c, m in pairs]))


def v1_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows: frame_id, ts, pts (ms), held, actions, dx, dy. One row a session."""
    w = Window.partitionBy(*keys).orderBy("frame_id")
    r = rows.withColumns({"_n": F.row_number().over(w) - 1, "_dt": F.col("ts") - F.lag("ts").over(w)})
    return r.groupBy(*keys).agg(
        F.count("*").alias("rows"), F.bool_and(F.col("frame_id") == F.col("_n")).alias("contiguous"), (F.max("ts") - F.min("ts")).alias("span"),
        F.max(F.abs(F.col("ts") - F.col("pts"))).alias("worst_ms"), F.count_if(F.col("_dt") < 0).alias("backward"),
        F.count_if(F.size("held") > 0).alias("key_frames"), F.count_if((F.col("dx") != 0) | (F.col("dy") != 0)).alias("motion_frames"),
    )


def v1_problems(c: DataFrame, video_frames: Column, duration_s: Column, actions: Column) -> DataFrame:
    fails = problems(
        (~F.col("contiguous"), "frame ids not contiguous"), (F.col("rows") != video_frames, "row count differs"), (F.col("worst_ms") > 100, "frame-sync drift"), (F.col("backward") > 0, "timestamps go back"),
    )
    warns = problems(
        (F.abs(F.col("span") / 1000 - duration_s) > 2, "span differs from duration"), (duration_s < T.MIN_CLIP_S, "under 70s"), (actions < T.MIN_ACTIONS, "few actions"),
        (F.col("key_frames") == 0, "no keyboard"), (F.col("motion_frames") == 0, "no mouse motion"),
    )
    out = c.withColumns({"fails": fails, "warns": warns})
    return out.withColumn("status", F.when(F.size("fails") > 0, "FAIL").when(F.size("warns") > 0, "WARN").otherwise("PASS"))


def irregular(rows: DataFrame, keys: list[str], ts: str, order: list[str], tolerance: float = 0.2) -> DataFrame:
    """Steps further than tolerance from the upper median step."""
    w = Window.partitionBy(*keys).orderBy(*order)
    dt = rows.withColumn("_dt", F.col(ts) - F.lag(ts).over(w)).filter("_dt is not null")
    med = dt.groupBy(*keys).agg(upper_median(F.collect_list("_dt")).alias("median_dt"))
    joined = dt.join(med, keys)
    return joined.groupBy(*keys, "median_dt").agg(F.count("*").alias("n"), F.count_if(F.abs(F.col("_dt") - F.col("median_dt")) > tolerance * F.col("median_dt")).alias("irregular"))


def fan_out(rows: DataFrame, inverted: dict[str, list[str]], keys: list[str]) -> DataFrame:
    """Frames in which two or more fired actions are alternatives of one held token."""
    table = F.create_map(*[x for k, v in inverted.items() for x in (F.lit(k), F.array(*[F.lit(s) for s in v]))])
    worst = F.array_max(F.transform("held", lambda t: F.size(F.array_intersect(F.col("actions"), F.coalesce(F.element_at(table, t), F.array().cast("array<string>"))))))
    return rows.filter(worst >= 2).groupBy(*keys).agg(F.count("*").alias("frames"))


def token_shape(token: Column) -> Column:
    """Whether a shown token is malformed: blank, with a space or comma, or a lower-case letter first."""
    return (F.trim(token) == "") | token.rlike(r"[\s,]") | token.rlike("^[a-z]")


def tampered(rows: Column, large: Column) -> Column:
    return large > F.greatest(F.floor(rows / 100), F.lit(2))


def rotation_measures(m: list[Column]) -> dict[str, Column]:
    """det, distance of R R' from the identity, and the camera's own angles of a rotation given by nine columns in row order."""
    det = m[0] * (m[4] * m[8] - m[5] * m[7]) - m[1] * (m[3] * m[8] - m[5] * m[6]) + m[2] * (m[3] * m[7] - m[4] * m[6])
    total = F.lit(0.0)
    for i in range(3):
        for j in range(3):
            dot = sum((m[3 * i + k] * m[3 * j + k] for k in range(3)), F.lit(0.0))
            total = total + F.pow(dot - (1.0 if i == j else 0.0), F.lit(2.0))
    return {"det": det, "ortho": F.sqrt(total), "yaw": F.degrees(F.atan2(m[2], m[8])), "pitch": F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), -m[5]))))}


def turn_angle(now: list[Column], before: list[Column]) -> Column:
    trace = sum((a * b for a, b in zip(now, before)), F.lit(0.0))
    return F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (trace - 1) / 2))))


def camera_checks(rows: DataFrame, keys: list[str], order: str, m: list[str]) -> DataFrame:
    """Per session: mirrored frames, frames off orthonormal, fast spins, teleports (steps beyond 25 times the 99th percentile and 5 units)."""
    w = Window.partitionBy(*keys).orderBy(order)
    cols = [F.col(c) for c in m]
    r = rows.withColumns(rotation_measures(cols)).withColumn("spin", turn_angle(cols, [F.lag(c).over(w) for c in m]))
    return r.groupBy(*keys).agg(F.count("*").alias("rows"), F.count_if(F.col("det") < 0).alias("mirrored"), F.count_if(F.col("ortho") > 1e-4).alias("skewed"), F.count_if(F.col("spin") > 30).alias("spins"))


#: A frame is black below this mean luma; a recording is rejected from this share of black frames on.
BLACK_LUMA, BLACK_SHARE = 5.0, 0.995


def dead_black(luma: Column, below: float = BLACK_LUMA, share: float = BLACK_SHARE) -> Column:
    """Aggregate: whether nearly all frames are black."""
    return F.avg(F.when(luma < below, 1.0).otherwise(0.0)) >= share


def bin_stats(rows: DataFrame, key: str) -> DataFrame:
    """What a recording's binned frames (keys, buttons: arrays; dx, dy; bleed, dropped) hold: flags, the sets of keys and buttons, bleed frames, dropped events."""
    moves = (F.coalesce("dx", F.lit(0.0)) != 0) | (F.coalesce("dy", F.lit(0.0)) != 0)
    sets = {c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(f"{c}_seen") for c in ("keys", "buttons")}
    return rows.groupBy(key).agg(
        F.bool_or(F.size("keys") > 0).alias("has_keyboard"), F.bool_or(moves).alias("has_motion"), F.bool_or(F.size("buttons") > 0).alias("has_buttons"), sets["keys"], sets["buttons"],
        F.count_if("bleed").alias("bleed_frames"), F.sum("dropped").alias("dropped"),
    )
