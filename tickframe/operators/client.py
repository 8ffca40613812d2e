"""A client's frame-table checks: every session is measured in one pass over its frames, then judged at configured levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.operators import checks

#: Columns that a delivery must have.
BASE_COLUMNS = ["frame_id", "timestamp_ms", "input_keys", "input_mouse_buttons", "input_mouse_dx", "input_mouse_dy"]
MATRIX_COLUMNS = [f"c2w_m{r}{c}" for r in range(4) for c in range(4)]
INTRINSIC_COLUMNS = ["camera_model", "camera_fx", "camera_fy", "camera_cx", "camera_cy"]
#: The level of each group of checks.
LEVELS = {
    "camera_matrix": "REQUIRED", "camera_intrinsics": "REQUIRED", "timestamp_mono": "REQUIRED", "nan_inf": "REQUIRED", "duplicate_frames": "REQUIRED", "video_present": "REQUIRED",
    "camera_orientation": "WARN", "timestamp_jitter": "WARN", "mouse_capture": "WARN", "key_checks": "WARN", "frame_count": "WARN", "frame_sync": "WARN", "fps_range": "WARN",
    "session_length": "WARN", "camera_stationary": "WARN", "teleport": "WARN", "camera_spin": "WARN", "fov_range": "WARN",
}
#: Keys that are held for long in ordinary play.
MOVEMENT_KEYS = ["w", "a", "s", "d", "space", "up", "down", "left", "right", "arrow_up", "arrow_down", "arrow_left", "arrow_right"]


def missing_columns(rows: DataFrame) -> dict[str, list[str]]:
    """The columns that the schema lacks, by group."""
    groups = {"base": BASE_COLUMNS, "camera_matrix": MATRIX_COLUMNS, "camera_intrinsics": INTRINSIC_COLUMNS}
    return {g: sorted(set(cols) - set(rows.columns)) for g, cols in groups.items()}


def _finite(c: str) -> Column:
    return F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


def _tokens(c: str) -> Column:
    return F.filter(F.transform(F.split(F.lower(F.coalesce(c, F.lit(""))), r"\|"), F.trim), lambda k: k != "")


def measures(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row a session: counts that the checks judge. The windows and the aggregate share one shuffle by session."""
    missing = missing_columns(rows)
    w, all_rows = Window.partitionBy(key).orderBy(order), Window.partitionBy(key)
    count = lambda cond: F.count_if(cond)
    r = rows.withColumn("dt", F.col("timestamp_ms") - F.lag("timestamp_ms").over(w))
    r = r.withColumn("step", F.median(F.when(F.col("dt") > 0, F.col("dt"))).over(all_rows))
    keys, buttons = _tokens("input_keys"), _tokens("input_mouse_buttons")
    has = lambda k: F.array_contains(keys, k)
    aggs = {
        "n_rows": F.count("*"), "dup": F.count("*") - F.count_distinct("frame_id"), "bad_ts": count(~_finite("timestamp_ms")), "back": count(F.col("dt") <= 0), "steps": F.count("dt"), "step": F.first("step"),
        "jitter": count((F.col("dt") > 3 * F.col("step")) | ((F.col("dt") > 0) & (F.col("dt") < 0.1 * F.col("step")))),
        "still_mouse": F.bool_and((F.coalesce("input_mouse_dx", F.lit(0.0)) == 0) & (F.coalesce("input_mouse_dy", F.lit(0.0)) == 0)),
        "bare_ctrl": count(has("ctrl") & ~has("lctrl") & ~has("rctrl")),
        "leaked": count(F.exists(keys, lambda k: k.startswith("mouse_") & ~F.array_contains(buttons, F.substring(k, F.lit(7), F.length(k))))),
    }
    if not missing["camera_matrix"]:
        m = [f"c2w_m{i}{j}" for i in range(3) for j in range(3)]
        cols, place = [F.col(c) for c in m], [f"c2w_m{i}3" for i in range(3)]
        before = [F.lag(c).over(w) for c in m]
        move = F.sqrt(sum((F.pow(F.col(c) - F.lag(c).over(w), F.lit(2.0)) for c in place), F.lit(0.0)))
        measured = checks.rotation_measures(cols)
        r = r.withColumns({"det": measured["det"], "ortho": measured["ortho"], "spin": checks.turn_angle(cols, before), "move": move})
        r = r.withColumn("far", F.greatest(F.percentile(F.when(F.col("move") > 0, F.col("move")), 0.99).over(all_rows) * 25, F.lit(5.0)))
        bottom = [F.abs(F.col(f"c2w_m3{j}") - (1.0 if j == 3 else 0.0)) > 1e-6 for j in range(4)]
        finite = _finite(MATRIX_COLUMNS[0])
        for c in MATRIX_COLUMNS[1:]:
            finite = finite & _finite(c)
        aggs |= {
            "bad_matrix": count(~finite), "mirrored": count(F.col("det") < 0), "skewed": count(F.col("ortho") > 1e-4), "skew": F.max("ortho"), "bottom": count(bottom[0] | bottom[1] | bottom[2] | bottom[3]),
            "inverted": count(F.col("c2w_m21") < -0.1), "leaning": count((F.col("c2w_m21") < 0) & (F.col("c2w_m21") >= -0.1)), "lean_std": F.stddev_pop("c2w_m21"),
            "rolling": count(F.abs("c2w_m20") > 0.1), "roll_std": F.stddev_pop("c2w_m20"), "moves": count(F.col("move") > 0), "jumps": count(F.col("move") > F.col("far")), "spins": count(F.col("spin") > 30),
        }
    if not missing["camera_intrinsics"]:
        fov = F.when(F.col("camera_fy") > 0, F.degrees(2 * F.atan(F.col("camera_cy") / F.col("camera_fy"))))
        aggs |= {"bad_lens": count(~_finite("camera_fx") | ~_finite("camera_fy")), "oblong": count(F.abs(F.col("camera_fx") - F.col("camera_fy")) > 1), "fov": F.median(fov)}
    return r.groupBy(key).agg(*[c.alias(n) for n, c in aggs.items()])


def held_keys(rows: DataFrame, key: str) -> DataFrame:
    """key, leaks: those of a session's ten commonest keys that are down in nearly all frames."""
    frames = rows.groupBy(key).agg(F.count("*").alias("frames"))
    held = rows.select(key, F.explode(F.array_distinct(_tokens("input_keys"))).alias("k")).filter(~F.col("k").contains("mouse")).groupBy(key, "k").agg(F.count("*").alias("n"))
    top = held.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "k"))).filter("place <= 10").join(frames, key)
    share = F.when(F.col("k").isin(MOVEMENT_KEYS), 0.99).otherwise(0.9)
    return top.filter(F.col("n") >= share * F.col("frames")).groupBy(key).agg(F.count("*").alias("leaks"))


def findings(measured: DataFrame, levels: dict[str, str] | None = None) -> DataFrame:
    """measured, with fps, footage_hours, findings (check, level, n) in the order of the checks, and status; SKIP leaves a check out.

    Columns that a group of checks needs and the table lacks leave that group out; see missing_columns.
    """
    levels = LEVELS | (levels or {})
    have, c = set(measured.columns), F.col
    fps = F.when(c("step") > 0, 1000.0 / c("step"))
    out = measured.withColumn("fps", fps).withColumn("footage_hours", c("n_rows") / c("fps") / 3600)
    some = lambda n: (c(n) > 0, c(n)) if n in have else None
    if_has = lambda n, cond, count: (cond, count) if n in have else None
    rules = [
        ("duplicate_frames", "duplicate frame_id", some("dup")),
        ("nan_inf", "timestamp not finite", some("bad_ts")),
        ("timestamp_mono", "timestamps not increasing", some("back")),
        ("fps_range", "fps out of range", ((c("fps") < 5) | (c("fps") > 240), c("steps"))),
        ("session_length", "session too short", (c("footage_hours") * 3600 < 30, c("n_rows"))),
        ("timestamp_jitter", "jitter", (c("jitter") > 0.05 * c("steps"), c("jitter"))),
        ("nan_inf", "matrix not finite", some("bad_matrix")),
        ("camera_matrix", "left-handed", some("mirrored")),
    ]
    if "skew" in have:
        many = (c("skew") > 1e-4) & (c("skewed") > 0.001 * c("n_rows"))
        rules += [
            ("camera_matrix", "not orthonormal", (many, c("skewed"))),
            (None, "few frames not orthonormal", (~many & (c("skew") > 1e-4), c("skewed"))),
            (None, "nearly not orthonormal", ((c("skew") <= 1e-4) & (c("skew") > 1e-5), c("n_rows"))),
            ("camera_matrix", "bottom row", some("bottom")),
            (None, "inverted", some("inverted")),
            (None, "leaning", ((c("inverted") == 0) & (c("leaning") > 0.01 * c("n_rows")) & (c("lean_std") > 0.02), c("leaning"))),
            (None, "rolling", ((c("rolling") > 0.05 * c("n_rows")) & (c("roll_std") > 0.02), c("rolling"))),
            ("camera_stationary", "never moves", ((c("n_rows") > 1) & (c("moves") == 0), c("n_rows"))),
            ("teleport", "teleports", ((c("moves") >= 2) & (c("jumps") > 0), c("jumps"))),
            ("camera_spin", "spins", (c("spins") > 0.05 * c("n_rows"), c("spins"))),
        ]
    rules += [
        ("nan_inf", "lens not finite", some("bad_lens")),
        (None, "pixels not square", some("oblong")),
        ("fov_range", "field of view", if_has("fov", (c("fov") < 10) | (c("fov") > 150), c("n_rows") if "fov" in have else None)),
        ("mouse_capture", "mouse never moves", (c("still_mouse"), c("n_rows"))),
        ("key_checks", "bare ctrl", (c("bare_ctrl") > 10, c("bare_ctrl"))),
        ("key_checks", "button among keys", some("leaked")),
        ("key_checks", "key held throughout", some("leaks")),
    ]
    if "video_frames" in have:
        rules += [
            ("video_present", "no video", (c("video_frames").isNull(), F.lit(1))),
            ("frame_count", "frame count", (F.abs(c("video_frames") - c("n_rows")) > F.greatest(F.lit(5.0), 0.01 * c("n_rows")), F.abs(c("video_frames") - c("n_rows")))),
            ("frame_sync", "duration", (F.abs(c("video_s") - c("n_rows") / c("fps")) > 2, F.lit(1))),
        ]
    kind = "struct<check:string,level:string,n:bigint>"
    found = []
    for group, name, rule in rules:
        level = levels[group] if group else "WARN"
        if rule and level != "SKIP":
            found.append(F.when(rule[0], F.struct(F.lit(name).alias("check"), F.lit(level).alias("level"), rule[1].cast("bigint").alias("n")).cast(kind)))
    out = out.withColumn("findings", F.filter(F.array(*found), lambda x: x.isNotNull()))
    of = lambda level: F.exists("findings", lambda x: x.level == level)
    return out.withColumn("status", F.when(of("REQUIRED"), "FAIL").when(of("WARN"), "WARN").otherwise("PASS"))


def client_checks(rows: DataFrame, key: str, order: str, video: DataFrame | None = None, levels: dict[str, str] | None = None) -> DataFrame:
    """Findings of each session of frame rows; video (key, video_frames, video_s) may lack sessions. A table without the base columns is refused."""
    missing = missing_columns(rows)["base"]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    measured = measures(rows, key, order).join(held_keys(rows, key), key, "left")
    return findings(measured.join(video, key, "left") if video is not None else measured, levels)
