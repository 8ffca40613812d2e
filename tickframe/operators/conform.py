"""Conformance of a delivered session: its files, its metadata object, its frame table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Files, fields, enumerations and patterns of the delivery format.
FILES = ["session.json", "frames.csv", "video.mp4", "session.rrd", "rrd_creation.py"]
FORBIDDEN = ["key_binding.json"]
FIELDS = [
    "vendor_name", "game_title", "session_id", "created_at_utc", "ended_at_utc", "duration_ms", "duration_seconds", "fps", "frame_count", "record_width_px", "record_height_px", "screen_width_px",
    "screen_height_px", "localization", "platform", "input_mouse_convention",
]
PLATFORMS = ["Xbox", "PC", "Switch", "PlayStation", "Mobile-iOS", "Mobile-Android", "Steam Deck"]
MAPS_TO = ["camera_look_velocity", "camera_pan_velocity", "camera_pan_position", "cursor_position", "vehicle_steering", "none", "other"]
CAMERA_MAPS = ["camera_look_velocity", "camera_pan_velocity", "camera_pan_position"]
CONVENTION = ["maps_to", "dx_positive", "dx_negative", "dy_positive", "dy_negative"]
TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"
LOCALE = r"^[a-z]{2,3}(-[A-Z]{2,3})?$"
BUTTONS = ["left", "right", "middle", "x1", "x2"]
#: Failures that a delivery may still have at the last gate, since it adds those files itself.
WAIVED = ["missing session.rrd", "missing rrd_creation.py"]


def _list(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _told(*problems: tuple[Column, str]) -> Column:
    return F.filter(F.array(*[F.when(cond, text) for cond, text in problems]), lambda x: x.isNotNull())


def file_problems(files: Column) -> Column:
    lost = F.transform(F.array_except(_list(FILES), files), lambda f: F.concat(F.lit("missing "), f))
    return F.concat(lost, F.transform(F.array_intersect(_list(FORBIDDEN), files), lambda f: F.concat(F.lit("must not hold "), f)))


def at_gate(problems: Column) -> Column:
    return F.array_except(problems, _list(WAIVED))


def _kind(v: Column, path: str) -> Column:
    """string, number, object, array, ... of a field of a parsed object; null if absent."""
    name = F.lower(F.regexp_extract(F.schema_of_variant(F.try_variant_get(v, path, "variant")), "^[A-Z]+", 0))
    return F.when(name.isin("bigint", "decimal", "double", "float"), "number").otherwise(name)


def convention_problems(v: Column) -> Column:
    """The rules of the mouse convention object within a parsed metadata object; the first broken rule of shape hides the others."""
    root = "$.input_mouse_convention"
    text = lambda f: F.try_variant_get(v, f"{root}.{f}", "string")
    kind = {f: _kind(v, f"{root}.{f}") for f in CONVENTION}
    absent = F.filter(F.array(*[F.when(kind[f].isNull(), f) for f in CONVENTION]), lambda x: x.isNotNull())
    maps, sides = text("maps_to"), CONVENTION[1:]
    camera = maps.isin(CAMERA_MAPS)
    lacks_string = kind[sides[0]] != "string"
    other_side = F.lit(False)
    for f in sides:
        lacks_string = lacks_string | (kind[f] != "string")
        other_side = other_side | ~text(f).eqNullSafe("not_applicable")
    values = _told(
        (~maps.isin(MAPS_TO), "maps_to unknown"),
        ((maps == "other") & (F.coalesce(text("maps_to_other"), F.lit("")) == ""), "maps_to_other missing"),
        (camera & lacks_string, "directions not strings"),
        (camera & ~lacks_string & ~(text("dx_positive").isin("right", "left") & text("dx_negative").isin("right", "left")), "dx not right or left"),
        (camera & ~lacks_string & ~(text("dy_positive").isin("down", "up") & text("dy_negative").isin("down", "up")), "dy not down or up"),
        (~camera & other_side, "directions not not_applicable"),
    )
    shape = F.when(~_kind(v, root).eqNullSafe("object"), "convention not an object").when(F.size(absent) > 0, F.concat(F.lit("convention lacks "), F.array_join(absent, " "))).when(kind["maps_to"] != "string", "maps_to not a string")
    return F.when(shape.isNotNull(), F.array(shape)).otherwise(values)


def metadata_problems(v: Column) -> Column:
    """The rules of a parsed metadata object; missing fields hide the others, an unreadable object (null) is one problem."""
    text = lambda f: F.try_variant_get(v, f"$.{f}", "string")
    number = lambda f: F.when(_kind(v, f"$.{f}") == "number", F.try_variant_get(v, f"$.{f}", "double"))
    absent = F.filter(F.array(*[F.when(_kind(v, f"$.{f}").isNull(), f) for f in FIELDS]), lambda x: x.isNotNull())
    when = {f: F.when(_kind(v, f"$.{f}") == "string", text(f)) for f in ("created_at_utc", "ended_at_utc")}
    at = {f: F.try_to_timestamp(F.regexp_replace(t, "T", " ")) for f, t in when.items()}
    aware = {f: t.rlike(r"(Z|[+-]\d{2}:?\d{2})$") for f, t in when.items()}
    read = at["created_at_utc"].isNotNull() & at["ended_at_utc"].isNotNull()
    alike = read & (aware["created_at_utc"] == aware["ended_at_utc"])
    took = F.when(alike, (F.unix_micros(at["ended_at_utc"]) - F.unix_micros(at["created_at_utc"])) / 1e6)
    ms, seconds, fps, count = (number(f) for f in ("duration_ms", "duration_seconds", "fps", "frame_count"))
    numbers = ms.isNotNull() & seconds.isNotNull() & fps.isNotNull() & count.isNotNull()
    is_text = lambda f: _kind(v, f"$.{f}") == "string"
    values = _told(
        *[(~F.coalesce(t.rlike(TIME), F.lit(False)), f"{f} not a zoned ISO time") for f, t in when.items()],
        (~read, "times unreadable"),
        (read & ~alike, "times mix zoned and not"),
        (took <= 0, "ends before it begins"),
        (numbers & (F.abs(ms / 1000 - seconds) > 1), "duration_ms differs from duration_seconds"),
        (numbers & (F.abs(took - ms / 1000) > 1), "duration_ms differs from the times"),
        (numbers & (F.abs(count - fps * seconds) > 2), "frame_count differs from fps and duration"),
        (~numbers, "numbers malformed"),
        (~(is_text("localization") & text("localization").rlike(LOCALE)), "locale malformed"),
        (~(is_text("platform") & text("platform").isin(PLATFORMS)), "platform unknown"),
        (~is_text("game_title"), "game_title not a string"),
    )
    return (
        F.when(v.isNull(), _list(["metadata unreadable"]))
        .when(F.size(absent) > 0, F.array(F.concat(F.lit("fields missing: "), F.array_join(absent, " "))))
        .otherwise(F.concat(values, convention_problems(v)))
    )


def valid_convention(v: Column) -> Column:
    return F.size(convention_problems(v)) == 0


def with_metadata_problems(rows: DataFrame, json: str, name: str = "problems") -> DataFrame:
    """rows with the problems of an object held as text; it is parsed once, before the rules look at it."""
    parsed = rows.withColumn("_parsed", F.try_parse_json(json))
    return parsed.withColumn(name, metadata_problems(F.col("_parsed"))).drop("_parsed")


def frame_problems(rows: DataFrame, key: str, order: str, meta: DataFrame, camera: list[str]) -> DataFrame:
    """key, problems of frame rows (frame_id, timestamp_ms, camera cells as text, actions and buttons as arrays, dx, dy), in one shuffle.

    meta holds a row a session: frame_count, fps, duration_s, width, height, video_frames, video_s, video_width, video_height (null: no video).
    """
    w = Window.partitionBy(key).orderBy(order)
    c = F.col
    r = rows.withColumns({"_place": F.row_number().over(w) - 1, "_dt": c("timestamp_ms") - F.lag("timestamp_ms").over(w)})
    filled = F.exists(F.array(*[F.coalesce(F.col(x), F.lit("")) for x in camera]), lambda x: x != "")
    g = r.groupBy(key).agg(
        F.count("*").alias("n"), F.bool_and(c("frame_id") == c("_place")).alias("ids"), F.coalesce(F.bool_and(c("_dt") > 0), F.lit(True)).alias("rising"), F.min_by("timestamp_ms", order).alias("first"),
        F.max_by("timestamp_ms", order).alias("last"), F.count_if(filled).alias("camera"), F.count_if(F.exists("buttons", lambda b: ~b.isin(BUTTONS))).alias("odd_buttons"),
        F.size(F.array_distinct(F.flatten(F.collect_set("actions")))).alias("actions"), F.bool_or((F.coalesce("dx", F.lit(0.0)) != 0) | (F.coalesce("dy", F.lit(0.0)) != 0)).alias("motion"), F.bool_or(F.size("buttons") > 0).alias("pressed"),
    )
    j = g.join(meta, key)
    step = 1000 / c("fps")
    told = _told(
        (c("n") != c("frame_count"), "FAIL rows differ from frame_count"),
        (~c("ids"), "FAIL frame_id not 0 to n - 1"),
        (~c("rising"), "FAIL timestamps not increasing"),
        (c("first") > step, "FAIL first timestamp late"),
        (F.abs(c("last") - 1000 * c("duration_s")) > 4 * step, "FAIL last timestamp off the duration"),
        (c("camera") > 0, "FAIL camera cells filled"),
        (c("odd_buttons") > 0, "FAIL unknown buttons"),
        (c("actions") < 3, "WARN fewer than 3 actions"),
        (~c("motion"), "FAIL no mouse motion"),
        (~c("pressed"), "WARN no buttons"),
        (c("video_frames").isNull(), "FAIL no video"),
        ((c("video_width") != c("width")) | (c("video_height") != c("height")), "FAIL video size differs"),
        (c("video_frames") != c("n"), "FAIL video frames differ from rows"),
        (F.abs(c("video_s") - c("duration_s")) > 1, "FAIL video duration differs"),
        (c("video_s") < 70, "WARN under 70 s"),
    )
    return j.select(key, told.alias("problems"))


def verdict(problems: Column) -> Column:
    has = lambda level: F.exists(problems, lambda p: p.startswith(level))
    return F.when(has("FAIL"), "FAIL").when(has("WARN"), "WARN").otherwise("PASS")
