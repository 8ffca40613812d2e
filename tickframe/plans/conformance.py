"""Queries on delivered tables: client checks, metadata conformance, repairs of headers, shifts and records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.operators import client, conform
from tickframe.plans.timeseries import query

# --- client checks: vectors are frames, their labels sessions ------------------------------------------------------

FRAMES = """fr AS (SELECT label AS session_id, vec_id, CASE WHEN label = 4 THEN vec_id // 30 ELSE vec_id END AS frame_id, CASE label WHEN 1 THEN (vec_id // 50) * 330 WHEN 3 THEN vec_id * 300 WHEN 8 THEN vec_id ELSE vec_id * 4 END * 1.0 AS t,
 CASE WHEN label = 5 THEN CAST(embedding[1] AS DOUBLE) * 4 ELSE 1.0 END AS m00, CASE WHEN label = 6 THEN 0.00005 ELSE 0.0 END AS m01, 0.0 AS m02, 0.0 AS m10, CASE WHEN label = 7 AND vec_id % 3 = 0 THEN -1.0 ELSE 1.0 END AS m11, 0.0 AS m12,
 CASE WHEN label = 2 THEN round(CAST(embedding[2] AS DOUBLE), 3) * 3 ELSE 0.0 END AS m20, CASE WHEN label = 9 THEN round(CAST(embedding[3] AS DOUBLE), 3) * 0.3 ELSE 0.0 END AS m21, CASE WHEN label = 6 AND vec_id % 9 = 0 THEN -1.0 ELSE 1.0 END AS m22,
 CASE WHEN label = 8 THEN 0.0 WHEN vec_id % 97 = 5 THEN 5000.0 ELSE round(CAST(embedding[4] AS DOUBLE), 3) END AS x, CASE WHEN label = 1 AND vec_id % 7 = 0 THEN 0.5 ELSE 1.0 END AS m33,
 CASE WHEN label = 9 THEN 1002.0 ELSE 1000.0 END AS fx, CASE WHEN label = 0 THEN 20000.0 ELSE 540.0 END AS cy, CASE WHEN label = 3 THEN 0.0 ELSE vec_id % 5 * 1.0 END AS dx,
 CASE label WHEN 2 THEN 'Ctrl|w' WHEN 5 THEN 'mouse_right| a' WHEN 6 THEN 'tab|w' WHEN 7 THEN 'lctrl|ctrl' ELSE CASE WHEN vec_id % 2 = 0 THEN 'w' ELSE '' END END AS ks, CASE WHEN vec_id % 3 = 0 THEN 'Right' ELSE 'left' END AS bs FROM embeddings)"""


def frames(spark, d) -> DataFrame:
    v = spark.read.parquet(f"{d}/embeddings.parquet")
    n, i = F.col("label"), F.col("vec_id")
    e = lambda k: F.col("embedding")[k].cast("double")
    zero, one = F.lit(0.0), F.lit(1.0)
    t = F.when(n == 1, F.floor(i / 50) * 330).when(n == 3, i * 300).when(n == 8, i).otherwise(i * 4).cast("double")
    cells = {f"c2w_m{r}{c}": (one if r == c else zero) for r in range(4) for c in range(4)} | {
        "c2w_m00": F.when(n == 5, e(0) * 4).otherwise(one), "c2w_m01": F.when(n == 6, 0.00005).otherwise(zero), "c2w_m11": F.when((n == 7) & (i % 3 == 0), -1.0).otherwise(one),
        "c2w_m20": F.when(n == 2, F.round(e(1), 3) * 3).otherwise(zero), "c2w_m21": F.when(n == 9, F.round(e(2), 3) * 0.3).otherwise(zero), "c2w_m22": F.when((n == 6) & (i % 9 == 0), -1.0).otherwise(one),
        "c2w_m03": F.when(n == 8, 0.0).when(i % 97 == 5, 5000.0).otherwise(F.round(e(3), 3)), "c2w_m33": F.when((n == 1) & (i % 7 == 0), 0.5).otherwise(one),
    }
    keys = F.when(n == 2, "Ctrl|w").when(n == 5, "mouse_right| a").when(n == 6, "tab|w").when(n == 7, "lctrl|ctrl").otherwise(F.when(i % 2 == 0, "w").otherwise(""))
    return v.select(
        n.alias("session_id"), "vec_id", F.when(n == 4, F.floor(i / 30)).otherwise(i).alias("frame_id"), t.alias("timestamp_ms"), *[c.alias(k) for k, c in cells.items()], F.lit("pinhole").alias("camera_model"),
        F.when(n == 9, 1002.0).otherwise(1000.0).alias("camera_fx"), F.lit(1000.0).alias("camera_fy"), F.lit(960.0).alias("camera_cx"), F.when(n == 0, 20000.0).otherwise(540.0).alias("camera_cy"),
        F.when(n == 3, 0.0).otherwise(i % 5).cast("double").alias("input_mouse_dx"), zero.alias("input_mouse_dy"), keys.alias("input_keys"), F.when(i % 3 == 0, "Right").otherwise("left").alias("input_mouse_buttons"),
    )


def videos(spark, d) -> DataFrame:
    """A session's frame count is off by its label times 4; session 9 has no video."""
    v = spark.read.parquet(f"{d}/embeddings.parquet").filter("label <> 9").groupBy(F.col("label").alias("session_id")).agg(F.count("*").alias("n"))
    return v.select("session_id", (F.col("n") + F.col("session_id") * 4).alias("video_frames"), (F.col("session_id") * 1.0).alias("video_s"))


@query("client_qa", f"""WITH {FRAMES}, vi AS (SELECT label AS session_id, count(*) + label * 4 AS video_frames, label * 1.0 AS video_s FROM embeddings WHERE label <> 9 GROUP BY label),
l AS (SELECT *, t - lag(t) OVER w AS dt, abs(x - lag(x) OVER w) AS move, lag(m00) OVER w * m00 + lag(m01) OVER w * m01 + lag(m11) OVER w * m11 + lag(m20) OVER w * m20 + lag(m21) OVER w * m21 + lag(m22) OVER w * m22 AS tr,
 m00 * m11 * m22 - m01 * (0 - 0 * m20) AS det, sqrt(pow(m00 * m00 + m01 * m01 - 1, 2) + pow(m11 * m11 - 1, 2) + pow(m20 * m20 + m21 * m21 + m22 * m22 - 1, 2) + 2 * pow(m01 * m11, 2) + 2 * pow(m00 * m20 + m01 * m21, 2) + 2 * pow(m11 * m21, 2)) AS ortho,
 list_filter(list_transform(string_split(lower(ks), '|'), lambda k: trim(k)), lambda k: k <> '') AS kl FROM fr WINDOW w AS (PARTITION BY session_id ORDER BY vec_id)),
md AS (SELECT session_id, median(dt) FILTER (WHERE dt > 0) AS step, greatest(quantile_cont(move, 0.99) FILTER (WHERE move > 0) * 25, 5.0) AS far FROM l GROUP BY 1),
kc AS (SELECT session_id, k, count(*) AS n FROM (SELECT session_id, unnest(list_distinct(kl)) AS k FROM l) WHERE k NOT LIKE '%mouse%' GROUP BY ALL), kr AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY n DESC, k) AS place FROM kc),
kf AS (SELECT session_id, count(*) AS n_rows FROM l GROUP BY 1), le AS (SELECT session_id, count(*) AS leaks FROM kr JOIN kf USING (session_id) WHERE place <= 10 AND n >= CASE WHEN k IN ('w', 'a', 's', 'd', 'space', 'up', 'down', 'left', 'right') THEN 0.99 ELSE 0.9 END * n_rows GROUP BY 1),
g AS (SELECT session_id, count(*) AS n_rows, count(*) - count(DISTINCT frame_id) AS dup, count(*) FILTER (WHERE dt <= 0) AS back, count(dt) AS steps, first(step) AS step, count(*) FILTER (WHERE dt > 3 * step OR (dt > 0 AND dt < 0.1 * step)) AS jitter, count(*) FILTER (WHERE det < 0) AS mirrored,
 count(*) FILTER (WHERE ortho > 1e-4) AS skewed, max(ortho) AS skew, count(*) FILTER (WHERE abs(m33 - 1) > 1e-6) AS bottom, count(*) FILTER (WHERE m21 < -0.1) AS inverted, count(*) FILTER (WHERE m21 < 0 AND m21 >= -0.1) AS leaning, stddev_pop(m21) AS lean_std, count(*) FILTER (WHERE abs(m20) > 0.1) AS rolling, stddev_pop(m20) AS roll_std,
 count(*) FILTER (WHERE move > 0) AS moves, count(*) FILTER (WHERE move > far) AS jumps, count(*) FILTER (WHERE degrees(acos(greatest(-1.0, least(1.0, (tr - 1) / 2)))) > 30) AS spins, count(*) FILTER (WHERE fx <> 1000) AS oblong, median(degrees(2 * atan(cy / 1000))) AS fov, bool_and(dx = 0) AS still_mouse,
 count(*) FILTER (WHERE list_contains(kl, 'ctrl') AND NOT list_contains(kl, 'lctrl') AND NOT list_contains(kl, 'rctrl')) AS bare_ctrl, count(*) FILTER (WHERE list_contains(kl, 'mouse_right') AND lower(bs) <> 'right') AS leaked FROM l JOIN md USING (session_id) GROUP BY 1),
q AS (SELECT *, 1000.0 / step AS fps, 1000.0 / step AS f FROM g LEFT JOIN le USING (session_id) LEFT JOIN vi USING (session_id)),
a AS (SELECT session_id, round(fps, 6) AS fps, round(n_rows / fps / 3600, 9) AS footage_hours, list_filter([
 CASE WHEN dup > 0 THEN 'duplicate frame_id:REQUIRED:' || dup END, CASE WHEN back > 0 THEN 'timestamps not increasing:REQUIRED:' || back END, CASE WHEN f < 5 OR f > 240 THEN 'fps out of range:WARN:' || steps END,
 CASE WHEN n_rows / f < 30 THEN 'session too short:WARN:' || n_rows END, CASE WHEN jitter > 0.05 * steps THEN 'jitter:WARN:' || jitter END, CASE WHEN mirrored > 0 THEN 'left-handed:REQUIRED:' || mirrored END,
 CASE WHEN skew > 1e-4 AND skewed > 0.001 * n_rows THEN 'not orthonormal:REQUIRED:' || skewed WHEN skew > 1e-4 THEN 'few frames not orthonormal:WARN:' || skewed WHEN skew > 1e-5 THEN 'nearly not orthonormal:WARN:' || n_rows END,
 CASE WHEN bottom > 0 THEN 'bottom row:REQUIRED:' || bottom END, CASE WHEN inverted > 0 THEN 'inverted:WARN:' || inverted WHEN leaning > 0.01 * n_rows AND lean_std > 0.02 THEN 'leaning:WARN:' || leaning END,
 CASE WHEN rolling > 0.05 * n_rows AND roll_std > 0.02 THEN 'rolling:WARN:' || rolling END, CASE WHEN n_rows > 1 AND moves = 0 THEN 'never moves:WARN:' || n_rows END, CASE WHEN moves >= 2 AND jumps > 0 THEN 'teleports:WARN:' || jumps END,
 CASE WHEN spins > 0.05 * n_rows THEN 'spins:WARN:' || spins END, CASE WHEN oblong > 0 THEN 'pixels not square:WARN:' || oblong END, CASE WHEN fov < 10 OR fov > 150 THEN 'field of view:WARN:' || n_rows END, CASE WHEN still_mouse THEN 'mouse never moves:WARN:' || n_rows END,
 CASE WHEN bare_ctrl > 10 THEN 'bare ctrl:WARN:' || bare_ctrl END, CASE WHEN leaked > 0 THEN 'button among keys:WARN:' || leaked END, CASE WHEN leaks > 0 THEN 'key held throughout:WARN:' || leaks END,
 CASE WHEN video_frames IS NULL THEN 'no video:REQUIRED:1' END, CASE WHEN abs(video_frames - n_rows) > greatest(5.0, 0.01 * n_rows) THEN 'frame count:WARN:' || abs(video_frames - n_rows) END, CASE WHEN abs(video_s - n_rows / f) > 2 THEN 'duration:WARN:1' END], lambda x: x IS NOT NULL) AS fl FROM q)
SELECT session_id, fps, footage_hours, array_to_string(fl, ';') AS findings, CASE WHEN len(list_filter(fl, lambda x: x LIKE '%:REQUIRED:%')) > 0 THEN 'FAIL' WHEN len(fl) > 0 THEN 'WARN' ELSE 'PASS' END AS status FROM a""")  # fmt: skip
def _(spark, d):
    out = client.client_checks(frames(spark, d), "session_id", "vec_id", videos(spark, d))
    text = F.transform("findings", lambda x: F.concat_ws(":", x.check, x.level, x.n.cast("string")))
    return out.select("session_id", F.round("fps", 6).alias("fps"), F.round("footage_hours", 9).alias("footage_hours"), F.array_join(text, ";").alias("findings"), "status")


# --- metadata objects and frame tables: orders are sessions, line items frames --------------------------------------

META = (
    '{"vendor_name":"v","game_title":"G","session_id":"s1","created_at_utc":"2024-01-01T00:00:00Z","ended_at_utc":"2024-01-01T00:02:00Z","duration_ms":120000,"duration_seconds":120.0,"fps":30,"frame_count":3600,'
    '"record_width_px":1920,"record_height_px":1080,"screen_width_px":1920,"screen_height_px":1080,"localization":"en-IN","platform":"PC","input_mouse_convention":'
    '{"maps_to":"camera_look_velocity","dx_positive":"right","dx_negative":"left","dy_positive":"down","dy_negative":"up"}}'
)
#: What is replaced in the object of every 20th order, so that each rule is broken once.
BROKEN = [
    ("@", "@"), ('"fps":30,', ""), ('0:00Z","e', '0:00","e'), ("00:02:00Z", "00:00:00Z"), ("120000", "125000"), ("3600", "3700"), ("120000", '"120000"'), ("en-IN", "english"), ('"PC"', '"Amiga"'), ('"G"', "5"),
    ('"input_mouse_convention":{', '"input_mouse_convention":[],"x":{'), (',"dy_negative":"up"', ""), ("camera_look_velocity", "sky"), ("camera_look_velocity", "other"), ('"dx_positive":"right"', '"dx_positive":"up"'),
    ('"dx_positive":"right"', '"dx_positive":1'), ("camera_look_velocity", "none"), ("{", "["), ("2024-01-01T00:02", "2024-13-01T00:02"), ('"maps_to":"camera_look_velocity"', '"maps_to":7'),
]
BUILT = "js AS (SELECT o_orderkey AS session_id, CASE o_orderkey % 20 " + " ".join(f"WHEN {i} THEN replace('{META}', '{a}', '{b}')" for i, (a, b) in enumerate(BROKEN)) + " END AS js FROM orders)"


def metadata(spark, d) -> DataFrame:
    o = spark.read.parquet(f"{d}/orders.parquet")
    js = F.lit(None).cast("string")
    for i, (a, b) in enumerate(BROKEN):
        js = F.when(F.col("o_orderkey") % 20 == i, F.lit(META.replace(a, b))).otherwise(js)
    return o.select(F.col("o_orderkey").alias("session_id"), js.alias("js"))


def _lists(v) -> str:
    return "(" + ", ".join(f"'{x}'" for x in v) + ")"


C = conform
SIDES = C.CONVENTION[1:]
ROOT = "$.input_mouse_convention"
KIND = "CASE json_type(p, '{f}') WHEN 'UBIGINT' THEN 'number' WHEN 'BIGINT' THEN 'number' WHEN 'DOUBLE' THEN 'number' WHEN 'VARCHAR' THEN 'string' ELSE lower(json_type(p, '{f}')) END"
TIMES = "^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})$"
CONV_SQL = f"""list_filter([CASE WHEN m NOT IN {_lists(C.MAPS_TO)} THEN 'maps_to unknown' END, CASE WHEN m = 'other' AND coalesce(p ->> '{ROOT}.maps_to_other', '') = '' THEN 'maps_to_other missing' END,
 CASE WHEN cam AND ns THEN 'directions not strings' END, CASE WHEN cam AND NOT ns AND NOT (p ->> '{ROOT}.dx_positive' IN ('right', 'left') AND p ->> '{ROOT}.dx_negative' IN ('right', 'left')) THEN 'dx not right or left' END,
 CASE WHEN cam AND NOT ns AND NOT (p ->> '{ROOT}.dy_positive' IN ('down', 'up') AND p ->> '{ROOT}.dy_negative' IN ('down', 'up')) THEN 'dy not down or up' END,
 CASE WHEN NOT cam AND ({' OR '.join(f"p ->> '{ROOT}.{f}' IS DISTINCT FROM 'not_applicable'" for f in SIDES)}) THEN 'directions not not_applicable' END], lambda x: x IS NOT NULL)"""
META_SQL = f"""WITH {BUILT}, ps AS (SELECT session_id, CASE WHEN json_valid(js) THEN js::JSON END AS p FROM js),
k AS (SELECT *, list_filter([{', '.join(f"CASE WHEN json_type(p, '$.{f}') IS NULL THEN '{f}' END" for f in C.FIELDS)}], lambda x: x IS NOT NULL) AS absent, list_filter([{', '.join(f"CASE WHEN json_type(p, '{ROOT}.{f}') IS NULL THEN '{f}' END" for f in C.CONVENTION)}], lambda x: x IS NOT NULL) AS cabsent,
 p ->> '{ROOT}.maps_to' AS m, coalesce(p ->> '{ROOT}.maps_to' IN {_lists(C.CAMERA_MAPS)}, false) AS cam, coalesce({' OR '.join(f"json_type(p, '{ROOT}.{f}') <> 'VARCHAR'" for f in SIDES)}, false) AS ns,
 p ->> '$.created_at_utc' AS c1, p ->> '$.ended_at_utc' AS e1, try_cast(rtrim(p ->> '$.created_at_utc', 'Z') AS TIMESTAMP) AS c2, try_cast(rtrim(p ->> '$.ended_at_utc', 'Z') AS TIMESTAMP) AS e2,
 {', '.join(f"CASE WHEN {KIND.format(f='$.' + f)} = 'number' THEN CAST(p ->> '$.{f}' AS DOUBLE) END AS {a}" for f, a in (('duration_ms', 'ms'), ('duration_seconds', 'sec'), ('fps', 'fps'), ('frame_count', 'cnt')))} FROM ps),
t AS (SELECT *, c2 IS NOT NULL AND e2 IS NOT NULL AS rd, c2 IS NOT NULL AND e2 IS NOT NULL AND (c1 LIKE '%Z') = (e1 LIKE '%Z') AS alike, ms IS NOT NULL AND sec IS NOT NULL AND fps IS NOT NULL AND cnt IS NOT NULL AS nums FROM k),
u AS (SELECT *, CASE WHEN alike THEN (epoch_us(e2) - epoch_us(c2)) / 1e6 END AS took FROM t)
SELECT session_id, array_to_string(CASE WHEN p IS NULL THEN ['metadata unreadable'] WHEN len(absent) > 0 THEN ['fields missing: ' || array_to_string(absent, ' ')] ELSE list_concat(list_filter([
 CASE WHEN NOT regexp_matches(c1, '{TIMES}') THEN 'created_at_utc not a zoned ISO time' END, CASE WHEN NOT regexp_matches(e1, '{TIMES}') THEN 'ended_at_utc not a zoned ISO time' END, CASE WHEN NOT rd THEN 'times unreadable' END,
 CASE WHEN rd AND NOT alike THEN 'times mix zoned and not' END, CASE WHEN took <= 0 THEN 'ends before it begins' END, CASE WHEN nums AND abs(ms / 1000 - sec) > 1 THEN 'duration_ms differs from duration_seconds' END,
 CASE WHEN nums AND abs(took - ms / 1000) > 1 THEN 'duration_ms differs from the times' END, CASE WHEN nums AND abs(cnt - fps * sec) > 2 THEN 'frame_count differs from fps and duration' END, CASE WHEN NOT nums THEN 'numbers malformed' END,
 CASE WHEN NOT regexp_matches(p ->> '$.localization', '{C.LOCALE}') THEN 'locale malformed' END, CASE WHEN p ->> '$.platform' NOT IN {_lists(C.PLATFORMS)} THEN 'platform unknown' END,
 CASE WHEN json_type(p, '$.game_title') <> 'VARCHAR' THEN 'game_title not a string' END], lambda x: x IS NOT NULL),
 CASE WHEN json_type(p, '{ROOT}') <> 'OBJECT' THEN ['convention not an object'] WHEN len(cabsent) > 0 THEN ['convention lacks ' || array_to_string(cabsent, ' ')] WHEN json_type(p, '{ROOT}.maps_to') <> 'VARCHAR' THEN ['maps_to not a string'] ELSE {CONV_SQL} END) END, ';') AS problems FROM u"""


@query("session_conformance", META_SQL)
def _(spark, d):
    return conform.with_metadata_problems(metadata(spark, d), "js").select("session_id", F.array_join("problems", ";").alias("problems"))


FILE_SETS = [["session.json", "frames.csv", "video.mp4", "session.rrd", "rrd_creation.py"], ["frames.csv", "key_binding.json"], [], ["session.json", "frames.csv", "video.mp4"]]


@query("delivery_files", "WITH s AS (SELECT o_orderkey, CASE o_orderkey % 4 " + " ".join(f"WHEN {i} THEN {v}::VARCHAR[]" for i, v in enumerate(FILE_SETS)) + " END AS f FROM orders), p AS (SELECT o_orderkey, list_concat(list_transform(list_filter(" + str(C.FILES) + ", lambda x: NOT list_contains(f, x)), lambda x: 'missing ' || x), CASE WHEN list_contains(f, 'key_binding.json') THEN ['must not hold key_binding.json'] ELSE []::VARCHAR[] END) AS p FROM s) SELECT o_orderkey, array_to_string(p, ';') AS problems, array_to_string(list_filter(p, lambda x: x NOT IN " + _lists(C.WAIVED) + "), ';') AS at_gate FROM p")
def _(spark, d):
    files = F.element_at(F.array(*[F.array(*[F.lit(x) for x in v]).cast("array<string>") for v in FILE_SETS]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    p = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", conform.file_problems(files).alias("p"))
    return p.select("o_orderkey", F.array_join("p", ";").alias("problems"), F.array_join(conform.at_gate(F.col("p")), ";").alias("at_gate"))


ROWS_SQL = """r AS (SELECT l_orderkey AS session_id, l_linenumber AS ln, CASE WHEN l_orderkey % 7 = 0 THEN l_linenumber ELSE l_linenumber - 1 END AS frame_id, CASE l_orderkey % 5 WHEN 1 THEN 0.0 WHEN 2 THEN (l_linenumber - 1) * 33.0 + 100 ELSE (l_linenumber - 1) * 33.0 END AS t,
 CASE WHEN l_orderkey % 11 = 0 AND l_linenumber = 2 THEN '1.0' ELSE '' END AS cam, CASE WHEN l_linenumber % 3 = 0 THEN [l_returnflag, l_linestatus] ELSE [l_returnflag] END AS actions, CASE WHEN l_suppkey % 17 = 0 THEN ['claw'] WHEN l_suppkey % 2 = 0 THEN ['left'] ELSE []::VARCHAR[] END AS buttons, l_quantity % 4 AS dx FROM lineitem),
mt AS (SELECT o_orderkey AS session_id, o_orderkey % 7 + 1 AS fc, (o_orderkey % 7 + 1) * 0.033 AS dur, CASE WHEN o_orderkey % 13 <> 0 THEN o_orderkey % 5 + 1 END AS vf, CASE WHEN o_orderkey % 13 <> 0 THEN o_orderkey % 90 * 1.0 END AS vs, CASE WHEN o_orderkey % 13 <> 0 THEN 1080 - o_orderkey % 2 END AS vh FROM orders)"""


@query("frames_conformance", f"""WITH {ROWS_SQL}, w AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY ln) - 1 AS place, t - lag(t) OVER (PARTITION BY session_id ORDER BY ln) AS dt FROM r),
g AS (SELECT session_id, count(*) AS n, bool_and(frame_id = place) AS ids, coalesce(bool_and(dt > 0), true) AS rising, arg_min(t, ln) AS first, arg_max(t, ln) AS last, count(*) FILTER (WHERE cam <> '') AS cams, count(*) FILTER (WHERE list_contains(buttons, 'claw')) AS odd,
 len(list_distinct(flatten(list(actions)))) AS acts, bool_or(dx <> 0) AS motion, bool_or(len(buttons) > 0) AS pressed FROM w GROUP BY 1), j AS (SELECT *, 1000 / 30.0 AS step FROM g JOIN mt USING (session_id)),
p AS (SELECT session_id, list_filter([CASE WHEN n <> fc THEN 'FAIL rows differ from frame_count' END, CASE WHEN NOT ids THEN 'FAIL frame_id not 0 to n - 1' END, CASE WHEN NOT rising THEN 'FAIL timestamps not increasing' END, CASE WHEN first > step THEN 'FAIL first timestamp late' END,
 CASE WHEN abs(last - 1000 * dur) > 4 * step THEN 'FAIL last timestamp off the duration' END, CASE WHEN cams > 0 THEN 'FAIL camera cells filled' END, CASE WHEN odd > 0 THEN 'FAIL unknown buttons' END, CASE WHEN acts < 3 THEN 'WARN fewer than 3 actions' END, CASE WHEN NOT motion THEN 'FAIL no mouse motion' END,
 CASE WHEN NOT pressed THEN 'WARN no buttons' END, CASE WHEN vf IS NULL THEN 'FAIL no video' END, CASE WHEN vh <> 1080 THEN 'FAIL video size differs' END, CASE WHEN vf <> n THEN 'FAIL video frames differ from rows' END, CASE WHEN abs(vs - dur) > 1 THEN 'FAIL video duration differs' END, CASE WHEN vs < 70 THEN 'WARN under 70 s' END], lambda x: x IS NOT NULL) AS pl FROM j)
SELECT session_id, array_to_string(pl, ';') AS problems, CASE WHEN len(list_filter(pl, lambda x: x LIKE 'FAIL%')) > 0 THEN 'FAIL' WHEN len(pl) > 0 THEN 'WARN' ELSE 'PASS' END AS status FROM p""")  # fmt: skip
def _(spark, d):
    k, ln, sup = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey")
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    t = F.when(k % 5 == 1, 0.0).when(k % 5 == 2, (ln - 1) * 33.0 + 100).otherwise((ln - 1) * 33.0)
    rows = li.select(
        k.alias("session_id"), ln.alias("ln"), F.when(k % 7 == 0, ln).otherwise(ln - 1).alias("frame_id"), t.alias("timestamp_ms"), F.when((k % 11 == 0) & (ln == 2), "1.0").otherwise("").alias("camera_fx"),
        F.when(ln % 3 == 0, F.array("l_returnflag", "l_linestatus")).otherwise(F.array("l_returnflag")).alias("actions"), F.when(sup % 17 == 0, F.array(F.lit("claw"))).when(sup % 2 == 0, F.array(F.lit("left"))).otherwise(F.array().cast("array<string>")).alias("buttons"),
        (F.col("l_quantity") % 4).cast("double").alias("dx"), F.lit(0.0).alias("dy"),
    )
    o = F.col("o_orderkey")
    seen = lambda c: F.when(o % 13 != 0, c)
    meta = spark.read.parquet(f"{d}/orders.parquet").select(
        o.alias("session_id"), (o % 7 + 1).alias("frame_count"), ((o % 7 + 1) * 0.033).alias("duration_s"), F.lit(30.0).alias("fps"), F.lit(1920).alias("width"), F.lit(1080).alias("height"),
        seen(o % 5 + 1).alias("video_frames"), seen((o % 90).cast("double")).alias("video_s"), seen(F.lit(1920)).alias("video_width"), seen(1080 - o % 2).alias("video_height"),
    )
    out = conform.frame_problems(rows, "session_id", "ln", meta, ["camera_fx"])
    return out.select("session_id", F.array_join("problems", ";").alias("problems"), conform.verdict(F.col("problems")).alias("status"))
