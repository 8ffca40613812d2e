"""Queries on cells, key bindings, corrections and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.functions import cells
from tickframe.operators import checks, correct, decide, keybinds, ledger
from tickframe.plans.ledger import SE, sessions
from tickframe.plans.timeseries import EV, events, query
from tickframe.sources import readers

SIDS = "sid AS (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN '20240101T000000Z_' || p_name || '_c_0af' WHEN 1 THEN 'a/b' WHEN 2 THEN '' WHEN 3 THEN '..' || p_name WHEN 4 THEN repeat('x', p_partkey % 400) ELSE p_name END AS sid FROM part)"


@query("id_cells", f"WITH {SIDS} SELECT p_partkey, regexp_extract(sid, 'Z_(.+?)_c_[0-9a-f]+$', 1) AS slug, CASE WHEN sid <> '' AND sid <> '.' AND NOT contains(sid, '/') AND NOT contains(sid, chr(92)) AND NOT contains(sid, '..') AND strlen(sid) <= 200 THEN sid ELSE 'folder' END AS safe FROM sid")
def _(spark, d):
    p, i = spark.read.parquet(f"{d}/part.parquet"), F.col("p_partkey") % 6
    sid = F.when(i == 0, F.concat(F.lit("20240101T000000Z_"), "p_name", F.lit("_c_0af"))).when(i == 1, "a/b").when(i == 2, "").when(i == 3, F.concat(F.lit(".."), "p_name")).when(i == 4, F.expr("repeat('x', p_partkey % 400)")).otherwise(F.col("p_name"))
    return p.select("p_partkey", cells.id_slug(sid).alias("slug"), cells.safe_component(sid, F.lit("folder")).alias("safe"))


MESSAGES = "ms AS (SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN 'input leads video ' || o_orderkey % 300 || '.5ms, |corr|=0.' || o_orderkey % 90 + 10 WHEN 1 THEN '2024/01/02 03:04:05 ERROR x' || chr(10) || '2024/01/02 03:04:06 again' WHEN 2 THEN 'moved prev_md5=aa healed prev_md5= b' || o_orderkey || ' ' ELSE 'nothing' END AS m FROM orders)"


@query("message_cells", f"WITH {MESSAGES} SELECT k, try_cast(regexp_extract(m, 'video ([0-9]+([.][0-9]+)?)ms', 1) AS DOUBLE) AS lag_ms, try_cast(regexp_extract(m, '[|]corr[|]=([0-9]+([.][0-9]+)?)', 1) AS DOUBLE) AS corr, CASE WHEN contains(m, 'prev_md5=') THEN trim(string_split(m, 'prev_md5=')[-1]) ELSE '' END AS crumb, regexp_replace(m, '(^|\n)[0-9]{{4}}/[0-9]{{2}}/[0-9]{{2}} [0-9:]{{8}} ', '\\1', 'g') AS plain FROM ms")
def _(spark, d):
    o, i = F.col("o_orderkey"), F.col("o_orderkey") % 4
    s = lambda c: c.cast("string")
    m = F.when(i == 0, F.concat(F.lit("input leads video "), s(o % 300), F.lit(".5ms, |corr|=0."), s(o % 90 + 10))).when(i == 1, "2024/01/02 03:04:05 ERROR x\n2024/01/02 03:04:06 again")
    m = m.when(i == 2, F.concat(F.lit("moved prev_md5=aa healed prev_md5= b"), s(o), F.lit(" "))).otherwise("nothing")
    ms = spark.read.parquet(f"{d}/orders.parquet").select(o.alias("k"), m.alias("m"))
    m = F.col("m")
    return ms.select("k", cells.told_lag_ms(m).alias("lag_ms"), cells.told_correlation(m).alias("corr"), cells.breadcrumb(m).alias("crumb"), cells.without_log_times(m).alias("plain"))


CELL = "CASE e.event_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'junk' WHEN 2 THEN '0.0' ELSE CAST(value AS VARCHAR) END"


@query("motion_cells", f"""WITH c AS (SELECT event_id, {CELL} AS cell, CASE event_id % 3 WHEN 0 THEN 'camera_look_velocity' ELSE 'cursor_position' END AS m, CASE event_id % 2 WHEN 0 THEN 'left' ELSE 'right' END AS px, event_id % 7 AS n, value FROM events e)
SELECT event_id, coalesce(try_cast(cell AS DOUBLE), 0) <> 0 AS moves, CAST(coalesce(try_cast(cell AS DOUBLE), 0) * CASE WHEN m = 'camera_look_velocity' AND px = 'left' THEN -1 ELSE 1 END AS DOUBLE) AS track, CASE WHEN m = 'camera_look_velocity' THEN -1.0 ELSE 1.0 END AS dy_sign,
 CASE WHEN trunc(try_cast(cell AS DOUBLE)) > 0 THEN CAST(trunc(try_cast(cell AS DOUBLE)) AS BIGINT) ELSE 1920 END AS width, CASE WHEN n <> 0 THEN event_id % 40 / n * 1000.0 ELSE 0.0 END AS lag_ms, coalesce(CASE WHEN n < 4 THEN value END, event_id * 1000 / 262144.0) AS seconds,
 CASE WHEN n <> 0 THEN n * 1e9 * 1.25 / 1073741824 ELSE value / 3600 * 3.13 END AS gb, CASE WHEN n <> 0 THEN 'corrected ' || printf('%+.1f', n * 33.0) || 'ms (was ' || printf('%+.1f', -n * 33.0) || 'ms, residual +0.5ms)' WHEN event_id % 2 = 0 THEN 'ok' ELSE 'unverified' END AS sync, CASE WHEN n > 2 THEN 'ok' ELSE 'missing' END AS keyboard FROM c""")  # fmt: skip
def _(spark, d):
    e, i = spark.read.parquet(f"{d}/events.parquet"), F.col("event_id")
    cell = F.when(i % 5 == 0, "").when(i % 5 == 1, "junk").when(i % 5 == 2, "0.0").otherwise(F.col("value").cast("string"))
    maps, px, n = F.when(i % 3 == 0, "camera_look_velocity").otherwise("cursor_position"), F.when(i % 2 == 0, "left").otherwise("right"), i % 7
    sx, sy = cells.axis_signs(maps, px, F.lit("up"))
    shift = (n * 33.0).cast("double")
    status = F.when(i % 2 == 0, "PASS").otherwise("WARN")
    return e.select(
        "event_id", cells.moving(cell).alias("moves"), cells.input_track(cell, sx).alias("track"), sy.alias("dy_sign"), cells.pixels(cell, F.lit(1920).cast("bigint")).alias("width"), cells.lag_ms((i % 40).cast("double"), n.cast("double")).alias("lag_ms"),
        cells.seconds_or_estimate(F.when(n < 4, F.col("value")), i * 1000, 262144.0).alias("seconds"), cells.upload_gb(n * 1e9, F.col("value")).alias("gb"), cells.sync_text(shift, -shift, F.lit(0.5), status).alias("sync"),
        cells.data_quality(n > 2, n > 1, n > 0, n)["keyboard_capture"].alias("keyboard"),
    )


@query("sampling", "WITH s AS (SELECT user_id AS session_id, list(value ORDER BY event_id) AS v, count(*) AS n FROM events GROUP BY 1), t AS (SELECT *, list_concat([0.3], list_transform(range(0, CAST(greatest(ceil((least(n * 1.7, 86400.0) - 2.6) / 5.0), 0) AS BIGINT)), lambda i: 2.0 + i * 5.0), [greatest(least(n * 1.7, 86400.0) - 0.5, 0.3)]) AS times, list_filter(v[:12], lambda x: x > 30) AS g, list_filter(v[:6], lambda x: x > 0) AS b FROM s) SELECT session_id, len(times) AS n_times, round(list_sum(times), 6) AS total, len(list_filter(v, lambda x, i: (i - 1) % CAST(greatest(ceil(n / 5.0), 1) AS BIGINT) = 0)) AS n_sub, round(CASE WHEN len(g) > 0 THEN list_avg(g) ELSE list_sort(v)[CAST(floor(n * 0.75) AS BIGINT) + 1] END, 9) AS baseline, CASE WHEN list_avg(b) >= 0.5 THEN round(list_avg(v) / list_avg(b), 2) END AS still FROM t")
def _(spark, d):
    s = spark.read.parquet(f"{d}/events.parquet").groupBy(F.col("user_id").alias("session_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "value"))), lambda x: x.value).alias("v"), F.count("*").alias("n"))
    v, times = F.col("v"), cells.sweep_times(F.col("n") * 1.7, 5.0)
    seen = F.transform(v, lambda x: F.when(x > 30, x))
    return s.select("session_id", F.size(times).alias("n_times"), F.round(F.aggregate(times, F.lit(0.0), lambda a, x: a + x), 6).alias("total"), F.size(cells.even_subsample(v, 5)).alias("n_sub"), F.round(cells.motion_baseline(seen, v), 9).alias("baseline"), cells.stillness(v, F.transform(v, lambda x: F.when(x > 0, x))).alias("still"))


# --- key bindings --------------------------------------------------------------------------------------------------

BINDINGS = "bi AS (SELECT user_id % 7 AS game, min(event_id) AS place, event_type AS semantic, 'k' || CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 9 AS literal FROM events GROUP BY ALL), sn AS (SELECT DISTINCT user_id % 7 AS game, 'k' || event_id % 13 AS literal FROM events)"


@query("keybind_inverted", f"WITH {BINDINGS} SELECT coalesce(bi.game, sn.game) AS game, coalesce(bi.literal, sn.literal) AS literal, coalesce(array_to_string(list(semantic ORDER BY place) FILTER (WHERE semantic IS NOT NULL), ','), '') AS semantics FROM bi FULL JOIN sn ON bi.game = sn.game AND bi.literal = sn.literal GROUP BY 1, 2")
def _(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    game = F.pmod("user_id", F.lit(7)).alias("game")
    literal = F.concat(F.lit("k"), (F.regexp_extract("props", "([0-9]+)", 1).cast("int") % 9).cast("string")).alias("literal")
    bound = e.groupBy(game, F.col("event_type").alias("semantic"), literal).agg(F.min("event_id").alias("place"))
    seen = e.select(game, F.concat(F.lit("k"), (F.col("event_id") % 13).cast("string")).alias("literal")).distinct()
    return keybinds.inverted(bound, seen, ["game"]).select("game", "literal", F.array_join("semantics", ",").alias("semantics"))


def _entries(m) -> F.Column:
    return F.array_join(F.array_sort(F.transform(F.map_entries(m), lambda e: F.concat(e.key, F.lit("="), F.array_join(e.value, "+")))), ";")


#: Each kind of binding and, beside it, what must become of it: turned round or not, after precedence, patch and cover.
DIRECTION = ["jump=w;move_far_left=w+a", "jump=w;run=a+d", "", "jump=w"]



@query("keybind_maps", "SELECT o_orderkey, CASE o_orderkey % 4 " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(DIRECTION)) + " END AS direction, CASE o_orderkey % 4 WHEN 0 THEN 'a=move_far_left;w=jump+move_far_left' WHEN 1 THEN 'jump=w;run=a+d' WHEN 2 THEN 'jump=space' ELSE 'jump=w' END AS resolved, CASE o_orderkey % 4 WHEN 0 THEN 'a=move_far_left;w=x' WHEN 1 THEN 'jump=w;run=a+d;w=x' WHEN 2 THEN 'w=x' ELSE 'jump=w;w=x' END AS patched, CASE o_orderkey % 4 WHEN 0 THEN 'q' ELSE 'q,w' END AS uncovered FROM orders")
def _(spark, d):
    def m(**entries):
        return F.map_from_arrays(F.array(*[F.lit(k) for k in entries]).cast("array<string>"), F.array(*[F.array(*[F.lit(x) for x in v]) for v in entries.values()]).cast("array<array<string>>"))

    i = F.col("o_orderkey") % 4
    b = F.when(i == 0, m(w=["jump", "move_far_left"], a=["move_far_left"])).when(i == 1, m(jump=["w"], run=["a", "d"])).when(i == 2, m()).otherwise(m(jump=["w"]))
    o = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", b.alias("b"))
    b = F.col("b")
    return o.select("o_orderkey", _entries(keybinds.semantic_to_literal(b, ["jump", "run"])).alias("direction"), _entries(keybinds.resolved(b, F.lit(True), m(jump=["space"]))).alias("resolved"), _entries(keybinds.patched(b, m(w=["x"]))).alias("patched"), F.array_join(keybinds.uncovered(F.array(F.lit("w"), F.lit("q")), b), ",").alias("uncovered"))


# --- corrections ---------------------------------------------------------------------------------------------------

@query("signal_choice", "WITH a AS (SELECT user_id AS session_id, avg(CASE WHEN abs(CASE WHEN event_type = 'click' AND user_id % 3 = 0 THEN value ELSE 0 END) > 1e-4 THEN 1.0 ELSE 0.0 END) AS mouse, avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) AS pose FROM events GROUP BY 1) SELECT session_id, CASE WHEN mouse >= 0.1 THEN 'mouse' WHEN pose >= 0.1 THEN 'camera_pose' ELSE 'none' END AS source FROM a")
def _(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    dx = F.when((F.col("event_type") == "click") & (F.col("user_id") % 3 == 0), F.col("value")).otherwise(0.0)
    turn = F.when(F.col("event_type") == "error", 1.0).otherwise(0.0)
    a = e.groupBy(F.col("user_id").alias("session_id")).agg(correct.active_share(dx, F.lit(0.0)).alias("mouse"), correct.active_share(turn, F.lit(0.0)).alias("pose"))
    return a.select("session_id", correct.signal(F.col("mouse"), F.col("pose"), 0.1).alias("source"))


@query("shift_recovered", f"WITH {EV}, n AS (SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY t, seq) AS i, event_type || k AS v FROM ev), f AS (SELECT session_id, i - (session_id % 21 - 10) AS i, CASE WHEN session_id % 4 = 0 AND i % 3 = 0 THEN 'x' ELSE v END AS v FROM n), m AS (SELECT n.session_id, s.shift, bool_and(n.v = f.v) AS same, count(*) AS c FROM n JOIN f USING (session_id) JOIN (SELECT unnest(range(-15, 16)) AS shift) s ON f.i + s.shift = n.i GROUP BY ALL), g AS (SELECT session_id, count(*) AS c, min(shift) AS shift FROM m WHERE c >= 3 AND same GROUP BY 1) SELECT session_id, CASE WHEN c = 1 THEN shift END AS shift FROM (SELECT DISTINCT session_id FROM n) LEFT JOIN g USING (session_id)")
def _(spark, d):
    from pyspark.sql import Window

    e = events(spark, d)
    n = e.select("session_id", F.row_number().over(Window.partitionBy("session_id").orderBy("t", "seq")).alias("i"), F.concat("event_type", F.col("k").cast("string")).alias("v"))
    f = n.select("session_id", (F.col("i") - (F.col("session_id") % 21 - 10)).alias("i"), F.when((F.col("session_id") % 4 == 0) & (F.col("i") % 3 == 0), "x").otherwise(F.col("v")).alias("v"))
    return correct.constant_shift(n, f, "session_id", "i", "v")


@query("head_trimmed", "WITH n AS (SELECT o_orderkey AS l_orderkey, o_orderkey % 4 + 1 AS n FROM orders), r AS (SELECT l_orderkey, l_linenumber, l_linenumber * 33.0 AS t, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC) AS back FROM lineitem), k AS (SELECT r.* FROM r JOIN n USING (l_orderkey) WHERE back <= n) SELECT l_orderkey, l_linenumber, t - min(t) OVER (PARTITION BY l_orderkey) AS t, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS frame_id, '' AS camera_fx FROM k")
def _(spark, d):
    rows = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", (F.col("l_linenumber") * 33.0).alias("t"), F.lit("0.5").alias("camera_fx"))
    keep = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_orderkey") % 4 + 1).alias("n"))
    out = correct.head_trimmed(rows, keep, "l_orderkey", "l_linenumber", "t")
    return correct.projected(correct.blanked(out, ["camera_fx"]), ["l_orderkey", "l_linenumber", "t", "frame_id", "camera_fx"])


@query("segment_windows", "WITH w AS (SELECT l_orderkey AS k, l_quantity * 1.0 AS t0, l_quantity + l_linenumber * 4.0 AS t1 FROM lineitem), s AS (SELECT o_orderkey AS k, o_orderkey * 10 + j AS segment, j * 20.0 AS s0, j * 20.0 + 15 AS s1 FROM orders CROSS JOIN (SELECT unnest(range(0, 3)) AS j)) SELECT segment, greatest(t0, s0) - s0 AS t0, least(t1, s1) - s0 AS t1 FROM w JOIN s USING (k) WHERE t0 < s1 AND t1 > s0")
def _(spark, d):
    w = spark.read.parquet(f"{d}/lineitem.parquet").select(F.col("l_orderkey").alias("k"), F.col("l_quantity").cast("double").alias("t0"), (F.col("l_quantity") + F.col("l_linenumber") * 4.0).alias("t1"))
    s = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("k"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("j"))
    s = s.select("k", (F.col("k") * 10 + F.col("j")).alias("segment"), (F.col("j") * 20.0).alias("s0"), (F.col("j") * 20.0 + 15).alias("s1"))
    return correct.windows_of_segments(w, s, "k")


@query("numbers_recomputed", "SELECT o_orderkey, CASE WHEN abs(o_orderkey % 9 - 4) <= 2 THEN o_orderkey % 9 ELSE 4 END AS frame_count FROM orders")
def _(spark, d):
    o = F.col("o_orderkey")
    return spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", correct.recomputed(o % 9, F.lit(4), F.lit(2)).alias("frame_count"))


# --- folders -------------------------------------------------------------------------------------------------------

NAMES = ["video.mp4", "frames.csv", "session.json", "inputs.jsonl", "metadata.json", "key_binding.json"]


@query("payload_kinds", f"WITH s AS (SELECT o_orderkey, list_filter({NAMES}, lambda x, i: (o_orderkey // CAST(pow(2, i - 1) AS BIGINT)) % 2 = 1) AS f, CASE o_custkey % 3 WHEN 0 THEN '{{}}' WHEN 1 THEN '{{\"canonical\":1}}' ELSE 'no' END AS js FROM orders) SELECT o_orderkey, CASE WHEN list_has_all(f, ['frames.csv', 'session.json', 'key_binding.json']) THEN 'v1' WHEN list_has_all(f, ['frames.csv', 'session.json']) THEN CASE WHEN NOT json_valid(js) THEN 'garbage' WHEN json_exists(js, '$.canonical') THEN 'v1' ELSE 'v2' END WHEN list_has_all(f, ['video.mp4', 'inputs.jsonl', 'metadata.json']) THEN 'raw' ELSE 'garbage' END AS kind FROM s")
def _(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    files = F.filter(F.array(*[F.lit(n) for n in NAMES]), lambda x, i: F.floor(F.col("o_orderkey") / F.pow(F.lit(2), i)) % 2 == 1)
    js = F.when(F.col("o_custkey") % 3 == 0, "{}").when(F.col("o_custkey") % 3 == 1, '{"canonical":1}').otherwise("no")
    return o.select("o_orderkey", readers.payload_kind(files, js).alias("kind"))


SID = "2024-01-01T00-00-00Z_kamla_c_0123456789abcdef"
BAD = [
    "a/b", "g/op/20240101", f"g/op/p/01-02-2024/{SID}", f"g/op/p/{SID}/{SID}", f"g/op/p/{SID}/x", f"g/op/p/{SID} (2)/x", f"g/op/p/junk/{SID}", "g/op/p/junk/more", "g/op/p/q/r/s/t", "g/op/p/x",
    f"g/op/p/{SID} (1)", "g/op/p/Z_c_0123456789abcdef", "g/op/p/tmp", "g/op/p/plain",
]
WHY = ["", "", "", "", "", "", "", "", "", "folder is not an email", "x doesn't match the id pattern", "x doesn't match the id pattern", "x doesn't match the id pattern", "else"]
CLASSES = [
    "too shallow (depth 2)", "no player folder (depth 3)", "date folder between (depth 5)", "session inside a session (depth 5)", "folder inside a session (depth 5)", "session inside a copied session (depth 5)",
    "folder between player and session (depth 5)", "other nesting (depth 5)", "too deep (depth 7)", "player folder is no e-mail (depth 4)", "copied session (depth 4)", "mangled session id (depth 4)", "junk session name (depth 4)", "other",
]


@query("path_problems", "SELECT CASE p_partkey % 14 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(CLASSES)) + " END AS problem, count(*) AS n FROM part GROUP BY 1")
def _(spark, d):
    pick = lambda v: F.element_at(F.array(*[F.lit(x) for x in v]), (F.col("p_partkey") % 14 + 1).cast("int"))
    p = spark.read.parquet(f"{d}/part.parquet").select(pick(BAD).alias("path"), pick(WHY).alias("why"))
    return p.groupBy(readers.path_problem(F.col("path"), F.col("why")).alias("problem")).agg(F.count("*").alias("n"))


@query("bin_stats", "WITH r AS (SELECT l_orderkey AS k, CASE WHEN l_linenumber % 2 = 0 THEN [l_returnflag, l_linestatus] ELSE []::VARCHAR[] END AS keys, CASE WHEN l_suppkey % 5 = 0 THEN ['left'] ELSE []::VARCHAR[] END AS buttons, l_quantity % 3 AS dx, l_suppkey % 7 = 0 AS bleed, l_linenumber % 3 AS dropped FROM lineitem) SELECT k, bool_or(len(keys) > 0) AS has_keyboard, bool_or(dx <> 0) AS has_motion, bool_or(len(buttons) > 0) AS has_buttons, array_to_string(list_sort(list_distinct(flatten(list(keys)))), ',') AS keys_seen, array_to_string(list_sort(list_distinct(flatten(list(buttons)))), ',') AS buttons_seen, count(*) FILTER (WHERE bleed) AS bleed_frames, CAST(sum(dropped) AS BIGINT) AS dropped FROM r GROUP BY 1")
def _(spark, d):
    none = F.array().cast("array<string>")
    r = spark.read.parquet(f"{d}/lineitem.parquet").select(
        F.col("l_orderkey").alias("k"), F.when(F.col("l_linenumber") % 2 == 0, F.array("l_returnflag", "l_linestatus")).otherwise(none).alias("keys"), F.when(F.col("l_suppkey") % 5 == 0, F.array(F.lit("left"))).otherwise(none).alias("buttons"),
        (F.col("l_quantity") % 3).cast("double").alias("dx"), F.lit(0.0).alias("dy"), (F.col("l_suppkey") % 7 == 0).alias("bleed"), (F.col("l_linenumber") % 3).alias("dropped"),
    )
    out = checks.bin_stats(r, "k")
    return out.withColumns({c: F.array_join(c, ",") for c in ("keys_seen", "buttons_seen")})


# --- ledger --------------------------------------------------------------------------------------------------------

HELD_L = "held AS (SELECT o_orderkey AS session_id, 'p' || o_orderkey AS path, CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE 'x' || o_custkey % 3 END AS player, CASE WHEN o_orderkey % 3 = 0 THEN 'QUARANTINED' ELSE 'READY' END AS state, '[1]' AS reasons FROM orders WHERE o_orderkey % 5 <> 0), listed AS (SELECT o_orderkey AS session_id, CASE WHEN o_orderkey % 4 = 0 THEN 'p' || o_orderkey WHEN o_orderkey % 4 = 1 THEN 'q' || o_orderkey ELSE 'p' || o_orderkey + 1 END AS path, 'x' || o_custkey % 3 AS player FROM orders)"
KINDS = "pl AS (SELECT l.session_id, l.path, CASE WHEN h.state IS NULL THEN 'new' WHEN h.path = l.path THEN 'same' WHEN h.state = 'QUARANTINED' AND (h.player = '' OR h.player = l.player) THEN 'heal' WHEN NOT EXISTS (SELECT 1 FROM listed x WHERE x.path = h.path) AND h.player = l.player THEN 'moved' ELSE 'collision' END AS kind FROM listed l LEFT JOIN held h USING (session_id))"


def _listed_and_held(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    k, player = F.col("o_orderkey"), F.concat(F.lit("x"), (F.col("o_custkey") % 3).cast("string"))
    p = lambda c, n: F.concat(F.lit(c), n.cast("string"))
    held = o.filter(k % 5 != 0).select(k.alias("session_id"), p("p", k).alias("path"), F.when(k % 6 == 0, "").otherwise(player).alias("player"), F.when(k % 3 == 0, "QUARANTINED").otherwise("READY").alias("state"), F.lit("[1]").alias("reasons"))
    listed = o.select(k.alias("session_id"), F.when(k % 4 == 0, p("p", k)).when(k % 4 == 1, p("q", k)).otherwise(p("p", k + 1)).alias("path"), player.alias("player"))
    return listed, held


@query("placements", f"WITH {HELD_L}, {KINDS} SELECT * FROM pl")
def _(spark, d):
    return ledger.placements(*_listed_and_held(spark, d))


@query("healed", f"WITH {HELD_L}, {KINDS} SELECT h.session_id, CASE WHEN kind = 'heal' THEN pl.path ELSE h.path END AS path, CASE WHEN kind = 'heal' THEN 'DISCOVERED' ELSE state END AS state, CASE WHEN kind = 'heal' THEN '[]' ELSE reasons END AS reasons, CASE WHEN kind = 'heal' THEN 'healed from ' || h.path END AS detail FROM held h LEFT JOIN pl USING (session_id)")
def _(spark, d):
    listed, held = _listed_and_held(spark, d)
    after, audit = ledger.healed(held, ledger.placements(listed, held), F.lit("2024-01-01"))
    return after.join(audit.select("session_id", "detail"), "session_id", "left").select("session_id", "path", "state", "reasons", "detail")


@query("went_down", "WITH b AS (SELECT o_custkey AS player, count(*) AS sessions, count(*) * 1.5 AS hours FROM orders GROUP BY 1), n AS (SELECT o_custkey AS player, count(*) AS sessions, count(*) * 1.5 AS hours FROM orders WHERE o_orderkey % 9 <> 0 GROUP BY 1) SELECT b.player, b.sessions AS sessions_before, coalesce(n.sessions, 0) AS sessions_now, n.player IS NULL AS row_gone FROM b LEFT JOIN n USING (player) WHERE coalesce(n.sessions, 0) < b.sessions")
def _(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    report = lambda rows: rows.groupBy(F.col("o_custkey").alias("player")).agg(F.count("*").alias("sessions"), (F.count("*") * 1.5).alias("hours"))
    return ledger.went_down(report(o.filter("o_orderkey % 9 <> 0")), report(o), "player")


@query("game_names", "WITH n AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'outer_wilds' WHEN 1 THEN 'kamla' ELSE '' END AS folder, CASE p_partkey % 3 WHEN 0 THEN 'Outer Wilds' WHEN 1 THEN 'Kamla' ELSE '' END AS claimed, CASE p_partkey % 5 WHEN 0 THEN 'outerwilds' WHEN 1 THEN 'x' ELSE 'kamla' END AS slug FROM part), p AS (SELECT p_partkey, regexp_replace(lower(folder), '[^a-z0-9]', '', 'g') AS f, regexp_replace(lower(claimed), '[^a-z0-9]', '', 'g') AS c, slug AS s FROM n) SELECT p_partkey, array_to_string(list_filter([CASE WHEN f <> '' AND c <> '' AND f <> c THEN 'folder/claimed' END, CASE WHEN f <> '' AND f <> s THEN 'folder/slug' END, CASE WHEN c <> '' AND c <> s THEN 'claimed/slug' END], lambda x: x IS NOT NULL), ',') AS differ FROM p")
def _(spark, d):
    i = F.col("p_partkey")
    folder, claimed = F.when(i % 4 == 0, "outer_wilds").when(i % 4 == 1, "kamla").otherwise(""), F.when(i % 3 == 0, "Outer Wilds").when(i % 3 == 1, "Kamla").otherwise("")
    slug = F.when(i % 5 == 0, "outerwilds").when(i % 5 == 1, "x").otherwise("kamla")
    return spark.read.parquet(f"{d}/part.parquet").select("p_partkey", F.array_join(ledger.game_mismatches(folder, claimed, slug), ",").alias("differ"))


@query("game_identity", "WITH g AS (SELECT o_orderkey AS k, CASE o_orderkey % 3 WHEN 0 THEN 'kamla' WHEN 1 THEN 'outer_wilds' ELSE 'minecraft' END AS top, o_custkey % 12 AS votes, o_custkey % 12 + o_orderkey % 2 AS named, 14 AS frames, CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'doom' WHEN 2 THEN 'outer_wilds' ELSE 'kamla' END AS claimed, CASE WHEN o_orderkey % 7 = 0 THEN 'outer_wilds' ELSE '' END AS expected FROM orders), x AS (SELECT *, claimed <> '' AND NOT contains(replace(claimed, '_', ''), replace(top, '_', '')) AND NOT contains(replace(top, '_', ''), replace(claimed, '_', '')) AS doubt FROM g), y AS (SELECT *, doubt AND votes >= 8 AND votes / greatest(named, 1) >= 0.9 AND votes / frames >= 0.5 AS sure FROM x), z AS (SELECT *, CASE WHEN claimed <> '' AND claimed NOT IN ('kamla', 'outer_wilds') THEN 'CNT_WRONG_GAME' WHEN claimed <> '' AND expected <> '' AND expected <> claimed THEN 'STR_GAME_MISMATCH' WHEN doubt THEN 'advisory: verify the game by hand' END AS rest FROM y) SELECT k, CASE WHEN sure THEN 'advisory: video shows another game' ELSE rest END AS reported, CASE WHEN sure THEN CASE WHEN top IN ('kamla', 'outer_wilds') THEN 'STR_GAME_MISMATCH' ELSE 'CNT_WRONG_GAME' END ELSE rest END AS gated FROM z")
def _(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    g = spark.read.parquet(f"{d}/orders.parquet").select(
        k.alias("k"), F.when(k % 3 == 0, "kamla").when(k % 3 == 1, "outer_wilds").otherwise("minecraft").alias("top"), (c % 12).alias("votes"), (c % 12 + k % 2).alias("named"), F.lit(14).alias("frames"),
        F.when(k % 5 == 0, "").when(k % 5 == 1, "doom").when(k % 5 == 2, "outer_wilds").otherwise("kamla").alias("claimed"), F.when(k % 7 == 0, "outer_wilds").otherwise("").alias("expected"),
    )
    args = [F.col(x) for x in ("top", "votes", "named", "frames", "claimed", "expected")]
    return g.select("k", decide.game_identity(*args, ["kamla", "outer_wilds"]).alias("reported"), decide.game_identity(*args, ["kamla", "outer_wilds"], True).alias("gated"))


@query("sheet_flags", "WITH f AS (SELECT o_orderkey AS k, o_custkey % 100 AS up, o_orderkey % 2 = 0 AS countable, o_orderkey % 5 = 0 AS rejected, o_orderkey % 3 = 0 AS reported, o_orderkey % 7 = 0 AS sealed, o_orderkey % 4 = 0 AS uncounted FROM orders), g AS (SELECT *, up >= 40 AND up < 70 AND NOT reported AS inw FROM f) SELECT k, inw AS in_window, NOT inw AND up < 40 AND (countable OR rejected) AND NOT reported AS late, up < 70 AND NOT sealed AND reported AND uncounted AS accepted_due, NOT inw AND up < 70 AND NOT sealed AND NOT reported AND NOT (countable OR rejected) AND uncounted AS uncountable_due FROM g")
def _(spark, d):
    k = F.col("o_orderkey")
    flags = ledger.sheet_flags(F.col("o_custkey") % 100, F.lit(40), F.lit(70), k % 2 == 0, k % 5 == 0, k % 3 == 0, k % 7 == 0, k % 4 == 0)
    return spark.read.parquet(f"{d}/orders.parquet").select(k.alias("k"), *[c.alias(n) for n, c in flags.items()])


@query("operator_totals", f"WITH {SE} SELECT operator, round(sum(round(cents / 1234.0, 2)), 2) AS hours FROM se GROUP BY 1")
def _(spark, d):
    return ledger.operator_totals(sessions(spark, d).select("operator", (F.col("cents") / 1234.0).alias("hours")), "operator", ["hours"])


@query("dispatch_order", "WITH s AS (SELECT o_orderkey AS session_id, o_orderdate AS created, CASE o_orderkey % 7 WHEN 0 THEN 'FIX_QUEUED' WHEN 1 THEN 'VALIDATING' WHEN 2 THEN 'HOLD_VLM' WHEN 3 THEN 'INGESTED' WHEN 4 THEN 'FIXING' ELSE 'READY' END AS state, o_custkey AS player FROM orders), r AS (SELECT *, CASE state WHEN 'FIX_QUEUED' THEN 0 WHEN 'VALIDATING' THEN 1 WHEN 'FIXING' THEN 1 WHEN 'HOLD_VLM' THEN 2 WHEN 'INGESTED' THEN 3 END AS rank FROM s) SELECT player, session_id, state FROM (SELECT *, row_number() OVER (PARTITION BY player ORDER BY rank, created, session_id) AS place FROM r WHERE rank IS NOT NULL) WHERE place = 1")
def _(spark, d):
    from pyspark.sql import Window

    k = F.col("o_orderkey")
    state = F.when(k % 7 == 0, "FIX_QUEUED").when(k % 7 == 1, "VALIDATING").when(k % 7 == 2, "HOLD_VLM").when(k % 7 == 3, "INGESTED").when(k % 7 == 4, "FIXING").otherwise("READY")
    s = spark.read.parquet(f"{d}/orders.parquet").select(k.alias("session_id"), F.col("o_orderdate").alias("created"), state.alias("state"), F.col("o_custkey").alias("player")).withColumn("rank", ledger.dispatch_rank(F.col("state")))
    w = Window.partitionBy("player").orderBy("rank", "created", "session_id")
    return s.filter("rank is not null").withColumn("place", F.row_number().over(w)).filter("place = 1").select("player", "session_id", "state")


@query("ledger_reads", f"WITH {SE}, x AS (SELECT *, CASE WHEN session_id % 9 = 0 THEN '' ELSE 'm' || session_id % 4 END AS md5, max(created) OVER () AS now FROM se) SELECT session_id, 'state' AS read FROM x WHERE state IN ('READY', 'SPLIT') UNION ALL SELECT session_id, 'md5' FROM x WHERE md5 = 'm3' UNION ALL SELECT session_id, 'recent' FROM x WHERE state = 'DELIVERED' AND created > now - INTERVAL 2400 HOUR UNION ALL SELECT session_id, 'left' FROM x WHERE session_id NOT IN (SELECT session_id FROM x WHERE state = 'DELIVERED')")
def _(spark, d):
    s = sessions(spark, d)
    s = s.withColumn("md5", F.when(F.col("session_id") % 9 == 0, "").otherwise(F.concat(F.lit("m"), (F.col("session_id") % 4).cast("string"))))
    now = F.lit(s.agg(F.max("created").alias("now")).first()["now"])
    reads = {"state": ledger.by_state(s, "READY", "SPLIT"), "md5": ledger.by_md5(s, "m3"), "recent": ledger.delivered_since(s, "created", now, 2400), "left": ledger.removed(s, s.filter("state = 'DELIVERED'"), "session_id")}
    out = [rows.select("session_id", F.lit(name).alias("read")) for name, rows in reads.items()]
    return out[0].union(out[1]).union(out[2]).union(out[3])


@query("superseded", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 4 = 0 OR o_orderkey % 5 = o_custkey % 5 THEN o_totalprice END AS paid FROM orders")
def _(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    old = F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("m"), (k % 5).cast("string")))
    new = F.when(k % 4 != 0, F.concat(F.lit("m"), (c % 5).cast("string")))
    paid = ledger.superseded(old, new, {"paid": F.col("o_totalprice")})
    return spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", paid["paid"].alias("paid"))


@query("gate_destroyed", "SELECT l_orderkey, array_to_string(list_sort(list_distinct(flatten(list([l_returnflag, l_linestatus])))), ',') AS actions, CAST(sum(l_linenumber) AS BIGINT) AS key_frames FROM lineitem GROUP BY 1")
def _(spark, d):
    r = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", F.array("l_returnflag", "l_linestatus").alias("actions"), F.col("l_linenumber").alias("key_frames"))
    return ledger.destroyed(r, "l_orderkey").select("l_orderkey", F.array_join("actions", ",").alias("actions"), "key_frames")


@query("longest_runs", "SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS place FROM events) WHERE place <= 40")
def _(spark, d):
    return ledger.longest(spark.read.parquet(f"{d}/events.parquet").select("user_id", "event_id", "value"), ["user_id"], "event_id", "value").select("user_id", "event_id")


@query("uncounted_trees", f"WITH {SE} SELECT operator AS root, bool_or(state = 'READY' AND session_id % 3 <> 0) AS uncounted FROM se GROUP BY 1")
def _(spark, d):
    s = sessions(spark, d)
    nodes = s.select(F.col("session_id").alias("node"), (F.col("state") == "READY").alias("accepted"), (F.col("session_id") % 3 == 0).alias("counted"))
    return ledger.uncounted_trees(nodes, s.select(F.col("session_id").alias("node"), F.col("operator").alias("root")))
