"""Queries on the event stream: sessions are users, frames a uniform clock, as the survey binds them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickframe.functions import numeric, tokens
from tickframe.functions import tables as T
from tickframe.operators import frames, patterns, sync

#: Recorded key names that event numbers are mapped to, so that every rule of normalisation occurs.
RAW_KEYS = ["W", "a", " S ", "D", "Shift", "LShift", "Right Shift", "ctrl_l", "RCtrl", "F5", "vk_255", "<12>", "0x1f", "Spacebar", "Return", "Escape", "Comma", "caps_lock", "cmd", "volume_up", "", "Tab", "MouseLeft", "Page Up", "e"]
KEYBIND = {
    "move_forward": "W", "move_left": ["A"], "move_back": "s", "move_right": {"key": "D"}, "jump": "Space", "boost": ["spacebar"], "interact": "e", "confirm": ["e", "enter"],
    "sprint": {"modifier": "LShift", "key": "W"}, "crouch": "LCtrl", "look": "mouse", "look_x": "mouse_x", "pause": "Esc", "caps": "capslock", "shoot": "MouseLeft", "nothing": {"modifier": "shift", "key": ""},
}
RULES = frames.compile_rules(KEYBIND)
BOUND = frames.bound_tokens(KEYBIND)
ALLOWED = {"jump": ["on_foot", "suit"], "boost": ["suit"], "interact": ["on_foot", "suit", "cockpit"], "confirm": ["dialogue", "pause_menu"], "look": ["on_foot", "suit", "cockpit"]}
CONTEXTS = ["on_foot", "suit", "dialogue", "cockpit", "map"]
FRAME_US = 7_200_000_000

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def ql(values) -> str:
    """A SQL list of strings."""
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


# --- bindings -----------------------------------------------------------------------------------------------------

EV = "ev AS (SELECT user_id AS session_id, event_id AS seq, epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id) AS t, event_type, value, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events)"
RAW = f"raw AS (SELECT *, {ql(RAW_KEYS)}[k % {len(RAW_KEYS)} + 1] AS raw FROM ev)"


def sql_alias(e: str, table: dict) -> str:
    return "CASE " + e + " " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in table.items()) + f" ELSE {e} END"


LOWERED = "low AS (SELECT *, lower(trim(raw)) AS s FROM raw)"
ALIASED = f"al AS (SELECT *, {sql_alias('s', T.LITERAL_ALIASES)} AS tok FROM low)"
STRIPPED = ", ".join(f"'{x}'" for x in T.OS_KEYS + T.F_KEYS)
KEYS = f"keys AS (SELECT *, CASE WHEN s = '' OR regexp_matches(s, '{T.VIRTUAL_KEY}') OR (tok IN ({STRIPPED}) AND NOT list_contains({ql(BOUND)}, tok)) THEN NULL ELSE tok END AS token FROM al)"
TOKENS = f"WITH {EV}, {RAW}, {LOWERED}, {ALIASED}, {KEYS}"
LAST = "lf AS (SELECT session_id, max(t) // {f} AS last_frame FROM ev GROUP BY 1)".format(f=FRAME_US)
HELD = f"""{TOKENS}, {LAST},
kev AS (SELECT keys.session_id, seq, t, token, event_type = 'click' AS down, t // {FRAME_US} AS frame_id, last_frame FROM keys JOIN lf USING (session_id) WHERE token IS NOT NULL AND event_type IN ('click', 'view')),
m AS (SELECT *, coalesce(lag(down) OVER w, false) AS before, coalesce(min(CASE WHEN NOT down THEN frame_id END) OVER (PARTITION BY session_id, token ORDER BY t, seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), last_frame) AS until FROM kev WINDOW w AS (PARTITION BY session_id, token ORDER BY t, seq)),
sp AS (SELECT session_id, token, frame_id AS f0, until AS f1 FROM m WHERE down AND NOT before UNION ALL SELECT session_id, token, frame_id, frame_id FROM m WHERE NOT down),
hf AS (SELECT DISTINCT session_id, token, unnest(generate_series(f0, f1)) AS frame_id FROM sp WHERE f1 >= f0)"""


def events(spark: SparkSession, d: str) -> DataFrame:
    e = spark.read.parquet(f"{d}/events.parquet").select("user_id", "event_id", "ts", "event_type", "value", "props")
    t = F.unix_micros(F.col("ts").cast("timestamp"))
    return e.select(
        F.col("user_id").alias("session_id"), F.col("event_id").alias("seq"), (t - F.min(t).over(Window.partitionBy("user_id"))).alias("t"), "event_type", "value",
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
    )


def keyed(spark, d) -> DataFrame:
    raw = F.element_at(F.array(*[F.lit(x) for x in RAW_KEYS]), F.col("k") % len(RAW_KEYS) + 1)
    e = events(spark, d).withColumn("raw", raw)
    return e.withColumn("token", tokens.event_key(F.col("raw"), F.array(*[F.lit(b) for b in BOUND])))


def key_events(spark, d) -> DataFrame:
    e = keyed(spark, d)
    e = e.withColumn("frame_id", frames.frame_uniform(F.col("t"), FRAME_US)).withColumn("last_frame", F.max("frame_id").over(Window.partitionBy("session_id")))
    return e.filter("token is not null and event_type in ('click', 'view')").select("session_id", "seq", "t", "token", (F.col("event_type") == "click").alias("down"), "frame_id", "last_frame")


def held(spark, d) -> DataFrame:
    return frames.held_frames(key_events(spark, d), ["session_id"], "last_frame")


def frame_rows(spark, d) -> DataFrame:
    """session_id, frame_id, held (sorted tokens), dx, dy, context: one row a frame that holds anything or moves."""
    e = events(spark, d)
    shown = frames.shown_frames(key_events(spark, d), ["session_id"], "last_frame")
    m = e.filter("event_type = 'purchase'").select("session_id", frames.frame_uniform(F.col("t"), FRAME_US).alias("frame_id"), (F.col("k") - 50).alias("dx"), (F.col("k") % 7 - 3).alias("dy"))
    ctx = F.element_at(F.array(*[F.lit(c) for c in CONTEXTS]), (F.floor(F.col("frame_id") / 9) % len(CONTEXTS) + 1).cast("int"))
    return frames.joined_frames(shown, m, ["session_id"]).withColumn("context", ctx)


ROWS = f"""{HELD}, h AS (SELECT session_id, frame_id, list_sort(list(token)) AS held FROM hf GROUP BY ALL),
mo AS (SELECT session_id, t // {FRAME_US} AS frame_id, sum(k - 50) AS dx, sum(k % 7 - 3) AS dy FROM ev WHERE event_type = 'purchase' GROUP BY 1, 2),
fr AS (SELECT coalesce(h.session_id, mo.session_id) AS session_id, coalesce(h.frame_id, mo.frame_id) AS frame_id, coalesce(held, CAST([] AS VARCHAR[])) AS held, coalesce(dx, 0) AS dx, coalesce(dy, 0) AS dy FROM h FULL JOIN mo ON h.session_id = mo.session_id AND h.frame_id = mo.frame_id),
fx AS (SELECT *, {ql(CONTEXTS)}[(frame_id // 9) % {len(CONTEXTS)} + 1] AS context FROM fr)"""


def sql_rules(context: bool) -> tuple[str, str, str]:
    """SQL of actions, credited and blocked tokens as joined lists."""
    fired, credited, blocked = [], [], []
    for semantic, axis, groups in RULES:
        if axis:
            ok, used = {"x": "dx <> 0", "y": "dy <> 0", "any": "(dx <> 0 OR dy <> 0)"}[axis], "CAST([] AS VARCHAR[])"
        else:
            ok = " AND ".join(f"list_has_any(held, {ql(g)})" for g in groups)
            used = f"list_intersect(held, {ql(sorted({t for g in groups for t in g}))})"
        live = f"context IN ({', '.join(repr(c) for c in ALLOWED[semantic])})" if context and semantic in ALLOWED else "true"
        none = "CAST([] AS VARCHAR[])"
        fired.append(f"CASE WHEN {ok} AND {live} THEN ['{semantic}'] ELSE {none} END")
        credited.append(f"CASE WHEN {ok} AND {live} THEN {used} ELSE {none} END")
        blocked.append(f"CASE WHEN {ok} AND NOT ({live}) THEN {used} ELSE {none} END")
    join = lambda xs: "(" + " || ".join(f"({x})" for x in xs) + ")"
    return join(fired), join(credited), join(blocked)


def sorted_text(c) -> F.Column:
    return F.array_join(F.array_sort(F.array_distinct(c)), "|")


# --- sources and keys -------------------------------------------------------------------------------------------


@query("scan_events_permissive", f"WITH {EV} SELECT session_id, count(*) AS n_lines, count(*) FILTER (WHERE seq % 7 <> 0 AND seq % 11 <> 0 AND seq % 13 <> 0) AS n_kept, CAST(sum(CASE WHEN seq % 7 <> 0 AND seq % 11 <> 0 AND seq % 13 <> 0 THEN t ELSE 0 END) AS BIGINT) AS sum_t FROM ev GROUP BY session_id")
def _(spark, d):
    from tickframe.sources.readers import parse_event_lines

    e = events(spark, d)
    line = F.when(F.col("seq") % 7 == 0, F.lit("not json")).when(F.col("seq") % 11 == 0, F.lit("[1, 2]")).when(F.col("seq") % 13 == 0, F.lit('{"t": "5", "type": "key"}')).otherwise(F.to_json(F.struct("t", F.col("event_type").alias("type"))))
    lines = e.select("session_id", line.alias("value"))
    kept = parse_event_lines(lines).groupBy("session_id").agg(F.count("*").alias("n_kept"), F.sum("t").alias("sum_t"))
    return lines.groupBy("session_id").agg(F.count("*").alias("n_lines")).join(kept, "session_id", "left").select("session_id", "n_lines", F.coalesce("n_kept", F.lit(0)).alias("n_kept"), F.coalesce("sum_t", F.lit(0)).alias("sum_t"))


@query("key_normalize", f"{TOKENS} SELECT raw, token, count(*) AS n FROM keys GROUP BY ALL")
def _(spark, d):
    return keyed(spark, d).groupBy("raw", "token").agg(F.count("*").alias("n"))


@query("token_display", f"""{TOKENS}, d AS (SELECT DISTINCT token FROM keys WHERE token IS NOT NULL),
s AS (SELECT token, CASE token {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in T.KEY_DISPLAY.items())} ELSE CASE WHEN length(token) = 1 THEN upper(token) ELSE array_to_string([upper(p[1]) || lower(p[2:]) for p in string_split(token, '_')], '') END END AS shown FROM d)
SELECT token, shown, token AS back FROM s WHERE token NOT IN ('mouse_left') UNION ALL SELECT token, shown, 'mouse_left' FROM s WHERE token = 'mouse_left'""")
def _(spark, d):
    t = keyed(spark, d).filter("token is not null").select("token").distinct().withColumn("shown", tokens.display(F.col("token")))
    return t.withColumn("back", tokens.canonical(F.col("shown")))


@query("os_keys_two_ways", f"""{TOKENS} SELECT s, s IN ({STRIPPED}) AS in_set, regexp_matches(s, '(cmd|win|super|menu|volume|media|print|lock|^f([1-9]|1[0-9]|2[0-4])$)') AS by_pattern, count(*) AS n FROM keys WHERE s <> '' GROUP BY ALL""")
def _(spark, d):
    s = F.lower(F.trim("raw"))
    k = keyed(spark, d).withColumn("s", s).filter("s <> ''")
    return k.groupBy("s", F.col("s").isin(T.OS_KEYS + T.F_KEYS).alias("in_set"), F.col("s").rlike("(cmd|win|super|menu|volume|media|print|lock|^f([1-9]|1[0-9]|2[0-4])$)").alias("by_pattern")).agg(F.count("*").alias("n"))


@query("coerce_int", """WITH c AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN CAST(value AS VARCHAR) WHEN 1 THEN '-' || CAST(value AS VARCHAR) WHEN 2 THEN 'junk' WHEN 3 THEN '' WHEN 4 THEN CAST(event_id AS VARCHAR) ELSE NULL END AS cell FROM events)
SELECT event_id, CAST(coalesce(trunc(TRY_CAST(cell AS DOUBLE)), 0) AS BIGINT) AS as_int, coalesce(TRY_CAST(cell AS DOUBLE), 0.0) <> 0 AS moving FROM c""")
def _(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", "value")
    m, v = F.col("event_id") % 6, F.col("value").cast("string")
    cell = F.when(m == 0, v).when(m == 1, F.concat(F.lit("-"), v)).when(m == 2, "junk").when(m == 3, "").when(m == 4, F.col("event_id").cast("string"))
    return e.select("event_id", numeric.as_int(cell).alias("as_int"), (numeric.as_float(cell) != 0).alias("moving"))


# --- binning and held state ---------------------------------------------------------------------------------------


@query("bin_uniform", f"WITH {EV} SELECT session_id, greatest(t // {FRAME_US}, 0) AS frame_id, count(*) AS n, CAST(sum(CASE WHEN event_type = 'purchase' THEN k - 50 ELSE 0 END) AS BIGINT) AS dx FROM ev GROUP BY ALL")
def _(spark, d):
    e = events(spark, d).withColumn("frame_id", frames.frame_uniform(F.col("t"), FRAME_US))
    return e.groupBy("session_id", "frame_id").agg(F.count("*").alias("n"), F.sum(F.when(F.col("event_type") == "purchase", F.col("k") - 50).otherwise(0)).alias("dx"))


CLOCK = "cl AS (SELECT session_id, t AS pts_us, row_number() OVER (PARTITION BY session_id ORDER BY t, seq) - 1 AS frame_id FROM ev WHERE event_type = 'view')"


def clock(e: DataFrame) -> DataFrame:
    v = e.filter("event_type = 'view'")
    return v.select("session_id", F.col("t").alias("pts_us"), (F.row_number().over(Window.partitionBy("session_id").orderBy("t", "seq")) - 1).cast("bigint").alias("frame_id"))


@query("bin_asof", f"WITH {EV}, {CLOCK}, o AS (SELECT ev.session_id, ev.seq, ev.t FROM ev WHERE event_type <> 'view') SELECT o.session_id, o.seq, coalesce(cl.frame_id, 0) AS frame_id FROM o ASOF LEFT JOIN cl ON o.session_id = cl.session_id AND o.t >= cl.pts_us")
def _(spark, d):
    e = events(spark, d)
    return frames.bin_as_of(e.filter("event_type <> 'view'").select("session_id", "seq", "t"), clock(e), ["session_id"]).select("session_id", "seq", "frame_id")


@query("bin_forward", f"WITH {EV}, {CLOCK}, o AS (SELECT ev.session_id, ev.seq, ev.t FROM ev WHERE event_type <> 'view') SELECT o.session_id, o.seq, cl.frame_id FROM o ASOF LEFT JOIN cl ON o.session_id = cl.session_id AND o.t <= cl.pts_us")
def _(spark, d):
    e = events(spark, d)
    return frames.bin_forward(e.filter("event_type <> 'view'").select("session_id", "seq", "t"), clock(e), ["session_id"]).select("session_id", "seq", "frame_id")


@query("bin_nominal", f"WITH {EV}, n AS (SELECT session_id, count(*) AS frames FROM ev GROUP BY 1) SELECT session_id, least(CAST(floor(t * 0.0001 / 1e6) AS BIGINT), frames - 1) AS frame_id, count(*) AS n FROM ev JOIN n USING (session_id) GROUP BY ALL")
def _(spark, d):
    e = events(spark, d).withColumn("frames", F.count("*").over(Window.partitionBy("session_id")))
    return e.groupBy("session_id", frames.frame_nominal(F.col("t"), 0.0001, F.col("frames")).alias("frame_id")).agg(F.count("*").alias("n"))


@query("remap_shift", f"WITH {EV}, {CLOCK}, o AS (SELECT session_id, pts_us - 3600000000 AS at, frame_id FROM cl) SELECT o.session_id, o.frame_id, coalesce(cl.frame_id, -1) AS source_frame FROM o ASOF LEFT JOIN cl ON o.session_id = cl.session_id AND o.at >= cl.pts_us")
def _(spark, d):
    c = clock(events(spark, d))
    at = c.select("session_id", (F.col("pts_us") - 3_600_000_000).alias("at"), F.col("frame_id").alias("frame"))
    out = patterns.as_of(at, c, ["session_id"], "at", "pts_us", "frame_id")
    return out.select("session_id", F.col("frame").alias("frame_id"), F.coalesce("frame_id", F.lit(-1)).cast("bigint").alias("source_frame"))


@query("held_state", f"{HELD} SELECT session_id, frame_id, array_to_string(list_sort(list(token)), '|') AS held FROM hf GROUP BY ALL")
def _(spark, d):
    return held(spark, d).groupBy("session_id", "frame_id").agg(F.array_join(F.array_sort(F.collect_set("token")), "|").alias("held"))


HEAD, LENGTH = 10 * 86_400_000_000, 10 * 86_400_000_000


@query("carry_cut", f"""{HELD}, st AS (SELECT session_id, token, arg_max(down, (t, seq)) AS down FROM kev WHERE t < {HEAD} GROUP BY 1, 2)
SELECT session_id, 0 AS t, -1 AS seq, token, true AS down FROM st WHERE down UNION ALL SELECT session_id, t - {HEAD}, seq, token, down FROM kev WHERE t >= {HEAD} AND t < {HEAD + LENGTH}""")
def _(spark, d):
    return frames.carry_over_cut(key_events(spark, d), ["session_id"], HEAD, LENGTH)


@query("bleed_resolve", f"""{HELD}, h AS (SELECT session_id, frame_id, list(token) AS held FROM hf GROUP BY ALL),
b AS (SELECT *, [x FOR x IN held IF NOT ((x = 'shift_r' AND list_contains(held, 'shift_l')) OR (x = 'ctrl_r' AND list_contains(held, 'ctrl_l')) OR (x = 'alt_r' AND list_contains(held, 'alt_l')))] AS kept FROM h)
SELECT session_id, frame_id, array_to_string(list_sort(kept), '|') AS kept FROM b WHERE len(kept) < len(held)""")
def _(spark, d):
    h = held(spark, d).groupBy("session_id", "frame_id").agg(F.collect_set("token").alias("held"))
    kept = frames.without_bleed(F.col("held"), F.array(*[F.lit(b) for b in BOUND]))
    return h.filter(frames.bled(F.col("held"))).select("session_id", "frame_id", F.array_join(F.array_sort(kept), "|").alias("kept"))


_A, _C, _B = sql_rules(False)
_AX, _CX, _BX = sql_rules(True)


@query("resolve_actions", f"{ROWS} SELECT session_id, frame_id, array_to_string(list_sort(list_distinct({_A})), '|') AS actions, array_to_string(list_sort(list_distinct({_C})), '|') AS credited FROM fx")
def _(spark, d):
    r = frame_rows(spark, d)
    actions, _, credited = frames.resolve(F.col("held"), F.col("dx") != 0, F.col("dy") != 0, RULES)
    return r.select("session_id", "frame_id", sorted_text(actions).alias("actions"), sorted_text(credited).alias("credited"))


@query("context_gating", f"{ROWS}, g AS (SELECT *, list_distinct({_AX}) AS a, list_distinct({_CX}) AS c, list_distinct({_BX}) AS b FROM fx) SELECT session_id, frame_id, context, array_to_string(list_sort(a), '|') AS actions, array_to_string(list_sort([x FOR x IN b IF NOT list_contains(c, x)]), '|') AS dead FROM g")
def _(spark, d):
    r = frame_rows(spark, d)
    actions, dead, _ = frames.resolve(F.col("held"), F.col("dx") != 0, F.col("dy") != 0, RULES, F.col("context"), ALLOWED)
    return r.select("session_id", "frame_id", "context", sorted_text(actions).alias("actions"), sorted_text(dead).alias("dead"))


@query("ambiguous_collapse", f"""{ROWS}, a AS (SELECT session_id, frame_id, list_contains(held, 'space') AS bt FROM fx),
n AS (SELECT *, CASE WHEN bt AND NOT coalesce(lag(bt) OVER w, false) THEN 1 ELSE 0 END AS new FROM a WINDOW w AS (PARTITION BY session_id ORDER BY frame_id)),
r AS (SELECT *, sum(new) OVER (PARTITION BY session_id ORDER BY frame_id ROWS UNBOUNDED PRECEDING) AS run FROM n),
z AS (SELECT *, sum(CASE WHEN bt THEN 1 ELSE 0 END) OVER (PARTITION BY session_id, run) AS size FROM r)
SELECT session_id, frame_id, CASE WHEN size < 6 THEN 'jump' ELSE 'boost' END AS kept FROM z WHERE bt""")
def _(spark, d):
    r = frame_rows(spark, d).select("session_id", "frame_id", F.when(F.array_contains("held", "space"), F.array(F.lit("jump"), F.lit("boost"))).otherwise(F.array().cast("array<string>")).alias("actions"))
    out = frames.collapse_pair(r, ["session_id"], "jump", "boost", fps=20.0)
    return out.filter("size(actions) > 0").select("session_id", "frame_id", F.element_at("actions", 1).alias("kept"))


# --- runs and windows ---------------------------------------------------------------------------------------------

FLAG = f"WITH {EV}, b AS (SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY t, seq) - 1 AS i, CASE WHEN k % 3 = 0 THEN 0 ELSE 1 END AS flag, k, t, seq FROM ev)"
FLIP = "{a}n AS (SELECT *, CASE WHEN lag(flag) OVER (PARTITION BY session_id ORDER BY i) = flag THEN 0 ELSE 1 END AS nw FROM {src}), {a}r AS (SELECT *, sum(nw) OVER (PARTITION BY session_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM {a}n), {a}z AS (SELECT *, count(*) OVER (PARTITION BY session_id, run) AS size, max(run) OVER (PARTITION BY session_id) AS last FROM {a}r)"


def flags(spark, d) -> DataFrame:
    e = events(spark, d)
    return e.select("session_id", (F.row_number().over(Window.partitionBy("session_id").orderBy("t", "seq")) - 1).cast("bigint").alias("i"), F.when(F.col("k") % 3 == 0, 0).otherwise(1).alias("flag"), "k", "t", "seq")


@query("close_binary", f"{FLAG}, {FLIP.format(a='x', src='b')} SELECT session_id, i, CASE WHEN flag = 0 AND size <= 1 AND run > 1 AND run < last THEN 1 ELSE flag END AS flag FROM xz")
def _(spark, d):
    return frames.binary_close(flags(spark, d), ["session_id"], "i", "flag", 1).select("session_id", "i", "flag")


@query("open_binary", f"{FLAG}, {FLIP.format(a='x', src='b')} SELECT session_id, i, CASE WHEN flag = 1 AND size < 3 THEN 0 ELSE flag END AS flag FROM xz")
def _(spark, d):
    return frames.binary_open(flags(spark, d), ["session_id"], "i", "flag", 3).select("session_id", "i", "flag")


@query("context_priority", f"""{FLAG}, {FLIP.format(a='x', src='b')}, c AS (SELECT session_id, i, k, CASE WHEN flag = 0 AND size <= 1 AND run > 1 AND run < last THEN 1 ELSE flag END AS flag FROM xz)
SELECT CASE WHEN k >= 95 THEN 'pause_menu' WHEN k >= 85 THEN 'map' WHEN k >= 75 THEN 'dialogue' WHEN flag = 0 THEN 'cockpit' WHEN k < 30 THEN 'suit' ELSE 'on_foot' END AS context, session_id, count(*) AS n FROM c GROUP BY ALL""")
def _(spark, d):
    f = frames.binary_close(flags(spark, d), ["session_id"], "i", "flag", 1)
    k = F.col("k")
    context = F.when(k >= 95, "pause_menu").when(k >= 85, "map").when(k >= 75, "dialogue").when(F.col("flag") == 0, "cockpit").when(k < 30, "suit").otherwise("on_foot")
    return f.groupBy(context.alias("context"), "session_id").agg(F.count("*").alias("n"))


@query("segments_rle", """WITH n AS (SELECT *, CASE WHEN lag(role) OVER w IS NOT DISTINCT FROM role AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS nw FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
r AS (SELECT *, sum(nw) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS run FROM n) SELECT conv_id, role, min(turn) AS first, max(turn) AS last, count(*) AS n FROM r GROUP BY conv_id, run, role""")
def _(spark, d):
    c = spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role")
    return patterns.run_lengths(c, ["conv_id"], "turn", "role")


RUNS = FLAG + ", " + FLIP.format(a="x", src="b")


@query("static_windows", f"{RUNS}, g AS (SELECT session_id, run, min(t) AS t0, max(t) AS t_last, max(i) AS i1 FROM xz WHERE flag = 1 GROUP BY 1, 2), e AS (SELECT g.session_id, t0, coalesce(b.t, t_last) AS t1 FROM g LEFT JOIN b ON b.session_id = g.session_id AND b.i = g.i1 + 1) SELECT * FROM e WHERE t1 - t0 >= 86400000000")
def _(spark, d):
    f = patterns.runs(flags(spark, d).withColumn("next_t", F.lead("t").over(Window.partitionBy("session_id").orderBy("i"))), ["session_id"], "i", "flag")
    g = f.filter("flag = 1").groupBy("session_id", "run").agg(F.min("t").alias("t0"), F.max_by(F.coalesce("next_t", "t"), "i").alias("t1"))
    return g.filter("t1 - t0 >= 86400000000").select("session_id", "t0", "t1")


@query("refine_window", f"{RUNS}, g AS (SELECT session_id, run, min(t) AS t0, max(t) AS t1, count(*) AS n FROM xz WHERE flag = 1 GROUP BY 1, 2), o AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY n DESC, t0) AS rn FROM g WHERE t0 < 1296000000000 AND t1 > 432000000000) SELECT session_id, t0, t1, n FROM o WHERE rn = 1")
def _(spark, d):
    f = patterns.runs(flags(spark, d), ["session_id"], "i", "flag").filter("flag = 1")
    g = f.groupBy("session_id", "run").agg(F.min("t").alias("t0"), F.max("t").alias("t1"), F.count("*").alias("n")).filter("t0 < 1296000000000 and t1 > 432000000000")
    w = Window.partitionBy("session_id").orderBy(F.desc("n"), "t0")
    return g.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("session_id", "t0", "t1", "n")


@query("afk_runs", f"WITH {EV}, g AS (SELECT session_id, t AS t1, lag(t) OVER (PARTITION BY session_id ORDER BY t, seq) AS t0 FROM ev) SELECT session_id, t0, t1, t1 - t0 AS idle_us FROM g WHERE t1 - t0 >= 86400000000")
def _(spark, d):
    g = events(spark, d).select("session_id", F.lag("t").over(Window.partitionBy("session_id").orderBy("t", "seq")).alias("t0"), F.col("t").alias("t1"))
    return g.withColumn("idle_us", F.col("t1") - F.col("t0")).filter("idle_us >= 86400000000")


@query("afk_confirm", f"WITH {EV}, g AS (SELECT session_id, t AS t1, lag(t) OVER (PARTITION BY session_id ORDER BY t, seq) AS t0, k, avg(k) OVER (PARTITION BY session_id) AS base FROM ev) SELECT session_id, t0, t1 FROM g WHERE t1 - t0 >= 86400000000 AND k < 0.40 * base")
def _(spark, d):
    w = Window.partitionBy("session_id")
    g = events(spark, d).select("session_id", F.lag("t").over(w.orderBy("t", "seq")).alias("t0"), F.col("t").alias("t1"), "k", F.avg("k").over(w).alias("base"))
    return g.filter("t1 - t0 >= 86400000000 and k < 0.40 * base").select("session_id", "t0", "t1")


SAMPLES = f"WITH {EV}, s AS (SELECT session_id, t, seq, event_type AS label, k, lag(t) OVER w AS pt, lead(t) OVER w AS nt, event_type <> 'click' AS away FROM ev WINDOW w AS (PARTITION BY session_id ORDER BY t, seq)), n AS (SELECT *, CASE WHEN lag(away) OVER w = away THEN 0 ELSE 1 END AS nw FROM s WINDOW w AS (PARTITION BY session_id ORDER BY t, seq)), r AS (SELECT *, sum(nw) OVER (PARTITION BY session_id ORDER BY t, seq ROWS UNBOUNDED PRECEDING) AS run FROM n)"


@query("sample_windows", f"{SAMPLES} SELECT session_id, min(coalesce((pt + t) / 2, 0)) AS t0, max(coalesce((t + nt) / 2, CAST(t AS DOUBLE))) AS t1, count(*) AS n, bool_or(label IN ('error', 'signup')) AS gating, bool_or(label IN ('error', 'signup')) AND count(*) >= 2 AND min(k) >= 20 AS high FROM r WHERE away GROUP BY session_id, run")
def _(spark, d):
    w = Window.partitionBy("session_id").orderBy("t", "seq")
    s = events(spark, d).withColumns({"pt": F.lag("t").over(w), "nt": F.lead("t").over(w), "away": F.col("event_type") != "click"})
    s = s.withColumn("nw", F.when(F.lag("away").over(w) == F.col("away"), 0).otherwise(1)).withColumn("run", F.sum("nw").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    gating = F.bool_or(F.col("event_type").isin("error", "signup"))
    t0, t1 = F.min(F.coalesce((F.col("pt") + F.col("t")) / 2, F.lit(0.0))), F.max(F.coalesce((F.col("t") + F.col("nt")) / 2, F.col("t").cast("double")))
    return s.filter("away").groupBy("session_id", "run").agg(t0.alias("t0"), t1.alias("t1"), F.count("*").alias("n"), gating.alias("gating"), (gating & (F.count("*") >= 2) & (F.min("k") >= 20)).alias("high")).drop("run")


@query("refine_points", f"{SAMPLES}, g AS (SELECT session_id, pt, t FROM n WHERE nw = 1 AND pt IS NOT NULL AND t - pt > 21600000000) SELECT session_id, unnest(generate_series(pt + 7200000000, t - 1, 7200000000)) AS at FROM g")
def _(spark, d):
    w = Window.partitionBy("session_id").orderBy("t", "seq")
    s = events(spark, d).withColumns({"pt": F.lag("t").over(w), "away": F.col("event_type") != "click"})
    s = s.withColumn("nw", F.when(F.lag("away").over(w) == F.col("away"), 0).otherwise(1)).filter("nw = 1 and pt is not null and t - pt > 21600000000")
    return s.select("session_id", F.explode(F.sequence(F.col("pt") + 7_200_000_000, F.col("t") - 1, F.lit(7_200_000_000))).alias("at"))


CUTS = f"WITH {EV}, du AS (SELECT session_id, CAST(max(t) AS DOUBLE) AS duration FROM ev GROUP BY 1), cu AS (SELECT session_id, CAST(t AS DOUBLE) - 1000 AS t0, CAST(t AS DOUBLE) + 43200000000 + k * 1000000000.0 AS t1 FROM ev WHERE event_type = 'error')"
MERGED = "cl AS (SELECT session_id, greatest(t0, 0.0) AS t0, least(t1, duration) AS t1 FROM cu JOIN du USING (session_id)), mk AS (SELECT *, max(t1) OVER (PARTITION BY session_id ORDER BY t0, t1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM cl WHERE t1 > t0), il AS (SELECT *, sum(CASE WHEN reach IS NULL OR t0 > reach THEN 1 ELSE 0 END) OVER (PARTITION BY session_id ORDER BY t0, t1 ROWS UNBOUNDED PRECEDING) AS island FROM mk), mg AS (SELECT session_id, min(t0) AS t0, max(t1) AS t1 FROM il GROUP BY session_id, island)"


def cuts(spark, d) -> tuple[DataFrame, DataFrame]:
    e = events(spark, d)
    t = F.col("t").cast("double")
    return e.groupBy("session_id").agg(F.max("t").cast("double").alias("duration")), e.filter("event_type = 'error'").select("session_id", (t - 1000).alias("t0"), (t + 43200000000 + F.col("k") * 1000000000.0).alias("t1"))


@query("merge_intervals", f"{CUTS}, {MERGED} SELECT * FROM mg")
def _(spark, d):
    du, cu = cuts(spark, d)
    inside = cu.join(du, "session_id").select("session_id", F.greatest("t0", F.lit(0.0)).alias("t0"), F.least("t1", "duration").alias("t1")).filter("t1 > t0")
    return patterns.merged(inside, ["session_id"])


@query("merge_complement", f"{CUTS}, {MERGED}, gp AS (SELECT session_id, coalesce(lag(t1) OVER (PARTITION BY session_id ORDER BY t0), 0.0) AS t0, t0 AS t1 FROM mg UNION ALL SELECT du.session_id, coalesce(max(mg.t1), 0.0), max(duration) FROM du LEFT JOIN mg USING (session_id) GROUP BY du.session_id) SELECT * FROM gp WHERE t1 > t0")
def _(spark, d):
    du, cu = cuts(spark, d)
    return patterns.complement(du, cu, ["session_id"], "duration")


@query("gate_pad_rows", f"""{CUTS}, rw AS (SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY t, seq) - 1 AS frame_id, CAST(t AS DOUBLE) AS ts FROM ev),
hit AS (SELECT DISTINCT rw.session_id, frame_id FROM rw JOIN cu ON rw.session_id = cu.session_id AND ts >= t0 AND ts <= t1),
pad AS (SELECT DISTINCT session_id, unnest(generate_series(frame_id - 2, frame_id + 2)) AS frame_id FROM hit)
SELECT rw.session_id, rw.frame_id, pad.frame_id IS NOT NULL AS gated FROM rw LEFT JOIN pad ON rw.session_id = pad.session_id AND rw.frame_id = pad.frame_id""")
def _(spark, d):
    _, cu = cuts(spark, d)
    e = events(spark, d)
    rows = e.select("session_id", (F.row_number().over(Window.partitionBy("session_id").orderBy("t", "seq")) - 1).cast("bigint").alias("frame_id"), F.col("t").cast("double").alias("ts"))
    return frames.gate(rows, cu, ["session_id"]).select("session_id", "frame_id", "gated")


@query("rows_in_window", f"WITH {EV} SELECT a.session_id, a.seq, count(*) AS n_rows, count(DISTINCT b.event_type) AS n_actions FROM ev a JOIN ev b ON a.session_id = b.session_id AND b.t >= a.t AND b.t <= a.t + 172800000000 WHERE a.event_type = 'error' GROUP BY ALL")
def _(spark, d):
    e = events(spark, d)
    w = Window.partitionBy("session_id").orderBy("t").rangeBetween(0, 172_800_000_000)
    out = e.withColumn("n_rows", F.count("*").over(w)).withColumn("n_actions", F.size(F.collect_set("event_type").over(w)).cast("bigint"))
    return out.filter("event_type = 'error'").select("session_id", "seq", "n_rows", "n_actions")


@query("overlap_exclude", f"{CUTS}, a AS (SELECT session_id, seq, CAST(t AS DOUBLE) AS t0, CAST(t AS DOUBLE) + 3600000000 AS t1 FROM ev WHERE event_type = 'signup') SELECT session_id, seq FROM a WHERE NOT EXISTS (SELECT 1 FROM cu WHERE cu.session_id = a.session_id AND a.t0 < cu.t1 + 1000000 AND a.t1 > cu.t0 - 1000000)")
def _(spark, d):
    _, cu = cuts(spark, d)
    e = events(spark, d).filter("event_type = 'signup'")
    slack = cu.select("session_id", (F.col("t0") - 1_000_000).alias("t0"), (F.col("t1") + 1_000_000).alias("t1"))
    # the last merged window that begins before the candidate's end decides
    one = patterns.merged(slack, ["session_id"]).withColumn("stop", F.col("t1")).withColumn("t0", F.col("t0") + 0.0001)
    cand = e.select("session_id", "seq", F.col("t").cast("double").alias("c0"), (F.col("t").cast("double") + 3_600_000_000).alias("c1"))
    return patterns.as_of(cand, one, ["session_id"], "c1", "t0", "stop").filter("stop is null or c0 >= stop").select("session_id", "seq")


@query("plan_cuts", f"WITH {EV}, s AS (SELECT session_id, max(t) AS duration, min(CASE WHEN event_type = 'view' AND t >= 432000000000 THEN t END) AS key_after, max(CASE WHEN event_type = 'view' THEN t END) AS key_last FROM ev GROUP BY 1) SELECT session_id, coalesce(key_after, key_last, 0) AS head, greatest(duration - 432000000000, coalesce(key_after, key_last, 0)) AS tail FROM s")
def _(spark, d):
    view = F.col("event_type") == "view"
    s = events(spark, d).groupBy("session_id").agg(F.max("t").alias("duration"), F.min(F.when(view & (F.col("t") >= 432_000_000_000), F.col("t"))).alias("key_after"), F.max(F.when(view, F.col("t"))).alias("key_last"))
    head = F.coalesce("key_after", "key_last", F.lit(0))
    return s.select("session_id", head.alias("head"), F.greatest(F.col("duration") - 432_000_000_000, head).alias("tail"))


@query("segment_rows", f"{CUTS}, {MERGED}, gp AS (SELECT session_id, coalesce(lag(t1) OVER (PARTITION BY session_id ORDER BY t0), 0.0) AS t0, t0 AS t1 FROM mg UNION ALL SELECT du.session_id, coalesce(max(mg.t1), 0.0), max(duration) FROM du LEFT JOIN mg USING (session_id) GROUP BY du.session_id), kp AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY t0) AS part FROM gp WHERE t1 > t0), rw AS (SELECT ev.session_id, part, ev.seq, CAST(ev.t AS DOUBLE) - t0 AS ts, row_number() OVER (PARTITION BY ev.session_id, part ORDER BY ev.t, ev.seq) - 1 AS frame_id FROM kp JOIN ev ON ev.session_id = kp.session_id AND ev.t >= t0 AND ev.t < t1 WHERE t1 - t0 >= 86400000000) SELECT CAST(session_id AS VARCHAR) || '-p' || part AS child_id, frame_id, seq, ts FROM rw")
def _(spark, d):
    du, cu = cuts(spark, d)
    e = events(spark, d)
    kp = patterns.complement(du, cu, ["session_id"], "duration").withColumn("part", F.row_number().over(Window.partitionBy("session_id").orderBy("t0")))
    kp = kp.select("session_id", F.col("t0").alias("s0"), F.struct("t0", "t1", "part").alias("seg"))
    rows = patterns.as_of(e.select("session_id", "seq", F.col("t").cast("double").alias("t")), kp, ["session_id"], "t", "s0", "seg").filter("t < seg.t1 and seg.t1 - seg.t0 >= 86400000000")
    w = Window.partitionBy("session_id", "seg.part").orderBy("t", "seq")
    return rows.select(F.concat(F.col("session_id").cast("string"), F.lit("-p"), F.col("seg.part").cast("string")).alias("child_id"), (F.row_number().over(w) - 1).cast("bigint").alias("frame_id"), "seq", (F.col("t") - F.col("seg.t0")).alias("ts"))


@query("shift_rows", f"{FLAG} SELECT session_id, i, lag(k, 2, -1) OVER (PARTITION BY session_id ORDER BY i) AS k FROM b")
def _(spark, d):
    return frames.shift_rows(flags(spark, d).select("session_id", "i", "k"), ["session_id"], "i", ["k"], 2, -1)


@query("mismatch_runs", f"{RUNS}, g AS (SELECT session_id, count(*) AS n, max(CASE WHEN flag = 0 THEN size ELSE 0 END) AS longest, sum(1 - flag) AS bad FROM xz GROUP BY 1) SELECT session_id, n, CAST(longest AS BIGINT) AS longest, CAST(bad AS BIGINT) AS bad, longest >= 3 OR bad > 0.005 * n AS blocks FROM g")
def _(spark, d):
    f = patterns.runs(flags(spark, d), ["session_id"], "i", "flag")
    f = f.withColumn("size", F.count("*").over(Window.partitionBy("session_id", "run")))
    g = f.groupBy("session_id").agg(F.count("*").alias("n"), F.max(F.when(F.col("flag") == 0, F.col("size")).otherwise(0)).alias("longest"), F.sum(1 - F.col("flag")).alias("bad"))
    return g.withColumn("blocks", (F.col("longest") >= 3) | (F.col("bad") > 0.005 * F.col("n")))


# --- lag ----------------------------------------------------------------------------------------------------------


@query("box_smooth", f"{FLAG}, w AS (SELECT session_id, i, sum(k) OVER (PARTITION BY session_id ORDER BY i ROWS BETWEEN 4 PRECEDING AND 3 FOLLOWING) / 8.0 AS smooth, count(*) OVER (PARTITION BY session_id) AS n, k FROM b) SELECT session_id, i, CASE WHEN n < 8 THEN CAST(k AS DOUBLE) ELSE CAST(smooth AS DOUBLE) END AS smooth FROM w")
def _(spark, d):
    f = flags(spark, d).select("session_id", "i", F.col("k").cast("double").alias("smooth"))
    return sync.smoothed(f, ["session_id"], "i", "smooth")


@query("zscore", f"{FLAG} SELECT session_id, i, round((k - avg(k) OVER p) / CASE WHEN stddev_pop(k) OVER p > 0 THEN stddev_pop(k) OVER p ELSE 1 END, 6) AS z FROM b WINDOW p AS (PARTITION BY session_id)")
def _(spark, d):
    f = flags(spark, d).select("session_id", "i", F.col("k").cast("double").alias("z"))
    return sync.normalised(f, ["session_id"], "z").withColumn("z", F.round("z", 6))


TRACKS = "WITH a AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings), p AS (SELECT vec_id, i, CAST(x AS DOUBLE) AS a, CAST(lag(x, 3, 0.0) OVER (PARTITION BY vec_id ORDER BY i) AS DOUBLE) AS m FROM a)"


@query("lag_scan", f"{TRACKS}, s AS (SELECT q.vec_id, l.lag, avg(q.a * r.m) AS score FROM p q CROSS JOIN (SELECT unnest(generate_series(-12, 12)) AS lag) l JOIN p r ON r.vec_id = q.vec_id AND r.i = q.i - l.lag GROUP BY 1, 2), b AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(abs(score), 9) DESC, lag) AS rn FROM s) SELECT vec_id, CAST(lag AS INTEGER) AS lag, round(score, 6) AS score FROM b WHERE rn = 1")
def _(spark, d):
    x = F.col("embedding").cast("array<double>")
    late = F.concat(F.array_repeat(F.lit(0.0), 3), F.slice(x, F.lit(1), F.greatest(F.size(x) - 3, F.lit(0))))
    t = spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", x.alias("a"), late.alias("m"))
    return sync.lag_scan_arrays(t, ["vec_id"], 12).select("vec_id", "lag", F.round("score", 6).alias("score"))


@query("lag_verdict", f"WITH {EV}, s AS (SELECT session_id, avg(CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END) AS active, (max(k) - 50) / 300.0 AS corr, (min(k) - 2) * 100.0 AS lag_ms FROM ev GROUP BY 1) SELECT session_id, CASE WHEN active < 0.02 THEN 'SKIP' WHEN abs(corr) < 0.15 THEN 'WARN' WHEN abs(lag_ms) > 150 THEN 'FAIL' ELSE 'PASS' END AS verdict FROM s")
def _(spark, d):
    s = events(spark, d).groupBy("session_id").agg(F.avg(F.when(F.col("event_type") == "purchase", 1.0).otherwise(0.0)).alias("active"), ((F.max("k") - 50) / 300.0).alias("corr"), ((F.min("k") - 2) * 100.0).alias("lag_ms"))
    return s.select("session_id", sync.verdict(F.col("active"), F.col("corr"), F.col("lag_ms")).alias("verdict"))
