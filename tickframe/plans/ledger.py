"""Queries on the ledger: orders are sessions, customers players, line items the audit log, as the survey binds them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickframe.functions import numeric, tokens
from tickframe.functions import tables as T
from tickframe.operators import checks, decide, ledger, patterns
from tickframe.plans import timeseries as ts
from tickframe.plans.timeseries import EV, ql, query
from tickframe.sources import readers, writers
from tickframe.streaming import live

STATE = "CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'O' THEN CASE WHEN o_orderkey % 10 = 0 THEN 'SPLIT' ELSE 'READY' END ELSE CASE WHEN o_orderkey % 7 = 0 THEN 'DUPLICATE' ELSE 'REJECTED' END END"
SE = f"se AS (SELECT o_orderkey AS session_id, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey // 4 END AS parent_id, CASE WHEN o_orderkey % 2 = 0 THEN 'kamla' ELSE 'outer_wilds' END AS game, c_nationkey AS operator, o_custkey AS player, {STATE} AS state, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, o_orderdate AS created, o_orderpriority AS priority FROM orders JOIN customer ON c_custkey = o_custkey)"
AU = "au AS (SELECT l_orderkey AS session_id, l_shipdate AS ts, l_linenumber * 1000000 + l_partkey AS id, l_returnflag AS to_state, l_linestatus AS status, l_suppkey FROM lineitem)"


def sessions(spark, d) -> DataFrame:
    o = spark.read.parquet(f"{d}/orders.parquet")
    c = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    k = F.col("o_orderkey")
    state = F.when(F.col("o_orderstatus") == "F", "DELIVERED").when(F.col("o_orderstatus") == "O", F.when(k % 10 == 0, "SPLIT").otherwise("READY")).otherwise(F.when(k % 7 == 0, "DUPLICATE").otherwise("REJECTED"))
    return o.join(c, "o_custkey").select(
        k.alias("session_id"), F.when(k % 4 != 0, F.floor(k / 4)).alias("parent_id"), F.when(k % 2 == 0, "kamla").otherwise("outer_wilds").alias("game"), F.col("c_nationkey").alias("operator"),
        F.col("o_custkey").alias("player"), state.alias("state"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"), F.col("o_orderdate").alias("created"), F.col("o_orderpriority").alias("priority"),
    )


def audit(spark, d) -> DataFrame:
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    return li.select(F.col("l_orderkey").alias("session_id"), F.col("l_shipdate").alias("ts"), (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("id"), F.col("l_returnflag").alias("to_state"), F.col("l_linestatus").alias("status"), "l_suppkey")


def files(spark, d) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet").select(F.md5(F.col("text").cast("binary")).alias("md5"), F.col("source").alias("owner"), F.col("doc_id").alias("ctime"))


FI = "fi AS (SELECT md5(text) AS md5, source AS owner, doc_id AS ctime FROM documents)"

# --- listing and names --------------------------------------------------------------------------------------------

PATHS = "pa AS (SELECT page_id, 'g' || page_id % 2 || '/op' || page_id % 5 || CASE WHEN page_id % 11 = 0 THEN '' ELSE '@x.org' END || '/p' || page_id % 13 || '@y.org/' || 's' || page_id // 4 AS folder, ['video.mp4', 'frames.csv', 'session.json', 'inputs.jsonl'][page_id % 4 + 1] AS name, length(html) AS size FROM pages)"


def listing(spark, d) -> DataFrame:
    p = spark.read.parquet(f"{d}/pages.parquet").select("page_id", F.length("html").cast("bigint").alias("Size"))
    i = F.col("page_id")
    s = lambda c: c.cast("string")
    folder = F.concat(F.lit("g"), s(i % 2), F.lit("/op"), s(i % 5), F.when(i % 11 == 0, "").otherwise("@x.org"), F.lit("/p"), s(i % 13), F.lit("@y.org/s"), s(F.floor(i / 4)))
    name = F.element_at(F.array(*[F.lit(x) for x in ("video.mp4", "frames.csv", "session.json", "inputs.jsonl")]), (i % 4 + 1).cast("int"))
    return p.select(F.concat(folder, F.lit("/"), name).alias("Path"), name.alias("Name"), F.lit(False).alias("IsDir"), "Size", F.format_string("%012d", i).alias("ModTime"), F.struct(F.md5(folder).alias("md5")).alias("Hashes"))


@query("listing_group", f"WITH {PATHS} SELECT folder, array_to_string(list_sort(list_distinct(list(name))), ',') AS files, CAST(sum(size) AS BIGINT) AS bytes, bool_and(folder LIKE '%@x.org/%') AS ok, regexp_extract(folder, '[^/]+$') AS session_id FROM pa GROUP BY folder")
def _(spark, d):
    out = readers.sessions_of_listing(listing(spark, d))
    return out.select("folder", F.array_join("files", ",").alias("files"), "bytes", "ok", "session_id")


@query("payload_sniff", f"WITH {PATHS}, g AS (SELECT folder, list(name) AS f FROM pa GROUP BY 1) SELECT folder, CASE WHEN list_contains(f, 'frames.csv') AND list_contains(f, 'session.json') THEN 'v2' ELSE 'garbage' END AS payload, CASE WHEN list_contains(f, 'inputs.jsonl') THEN 'raw' WHEN list_contains(f, 'frames.csv') THEN 'v2' ELSE 'unknown' END AS format, array_to_string([x FOR x IN ['video.mp4', 'frames.csv', 'session.json'] IF NOT list_contains(f, x)], ',') AS missing FROM g")
def _(spark, d):
    g = readers.sessions_of_listing(listing(spark, d))
    required = F.array(*[F.lit(x) for x in ("video.mp4", "frames.csv", "session.json")])
    return g.select("folder", readers.payload_kind(F.col("files")).alias("payload"), readers.detected_format(F.col("files")).alias("format"), F.array_join(F.array_except(required, "files"), ",").alias("missing"))


@query("bad_path_class", "WITH p AS (SELECT url, regexp_replace(url, '^https?://', '') AS rest FROM pages), q AS (SELECT url, len(string_split(rest, '/')) AS depth, string_split(rest, '/')[1] AS host FROM p) SELECT url, depth, CASE WHEN depth < 3 THEN 'too shallow' WHEN depth > 3 THEN 'too deep' WHEN regexp_matches(host, '^m[.]') THEN 'mobile' WHEN NOT regexp_matches(host, '[.]example[.](com|net|org)$') THEN 'foreign' ELSE 'fine' END AS class FROM q")
def _(spark, d):
    p = spark.read.parquet(f"{d}/pages.parquet").select("url", F.split(F.regexp_replace("url", "^https?://", ""), "/").alias("parts"))
    depth, host = F.size("parts").cast("bigint"), F.element_at("parts", 1)
    kind = F.when(depth < 3, "too shallow").when(depth > 3, "too deep").when(host.rlike("^m[.]"), "mobile").when(~host.rlike("[.]example[.](com|net|org)$"), "foreign").otherwise("fine")
    return p.select("url", depth.alias("depth"), kind.alias("class"))


@query("slugify", "SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name || ' ' || p_brand || '!'), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug, left(p_name, 40) || '~' || left(md5(p_brand), 8) AS surrogate, regexp_replace(lower(string_split(p_name || '.1@x.org', '@')[1]), '[^a-z]', '', 'g') AS core FROM part")
def _(spark, d):
    p = spark.read.parquet(f"{d}/part.parquet").select("p_partkey", "p_name", "p_brand")
    return p.select("p_partkey", tokens.slug(F.concat("p_name", F.lit(" "), "p_brand", F.lit("!"))).alias("slug"), tokens.quarantine_id(F.col("p_name"), F.col("p_brand")).alias("surrogate"), tokens.mail_core(F.concat("p_name", F.lit(".1@x.org"))).alias("core"))


@query("game_fuzzy_match", "WITH n AS (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'Outer Wilds' WHEN 1 THEN 'outerwild' WHEN 2 THEN p_name WHEN 3 THEN 'KAMLA (demo)' WHEN 4 THEN '' END AS name, CASE WHEN p_partkey % 4 = 0 THEN 'OuterWilds' ELSE 'x9' END AS exe FROM part), c AS (SELECT *, regexp_replace(lower(coalesce(name, '')), '[^a-z0-9]+', '', 'g') AS a, regexp_replace(lower(exe), '[^a-z0-9]+', '', 'g') AS b FROM n) SELECT p_partkey, CASE WHEN a <> '' AND (contains(a, 'kamla') OR contains('kamla', a)) THEN 'kamla' WHEN a <> '' AND (contains(a, 'outerwilds') OR contains('outerwilds', a)) THEN 'outer_wilds' WHEN contains(b, 'kamla') OR contains('kamla', b) THEN 'kamla' WHEN contains(b, 'outerwilds') OR contains('outerwilds', b) THEN 'outer_wilds' END AS game FROM c")
def _(spark, d):
    i = F.col("p_partkey") % 6
    name = F.when(i == 0, "Outer Wilds").when(i == 1, "outerwild").when(i == 2, F.col("p_name")).when(i == 3, "KAMLA (demo)").when(i == 4, "")
    exe = F.when(F.col("p_partkey") % 4 == 0, "OuterWilds").otherwise("x9")
    return spark.read.parquet(f"{d}/part.parquet").select("p_partkey", tokens.fuzzy_key([name, exe], ["kamla", "outer_wilds"]).alias("game"))


CODES = sorted(T.REASON_LABELS) + ["STR_HEADER_BAD", "SYN_LAG_CONST"]


@query("reason_label", f"WITH c AS (SELECT o_orderkey, {ql(CODES)}[o_orderkey % {len(CODES)} + 1] AS code FROM orders) SELECT code, {ts.sql_alias('code', {k: v[1] for k, v in T.REASON_LABELS.items()}).replace('ELSE code', chr(69) + 'LSE replace(lower(code), ' + repr('_') + ', ' + repr('-') + ')')} AS label, count(*) AS n FROM c GROUP BY ALL")
def _(spark, d):
    code = F.element_at(F.array(*[F.lit(c) for c in CODES]), (F.col("o_orderkey") % len(CODES) + 1).cast("int"))
    c = spark.read.parquet(f"{d}/orders.parquet").select(code.alias("code"))
    return c.groupBy("code", tokens.reason_label(F.col("code"), True).alias("label")).agg(F.count("*").alias("n"))


@query("iso_dialects", "SELECT event_id, CASE WHEN event_id % 5 = 4 THEN NULL ELSE epoch_us(date_trunc('second', ts)) END AS us, CASE WHEN event_id % 5 = 4 THEN NULL ELSE ((epoch_us(date_trunc('second', ts)) // 1000000 + 19800) // 86400) * 86400 - 19800 END AS local_day_s FROM events")
def _(spark, d):
    i, t = F.col("event_id") % 5, F.date_trunc("second", F.col("ts").cast("timestamp"))
    text = F.when(i == 0, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).when(i == 1, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ssXXX")).when(i == 2, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")).when(i == 3, F.concat(F.date_format(t + F.expr("interval 330 minutes"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:30"))).otherwise("soon")
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", numeric.parse_utc(text).alias("at"))
    return e.select("event_id", F.unix_micros("at").alias("us"), F.unix_seconds(numeric.local_day(F.col("at"))).alias("local_day_s"))


@query("report_window", f"WITH {EV}, s AS (SELECT session_id, max(t) // 1000000 AS now_s, min(CASE WHEN event_type = 'signup' THEN t END) // 1000000 AS anchor FROM ev GROUP BY 1), h AS (SELECT *, now_s - 14400 AS hi FROM s) SELECT session_id, CASE WHEN anchor >= hi - 172800 AND anchor < hi THEN anchor ELSE hi - 86400 END AS lo, hi, CASE WHEN anchor IS NOT NULL AND now_s - anchor >= 10800 THEN anchor ELSE now_s - 10800 END AS digest_lo FROM h")
def _(spark, d):
    e = ts.events(spark, d)
    sec = lambda c: F.floor(c / 1_000_000).cast("bigint")
    s = e.groupBy("session_id").agg(sec(F.max("t")).alias("now_s"), sec(F.min(F.when(F.col("event_type") == "signup", F.col("t")))).alias("anchor")).withColumn("hi", F.col("now_s") - 14400)
    lo = F.when((F.col("anchor") >= F.col("hi") - 172800) & (F.col("anchor") < F.col("hi")), F.col("anchor")).otherwise(F.col("hi") - 86400)
    return s.select("session_id", lo.alias("lo"), "hi", F.when(F.col("anchor").isNotNull() & (F.col("now_s") - F.col("anchor") >= 10800), F.col("anchor")).otherwise(F.col("now_s") - 10800).alias("digest_lo"))


# --- inventory and checks -----------------------------------------------------------------------------------------


@query("inventory", f"{ts.ROWS}, ac AS (SELECT *, list_distinct({ts._A}) AS a FROM fx), dd AS (SELECT session_id, count(DISTINCT x) AS distinct_actions FROM (SELECT session_id, unnest(a) AS x FROM ac) GROUP BY 1), dt AS (SELECT session_id, t - lag(t) OVER (PARTITION BY session_id ORDER BY t, seq) AS dt FROM ev), md AS (SELECT session_id, list_sort(list(dt))[len(list(dt)) // 2 + 1] AS med FROM dt WHERE dt IS NOT NULL GROUP BY 1), ir AS (SELECT dt.session_id, count(*) FILTER (WHERE abs(dt - med) > 0.2 * med) AS irregular FROM dt JOIN md USING (session_id) WHERE dt IS NOT NULL GROUP BY 1) SELECT ac.session_id, count(*) AS n_rows, count(*) FILTER (WHERE len(held) > 0) AS key_frames, count(*) FILTER (WHERE dx <> 0 OR dy <> 0) AS motion_frames, count(*) FILTER (WHERE len(held) > 0 AND len(a) = 0) AS keys_no_action, max(coalesce(distinct_actions, 0)) AS distinct_actions, max(irregular) AS irregular FROM ac LEFT JOIN dd USING (session_id) LEFT JOIN ir ON ir.session_id = ac.session_id GROUP BY 1")
def _(spark, d):
    from tickframe.operators import frames

    r = ts.frame_rows(spark, d)
    actions, _, _ = frames.resolve(F.col("held"), F.col("dx") != 0, F.col("dy") != 0, ts.RULES)
    r = r.withColumn("a", actions)
    keys = F.size("held") > 0
    counts = r.groupBy("session_id").agg(
        F.count("*").alias("n_rows"), F.count_if(keys).alias("key_frames"), F.count_if((F.col("dx") != 0) | (F.col("dy") != 0)).alias("motion_frames"),
        F.count_if(keys & (F.size("a") == 0)).alias("keys_no_action"), F.size(F.array_distinct(F.flatten(F.collect_set("a")))).cast("bigint").alias("distinct_actions"),
    )
    steps = checks.irregular(ts.events(spark, d), ["session_id"], "t", ["t", "seq"])
    return counts.join(steps.select("session_id", "irregular"), "session_id", "left")


@query("irregular_intervals", f"WITH {EV}, dt AS (SELECT session_id, t - lag(t) OVER (PARTITION BY session_id ORDER BY t, seq) AS dt FROM ev), md AS (SELECT session_id, list_sort(list(dt))[len(list(dt)) // 2 + 1] AS med FROM dt WHERE dt IS NOT NULL GROUP BY 1) SELECT dt.session_id, med AS median_dt, count(*) AS n, count(*) FILTER (WHERE abs(dt - med) > 0.2 * med) AS irregular FROM dt JOIN md USING (session_id) WHERE dt IS NOT NULL GROUP BY ALL")
def _(spark, d):
    return checks.irregular(ts.events(spark, d), ["session_id"], "t", ["t", "seq"])


@query("jitter_client", f"WITH {EV}, dt AS (SELECT session_id, t - lag(t) OVER (PARTITION BY session_id ORDER BY t, seq) AS dt FROM ev), md AS (SELECT session_id, median(CAST(dt AS DOUBLE)) AS med FROM dt WHERE dt > 0 GROUP BY 1) SELECT dt.session_id, count(*) AS n, count(*) FILTER (WHERE dt < 0.1 * med OR dt > 3 * med) AS outside FROM dt JOIN md USING (session_id) WHERE dt IS NOT NULL GROUP BY 1")
def _(spark, d):
    w = Window.partitionBy("session_id").orderBy("t", "seq")
    dt = ts.events(spark, d).select("session_id", (F.col("t") - F.lag("t").over(w)).cast("double").alias("dt")).filter("dt is not null")
    med = dt.filter("dt > 0").groupBy("session_id").agg(F.median("dt").alias("med"))
    return dt.join(med, "session_id").groupBy("session_id").agg(F.count("*").alias("n"), F.count_if((F.col("dt") < 0.1 * F.col("med")) | (F.col("dt") > 3 * F.col("med"))).alias("outside"))


INVERTED = {"space": ["jump", "boost"], "e": ["interact", "confirm"], "shift_l": ["sprint"]}


@query("fanout_check", f"{ts.ROWS}, ac AS (SELECT session_id, held, list_distinct({ts._A}) AS a FROM fx) SELECT session_id, count(*) AS frames FROM ac WHERE (list_contains(held, 'space') AND list_has_all(a, ['jump', 'boost'])) OR (list_contains(held, 'e') AND list_has_all(a, ['interact', 'confirm'])) GROUP BY 1")
def _(spark, d):
    from tickframe.operators import frames

    r = ts.frame_rows(spark, d)
    actions, _, _ = frames.resolve(F.col("held"), F.col("dx") != 0, F.col("dy") != 0, ts.RULES)
    return checks.fan_out(r.withColumn("actions", actions), INVERTED, ["session_id"])


@query("hotkey_leak_topk", f"{ts.HELD}, n AS (SELECT session_id, count(DISTINCT frame_id) AS frames FROM hf GROUP BY 1), c AS (SELECT session_id, token, count(*) AS held FROM hf GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY held DESC, token) AS rn FROM c) SELECT session_id, token, held, frames FROM r JOIN n USING (session_id) WHERE rn <= 10 AND held >= CASE WHEN token IN ('w', 'a', 's', 'd') THEN 0.99 ELSE 0.9 END * frames")
def _(spark, d):
    h = ts.held(spark, d)
    frames = h.groupBy("session_id").agg(F.count_distinct("frame_id").alias("frames"))
    c = h.groupBy("session_id", "token").agg(F.count("*").alias("held"))
    c = c.withColumn("rn", F.row_number().over(Window.partitionBy("session_id").orderBy(F.desc("held"), "token"))).filter("rn <= 10")
    least = F.when(F.col("token").isin("w", "a", "s", "d"), 0.99).otherwise(0.9) * F.col("frames")
    return c.join(frames, "session_id").filter(F.col("held") >= least).select("session_id", "token", "held", "frames")


@query("tamper_flag", "SELECT user_id AS session_id, count(*) AS n, count(*) FILTER (WHERE value > 300) AS large, count(*) FILTER (WHERE value > 300) > greatest(count(*) // 100, 2) AS flagged FROM events GROUP BY 1")
def _(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").groupBy(F.col("user_id").alias("session_id")).agg(F.count("*").alias("n"), F.count_if(F.col("value") > 300).alias("large"))
    return e.withColumn("flagged", checks.tampered(F.col("n"), F.col("large")))


@query("dead_black", "WITH l AS (SELECT user_id AS session_id, CASE WHEN user_id % 3 = 0 AND event_id % 300 <> 1 THEN 1.0 ELSE value END AS luma FROM events) SELECT session_id, avg(CASE WHEN luma < 5 THEN 1.0 ELSE 0.0 END) >= 0.995 AS black FROM l GROUP BY 1")
def _(spark, d):
    luma = F.when((F.col("user_id") % 3 == 0) & (F.col("event_id") % 300 != 1), 1.0).otherwise(F.col("value"))
    return spark.read.parquet(f"{d}/events.parquet").groupBy(F.col("user_id").alias("session_id")).agg(checks.dead_black(luma).alias("black"))


@query("v1_checks", f"{ts.ROWS}, p AS (SELECT *, row_number() OVER w - 1 AS rn, frame_id * 1000 - lag(frame_id * 1000) OVER w AS dt FROM fx WINDOW w AS (PARTITION BY session_id ORDER BY frame_id)) SELECT session_id, count(*) AS n_rows, bool_and(frame_id = rn) AS contiguous, max(frame_id) * 1000 - min(frame_id) * 1000 AS span, max(frame_id % 7 * 20) AS worst_ms, count(*) FILTER (WHERE dt < 0) AS backward, CASE WHEN NOT bool_and(frame_id = rn) OR max(frame_id % 7 * 20) > 100 THEN 'FAIL' ELSE 'PASS' END AS status FROM p GROUP BY 1")
def _(spark, d):
    r = ts.frame_rows(spark, d).withColumns({"ts": F.col("frame_id") * 1000, "pts": F.col("frame_id") * 1000 - F.col("frame_id") % 7 * 20})
    c = checks.v1_counts(r, ["session_id"])
    out = checks.v1_problems(c, F.col("rows"), F.lit(1e9), F.lit(5))
    return out.select("session_id", F.col("rows").alias("n_rows"), "contiguous", "span", "worst_ms", "backward", F.when(F.size("fails") > 0, "FAIL").otherwise("PASS").alias("status"))


@query("session_json_checks", "WITH s AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'en-IN' WHEN 1 THEN 'english' WHEN 2 THEN 'en' ELSE '' END AS loc, CAST(floor(o_totalprice) AS BIGINT) AS ms, o_orderkey % 3 AS off FROM orders) SELECT o_orderkey, array_to_string(list_filter([CASE WHEN NOT regexp_matches(loc, '^[a-z]{2,3}(-[A-Z]{2,3})?$') THEN 'localization' END, CASE WHEN off > 1 THEN 'duration_ms' END, CASE WHEN ms < 70000 THEN 'under 70s' END], lambda x: x IS NOT NULL), ',') AS problems FROM s")
def _(spark, d):
    k = F.col("o_orderkey")
    loc = F.when(k % 4 == 0, "en-IN").when(k % 4 == 1, "english").when(k % 4 == 2, "en").otherwise("")
    found = checks.problems((~loc.rlike("^[a-z]{2,3}(-[A-Z]{2,3})?$"), "localization"), (k % 3 > 1, "duration_ms"), (F.floor("o_totalprice") < 70000, "under 70s"))
    return spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", F.array_join(found, ",").alias("problems"))


M = [f"embedding[{i}]" for i in range(9)]


def _sql_m(i: int) -> str:
    return f"CAST(embedding[{i + 1}] AS DOUBLE) * 4"


@query("camera_checks", "WITH v AS (SELECT label, vec_id, " + ", ".join(f"{_sql_m(i)} AS m{i}" for i in range(9)) + " FROM embeddings), q AS (SELECT label, m0 * (m4 * m8 - m5 * m7) - m1 * (m3 * m8 - m5 * m6) + m2 * (m3 * m7 - m4 * m6) AS det, m0*m0+m1*m1+m2*m2 AS a, lag(m0) OVER w * m0 + lag(m1) OVER w * m1 + lag(m2) OVER w * m2 + lag(m3) OVER w * m3 + lag(m4) OVER w * m4 + lag(m5) OVER w * m5 + lag(m6) OVER w * m6 + lag(m7) OVER w * m7 + lag(m8) OVER w * m8 AS tr FROM v WINDOW w AS (PARTITION BY label ORDER BY vec_id)) SELECT label, count(*) AS n_rows, count(*) FILTER (WHERE det < 0) AS mirrored, count(*) FILTER (WHERE degrees(acos(greatest(-1.0, least(1.0, (tr - 1) / 2)))) > 30) AS spins FROM q GROUP BY 1")
def _(spark, d):
    v = spark.read.parquet(f"{d}/embeddings.parquet").select("label", "vec_id", *[(F.col("embedding")[i].cast("double") * 4).alias(f"m{i}") for i in range(9)])
    c = checks.camera_checks(v, ["label"], "vec_id", [f"m{i}" for i in range(9)])
    return c.select("label", F.col("rows").alias("n_rows"), "mirrored", "spins")


# --- decisions ----------------------------------------------------------------------------------------------------

MESSAGES = [f"check: {n} found" for n, _ in T.NEEDLES] + [f"{n} again" for n in T.NEEDLES_SKIPPED] + ["something else"]


def messages(spark, d) -> DataFrame:
    m = F.element_at(F.array(*[F.lit(x) for x in MESSAGES]), ((F.col("l_partkey") + F.col("l_linenumber")) % len(MESSAGES) + 1).cast("int"))
    return spark.read.parquet(f"{d}/lineitem.parquet").select(F.col("l_orderkey").alias("session_id"), m.alias("message"))


ME = f"me AS (SELECT l_orderkey AS session_id, {ql(MESSAGES)}[(l_partkey + l_linenumber) % {len(MESSAGES)} + 1] AS message FROM lineitem)"
NE = "ne AS (SELECT session_id, message, CASE " + " ".join(f"WHEN contains(message, '{n}') THEN NULL" for n in T.NEEDLES_SKIPPED) + " " + " ".join(f"WHEN contains(message, '{n}') THEN '{c}'" for n, c in T.NEEDLES) + " ELSE 'QA_FAIL_UNMAPPED' END AS code FROM me)"
CO = "co AS (SELECT DISTINCT session_id, code FROM ne WHERE code IS NOT NULL)"


@query("needle_map", f"WITH {ME}, {NE}, {CO} SELECT session_id, code, NOT (code = 'QA_FAIL_UNMAPPED' AND bool_or(code <> 'QA_FAIL_UNMAPPED') OVER (PARTITION BY session_id)) AS blocking FROM co")
def _(spark, d):
    return decide.reasons_of(messages(spark, d), ["session_id"])


@query("decision_bins", f"WITH {ME}, {NE}, {CO}, b AS (SELECT session_id, code, NOT (code = 'QA_FAIL_UNMAPPED' AND bool_or(code <> 'QA_FAIL_UNMAPPED') OVER (PARTITION BY session_id)) AS blocking FROM co) SELECT session_id, CASE WHEN bool_or(blocking AND code = 'QA_FAIL_UNMAPPED') THEN 3 WHEN bool_or(blocking) THEN 2 ELSE 1 END AS bin, count(*) AS n_reasons FROM b GROUP BY 1")
def _(spark, d):
    r = decide.reasons_of(messages(spark, d), ["session_id"])
    hopeless = F.bool_or(F.col("blocking") & (F.col("code") == "QA_FAIL_UNMAPPED"))
    return r.groupBy("session_id").agg(decide.verdict_bin(F.bool_or("blocking"), ~hopeless).alias("bin"), F.count("*").alias("n_reasons"))


PLAN_CODES = ["STR_HEADER_BAD", "INP_TOKEN_CASE", "SYN_LAG_CONST", "CNT_AFK", "INP_FROZEN_ACTIONS", "STR_SJ_INVALID", "INP_FANOUT", "CNT_SHORT", "STR_ROWS_MISMATCH"]


@query("fix_plan", f"""WITH p AS (SELECT l_orderkey AS session_id, l_orderkey % 3 = 0 AS raw, l_orderkey % 2 = 1 AS game, list(DISTINCT {ql(PLAN_CODES)}[l_partkey % {len(PLAN_CODES)} + 1]) AS c FROM lineitem GROUP BY ALL),
f AS (SELECT *, list_contains(c, 'STR_HEADER_BAD') AS hd, list_contains(c, 'INP_TOKEN_CASE') AS tk, list_contains(c, 'SYN_LAG_CONST') AS lg, list_contains(c, 'CNT_AFK') AS cut, list_contains(c, 'INP_FROZEN_ACTIONS') AS fz, list_contains(c, 'STR_SJ_INVALID') AS sj, list_contains(c, 'INP_FANOUT') AS fo, list_contains(c, 'STR_ROWS_MISMATCH') AS rm FROM p),
g AS (SELECT *, raw AND (hd OR lg OR rm) AS again FROM f),
s AS (SELECT *, list_filter([CASE WHEN sj THEN 'FIX_SESSIONJSON_REWRITE' END, CASE WHEN again THEN 'FIX_RETRANSLATE' END, CASE WHEN hd AND NOT again THEN 'FIX_HEADER_REWRITE' END, CASE WHEN rm AND NOT again THEN 'FIX_ROWS_SURGERY' END, CASE WHEN tk AND NOT again AND NOT cut THEN 'FIX_KEY_HYGIENE' END, CASE WHEN (fo OR tk) AND game AND NOT again AND NOT cut THEN 'FIX_ACTIONS_CONTEXT' END, CASE WHEN lg AND NOT again AND NOT cut THEN 'FIX_LAGSHIFT_CSV' END, CASE WHEN fz THEN 'FIX_GATE_WINDOW' END, CASE WHEN cut THEN 'FIX_CUT_SEGMENTS' END], lambda x: x IS NOT NULL) AS st FROM g)
SELECT session_id, array_to_string(CASE WHEN cut OR len(st) = 0 THEN st ELSE st || ['FIX_SESSIONJSON_RECOMPUTE'] END, ',') AS steps, array_to_string(list_sort([x FOR x IN c IF x = 'CNT_SHORT' OR (x = 'INP_FANOUT' AND NOT game AND NOT raw)]), ',') AS hopeless FROM s""")
def _(spark, d):
    code = F.element_at(F.array(*[F.lit(x) for x in PLAN_CODES]), (F.col("l_partkey") % len(PLAN_CODES) + 1).cast("int"))
    p = spark.read.parquet(f"{d}/lineitem.parquet").groupBy(F.col("l_orderkey").alias("session_id")).agg(F.collect_set(code).alias("c"))
    steps, hopeless = decide.plan(F.col("c"), F.col("session_id") % 3 == 0, F.col("session_id") % 2 == 1)
    return p.select("session_id", F.array_join(steps, ",").alias("steps"), F.array_join(hopeless, ",").alias("hopeless"))


@query("window_rules", "WITH w AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity * 2 AS t0, l_quantity * 2 + l_discount * 100 AS t1, 105.0 AS dur, l_tax > 0.01 AS high, CASE WHEN l_tax > 0.07 THEN NULL ELSE l_tax * 10 END AS still, l_linenumber % 2 AS actions FROM lineitem) SELECT CASE WHEN NOT high THEN 'ignore' WHEN t0 <= 1 AND t1 >= dur - 1 THEN 'reject' WHEN t0 <= 1 AND dur - (t1 + 0.5) < 70 THEN 'reject' WHEN t0 <= 1 THEN 'trim head' WHEN t1 >= dur - 1 AND t0 - 0.5 < 70 THEN 'reject' WHEN t1 >= dur - 1 THEN 'cut tail' WHEN still >= 0.40 THEN 'keep' WHEN still IS NULL THEN 'advise' WHEN t1 - t0 <= 5 AND actions > 0 THEN 'gate' WHEN t1 - t0 <= 5 THEN 'advise' ELSE 'cut' END AS rule, count(*) AS n FROM w GROUP BY 1")
def _(spark, d):
    w = spark.read.parquet(f"{d}/lineitem.parquet")
    t0, t1 = F.col("l_quantity") * 2, F.col("l_quantity") * 2 + F.col("l_discount") * 100
    still = F.when(F.col("l_tax") > 0.07, None).otherwise(F.col("l_tax") * 10)
    rule = decide.window_rule(t0, t1, F.lit(105.0), F.col("l_tax") > 0.01, still, F.col("l_linenumber") % 2)
    return w.groupBy(rule.alias("rule")).agg(F.count("*").alias("n"))


@query("reject_labels", f"WITH r AS (SELECT l_orderkey AS session_id, {ql(CODES)}[l_partkey % {len(CODES)} + 1] AS code, l_linestatus = 'F' AS blocking, l_returnflag = 'A' AS fixable FROM lineitem), l AS (SELECT session_id, list_sort(list_distinct(list({ts.sql_alias('code', {k: v[1] for k, v in T.REASON_LABELS.items()}).replace('ELSE code', 'ELSE replace(lower(code), ' + repr('_') + ', ' + repr('-') + ')')}) FILTER (WHERE blocking AND NOT fixable))) AS labels FROM r GROUP BY 1) SELECT session_id, CASE WHEN labels IS NULL OR len(labels) = 0 THEN 'fix-failed' ELSE array_to_string(labels, ',') END AS labels FROM l")
def _(spark, d):
    code = F.element_at(F.array(*[F.lit(c) for c in CODES]), (F.col("l_partkey") % len(CODES) + 1).cast("int"))
    r = spark.read.parquet(f"{d}/lineitem.parquet").groupBy(F.col("l_orderkey").alias("session_id")).agg(F.collect_list(F.struct(code.alias("code"), (F.col("l_linestatus") == "F").alias("blocking"), (F.col("l_returnflag") == "A").alias("fixable"))).alias("reasons"))
    return r.select("session_id", F.array_join(decide.reject_labels(F.col("reasons")), ",").alias("labels"))


# --- ledger -------------------------------------------------------------------------------------------------------


@query("player_rollup", f"WITH {SE} SELECT game, operator, player, count(*) AS sessions, count(*) FILTER (WHERE state = 'DELIVERED') AS delivered, count(*) FILTER (WHERE state = 'REJECTED') AS rejected, CAST(coalesce(sum(cents) FILTER (WHERE state = 'DELIVERED'), 0) AS BIGINT) AS delivered_cents FROM se WHERE state <> 'DUPLICATE' GROUP BY ALL")
def _(spark, d):
    return ledger.rollup(sessions(spark, d), ["game", "operator", "player"])


@query("delivered_hours", f"WITH {SE} SELECT game, CAST(sum(CASE WHEN state = 'DELIVERED' THEN cents ELSE 0 END) AS BIGINT) AS delivered_cents, CAST(sum(CASE WHEN parent_id IS NULL THEN cents ELSE 0 END) AS BIGINT) AS collected_cents FROM se GROUP BY 1")
def _(spark, d):
    s = sessions(spark, d)
    return s.groupBy("game").agg(F.sum(F.when(F.col("state") == "DELIVERED", F.col("cents")).otherwise(0)).alias("delivered_cents"), F.sum(F.when(F.col("parent_id").isNull(), F.col("cents")).otherwise(0)).alias("collected_cents"))


@query("counts_by_state", f"WITH {SE} SELECT state, count(*) AS n FROM se GROUP BY 1")
def _(spark, d):
    return sessions(spark, d).groupBy("state").agg(F.count("*").alias("n"))


TREE = f"WITH RECURSIVE {SE}, up AS (SELECT session_id AS node, session_id AS cur, parent_id, 0 AS depth FROM se UNION ALL SELECT up.node, se.session_id, se.parent_id, depth + 1 FROM up JOIN se ON se.session_id = up.parent_id), ro AS (SELECT node, cur AS root, depth FROM up WHERE parent_id IS NULL)"


@query("top_root", f"{TREE} SELECT node, root, depth FROM ro")
def _(spark, d):
    return patterns.top_roots(sessions(spark, d), "session_id", "parent_id")


@query("tree_descendants", f"{TREE} SELECT root, count(*) AS n, max(depth) AS deepest FROM ro GROUP BY 1")
def _(spark, d):
    return ledger.descendants(sessions(spark, d), "session_id", "parent_id")


@query("cohort_sheet", f"{TREE}, nd AS (SELECT se.*, ro.root, h.operator AS ho, h.player AS hp FROM se JOIN ro ON ro.node = se.session_id JOIN se h ON h.session_id = ro.root WHERE h.created >= TIMESTAMP '1996-01-01' AND h.created < TIMESTAMP '1998-01-01') SELECT ho AS operator, hp AS player, count(*) FILTER (WHERE root = session_id) AS uploaded, CAST(sum(CASE WHEN root = session_id THEN cents ELSE 0 END) AS BIGINT) AS uploaded_cents, CAST(sum(CASE WHEN state = 'DELIVERED' THEN cents ELSE 0 END) AS BIGINT) AS accepted_cents, CAST(sum(CASE WHEN state NOT IN ('DELIVERED', 'SPLIT', 'REJECTED') THEN cents ELSE 0 END) AS BIGINT) AS pending_cents, count(*) FILTER (WHERE state = 'REJECTED') AS rejected FROM nd GROUP BY ALL")
def _(spark, d):
    s = sessions(spark, d)
    at = lambda x: F.lit(x).cast("timestamp_ntz" if dict(s.dtypes)["created"] == "timestamp_ntz" else "timestamp")
    return ledger.cohort(s, patterns.top_roots(s, "session_id", "parent_id"), at("1996-01-01"), at("1998-01-01"))


@query("snapshot_pivot", f"WITH {SE}, g AS (SELECT operator, CAST(sum(cents) FILTER (WHERE game = 'kamla') AS BIGINT) AS kamla, CAST(sum(cents) FILTER (WHERE game = 'outer_wilds') AS BIGINT) AS outer_wilds FROM se GROUP BY operator) SELECT CAST(operator AS VARCHAR) AS operator, coalesce(kamla, 0) AS kamla, coalesce(outer_wilds, 0) AS outer_wilds FROM g UNION ALL SELECT 'TOTAL', CAST(sum(kamla) AS BIGINT), CAST(sum(outer_wilds) AS BIGINT) FROM g")
def _(spark, d):
    s = sessions(spark, d).select(F.col("operator").cast("string").alias("operator"), "game", "cents")
    games = ["kamla", "outer_wilds"]
    per = s.groupBy("operator").pivot("game", games).sum("cents").fillna(0, games)
    return per.unionByName(per.agg(*[F.sum(g).alias(g) for g in games]).withColumn("operator", F.lit("TOTAL")))


@query("label_rank", f"WITH {SE}, c AS (SELECT priority, count(*) AS n FROM se WHERE state = 'REJECTED' GROUP BY 1) SELECT string_agg(priority, ', ' ORDER BY n DESC, priority) AS labels FROM c")
def _(spark, d):
    return ledger.ranked_labels(sessions(spark, d).filter("state = 'REJECTED'"), "priority")


@query("votes", "WITH v AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL), r AS (SELECT *, sum(n) OVER (PARTITION BY source) AS total, row_number() OVER (PARTITION BY source ORDER BY n DESC, lang) AS rn FROM v) SELECT source, lang AS winner, n, CAST(total AS BIGINT) AS total, n >= 8 AND n >= 0.9 * total AS tripped FROM r WHERE rn = 1")
def _(spark, d):
    v = spark.read.parquet(f"{d}/documents.parquet").groupBy("source", "lang").agg(F.count("*").alias("n"))
    w = Window.partitionBy("source")
    v = v.withColumns({"total": F.sum("n").over(w), "rn": F.row_number().over(w.orderBy(F.desc("n"), "lang"))}).filter("rn = 1")
    return v.select("source", F.col("lang").alias("winner"), "n", "total", ((F.col("n") >= 8) & (F.col("n") >= 0.9 * F.col("total"))).alias("tripped"))


@query("reason_baseline", f"WITH {SE} SELECT priority AS reason, count(*) AS n, count(DISTINCT player) AS players, CAST(sum(cents) AS BIGINT) AS cents FROM se WHERE state = 'REJECTED' GROUP BY 1")
def _(spark, d):
    return sessions(spark, d).filter("state = 'REJECTED'").groupBy(F.col("priority").alias("reason")).agg(F.count("*").alias("n"), F.count_distinct("player").alias("players"), F.sum("cents").alias("cents"))


@query("dedupe_earliest", f"WITH {FI}, f AS (SELECT *, first_value(owner) OVER w AS o1, first_value(ctime) OVER w AS c1 FROM fi WINDOW w AS (PARTITION BY md5 ORDER BY ctime)) SELECT ctime, CASE WHEN ctime = c1 THEN 'keep' WHEN owner = o1 THEN 'duplicate' ELSE 'rejected' END AS verdict FROM f")
def _(spark, d):
    return ledger.first_owner(files(spark, d), "md5", "owner", "ctime").select("ctime", "verdict")


@query("issue_duplicates", f"WITH {FI} SELECT md5, count(DISTINCT owner) AS n, min(owner) AS first FROM fi GROUP BY 1 HAVING count(DISTINCT owner) > 1")
def _(spark, d):
    return ledger.several(files(spark, d), "md5", "owner")


@query("identity_clusters", None)
def _(spark, d):
    f = files(spark, d).select("md5", "owner").distinct()
    first = f.groupBy("md5").agg(F.min("owner").alias("a"))
    return patterns.clusters(f.join(first, "md5").select("a", F.col("owner").alias("b")).filter("a <> b"))


@query("anti_vanished", f"WITH {SE} SELECT session_id FROM se WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = session_id) AND game IN (SELECT CASE WHEN l_orderkey % 2 = 0 THEN 'kamla' ELSE 'outer_wilds' END FROM lineitem WHERE l_orderkey % 2 = 0)")
def _(spark, d):
    li = spark.read.parquet(f"{d}/lineitem.parquet").select(F.col("l_orderkey").alias("session_id"))
    listed = li.withColumn("game", F.when(F.col("session_id") % 2 == 0, "kamla").otherwise("outer_wilds"))
    s = sessions(spark, d).select("session_id", "game")
    gone = s.join(listed.select("session_id").distinct(), "session_id", "left_anti")
    return gone.join(listed.filter("session_id % 2 = 0").select("game").distinct(), "game", "left_semi").select("session_id")


@query("reconcile_full_outer", f"WITH {SE}, e AS (SELECT session_id AS k, cents AS size, CAST(player AS VARCHAR) AS md5 FROM se WHERE session_id % 3 <> 0), a AS (SELECT session_id AS k, cents + CASE WHEN session_id % 5 = 0 THEN 1 ELSE 0 END AS size, CAST(player AS VARCHAR) AS md5 FROM se WHERE session_id % 7 <> 0) SELECT coalesce(e.k, a.k) AS k, CASE WHEN a.k IS NULL THEN 'missing' WHEN e.k IS NULL THEN 'extra' WHEN a.size = e.size AND a.md5 = e.md5 THEN 'ok' ELSE 'different' END AS status FROM e FULL JOIN a ON e.k = a.k")
def _(spark, d):
    s = sessions(spark, d).select(F.col("session_id").alias("k"), F.col("cents").alias("size"), F.col("player").cast("string").alias("md5"))
    return writers.delivery_gaps(s.filter("k % 3 <> 0"), s.filter("k % 7 <> 0").withColumn("size", F.col("size") + F.when(F.col("k") % 5 == 0, 1).otherwise(0)), ["k"])


@query("current_state", f"WITH {AU} SELECT session_id, arg_max(to_state, (ts, id)) AS state FROM au GROUP BY 1")
def _(spark, d):
    return ledger.current_state(audit(spark, d))


@query("illegal_moves", f"WITH {AU}, m AS (SELECT session_id, ts, id, to_state, lag(to_state) OVER (PARTITION BY session_id ORDER BY ts, id) AS from_state FROM au) SELECT session_id, id, from_state, to_state FROM m WHERE from_state <> to_state AND from_state || '>' || to_state NOT IN ('N>A', 'A>R')")
def _(spark, d):
    return ledger.illegal_moves(audit(spark, d), ["N>A", "A>R"]).select("session_id", "id", "from_state", "to_state")


STINT = f"WITH {AU}, o AS (SELECT session_id, max((ts, id)) AS last_out FROM au WHERE to_state = 'R' GROUP BY 1), s AS (SELECT au.session_id, min(ts) AS since FROM au LEFT JOIN o USING (session_id) WHERE to_state IN ('A', 'N') AND (last_out IS NULL OR (ts, id) > last_out) GROUP BY 1)"


@query("stint_start", f"{STINT} SELECT session_id, epoch_us(since) AS since_us FROM s")
def _(spark, d):
    return ledger.stint_start(audit(spark, d), ["A", "N"]).select("session_id", us(F.col("since")).alias("since_us"))


def us(c) -> F.Column:
    return F.unix_micros(c.cast("timestamp"))


@query("stuck_list", f"{STINT}, r AS (SELECT *, row_number() OVER (ORDER BY since, session_id) AS rn, count(*) OVER () AS total FROM s WHERE since < TIMESTAMP '1996-06-01') SELECT session_id, epoch_us(since) AS since_us, total FROM r WHERE rn <= 5")
def _(spark, d):
    s = ledger.stint_start(audit(spark, d), ["A", "N"]).filter(F.col("since") < F.lit("1996-06-01"))
    total = s.agg(F.count("*").alias("total"))
    return s.orderBy("since", "session_id").limit(5).join(total).select("session_id", us(F.col("since")).alias("since_us"), "total")


@query("latest_transition", f"WITH {AU} SELECT session_id, epoch_us(max(ts)) AS rejected_us, arg_max(status, (ts, id)) AS status FROM au WHERE to_state ILIKE 'r' GROUP BY 1")
def _(spark, d):
    a = audit(spark, d).filter("to_state ilike 'r'")
    return a.groupBy("session_id").agg(us(F.max("ts")).alias("rejected_us"), F.max_by("status", F.struct("ts", "id")).alias("status"))


@query("queue_priority", f"WITH {SE} SELECT session_id, game FROM se WHERE state = 'READY' AND session_id % 9 <> 0 ORDER BY CASE WHEN game = 'kamla' THEN 0 ELSE 1 END, created, session_id LIMIT 500")
def _(spark, d):
    s = sessions(spark, d).filter("state = 'READY'").withColumn("ctime", F.col("created").cast("string"))
    return ledger.queue(s, "kamla", 500, [], s.filter("session_id % 9 = 0").select("session_id")).select("session_id", "game")


HELD_ROWS = "hr AS (SELECT doc_id AS path, n_chars AS first_seen, n_chars AS last_seen FROM documents WHERE doc_id % 3 = 0)"


@query("upsert_first_seen", f"WITH {HELD_ROWS}, nw AS (SELECT doc_id AS path, doc_id AS first_seen, doc_id + 1 AS last_seen FROM documents WHERE doc_id % 2 = 0) SELECT coalesce(hr.path, nw.path) AS path, coalesce(hr.first_seen, nw.first_seen) AS first_seen, coalesce(nw.last_seen, hr.last_seen) AS last_seen FROM hr FULL JOIN nw ON hr.path = nw.path")
def _(spark, d):
    p = spark.read.parquet(f"{d}/documents.parquet")
    old = p.filter("doc_id % 3 = 0").select(F.col("doc_id").alias("path"), F.col("n_chars").alias("first_seen"), F.col("n_chars").alias("last_seen"))
    new = p.filter("doc_id % 2 = 0").select(F.col("doc_id").alias("path"), F.col("doc_id").alias("first_seen"), (F.col("doc_id") + 1).alias("last_seen"))
    return live.sessions_seen(old, new)


@query("insert_or_ignore", "WITH o AS (SELECT md5(text) AS k, doc_id AS seconds FROM documents WHERE doc_id < 200), n AS (SELECT md5(text) AS k, doc_id AS seconds, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rn FROM documents WHERE doc_id >= 200) SELECT k, seconds FROM o UNION ALL SELECT k, seconds FROM n WHERE rn = 1 AND k NOT IN (SELECT k FROM o)")
def _(spark, d):
    p = spark.read.parquet(f"{d}/documents.parquet").select(F.md5(F.col("text").cast("binary")).alias("k"), F.col("doc_id").alias("seconds"))
    return patterns.insert_or_ignore(p.filter("seconds < 200"), p.filter("seconds >= 200"), ["k"], ["seconds"])


@query("cas_update", f"WITH {FI} SELECT ctime, CASE WHEN ctime % 4 = 0 AND ctime % 8 <> 0 THEN 'taken' ELSE owner END AS owner FROM fi")
def _(spark, d):
    f = files(spark, d)
    wanted = f.filter("ctime % 4 = 0").select("ctime", F.when(F.col("ctime") % 8 == 0, "stale").otherwise(F.col("md5")).alias("md5"), F.lit("taken").alias("owner"))
    return patterns.compare_and_set(f, wanted, ["ctime"], "md5", "owner").select("ctime", "owner")


@query("folder_issues_union", f"WITH {SE} SELECT session_id, 'incomplete' AS issue, epoch_us(created) AS at_us FROM se WHERE state = 'SPLIT' UNION ALL SELECT session_id, 'bad path', epoch_us(created) FROM se WHERE state = 'DUPLICATE'")
def _(spark, d):
    s = sessions(spark, d)
    one = lambda state, name: s.filter(F.col("state") == state).select("session_id", F.lit(name).alias("issue"), us(F.col("created")).alias("at_us"))
    return one("SPLIT", "incomplete").unionByName(one("DUPLICATE", "bad path"))


@query("daily_stats", f"WITH {SE} SELECT created AS day, count(*) FILTER (WHERE state = 'DELIVERED') AS delivered, count(*) FILTER (WHERE state = 'REJECTED') AS rejected, count(DISTINCT player) AS players FROM se GROUP BY 1")
def _(spark, d):
    return sessions(spark, d).groupBy(F.col("created").alias("day")).agg(F.count_if(F.col("state") == "DELIVERED").alias("delivered"), F.count_if(F.col("state") == "REJECTED").alias("rejected"), F.count_distinct("player").alias("players"))


@query("sample_floor", f"WITH {SE}, n AS (SELECT *, row_number() OVER (PARTITION BY game ORDER BY created, session_id) AS nth, session_id % 5 = 0 AS sampled FROM se WHERE state = 'DELIVERED'), r AS (SELECT *, sum(CASE WHEN sampled THEN 1 ELSE 0 END) OVER (PARTITION BY game ORDER BY nth) AS have FROM n) SELECT session_id, have < ceil(0.15 * (nth + 1)) AS short FROM r")
def _(spark, d):
    w = Window.partitionBy("game").orderBy("created", "session_id")
    n = sessions(spark, d).filter("state = 'DELIVERED'").withColumn("nth", F.row_number().over(w))
    have = F.sum(F.when(F.col("session_id") % 5 == 0, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return n.select("session_id", (have < F.ceil(0.15 * (F.col("nth") + 1))).alias("short"))


@query("hash_sample", "SELECT o_orderkey FROM orders WHERE CAST('0x' || substr(md5('2026:' || o_orderkey), 1, 8) AS BIGINT) % 1000 < 200")
def _(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey")
    draw = F.conv(F.substring(F.md5(F.concat(F.lit("2026:"), F.col("o_orderkey").cast("string"))), 1, 8), 16, 10).cast("bigint") % 1000
    return o.filter(draw < 200)


@query("pace", f"WITH {SE}, h AS (SELECT operator, sum(CASE WHEN game = 'kamla' AND state = 'DELIVERED' THEN cents ELSE 0 END) // 1000000 AS a, sum(CASE WHEN game = 'outer_wilds' AND state = 'DELIVERED' THEN cents ELSE 0 END) // 1000000 AS b, count(*) AS tr FROM se GROUP BY 1), p AS (SELECT *, greatest(0.0, 500.0 - a) + greatest(0.0, 500.0 - b) AS rest FROM h) SELECT operator, round(rest / 8, 6) AS need_total, CASE WHEN rest <= 0 THEN false ELSE rest / 8 > tr * 1.15 OR rest / tr > 8 END AS alarm FROM p")
def _(spark, d):
    s = sessions(spark, d)
    hours = lambda g: F.floor(F.sum(F.when((F.col("game") == g) & (F.col("state") == "DELIVERED"), F.col("cents")).otherwise(0)) / 1000000)
    h = s.groupBy("operator").agg(hours("kamla").alias("a"), hours("outer_wilds").alias("b"), F.count("*").alias("tr"))
    p = ledger.pace({"kamla": F.col("a"), "outer_wilds": F.col("b")}, F.col("tr"), F.lit(8.0), 150)
    return h.select("operator", F.round(p["need_total"], 6).alias("need_total"), p["alarm"].alias("alarm"))


@query("autoscale_law", "SELECT event_id, CASE WHEN value / 100 >= 4 THEN greatest(8, least(40, 20 - 4)) WHEN value % 100 > 95 AND event_id % 2 = 0 THEN greatest(8, least(40, 20 - 2)) WHEN value % 100 < 85 AND event_id % 30 > 10 THEN greatest(8, least(40, 20 + 2)) ELSE 20 END AS target FROM events")
def _(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    refused = F.when(F.col("value") / 100 >= 4, 1.0).otherwise(0.0)
    t = live.autoscale(F.lit(20), F.lit(10), F.col("event_id") % 30, F.col("value") % 100, refused, F.lit(False), F.col("event_id") % 2 == 0, 8, 40)
    return e.select("event_id", t.alias("target"))


@query("pressure_window", "WITH w AS (SELECT epoch_us(ts) // 3600000000 AS h FROM events WHERE event_type = 'error'), s AS (SELECT unnest(generate_series(h - 5, h)) AS h0 FROM w) SELECT h0 * 3600 AS start_s, count(*) AS n FROM s GROUP BY 1")
def _(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").filter("event_type = 'error'")
    w = e.groupBy(F.window(F.col("ts").cast("timestamp"), "6 hours", "1 hour")).agg(F.count("*").alias("n"))
    return w.select(F.unix_seconds("window.start").alias("start_s"), "n")
