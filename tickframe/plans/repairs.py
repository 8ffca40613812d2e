"""Queries on repairs and bookkeeping."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickframe.operators import patterns, repair
from tickframe.plans import timeseries as ts
from tickframe.plans.ledger import SE, TREE, sessions
from tickframe.plans.timeseries import EV, query

CLOCK = "ck AS (SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY t, seq) - 1 AS frame_id, t AS pts_us FROM ev)"


def clock(spark, d):
    e = ts.events(spark, d)
    return e.select("session_id", (F.row_number().over(Window.partitionBy("session_id").orderBy("t", "seq")) - 1).cast("bigint").alias("frame_id"), F.col("t").alias("pts_us"))


@query("times_from_clock", f"WITH {EV}, {CLOCK} SELECT session_id, frame_id, CAST(round_even(pts_us / 1000, 0) AS BIGINT) AS timestamp_ms FROM ck")
def _(spark, d):
    c = clock(spark, d)
    rows = c.select("session_id", "frame_id", F.lit(0).cast("bigint").alias("timestamp_ms"))
    return repair.times_from_clock(rows, c, ["session_id"]).select("session_id", "frame_id", "timestamp_ms")


@query("row_surgery", f"WITH {EV}, {CLOCK}, n AS (SELECT session_id, count(*) AS n FROM ck GROUP BY 1), rw AS (SELECT ck.session_id, frame_id FROM ck JOIN n USING (session_id) WHERE frame_id < n - session_id % 5), k AS (SELECT session_id, session_id % 5 <= 2 AS ok FROM n) SELECT ck.session_id, ck.frame_id, NULL AS problem FROM ck JOIN k USING (session_id) WHERE ok UNION ALL SELECT rw.session_id, frame_id, 'too many rows differ' FROM rw JOIN k USING (session_id) WHERE NOT ok")
def _(spark, d):
    c = clock(spark, d)
    n = F.count("*").over(Window.partitionBy("session_id"))
    rows = c.withColumn("n", n).filter(F.col("frame_id") < F.col("n") - F.col("session_id") % 5).select("session_id", "frame_id")
    return repair.row_surgery(rows, c, ["session_id"]).select("session_id", "frame_id", "problem")


@query("sentinels", "WITH c AS (SELECT event_id, user_id, CASE event_id % 4 WHEN 0 THEN CAST(value AS VARCHAR) WHEN 1 THEN 'x' WHEN 2 THEN '' ELSE '-1.5' END AS cell, user_id % 3 <> 0 AS moves FROM events) SELECT event_id, CASE WHEN NOT moves THEN '' WHEN regexp_matches(cell, '^-?[0-9]+\\.[0-9]+$') THEN cell ELSE '0.0' END AS cell FROM c")
def _(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    m = F.col("event_id") % 4
    cell = F.when(m == 0, F.col("value").cast("string")).when(m == 1, "x").when(m == 2, "").otherwise("-1.5")
    return e.select("event_id", repair.sentinels(cell, F.col("user_id") % 3 != 0).alias("cell"))


@query("press_order", f"""{ts.TOKENS}, e AS (SELECT session_id, seq, t, token, CASE event_type WHEN 'click' THEN 'down' WHEN 'view' THEN 'up' ELSE 'focus' END AS kind FROM keys WHERE event_type = 'error' OR (event_type IN ('click', 'view') AND token IN ('w', 'a', 's', 'd', 'e'))),
s AS (SELECT a.session_id, a.seq, a.t, b.token, b.t AS bt, b.seq AS bs, b.kind, row_number() OVER (PARTITION BY a.session_id, a.seq, b.token ORDER BY b.t DESC, b.seq DESC) AS rn, max(CASE WHEN b.kind = 'focus' THEN (b.t, b.seq) END) OVER (PARTITION BY a.session_id, a.seq) AS f FROM e a JOIN e b ON a.session_id = b.session_id AND (b.t, b.seq) <= (a.t, a.seq)),
h AS (SELECT session_id, seq, arg_max(token, (bt, bs)) AS holder FROM s WHERE rn = 1 AND kind = 'down' AND (f IS NULL OR (bt, bs) > f) GROUP BY 1, 2) SELECT e.session_id, e.seq, holder FROM e LEFT JOIN h USING (session_id, seq)""")
def _(spark, d):
    e = ts.keyed(spark, d).withColumn("kind", F.when(F.col("event_type") == "click", "down").when(F.col("event_type") == "view", "up").when(F.col("event_type") == "error", "focus"))
    e = e.filter("kind = 'focus' or (kind is not null and token in ('w', 'a', 's', 'd', 'e'))")
    return repair.newest_pressed(e, ["session_id"])


@query("clock_offset")
def _(spark, d):
    a = F.transform(F.sort_array(F.collect_list(F.struct("frame_id", "pts_us"))), lambda x: x.pts_us)
    c = clock(spark, d).groupBy("session_id").agg(a.alias("b"))
    return repair.clock_offset(c.select("session_id", F.expr("slice(b, 4, greatest(size(b) - 3, 0))").alias("a"), "b"), "session_id")


@query("paid_matches", f"{TREE}, pd AS (SELECT ro.root, se.session_id, cents + CASE WHEN session_id % 50 = 0 THEN 500 ELSE 60 END AS cents FROM se JOIN ro ON ro.node = se.session_id WHERE session_id % 3 = 0) SELECT root, bool_and(state = 'DELIVERED' AND abs(se.cents - pd.cents) <= 100) AS whole FROM pd JOIN se USING (session_id) GROUP BY 1")
def _(spark, d):
    s = sessions(spark, d)
    roots = patterns.top_roots(s, "session_id", "parent_id")
    paid = s.join(roots, F.col("session_id") == F.col("node")).filter("session_id % 3 = 0").select("root", "session_id", (F.col("cents") + F.when(F.col("session_id") % 50 == 0, 500).otherwise(60)).alias("cents"))
    return repair.paid_matches(paid, s)


@query("backup_retention", "SELECT DISTINCT o_orderdate AS day FROM orders ORDER BY day DESC LIMIT 14")
def _(spark, d):
    return repair.retained(spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderdate").alias("day")).distinct(), 14)


@query("reclaim_sweep", f"WITH {SE} SELECT session_id, CASE WHEN state IN ('DELIVERED', 'SPLIT', 'DUPLICATE') THEN true ELSE false END AS reclaim FROM se")
def _(spark, d):
    return sessions(spark, d).select("session_id", repair.reclaimable(F.col("state"), F.lit(13)).alias("reclaim"))


@query("resume_lanes", f"WITH {SE}, b AS (SELECT session_id // 10 AS batch, list(CASE WHEN session_id % 97 = 0 THEN 'DOWNLOADING' WHEN session_id % 11 = 0 THEN 'FIXING' ELSE state END) AS s FROM se GROUP BY 1) SELECT batch, CASE WHEN list_has_any(s, ['DISCOVERED', 'DOWNLOADING']) THEN 'D' WHEN list_has_any(s, ['FIXING', 'INGESTED']) THEN 'V' ELSE 'U' END AS lane FROM b")
def _(spark, d):
    k = F.col("session_id")
    state = F.when(k % 97 == 0, "DOWNLOADING").when(k % 11 == 0, "FIXING").otherwise(F.col("state"))
    b = sessions(spark, d).groupBy(F.floor(k / 10).alias("batch")).agg(F.collect_set(state).alias("s"))
    return b.select("batch", repair.lane(F.col("s")).alias("lane"))


@query("trimmed_metadata", "SELECT event_id, strftime(ts + to_microseconds(CAST(event_id % 7 * 500000 AS BIGINT)), '%Y-%m-%dT%H:%M:%S.%fZ') AS created_at_utc, strftime(ts + to_microseconds(CAST(event_id % 7 * 500000 + 70250000 AS BIGINT)), '%Y-%m-%dT%H:%M:%S.%fZ') AS ended_at_utc FROM events")
def _(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    t = repair.shifted_metadata(F.col("ts").cast("timestamp"), F.col("event_id") % 7 * 0.5, F.lit(70.25))
    return e.select("event_id", *[c.alias(n) for n, c in t.items()])


@query("digest_lines", f"WITH {SE}, o AS (SELECT operator, sum(cents) FILTER (WHERE state = 'DELIVERED') // 1000000 AS h, count(*) AS n, count(*) FILTER (WHERE state = 'REJECTED') AS r, string_agg(DISTINCT priority, ', ' ORDER BY priority) FILTER (WHERE state = 'REJECTED') AS l FROM se GROUP BY 1) SELECT operator, printf('%.1f h from %d sessions', CAST(h AS DOUBLE), n) || CASE WHEN r > 0 THEN printf(', %d rejected (', r) || l || ')' ELSE '' END AS line FROM o")
def _(spark, d):
    delivered, out = F.col("state") == "DELIVERED", F.col("state") == "REJECTED"
    o = sessions(spark, d).groupBy("operator").agg(
        F.floor(F.sum(F.when(delivered, F.col("cents"))) / 1000000).cast("double").alias("h"), F.count("*").alias("n"), F.count_if(out).alias("r"),
        F.array_join(F.array_sort(F.collect_set(F.when(out, F.col("priority")))), ", ").alias("l"),
    )
    return o.select("operator", repair.digest_line(F.col("h"), F.col("n"), F.col("r"), F.col("l")).alias("line"))
