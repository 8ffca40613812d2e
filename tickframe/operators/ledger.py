"""Session ledger: audit log, duplicates, cohorts, hours, stints and issue lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickframe.functions import tables as T
from tickframe.operators import patterns

#: Transitions that the state machine knows. Fixed values.
MOVES = [
    "DISCOVERED>DOWNLOADING", "DOWNLOADING>INGESTED", "DOWNLOADING>DISCOVERED", "DOWNLOADING>QUARANTINED", "DOWNLOADING>DUPLICATE", "DOWNLOADING>REJECTED", "INGESTED>VALIDATING",
    "HOLD_VLM>VALIDATING", "REVALIDATING>VALIDATING", "VALIDATING>READY", "VALIDATING>FIX_QUEUED", "VALIDATING>REJECTED", "VALIDATING>HOLD_VLM", "VALIDATING>QUARANTINED",
    "FIX_QUEUED>FIXING", "FIX_QUEUED>REJECTED", "FIXING>REVALIDATING", "FIXING>SPLIT", "FIXING>REJECTED", "FIXING>FIX_QUEUED", "READY>PACKAGED", "PACKAGED>UPLOADED",
    "UPLOADED>DELIVERED", "READY>FIX_QUEUED", "READY>REJECTED", "READY>QUARANTINED", "DISCOVERED>QUARANTINED", "REJECTED>DISCOVERED", "QUARANTINED>DISCOVERED",
]


def current_state(audit: DataFrame, key: str = "session_id") -> DataFrame:
    return audit.groupBy(key).agg(F.max_by("to_state", F.struct("ts", "id")).alias("state"))


def illegal_moves(audit: DataFrame, moves: list[str], key: str = "session_id") -> DataFrame:
    w = Window.partitionBy(key).orderBy("ts", "id")
    seen = audit.withColumn("from_state", F.lag("to_state").over(w)).filter("from_state is not null and from_state <> to_state")
    return seen.filter(~F.concat("from_state", F.lit(">"), "to_state").isin(moves))


def stint_start(audit: DataFrame, group: list[str], key: str = "session_id") -> DataFrame:
    """key, since: the first event of the states in group after the last event outside it; none if the last event is outside."""
    inside = F.col("to_state").isin(group)
    outside = audit.withColumn("_out", F.max(F.when(~inside, F.struct("ts", "id"))).over(Window.partitionBy(key)))
    stint = outside.filter(inside & (F.col("_out").isNull() | (F.struct("ts", "id") > F.col("_out"))))
    return stint.groupBy(key).agg(F.min("ts").alias("since"))


def first_owner(files: DataFrame, digest: str, owner: str, order: str) -> DataFrame:
    """files with verdict: keep (first of its digest), duplicate (the same owner's again) or rejected (another owner was first). An empty digest is never equal."""
    known = F.col(digest).isNotNull() & (F.col(digest) != "")
    first = F.min(F.struct(F.col(order), F.col(owner))).over(Window.partitionBy(digest))
    verdict = F.when(~known | (F.col(order) == first[order]), "keep").when(F.col(owner) == first[owner], "duplicate").otherwise("rejected")
    return files.withColumn("verdict", verdict)


def rollup(sessions: DataFrame, keys: list[str]) -> DataFrame:
    return sessions.filter("state <> 'DUPLICATE'").groupBy(*keys).agg(
        F.count("*").alias("sessions"), F.count_if(F.col("state") == "DELIVERED").alias("delivered"), F.count_if(F.col("state") == "REJECTED").alias("rejected"),
        F.coalesce(F.sum(F.when(F.col("state") == "DELIVERED", F.col("cents"))), F.lit(0)).alias("delivered_cents"),
    )


def cohort(sessions: DataFrame, roots: DataFrame, since: Column, until: Column) -> DataFrame:
    """Per operator and player: roots uploaded in the window, and of whole trees what is accepted, pending and rejected.

    sessions: session_id, state, cents, created, operator, player, game. Trees are judged by their root's upload time;
    DELIVERED nodes count as accepted, SPLIT nodes not at all, other nodes as pending unless REJECTED.
    """
    nodes = sessions.join(roots.select(F.col("node").alias("session_id"), "root"), "session_id")
    heads = sessions.select(F.col("session_id").alias("root"), F.col("created").alias("root_created"), F.col("operator").alias("ro"), F.col("player").alias("rp"))
    nodes = nodes.join(heads, "root").filter((F.col("root_created") >= since) & (F.col("root_created") < until))
    is_root = F.col("root") == F.col("session_id")
    return nodes.groupBy(F.col("ro").alias("operator"), F.col("rp").alias("player")).agg(
        F.count_if(is_root).alias("uploaded"), F.sum(F.when(is_root, F.col("cents")).otherwise(0)).alias("uploaded_cents"),
        F.sum(F.when(F.col("state") == "DELIVERED", F.col("cents")).otherwise(0)).alias("accepted_cents"),
        F.sum(F.when(~F.col("state").isin("DELIVERED", "SPLIT", "REJECTED"), F.col("cents")).otherwise(0)).alias("pending_cents"), F.count_if(F.col("state") == "REJECTED").alias("rejected"),
    )


def ranked_labels(labels: DataFrame, column: str) -> DataFrame:
    """One row: all labels by number, then name."""
    counts = labels.groupBy(column).agg(F.count("*").alias("n"))
    return counts.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), F.col(column).alias("label")))), lambda x: x.label), ", ").alias("labels"))


def queue(sessions: DataFrame, priority: str, n: int, closed: list[str], taken: DataFrame) -> DataFrame:
    """The next n to take: the priority game first, then by time (unknown last), then id; closed games and taken ids do not come."""
    left = sessions.filter(~F.col("game").isin(closed) if closed else F.lit(True)).join(taken, "session_id", "left_anti")
    return left.orderBy(F.when(F.col("game") == priority, 0).otherwise(1), F.coalesce(F.nullif("ctime", F.lit("")), F.lit("9")), "session_id").limit(n)


def pace(delivered_hours: dict[str, Column], trailing: Column, days_left: Column, players: int) -> dict[str, Column]:
    """What is needed a day, whether that is out of reach, and minutes a player."""
    remaining = sum((F.greatest(F.lit(0.0), F.lit(T.TARGET_HOURS) - h) for h in delivered_hours.values()), F.lit(0.0))
    need = remaining / days_left
    finish = F.when(trailing > 0, remaining / trailing)
    alarm = F.when(remaining <= 0, False).otherwise((need > trailing * T.PACE_ALARM_FACTOR) | finish.isNull() | (finish > days_left))
    return {"need_total": need, "days_to_finish": F.when(remaining <= 0, 0.0).otherwise(finish), "alarm": alarm, "minutes_per_player": F.when(remaining <= 0, 0.0).otherwise(need * 60 / players)}


def vanished(held: DataFrame, listed: DataFrame, path: str, game: str) -> DataFrame:
    """Held paths that the listing lacks, of games that it has at all."""
    return held.join(listed.select(path).distinct(), path, "left_anti").join(listed.select(game).distinct(), game, "left_semi")


def several(rows: DataFrame, by: str, what: str) -> DataFrame:
    """Values of by that occur with more than one what."""
    return rows.groupBy(by).agg(F.count_distinct(what).alias("n"), F.min(what).alias("first")).filter("n > 1")


def descendants(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """root, n, deepest: sizes and depths of trees."""
    up = patterns.top_roots(nodes, node, parent)
    return up.groupBy("root").agg(F.count("*").alias("n"), F.max("depth").alias("deepest"))


# --- listing against ledger ----------------------------------------------------------------------------------------


def placements(listed: DataFrame, held: DataFrame) -> DataFrame:
    """session_id, path, kind of listed sessions (session_id, path, player) against held ones (with state): new, same, heal, moved, collision.

    A held id at another path heals if it was quarantined and its player is unknown or the same; it has moved if its old path is
    gone from the listing and the player is the same; else two uploads claim one id.
    """
    old = held.select("session_id", F.col("path").alias("old_path"), F.col("player").alias("old_player"), F.col("state").alias("old_state"))
    there = listed.select(F.col("path").alias("old_path"), F.lit(True).alias("still")).distinct()
    j = listed.join(old, "session_id", "left").join(there, "old_path", "left")
    same_player = F.col("old_player") == F.col("player")
    kind = (
        F.when(F.col("old_state").isNull(), "new").when(F.col("old_path") == F.col("path"), "same")
        .when((F.col("old_state") == "QUARANTINED") & ((F.col("old_player") == "") | same_player), "heal")
        .when(F.col("still").isNull() & same_player, "moved").otherwise("collision")
    )
    return j.select("session_id", "path", kind.alias("kind"))


def healed(held: DataFrame, placed: DataFrame, at: Column) -> tuple[DataFrame, DataFrame]:
    """held after the heals among placements, and the audit rows that go with them, made from the same rows."""
    heals = placed.filter("kind = 'heal'").select("session_id", F.col("path").alias("_path"))
    j = held.join(heals, "session_id", "left")
    hit = F.col("_path").isNotNull()
    after = j.withColumns({"path": F.coalesce("_path", "path"), "state": F.when(hit, "DISCOVERED").otherwise(F.col("state")), "reasons": F.when(hit, "[]").otherwise(F.col("reasons"))}).drop("_path")
    audit = j.filter(hit).select("session_id", F.col("state").alias("from_state"), F.lit("DISCOVERED").alias("to_state"), F.concat(F.lit("healed from "), "path").alias("detail"), at.alias("ts"))
    return after, audit


def superseded(old_md5: Column, new_md5: Column, paid: dict[str, Column]) -> dict[str, Column]:
    """Payment columns after a new upload in a rejected session's place: kept if the bytes are proven the same or cannot be told, else empty."""
    unknown = F.coalesce(old_md5, F.lit("")).eqNullSafe("") | F.coalesce(new_md5, F.lit("")).eqNullSafe("")
    return {name: F.when(unknown | (old_md5 == new_md5), value) for name, value in paid.items()}


def went_down(now: DataFrame, before: DataFrame, key: str) -> DataFrame:
    """Keys whose sessions or hours (by more than 0.01) are fewer than in an earlier report, or whose row is gone."""
    later = now.select(key, F.col("sessions").alias("_s"), F.col("hours").alias("_h"))
    j = before.join(later, key, "left")
    down = (F.coalesce("_s", F.lit(0)) < F.col("sessions")) | (F.coalesce("_h", F.lit(0.0)) < F.col("hours") - 0.01)
    return j.filter(down).select(key, F.col("sessions").alias("sessions_before"), F.coalesce("_s", F.lit(0)).alias("sessions_now"), F.col("_s").isNull().alias("row_gone"))


def game_mismatches(folder: Column, claimed: Column, slug: Column) -> Column:
    """Which of a session's three game names disagree; names that are empty do not count."""
    plain = lambda c: F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]", "")
    differ = lambda a, b: (plain(a) != "") & (plain(b) != "") & (plain(a) != plain(b))
    told = F.array(F.when(differ(folder, claimed), "folder/claimed"), F.when(differ(folder, slug), "folder/slug"), F.when(differ(claimed, slug), "claimed/slug"))
    return F.filter(told, lambda x: x.isNotNull())


# --- reads, order, sheets ------------------------------------------------------------------------------------------


def by_state(sessions: DataFrame, *states: str) -> DataFrame:
    return sessions.filter(F.col("state").isin(*states)).orderBy("created", "session_id")


def by_md5(sessions: DataFrame, md5: str) -> DataFrame:
    return sessions.filter((F.col("md5") == md5) & (F.col("md5") != "")).orderBy("session_id")


def removed(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    return rows.join(gone.select(key).distinct(), key, "left_anti")


#: States in the order in which work is taken up.
DISPATCH = [["FIX_QUEUED"], ["FIXING", "REVALIDATING", "VALIDATING"], ["HOLD_VLM"], ["INGESTED"]]


def dispatch_rank(state: Column) -> Column:
    """0 for what comes first, null for what is not taken up."""
    rank = F.lit(None).cast("int")
    for i, states in reversed(list(enumerate(DISPATCH))):
        rank = F.when(state.isin(states), i).otherwise(rank)
    return rank


def sheet_flags(up: Column, lo: Column, hi: Column, countable: Column, rejected: Column, reported: Column, sealed: Column, uncounted: Column) -> dict[str, Column]:
    """Why a root is on a sheet: uploaded in the window; late for an earlier one; accepted nodes of its tree still to count; or those of a root that cannot be counted."""
    in_window = (up >= lo) & (up < hi) & ~reported
    known = countable | rejected
    return {
        "in_window": in_window, "late": ~in_window & (up < lo) & known & ~reported, "accepted_due": (up < hi) & ~sealed & reported & uncounted,
        "uncountable_due": ~in_window & (up < hi) & ~sealed & ~reported & ~known & uncounted,
    }


def uncounted_trees(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """root, uncounted: whether any node of a tree is accepted and not counted yet; nodes (node, accepted, counted), roots (node, root)."""
    return nodes.join(roots, "node").groupBy("root").agg(F.bool_or(F.col("accepted") & ~F.col("counted")).alias("uncounted"))


def operator_totals(rows: DataFrame, by: str, figures: list[str], digits: int = 2) -> DataFrame:
    """Sums of figures that are rounded already, as the rows show them."""
    return rows.groupBy(by).agg(*[F.round(F.sum(F.round(F.col(c), digits)), digits).alias(c) for c in figures])


def delivered_since(sessions: DataFrame, at: str, now: Column, hours: int = 24) -> DataFrame:
    return sessions.filter((F.col("state") == "DELIVERED") & (F.col(at) > now - F.expr(f"interval {hours} hours")) & (F.col(at) <= now))


def destroyed(records: DataFrame, key: str) -> DataFrame:
    """What gates blanked, over all records (actions array, key_frames) of a session."""
    return records.groupBy(key).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("actions")))).alias("actions"), F.sum("key_frames").alias("key_frames"))


def longest(runs: DataFrame, keys: list[str], start: str, length: str, most: int = 40) -> DataFrame:
    """The longest runs of each key, ties to the earlier; the rest is a top-k report's to leave out."""
    w = Window.partitionBy(*keys).orderBy(F.desc(length), start)
    return runs.withColumn("_place", F.row_number().over(w)).filter(F.col("_place") <= most).drop("_place")

