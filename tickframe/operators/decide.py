"""Evidence to reasons, reasons to verdicts and repair plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.functions import tables as T


def needle(message: Column) -> Column:
    """The reason of the first needle in the message; null if another check handles it."""
    out = F.lit("QA_FAIL_UNMAPPED")
    for text, code in reversed(T.NEEDLES):
        out = F.when(message.contains(text), F.lit(code)).otherwise(out)
    skip = F.lit(False)
    for text in T.NEEDLES_SKIPPED:
        skip = skip | message.contains(text)
    return F.when(~skip, out)


def reasons_of(messages: DataFrame, keys: list[str]) -> DataFrame:
    """keys, code, blocking: one row a reason; an unmapped failure does not block beside a repairable one."""
    codes = messages.select(*keys, needle(F.col("message")).alias("code")).filter("code is not null").distinct()
    some = codes.groupBy(*keys).agg(F.bool_or(F.col("code") != "QA_FAIL_UNMAPPED").alias("_repairable"))
    return codes.join(some, keys).withColumn("blocking", ~((F.col("code") == "QA_FAIL_UNMAPPED") & F.col("_repairable"))).drop("_repairable")


def verdict_bin(blocking: Column, fixable: Column) -> Column:
    """From arrays' facts: 3 if something blocks and cannot be fixed, 2 if something blocks, else 1."""
    return F.when(blocking & ~fixable, 3).when(blocking, 2).otherwise(1)


def window_rule(t0: Column, t1: Column, duration: Column, high: Column, still: Column, actions: Column) -> Column:
    """What becomes of a non-gameplay window."""
    short = T.MIN_CLIP_S
    return (
        F.when(~high, "ignore").when((t0 <= 1) & (t1 >= duration - 1), "reject")
        .when((t0 <= 1) & (duration - (t1 + 0.5) < short), "reject").when(t0 <= 1, "trim head")
        .when((t1 >= duration - 1) & (t0 - 0.5 < short), "reject").when(t1 >= duration - 1, "cut tail")
        .when(still >= 0.40, "keep").when(still.isNull(), "advise")
        .when((t1 - t0 <= T.KEEP_GATE_MAX_S) & (actions > 0), "gate").when(t1 - t0 <= T.KEEP_GATE_MAX_S, "advise").otherwise("cut")
    )


def sync_reason(status: Column, lag_ms: Column, corr: Column, motion: Column, active: Column) -> Column:
    return (
        F.when(status == "drift", "SYN_TS_NOT_PTS").when((status == "FAIL") | (F.abs(lag_ms) > T.LAG_TARGET_MS) & (F.abs(corr) >= T.MIN_CORRELATION), "SYN_LAG_CONST")
        .when((F.abs(corr) < 0.05) & (motion >= 0.10) & active, "SYN_UNMEASURABLE_SUSPECT")
    )


#: order of steps, and which reasons ask for each when raw recordings are absent
CSV_FIXES = [
    ("FIX_HEADER_REWRITE", ["STR_HEADER_BAD"]), ("FIX_ROWS_SURGERY", ["STR_ROWS_MISMATCH"]), ("FIX_TSREPAIR_PTS", ["STR_TS_NONMONO", "STR_TS_TAIL", "SYN_TS_NOT_PTS"]),
    ("FIX_KEY_HYGIENE", ["INP_TOKEN_CASE", "INP_OSKEYS", "INP_BLEED", "INP_KEYS_NO_ACTION"]), ("FIX_ACTIONS_CONTEXT", []),
    ("FIX_LAGSHIFT_CSV", ["SYN_LAG_CONST"]), ("FIX_CAMERA_NULL", ["STR_CAMERA_NONNULL"]), ("FIX_SENTINELS", ["STR_SENTINELS"]),
]
#: reasons that a new translation of raw recordings clears
RETRANSLATE = "STR_HEADER_BAD STR_ROWS_MISMATCH STR_TS_NONMONO STR_TS_TAIL SYN_TS_NOT_PTS INP_KEYS_NO_ACTION SYN_LAG_CONST STR_CAMERA_NONNULL STR_SENTINELS QA_FAIL_UNMAPPED".split()


def plan(codes: Column, has_raw: Column, gated_game: Column) -> tuple[Column, Column]:
    """(steps in order, codes that nothing repairs) for an array of reason codes.

    A new translation replaces the repairs of the table; repairs of header, rows and time come before a cut, a gate
    before a cut or trim; a cut ends the plan; otherwise session data are computed again last.
    """
    has = lambda *names: F.arrays_overlap(codes, F.array(*[F.lit(n) for n in names]))
    none = F.array().cast("array<string>")
    step = lambda cond, name: F.when(cond, F.array(F.lit(name))).otherwise(none)
    again = has_raw & (has(*RETRANSLATE) | has("STR_GAME_MISMATCH"))
    context = has("INP_FANOUT") & gated_game
    first = [
        step(has("STR_VIDEO_UNREADABLE"), "FIX_REMUX"), step(has("ARR_V1_FORMAT"), "FIX_V1_TO_V2"), step(has("ARR_RAW_ONLY"), "FIX_TRANSLATE_RAW"), step(has("STR_GAME_MISMATCH"), "FIX_REROUTE_GAME"),
        step(has("STR_SJ_INVALID"), "FIX_SESSIONJSON_REWRITE"), step(again, "FIX_RETRANSLATE"),
    ]
    wanted = {name: (has(*why) if why else F.lit(False)) & ~again for name, why in CSV_FIXES}
    wanted["FIX_ACTIONS_CONTEXT"] = (context | (wanted["FIX_KEY_HYGIENE"] & gated_game)) & ~again
    pre = [step(wanted[n], n) for n, _ in CSV_FIXES[:3]]
    rest = [step(wanted[n], n) for n, _ in CSV_FIXES[3:]]
    gate = step(has("INP_FROZEN_ACTIONS"), "FIX_GATE_WINDOW")
    cut = has("CNT_MID_NONGAMEPLAY", "CNT_AFK")
    trim = step(has("CNT_EDGE_NONGAMEPLAY"), "FIX_RETRIM_HEAD")
    short = F.concat(*first, *pre, gate, F.array(F.lit("FIX_CUT_SEGMENTS")))
    long = F.concat(*first, *pre, *rest, gate, trim)
    steps = F.when(cut, short).when(F.size(long) > 0, F.concat(long, F.array(F.lit("FIX_SESSIONJSON_RECOMPUTE")))).otherwise(long)
    hopeless = F.filter(codes, lambda c: c.isin(T.HARD_REASONS) | (c == "QA_FAIL_UNMAPPED") & ~has_raw | (c == "INP_FANOUT") & ~gated_game & ~has_raw)
    return steps, F.array_sort(F.array_distinct(hopeless))


def reject_labels(reasons: Column) -> Column:
    """Short labels of what blocks and cannot be fixed, sorted; fix-failed if nothing does; reasons: array of (code, blocking, fixable)."""
    from tickframe.functions.tokens import reason_label

    labels = F.array_sort(F.array_distinct(F.transform(F.filter(reasons, lambda r: r.blocking & ~r.fixable), lambda r: reason_label(r.code, True))))
    return F.when(reasons.isNull(), F.array(F.lit("unreadable-reasons"))).when(F.size(labels) == 0, F.array(F.lit("fix-failed"))).otherwise(labels)


#: Votes, share of named guesses and share of sampled frames from which the video's own game counts.
TRIPWIRE = (8, 0.9, 0.5)


def game_identity(top: Column, votes: Column, named: Column, frames: Column, claimed: Column, expected: Column, games: list[str], gating: bool = False) -> Column:
    """What a session's game names come to: a reason code, an advisory, or null.

    top: the game most guesses name, with votes of named guesses over frames. A near-unanimous video that contradicts the claim is
    reported, or gates; otherwise a claim out of scope and a folder that differs from it are reasons, weaker doubts an advisory.
    """
    bare = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("_"), F.lit(""))
    t, c = bare(top), bare(claimed)
    doubt = (t != "") & (c != "") & ~c.contains(t) & ~t.contains(c)
    sure = doubt & (votes >= TRIPWIRE[0]) & (votes / F.greatest(named, F.lit(1)) >= TRIPWIRE[1]) & (votes / frames >= TRIPWIRE[2])
    said = F.coalesce(claimed, F.lit("")) != ""
    on_video = F.when(top.isin(games), "STR_GAME_MISMATCH").otherwise("CNT_WRONG_GAME") if gating else F.lit("advisory: video shows another game")
    return (
        F.when(sure, on_video)
        .when(said & ~claimed.isin(games), "CNT_WRONG_GAME")
        .when(said & (F.coalesce(expected, F.lit("")) != "") & (expected != claimed), "STR_GAME_MISMATCH")
        .when(doubt, "advisory: verify the game by hand")
    )
