"""Repairs of delivered rows, and the bookkeeping around them."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def times_from_clock(rows: DataFrame, clock: DataFrame, keys: list[str]) -> DataFrame:
    """timestamp_ms from the frame clock, halves to even; rows beyond the clock keep theirs."""
    c = clock.select(*keys, "frame_id", F.rint(F.col("pts_us") / 1000).cast("bigint").alias("_ms"))
    return rows.join(c, [*keys, "frame_id"], "left").withColumn("timestamp_ms", F.coalesce("_ms", "timestamp_ms")).drop("_ms")


def row_surgery(rows: DataFrame, clock: DataFrame, keys: list[str], most: int = 2) -> DataFrame:
    """Rows cut or padded to the clock's frames where the counts differ by at most most; problem says where they differ more."""
    have = rows.groupBy(*keys).agg(F.count("*").alias("_rows"))
    want = clock.groupBy(*keys).agg(F.count("*").alias("_frames"))
    both = have.join(want, keys).withColumn("problem", F.when(F.abs(F.col("_rows") - F.col("_frames")) > most, "too many rows differ"))
    frames = clock.select(*keys, "frame_id")
    out = frames.join(both.filter("problem is null").select(*keys), keys).join(rows, [*keys, "frame_id"], "left").withColumn("problem", F.lit(None).cast("string"))
    return out.unionByName(rows.join(both.filter("problem is not null").select(*keys, "problem"), keys))


def sentinels(cell: Column, session_moves: Column) -> Column:
    """Motion cells: blank if the session has no motion at all, 0.0 for what is not a decimal number."""
    return F.when(~session_moves, "").when(cell.rlike(r"^-?[0-9]+\.[0-9]+$"), cell).otherwise("0.0")


def newest_pressed(events: DataFrame, keys: list[str]) -> DataFrame:
    """keys, seq, holder: which of several tokens of one action holds after each event: the one pressed last and not released; a loss of focus clears all.

    events: seq, t, token, kind (down, up, focus). Order decides, so a session's events are folded in order.
    """
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in events.select(*keys).schema)

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        held: list[str] = []
        out = []
        for r in pdf.sort_values(["t", "seq"]).itertuples():
            if r.kind == "focus":
                held = []
            else:
                held = [x for x in held if x != r.token] + ([r.token] if r.kind == "down" else [])
            out.append((*[getattr(r, k) for k in keys], r.seq, held[-1] if held else None))
        return pd.DataFrame(out, columns=[*keys, "seq", "holder"])

    return events.select(*keys, "seq", "t", "token", "kind").groupBy(*keys).applyInPandas(fold, f"{fields}, seq long, holder string")


def clock_offset(pairs: DataFrame, key: str, probe: int = 400, tolerance: int = 1000, least: int = 50) -> DataFrame:
    """key, offset, prefix: the one place in clock b where clock a begins, below 0 if b begins later, and how many steps fit from there.

    The first steps of the overlap must fit, probe of them or all, least at the least, and the times 99 % of it without a break;
    null if no place or several do. pairs: key, a, b, arrays of times of a pair of recordings; one pair is one row.
    """
    import numpy as np

    kind = dict(pairs.dtypes)[key]

    def run(batches):
        for pdf in batches:
            out = []
            for k, a, b in zip(pdf[key], pdf["a"], pdf["b"]):
                a, b = np.asarray(a, float), np.asarray(b, float)
                x, y = np.diff(a), np.diff(b)
                fits = []
                for s in range(-(len(a) - least) + 1, len(b) - least):
                    i, j = max(0, -s), max(0, s)
                    n = min(probe, len(x) - i, len(y) - j)
                    if n < least or np.any(np.abs(x[i : i + n] - y[j : j + n]) > tolerance):
                        continue
                    m = min(len(a) - i, len(b) - j)
                    bad = np.flatnonzero(np.abs((a[i : i + m] - a[i]) - (b[j : j + m] - b[j])) > tolerance)
                    good = int(bad[0]) if len(bad) else m
                    if good >= 0.99 * m:
                        fits.append((s, good - 1))
                out.append((k, *fits[0]) if len(fits) == 1 else (k, None, None))
            yield pd.DataFrame(out, columns=[key, "offset", "prefix"]).astype({"offset": "Int64", "prefix": "Int64"})

    return pairs.select(key, "a", "b").mapInPandas(run, f"{key} {kind}, offset long, prefix long")


def paid_matches(paid: DataFrame, nodes: DataFrame, tolerance: int = 100) -> DataFrame:
    """root, whole: whether every piece that was paid is still delivered with the same length, within tolerance."""
    n = nodes.select("session_id", F.col("state").alias("_s"), F.col("cents").alias("_c"))
    ok = F.coalesce((F.col("_s") == "DELIVERED") & (F.abs(F.col("_c") - F.col("cents")) <= tolerance), F.lit(False))
    return paid.join(n, "session_id", "left").groupBy("root").agg(F.bool_and(ok).alias("whole"))


def retained(backups: DataFrame, keep: int) -> DataFrame:
    return backups.orderBy(F.desc("day")).limit(keep)


def reclaimable(state: Column, age_h: Column) -> Column:
    """Whether a session's working files can go."""
    return F.when(state.isin("DELIVERED", "SPLIT", "DUPLICATE"), True).when(state == "QUARANTINED", age_h >= 48).when(state == "DISCOVERED", age_h >= 12).otherwise(False)


def lane(states: Column) -> Column:
    """Where a batch resumes: D if anything still downloads, else V if anything is under validation or repair, else U."""
    has = lambda *s: F.arrays_overlap(states, F.array(*[F.lit(x) for x in s]))
    return F.when(has("DISCOVERED", "DOWNLOADING"), "D").when(has("INGESTED", "VALIDATING", "HOLD_VLM", "FIX_QUEUED", "FIXING", "REVALIDATING"), "V").otherwise("U")


def shifted_metadata(started: Column, head_s: Column, duration_s: Column) -> dict[str, Column]:
    """created and ended instants of a trimmed recording, with microseconds."""
    created = F.timestamp_micros(F.unix_micros(started) + F.rint(head_s * 1e6).cast("bigint"))
    ended = F.timestamp_micros(F.unix_micros(created) + F.rint(duration_s * 1e6).cast("bigint"))
    text = lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return {"created_at_utc": text(created), "ended_at_utc": text(ended)}


def digest_line(hours: Column, sessions: Column, rejected: Column, labels: Column) -> Column:
    return F.concat(F.format_string("%.1f h from %d sessions", hours, sessions), F.when(rejected > 0, F.concat(F.format_string(", %d rejected (", rejected), labels, F.lit(")"))).otherwise(""))
