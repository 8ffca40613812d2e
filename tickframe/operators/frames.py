"""Events onto video frames: binning, held state, cuts, rows of frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickframe.functions import tables as T
from tickframe.operators.patterns import as_of, next_of


def frame_uniform(t: Column, frame_us: int) -> Column:
    """The frame of an instant on a clock without gaps; instants before 0 belong to frame 0."""
    return F.greatest(F.floor(t / F.lit(frame_us)), F.lit(0)).cast("bigint")


def frame_nominal(t: Column, fps: float, frames: Column) -> Column:
    """The frame at a fixed rate; the last frame takes what comes after."""
    return F.least(F.floor(t * F.lit(fps) / 1e6), frames - 1).cast("bigint")


def bin_as_of(events: DataFrame, clock: DataFrame, keys: list[str]) -> DataFrame:
    """events with frame_id, the last frame whose pts_us is at or before t; 0 before the first frame."""
    found = as_of(events, clock, keys, "t", "pts_us", "frame_id")
    return found.withColumn("frame_id", F.coalesce("frame_id", F.lit(0)).cast("bigint"))


def bin_forward(events: DataFrame, clock: DataFrame, keys: list[str]) -> DataFrame:
    """events with frame_id, the first frame whose pts_us is at or after t; null after the last."""
    return next_of(events, clock, keys, "t", "pts_us", "frame_id")


def held_spans(events: DataFrame, keys: list[str], last_frame: str) -> DataFrame:
    """keys, token, f0, f1: frames in which a token shows. events: frame_id, t, seq, token, down, last_frame.

    A press holds its token from its frame to that of the next release, or to the last frame; a release without a press
    shows in its own frame; a press and release within one frame show in it.
    """
    w = Window.partitionBy(*keys, "token").orderBy("t", "seq")
    before = F.coalesce(F.lag("down").over(w), F.lit(False))
    until = F.min(F.when(~F.col("down"), F.col("frame_id"))).over(w.rowsBetween(1, Window.unboundedFollowing))
    marked = events.withColumn("_before", before).withColumn("_until", F.coalesce(until, F.col(last_frame)))
    press = marked.filter("down and not _before").select(*keys, "token", F.col("frame_id").alias("f0"), F.col("_until").alias("f1"))
    stray = marked.filter("not down").select(*keys, "token", F.col("frame_id").alias("f0"), F.col("frame_id").alias("f1"))
    return press.unionByName(stray)


def shown_frames(events: DataFrame, keys: list[str], last_frame: str) -> DataFrame:
    """keys, frame_id, token; a token shows more than once in a frame where presses end and begin."""
    spans = held_spans(events, keys, last_frame).filter("f1 >= f0")
    return spans.select(*keys, "token", F.explode(F.sequence("f0", "f1")).alias("frame_id"))


def held_frames(events: DataFrame, keys: list[str], last_frame: str) -> DataFrame:
    """keys, frame_id, token: distinct."""
    return shown_frames(events, keys, last_frame).distinct()


def joined_frames(shown: DataFrame, motion: DataFrame, keys: list[str]) -> DataFrame:
    """keys, frame_id, held (sorted tokens), dx, dy of frames that hold anything or move, by one aggregate over both sides.

    motion: keys, frame_id, dx, dy, one row an event or any partial sums of them.
    """
    none = F.lit(None)
    left = shown.select(*keys, "frame_id", "token", none.cast("bigint").alias("dx"), none.cast("bigint").alias("dy"))
    right = motion.select(*keys, "frame_id", none.cast("string").alias("token"), F.col("dx").cast("bigint"), F.col("dy").cast("bigint"))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return left.union(right).groupBy(*keys, "frame_id").agg(F.array_sort(F.collect_set("token")).alias("held"), zero("dx"), zero("dy"))


def carry_over_cut(events: DataFrame, keys: list[str], head_us: int, length_us: int) -> DataFrame:
    """Events of [head, head + length) on the cut's own clock, after a synthetic press at 0 of each token held at the head."""
    before = events.filter(F.col("t") < head_us).groupBy(*keys, "token").agg(F.max_by("down", F.struct("t", "seq")).alias("down"))
    carried = before.filter("down").select(*keys, F.lit(0).cast("bigint").alias("t"), F.lit(-1).cast("bigint").alias("seq"), "token", "down")
    kept = events.filter((F.col("t") >= head_us) & (F.col("t") < head_us + length_us))
    return carried.unionByName(kept.select(*keys, (F.col("t") - head_us).alias("t"), "seq", "token", "down"))


def without_bleed(held: Column, bound: Column) -> Column:
    """Held tokens with one side of each left-and-right pair of modifiers: the bound side, else the left."""
    out = held
    for left, right in T.MODIFIER_PAIRS:
        both = F.array_contains(out, left) & F.array_contains(out, right)
        keep_right = F.array_contains(bound, right) & ~F.array_contains(bound, left)
        out = F.when(both & keep_right, F.array_remove(out, left)).when(both, F.array_remove(out, right)).otherwise(out)
    return out


def bled(held: Column) -> Column:
    out = F.lit(False)
    for left, right in T.MODIFIER_PAIRS:
        out = out | (F.array_contains(held, left) & F.array_contains(held, right))
    return out


def compile_rules(keybind: dict) -> list[tuple[str, str | None, list[list[str]]]]:
    """(semantic, motion axis, groups) in order: all groups must hold, a group holds if any of its tokens does."""
    axes = {"mouse": "any", "mouse_x": "x", "mouse_y": "y"}

    def norm(raw) -> str:
        s = raw.strip().lower() if isinstance(raw, str) else ""
        return T.LITERAL_ALIASES.get(s, s)

    def groups(value):
        if isinstance(value, list):
            for item in value:
                yield from groups(item)
            return
        combo = value if isinstance(value, dict) else {"key": value}
        if "key" in combo and not norm(combo["key"]):
            return  # a binding whose key is nothing binds nothing
        key = norm(combo.get("key"))
        if key in axes:
            yield axes[key], []
            return
        tokens = [t for t in (norm(combo.get("modifier")), key) if t]
        if tokens:
            yield None, [T.MODIFIER_ALTERNATES.get(t, [t]) for t in tokens]

    return [(semantic, axis, g) for semantic, value in keybind.items() for axis, g in groups(value)]


def bound_tokens(keybind: dict) -> list[str]:
    return sorted({t for _, _, groups in compile_rules(keybind) for g in groups for t in g})


def resolve(held: Column, dx: Column, dy: Column, rules, context: Column | None = None, allowed: dict[str, list[str]] | None = None) -> tuple[Column, Column, Column]:
    """(actions in rule order, dead tokens, credited tokens) of a frame: rules are compiled into the expression."""
    fired, credited, blocked = [], [], []
    for semantic, axis, groups in rules:
        if axis:
            ok, used = {"x": dx, "y": dy, "any": dx | dy}[axis], F.array().cast("array<string>")
        else:
            ok = F.lit(bool(groups))
            for g in groups:
                ok = ok & F.arrays_overlap(held, F.array(*[F.lit(t) for t in g]))
            used = F.array_intersect(held, F.array(*[F.lit(t) for t in dict.fromkeys(t for g in groups for t in g)]))
        live = F.lit(True)
        if context is not None and allowed and semantic in allowed:
            live = context.isNull() | context.isin(allowed[semantic])
        none = F.array().cast("array<string>")
        fired.append(F.when(ok & live, F.array(F.lit(semantic))).otherwise(none))
        credited.append(F.when(ok & live, used).otherwise(none))
        blocked.append(F.when(ok & ~live, used).otherwise(none))
    joined = [F.array_distinct(F.concat(*x)) for x in (fired, credited, blocked)]
    return joined[0], F.array_except(joined[2], joined[1]), joined[1]


def collapse_pair(frames: DataFrame, keys: list[str], tap: str, hold: str, fps: float, tap_s: float = 0.3) -> DataFrame:
    """frames (frame_id, actions) where runs with both actions keep one: tap if shorter than tap_s, else hold."""
    both = F.array_contains("actions", tap) & F.array_contains("actions", hold)
    w = Window.partitionBy(*keys).orderBy("frame_id")
    marked = frames.withColumn("_both", both)
    marked = marked.withColumn("_new", F.when(F.col("_both") & ~(F.coalesce(F.lag("_both").over(w), F.lit(False))), 1).otherwise(0))
    marked = marked.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    size = F.sum(F.col("_both").cast("int")).over(Window.partitionBy(*keys, "_run"))
    drop = F.when(size < tap_s * fps, F.lit(hold)).otherwise(F.lit(tap))
    return marked.withColumn("_drop", drop).withColumn("actions", F.when(F.col("_both"), F.array_except("actions", F.array("_drop"))).otherwise(F.col("actions"))).drop("_both", "_new", "_run", "_drop")


def binary_close(track: DataFrame, keys: list[str], order: str, flag: str, gap: int) -> DataFrame:
    """Runs of zeros of at most gap between ones become ones."""
    return _flip(track, keys, order, flag, 0, gap, inner=True)


def binary_open(track: DataFrame, keys: list[str], order: str, flag: str, least: int) -> DataFrame:
    """Runs of ones shorter than least become zeros."""
    return _flip(track, keys, order, flag, 1, least - 1, inner=False)


def _flip(track, keys, order, flag, value, longest, inner):
    w = Window.partitionBy(*keys).orderBy(order)
    now = track.withColumn("_new", F.when(F.lag(flag).over(w) == F.col(flag), 0).otherwise(1))
    now = now.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    now = now.withColumn("_size", F.count("*").over(Window.partitionBy(*keys, "_run"))).withColumn("_last", F.max("_run").over(Window.partitionBy(*keys)))
    flip = (F.col(flag) == value) & (F.col("_size") <= longest)
    if inner:
        flip = flip & (F.col("_run") > 1) & (F.col("_run") < F.col("_last"))
    return now.withColumn(flag, F.when(flip, 1 - F.col(flag)).otherwise(F.col(flag))).drop("_new", "_run", "_size", "_last")


def shift_rows(rows: DataFrame, keys: list[str], order: str, columns: list[str], k: int, empty) -> DataFrame:
    """Columns moved k rows later (earlier if negative); empty at the edges."""
    w = Window.partitionBy(*keys).orderBy(order)
    return rows.withColumns({c: F.lag(c, k, empty).over(w) for c in columns})


def gate(rows: DataFrame, windows: DataFrame, keys: list[str], pad: int = T.GATE_PAD) -> DataFrame:
    """rows with gated: whether a row lies in a window (ts within, ends included) or at most pad rows beside one that does.

    Windows are merged and looked up as of their start, so no pair of rows and windows is formed.
    """
    from tickframe.operators.patterns import merged

    one = merged(windows, keys)
    looked = as_of(rows, one.withColumn("_end", F.col("t1")), keys, "ts", "t0", "_end")
    w = Window.partitionBy(*keys).orderBy("frame_id").rowsBetween(-pad, pad)
    inside = (F.col("ts") <= F.col("_end")).cast("int")
    return looked.withColumn("_in", F.coalesce(inside, F.lit(0))).withColumn("gated", F.max("_in").over(w) == 1).drop("_in", "_end")
