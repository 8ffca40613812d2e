"""Single cells and texts of delivered files and ledger rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Seconds of footage a byte, a day's volume, GB of an hour of footage, share by which an upload grows.
GB_AN_HOUR, GROWTH, GB = 3.13, 1.25, 1024**3


def id_slug(sid: Column) -> Column:
    """The game's part of a session id: between Z_ and the closing _c_ with hexadecimal digits; empty if there is none."""
    return F.coalesce(F.regexp_extract(sid, r"Z_(.+?)_c_[0-9a-f]+$", 1), F.lit(""))


def safe_component(sid: Column, folder: Column) -> Column:
    """sid if it can be one component of a path (200 bytes at most, no separator, no .., no control character), else folder."""
    fine = (F.length(sid) > 0) & (sid != ".") & ~sid.contains("/") & ~sid.contains("\\") & ~sid.contains("..") & ~sid.rlike(r"[\x00-\x1f]") & (F.octet_length(sid) <= 200)
    return F.when(fine, sid).otherwise(folder)


def breadcrumb(detail: Column) -> Column:
    """What follows the last prev_md5= in an audit detail; empty if there is none."""
    return F.when(detail.contains("prev_md5="), F.trim(F.substring_index(detail, "prev_md5=", -1))).otherwise("")


def told_lag_ms(message: Column) -> Column:
    return F.regexp_extract(message, r"video (\d+(?:\.\d+)?)ms", 1).try_cast("double")


def told_correlation(message: Column) -> Column:
    return F.regexp_extract(message, r"\|corr\|=(\d+(?:\.\d+)?)", 1).try_cast("double")


def without_log_times(text: Column) -> Column:
    """Lines without their leading date and time."""
    return F.regexp_replace(text, r"(?m)^\d{4}/\d{2}/\d{2} \d{2}:\d{2}:\d{2} ", "")


def moving(cell: Column) -> Column:
    """Whether a motion cell holds a number other than zero; junk does not move."""
    return F.coalesce(cell.try_cast("double"), F.lit(0.0)) != 0


def pixels(cell: Column, fallback: Column) -> Column:
    """A screen size, from text; the fallback where it is not a positive number."""
    n = cell.try_cast("double").cast("bigint")
    return F.when(n > 0, n).otherwise(fallback)


def lag_ms(frames: Column, fps: Column) -> Column:
    return F.when(fps != 0, frames / fps * 1000.0).otherwise(0.0)


def axis_signs(maps_to: Column, dx_positive: Column, dy_positive: Column) -> tuple[Column, Column]:
    """Signs of the two mouse axes: only a mouse that turns the view is ever flipped."""
    sign = lambda c, flipped: F.when((maps_to == "camera_look_velocity") & (c == flipped), -1.0).otherwise(1.0)
    return sign(dx_positive, "left"), sign(dy_positive, "up")


def input_track(cell: Column, sign: Column) -> Column:
    """A motion cell as a signed number; blanks and junk are no motion."""
    return F.coalesce(cell.try_cast("double"), F.lit(0.0)) * sign


def seconds_or_estimate(seconds: Column, size: Column, bytes_a_second: float) -> Column:
    return F.coalesce(seconds, size / bytes_a_second)


def upload_gb(size: Column, delivered_s: Column) -> Column:
    """Upload volume: 1.25 times the bytes if they are known, else by hours of footage."""
    return F.when(size != 0, size * GROWTH / GB).otherwise(F.coalesce(delivered_s, F.lit(0.0)) / 3600 * GB_AN_HOUR)


def data_quality(keyboard: Column, motion: Column, buttons: Column, bleed_frames: Column) -> Column:
    told = lambda c: F.when(c, "ok").otherwise("missing")
    return F.struct(told(keyboard).alias("keyboard_capture"), told(motion).alias("mouse_capture"), told(buttons).alias("mouse_buttons"), bleed_frames.alias("input_bleed_frames"))


def sync_text(shift_ms: Column, lag_was: Column, residual: Column, status: Column) -> Column:
    """How a session's input and video agree, in words."""
    corrected = F.format_string("corrected %+.1fms (was %+.1fms, residual %+.1fms)", shift_ms, lag_was, residual)
    return F.when(shift_ms != 0, corrected).when(status == "PASS", "ok").otherwise("unverified")


def sweep_times(duration: Column, interval: float) -> Column:
    """Times at which a recording is sampled: 0.3 s, then every interval up to 0.6 s before the end, and 0.5 s before it; a day at most."""
    end = F.least(F.coalesce(duration, F.lit(0.0)), F.lit(86400.0))
    n = F.ceil((end - 0.6 - 2.0) / interval).cast("int")
    inner = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: 2.0 + i * interval)).otherwise(F.array().cast("array<double>"))
    return F.concat(F.array(F.lit(0.3)), inner, F.array(F.greatest(end - 0.5, F.lit(0.3))))


def even_subsample(values: Column, most: int) -> Column:
    """At most so many of an array's values, at an even stride."""
    stride = F.greatest(F.ceil(F.size(values) / most).cast("int"), F.lit(1))
    return F.filter(values, lambda _, i: F.pmod(i, stride) == 0)


def stillness(probes: Column, baseline_probes: Column) -> Column:
    """Mean motion of some probes against that of the first six baseline probes; null where the baseline hardly moves."""
    mean = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / F.size(a)
    known = lambda a: F.filter(a, lambda x: x.isNotNull())
    some, base = known(probes), known(F.slice(baseline_probes, 1, 6))
    return F.when((F.size(some) > 0) & (F.size(base) > 0) & (mean(base) >= 0.5), F.round(mean(some) / mean(base), 2))


def motion_baseline(at_gameplay: Column, all_motion: Column) -> Column:
    """Mean motion at the first 12 gameplay times that have one, else the value three quarters up all motion, else 0."""
    known = F.filter(F.slice(at_gameplay, 1, 12), lambda x: x.isNotNull())
    mean = F.aggregate(known, F.lit(0.0), lambda s, x: s + x) / F.size(known)
    upper = F.element_at(F.array_sort(all_motion), (F.floor(F.size(all_motion) * 0.75) + 1).cast("int"))
    return F.when(F.size(known) > 0, mean).when(F.size(all_motion) > 0, upper).otherwise(0.0)
