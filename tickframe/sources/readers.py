"""Readers: permissive for what others wrote, strict where a schema is promised."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FRAME_COLUMNS = [
    "frame_id", "timestamp_ms", *[f"c2w_m{r}{c}" for r in range(4) for c in range(4)], "camera_model", "camera_fx", "camera_fy", "camera_cx", "camera_cy",
    *[f"camera_radial_k{i}" for i in range(1, 7)], "camera_tangential_p1", "camera_tangential_p2", "input_keys", "input_actions", "input_mouse_buttons", "input_mouse_dx", "input_mouse_dy",
]
LISTING = "Path string, Name string, IsDir boolean, Size bigint, ModTime string, Hashes struct<md5:string>"


def parse_event_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Events of JSON lines, with t, type, key, button, action, dx, dy. Lines that are no object, or whose t is no whole number, are dropped.

    true and false count as the whole numbers 1 and 0. Fields of other kinds than expected become null or text.
    """
    rows = lines.withColumn("_v", F.try_parse_json(F.col(column))).withColumn("_k", F.schema_of_variant(F.col("_v")))
    rows = rows.filter(F.col("_v").isNotNull() & F.col("_k").startswith("OBJECT"))
    rows = rows.withColumn("t", F.try_variant_get("_v", "$.t", "bigint")).withColumn("_tk", F.schema_of_variant(F.try_variant_get("_v", "$.t", "variant")))
    text = {c: F.try_variant_get("_v", f"$.{c}", "string") for c in ("type", "key", "button", "action", "dx", "dy")}
    return rows.filter(F.col("t").isNotNull() & F.col("_tk").isin("BIGINT", "BOOLEAN")).withColumns(text).drop("_v", "_k", "_tk")


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Event files; session_id is the folder's name, seq the order in the file."""
    raw = spark.read.text(path, wholetext=True).withColumn("path", F.col("_metadata.file_path"))
    lines = raw.select("path", F.posexplode(F.split("value", "\r?\n")).alias("seq", "value")).filter(F.trim("value") != "")
    out = parse_event_lines(lines)
    return out.withColumn("session_id", F.element_at(F.split("path", "/"), -2)).drop("value")


def read_events_strict(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    """frames.csv as text columns, with session_id and ragged (a row without all its cells)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*FRAME_COLUMNS, "_corrupt"]])
    rows = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").csv(path)
    return rows.withColumn("session_id", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)).withColumn("ragged", F.col("_corrupt").isNotNull()).drop("_corrupt")


def numeric_frames(frames: DataFrame, columns: list[str]) -> DataFrame:
    """Columns as numbers; blanks and words as NaN."""
    return frames.withColumns({c: F.coalesce(F.col(c).try_cast("double"), F.lit(float("nan"))) for c in columns})


def list_cell(cell) -> F.Column:
    return F.filter(F.split(F.coalesce(cell, F.lit("")), r"\|"), lambda x: x != "")


def read_json_objects(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object a file, with problem: why it is none."""
    fields = f"{schema}, _corrupt string"
    rows = spark.read.schema(fields).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return rows.withColumn("problem", F.when(F.col("_corrupt").isNotNull(), "unreadable")).drop("_corrupt")


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LISTING).option("multiLine", True).json(path)


def sessions_of_listing(files: DataFrame, mail: str = r"^[^@/\s]+@[^@/\s]+\.[^@/\s]+$") -> DataFrame:
    """One row a folder game/operator/player/session: its files, least time, total size; ok: depth and addresses are right."""
    parts = F.split("Path", "/")
    rows = files.filter("not IsDir").withColumn("folder", F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/"))
    out = rows.groupBy("folder").agg(F.sort_array(F.collect_set("Name")).alias("files"), F.min("ModTime").alias("ctime"), F.sum("Size").alias("bytes"), F.max_by("Hashes.md5", "Size").alias("md5"))
    at = F.split("folder", "/")
    names = {n: F.when(F.size(at) == 4, F.element_at(at, i + 1)) for i, n in enumerate(("game", "operator", "player", "session_id"))}
    out = out.withColumns(names)
    return out.withColumn("ok", (F.size(at) == 4) & F.coalesce(F.col("operator").rlike(mail) & F.col("player").rlike(mail), F.lit(False)))


def payload_kind(files: F.Column, metadata: F.Column | None = None) -> F.Column:
    """v2, v1, raw or garbage, from the names in a folder and the text of its session.json (None: taken to be fine, without a canonical part)."""
    has = lambda n: F.array_contains(files, n)
    delivered = has("frames.csv") & has("session.json")
    raw = has("video.mp4") & has("inputs.jsonl") & has("metadata.json")
    kind = F.lit("v2")
    if metadata is not None:
        read = F.try_parse_json(metadata)
        kind = F.when(read.isNull(), "garbage").when(F.try_variant_get(read, "$.canonical", "variant").isNotNull(), "v1").otherwise("v2")
    return F.when(delivered & has("key_binding.json"), "v1").when(delivered, kind).when(raw, "raw").otherwise("garbage")


def detected_format(files: F.Column) -> F.Column:
    """raw, v1, v2 or unknown; raw files come first here."""
    has = lambda n: F.array_contains(files, n)
    return F.when(has("inputs.jsonl"), "raw").when(has("key_binding.json"), "v1").when(has("frames.csv"), "v2").otherwise("unknown")


def paired(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """Files 'X - Inputs (n).jsonl' with 'X - KeyBind.json' by X; inputs without a binding stay."""
    stem = lambda c: F.lower(F.trim(F.regexp_replace(c, r"(?i)\s*-\s*(inputs|keybind).*$", "")))
    return left.withColumn("stem", stem(F.col(left_name))).join(right.withColumn("stem", stem(F.col(right_name))), "stem", "left")


#: Patterns of folder names.
SESSION_ID = r"^\d{4}-\d{2}-\d{2}T\d{2}-\d{2}-\d{2}Z_[a-z0-9_]+_c_[0-9a-f]{16}$"
DATE_FOLDER = r"^\d{2}-\d{2}-\d{4}$"
COPY_SUFFIX = r"^(.*) \(\d+\)$"


def path_problem(path: F.Column, why: F.Column) -> F.Column:
    """The class of a quarantined path, by its depth, its folder names and the reason given."""
    parts = F.split(path, "/")
    n = F.size(parts)
    part = lambda i: F.coalesce(F.try_element_at(parts, F.lit(i)), F.lit(""))
    is_id = lambda c: c.rlike(SESSION_ID)
    copied = lambda c: F.regexp_extract(c, COPY_SUFFIX, 1).rlike(SESSION_ID)
    four, five = part(4), part(5)
    at_five = (
        F.when(four.rlike(DATE_FOLDER), "date folder between (depth 5)").when(is_id(four) & is_id(five), "session inside a session (depth 5)").when(is_id(four), "folder inside a session (depth 5)")
        .when(copied(four), "session inside a copied session (depth 5)").when(is_id(five), "folder between player and session (depth 5)").otherwise("other nesting (depth 5)")
    )
    at_four = (
        F.when(why.contains("is not an email"), "player folder is no e-mail (depth 4)").when(~why.contains("doesn't match the id pattern"), "other")
        .when(copied(four), "copied session (depth 4)").when(four.rlike("_c_[0-9a-f]{16}$"), "mangled session id (depth 4)").otherwise("junk session name (depth 4)")
    )
    return F.when(n == 3, "no player folder (depth 3)").when(n == 5, at_five).when(n > 5, F.concat(F.lit("too deep (depth "), n.cast("string"), F.lit(")"))).when(n == 4, at_four).otherwise(F.concat(F.lit("too shallow (depth "), n.cast("string"), F.lit(")")))


def found_sessions(files: DataFrame) -> DataFrame:
    """Folders with a video and a frame table beside it, from file rows (Path, Name)."""
    folder = F.regexp_replace("Path", "/[^/]+$", "").alias("folder")
    held = files.select(folder, "Name").filter(F.col("Name").isin("video.mp4", "frames.csv")).groupBy("folder").agg(F.count_distinct("Name").alias("n"))
    return held.filter("n = 2").select("folder")
