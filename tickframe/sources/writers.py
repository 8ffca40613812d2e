"""Sinks: delivery files, keyed stores, audit log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.operators import patterns
from tickframe.sources.readers import FRAME_COLUMNS


def delivered_frames(rows: DataFrame) -> DataFrame:
    """Rows with lists and numbers as the delivery's text cells: lists joined, dx and dy with one decimal, blanks for what is missing."""
    have = set(rows.columns)
    cells = {}
    for c in FRAME_COLUMNS:
        if c not in have:
            cells[c] = F.lit("")
        elif c in ("input_keys", "input_actions", "input_mouse_buttons"):
            cells[c] = F.array_join(c, "|")
        elif c in ("input_mouse_dx", "input_mouse_dy"):
            cells[c] = F.coalesce(F.format_string("%.1f", F.col(c).cast("double")), F.lit("")) if c in have else F.lit("")
            cells[c] = F.when(F.col(c).isNull(), "").otherwise(cells[c])
        else:
            cells[c] = F.coalesce(F.col(c).cast("string"), F.lit(""))
    return rows.select(*[c for c in rows.columns if c == "session_id"], *[cells[c].alias(c) for c in FRAME_COLUMNS])


def write_frames(rows: DataFrame, path: str) -> None:
    """One folder a session, rows in frame order; sessions are spread, never gathered in one task."""
    out = delivered_frames(rows).repartition("session_id").sortWithinPartitions("session_id", F.col("frame_id").cast("bigint"))
    out.write.mode("overwrite").option("header", True).partitionBy("session_id").csv(path)


def write_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def write_sheet(rows: DataFrame, path: str) -> None:
    """A report, small by its nature: one CSV file."""
    rows.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def markdown(rows: DataFrame, columns: list[str]) -> DataFrame:
    """line: the rows as a Markdown table, one line a row, after its head."""
    spark = rows.sparkSession
    head = spark.createDataFrame([(0, "| " + " | ".join(columns) + " |"), (1, "|" + "---|" * len(columns))], "at int, line string")
    cells = [F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")) for c in columns]
    body = rows.select(F.lit(2).alias("at"), F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))
    return head.unionByName(body)


def append_audit(moves: DataFrame, path: str) -> None:
    moves.write.mode("append").parquet(path)


def snapshot(audit: DataFrame) -> DataFrame:
    """The latest state of every session from its moves."""
    return patterns.latest(audit, ["session_id"], ["ts", "id"])


def delivery_gaps(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """expected and actual by key with status: ok, missing, extra or different (size or md5)."""
    e = expected.select(*keys, F.struct("size", "md5").alias("e"))
    a = actual.select(*keys, F.struct("size", "md5").alias("a"))
    status = F.when(F.col("a").isNull(), "missing").when(F.col("e").isNull(), "extra").when((F.col("a.size") == F.col("e.size")) & (F.col("a.md5") == F.col("e.md5")) & (F.col("e.md5") != ""), "ok").otherwise("different")
    return e.join(a, keys, "full_outer").select(*keys, status.alias("status"))
