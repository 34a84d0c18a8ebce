"""Line dedup by overlapping windows of three lines.

Every three consecutive lines are hashed (128 bits). A window found more than once anywhere keeps its first
occurrence, by (doc_id, text hash, position); the lines under all later occurrences are removed, overlapping ones
merged. Only DataFrame functions are used; counting combines in the tasks and only windows that repeat are joined back.

Defined cases: a null text stays null; a text of fewer than three lines has no window; a window of blank lines does not
count; rows that repeat both doc_id and text are one document and are treated alike; an empty table gives no rows;
other columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import saved

SIZE = 3


def _windows(lines: Column) -> Column:
    def window(i: Column) -> Column:
        part = [F.get(lines, i + k) for k in range(SIZE)]
        return F.struct(
            i.alias("at"),
            F.xxhash64(*part).alias("h1"),
            F.xxhash64(F.lit(SIZE), *part[::-1]).alias("h2"),
            (F.trim(F.concat(*part)) != "").alias("solid"),
        )

    some = F.transform(F.sequence(F.lit(0), F.size(lines) - SIZE), window)
    return F.filter(F.when(F.size(lines) >= SIZE, some), lambda w: w["solid"])


def repeated(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, text_hash, starts``: where later occurrences of windows start in each document that has one."""
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.split(text, "\n").alias("lines"))
    windows = rows.select("doc_id", "text_hash", F.explode(_windows(F.col("lines"))).alias("w"))
    windows = saved(windows.select("doc_id", "text_hash", "w.at", "w.h1", "w.h2"), "windows")
    place = F.struct("doc_id", "text_hash", "at")
    first = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = windows.join(saved(first, "first"), ["h1", "h2"]).where(~place.eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "text_hash").agg(F.collect_set("at").alias("starts"))


def dedup_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with later occurrences removed from ``text``, and ``n_lines``, ``n_removed`` (of the text as it was)."""
    cuts = repeated(docs, text).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "starts")
    spare = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    rows = docs.select(*spare).withColumn("__text_hash", F.xxhash64(text))
    rows = rows.join(cuts, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__hash")), "left")
    rows = rows.withColumn("__lines", F.split(text, "\n"))
    covered = F.flatten(F.transform("starts", lambda s: F.sequence(s, s + SIZE - 1)))
    left = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), covered)
    kept = F.transform(left, lambda i: F.get("__lines", i))
    rows = rows.withColumn("__kept", F.when(F.col("starts").isNull(), F.col("__lines")).otherwise(kept))
    n_lines = F.coalesce(F.when(F.col(text).isNotNull(), F.size("__lines")), F.lit(0))
    n_removed = F.coalesce(F.when(F.col("starts").isNotNull(), F.size("__lines") - F.size("__kept")), F.lit(0))
    changed = F.when(F.col("starts").isNull(), F.col(text)).otherwise(F.array_join("__kept", "\n"))
    return rows.select(*[changed.alias(text) if c == text else c for c in spare], n_lines.alias("n_lines"), n_removed.alias("n_removed"))
