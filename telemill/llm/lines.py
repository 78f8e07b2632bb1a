"""Repeated lines: windows of three consecutive lines that occur again are taken out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from telemill.llm.shared import pick, staged, temporary, whole

WINDOW = 3


def repeated_positions(rows: DataFrame) -> DataFrame:
    """Per row with repeated windows: ``row`` and ``removed``, the sorted positions of the lines
    (from 0) that a later occurrence of a window covers. ``rows``: ``row``, ``key``, ``text``.

    A window is three consecutive lines. Its first occurrence is the one of the smallest key, row
    and position and stays; the lines of every later one go. Only windows that occur more than
    once leave the counting, one row each, and are joined to the occurrences.
    """
    lines = pick(rows, key=F.col("key"), row=F.col("row"), lines=F.split(whole("text"), "\n", -1)).where(F.size("lines") >= WINDOW)
    windows = lines.select(
        "key",
        "row",
        F.posexplode(
            F.transform(
                F.sequence(F.lit(1), F.size("lines") - (WINDOW - 1)),
                lambda i: F.unhex(F.md5(F.array_join(F.slice("lines", i, WINDOW), "\n"))),
            )
        ).alias("position", "window"),
    )
    windows = staged(windows, "windows")
    first = windows.groupBy("window").agg(
        F.min(F.struct("key", "row", "position")).alias("first"), F.count("*").alias("times")
    )
    first = staged(first.where("times > 1").select("window", "first"), "repeated")
    later = windows.join(first, "window").where(
        ~((F.col("row") == F.col("first.row")) & (F.col("position") == F.col("first.position")))
    )
    # The starts of a row are collected and their windows merged; both are bounded by its lines.
    starts = later.groupBy("row").agg(F.collect_set("position").alias("starts"))
    covered = F.flatten(F.transform("starts", lambda p: F.sequence(p, p + (WINDOW - 1))))
    return starts.select("row", F.sort_array(F.array_distinct(covered)).alias("removed"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, and ``n_lines``, ``n_removed`` added
    (a column of ``docs`` named like one of the two is replaced).

    Lines end at a line feed. A text of fewer than three lines has no window and stays as it is,
    so does a null one, which has 0 lines. The lines that stay are joined again by line feeds.
    A null key is the smallest. Rows that repeat a key are documents of their own, in the order
    of the numbers they get in a staged copy. Every line that goes stays somewhere: the first
    occurrence of its window is smaller, and the smallest window holding a line is never a later one.
    """
    row, removed, lines = temporary(), temporary(), F.split(F.col(text), "\n", -1)
    # Written with its number once: read again, a row has the same one.
    docs = staged(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = repeated_positions(pick(docs, row=F.col(row), key=F.col(key), text=F.col(text)))
    found = staged(found.select(F.col("row").alias(f"{removed}k"), F.col("removed").alias(removed)), "removed")
    joined = docs.join(found, docs[row] == found[f"{removed}k"], "left")
    gone = F.when(F.col(removed).isNull(), 0).otherwise(F.size(removed))
    kept = F.filter(lines, lambda _, i: ~F.array_contains(F.col(removed), i))
    return (
        joined.withColumn("n_lines", F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)))
        .withColumn("n_removed", gone)
        .withColumn(text, F.when(F.col(removed).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")))
        .drop(removed, f"{removed}k", row)
    )
