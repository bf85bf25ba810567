"""Cleaning of raw lines: white space, comments, inline comments; and its counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions import text


def disposition(lines: DataFrame, column: str = "raw") -> DataFrame:
    """Adds cleaned (null if dropped), trimmed, and dropped: empty, comment, empty_after_strip or null."""
    raw = F.rtrim(F.coalesce(F.col(column), F.lit("")), F.lit("\r\n"))
    rows = lines.withColumn("_raw", raw).withColumn("_trimmed", text.strip(F.col("_raw")))
    rows = rows.withColumn("_cleaned", text.without_inline_comment(F.col("_trimmed")))
    dropped = F.when(F.col("_trimmed") == "", "empty").when(text.is_comment(F.col("_trimmed")), "comment").when(text.strip(F.col("_cleaned")) == "", "empty_after_strip")
    rows = rows.withColumn("trimmed", F.col("_trimmed") != F.col("_raw")).withColumn("dropped", dropped)
    return rows.withColumn("cleaned", F.when(F.col("dropped").isNull(), F.col("_cleaned"))).drop("_raw", "_trimmed", "_cleaned")


def clean(lines: DataFrame, column: str = "raw") -> DataFrame:
    """The lines that stay, with the cleaned text in the column."""
    return disposition(lines, column).where("dropped is null").withColumn(column, F.col("cleaned")).drop("cleaned", "trimmed", "dropped")


def counters(disposed: DataFrame, by: str) -> DataFrame:
    """Per file: lines_in, lines_out, trimmed, dropped_comments, dropped_empty."""
    return disposed.groupBy(by).agg(
        F.count(F.lit(1)).alias("lines_in"),
        F.count_if(F.col("dropped").isNull()).alias("lines_out"),
        F.count_if("trimmed").alias("trimmed"),
        F.count_if(F.col("dropped") == "comment").alias("dropped_comments"),
        F.count_if(F.col("dropped").isin("empty", "empty_after_strip")).alias("dropped_empty"),
    )


def summed(counted: DataFrame, but: str) -> DataFrame:
    """Counters over all files, missing ones as zero."""
    return counted.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counted.columns if c != but))
