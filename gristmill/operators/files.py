"""Operators on whole files: content dedup, auxiliary files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Marks of files that other steps leave.
AUXILIARY = ("_clean", "_valid", ".part", ".bak", ".swp")


def content_dedup(files: DataFrame, name: str, content: str, key: str) -> DataFrame:
    """Adds kept and group_size: of files with the same content the one with the shortest, then first name stays.

    A partial aggregate by size and digest carries only the best name, so that many copies are no hot group.
    """
    raw = F.col(content).cast("binary")
    rows = files.withColumns({"_size": F.octet_length(raw), "_digest": F.sha2(raw, 256)}).drop(content)
    best = rows.groupBy("_size", "_digest").agg(F.min(F.struct(F.length(name), F.col(name), F.col(key))).alias("_best"), F.count(F.lit(1)).alias("group_size"))
    joined = rows.join(best, ["_size", "_digest"])
    return joined.withColumn("kept", F.col("_best")[key] == F.col(key)).withColumnRenamed("_digest", "digest").drop("_best", "_size")


def auxiliary(files: DataFrame, name: str) -> DataFrame:
    """Adds purge: whether a name says that the file is left over."""
    pattern = "|".join(x.replace(".", "[.]") for x in AUXILIARY)
    return files.withColumn("purge", F.lower(name).rlike(pattern))


def ranked(files: DataFrame, name: str) -> DataFrame:
    """Adds file_rank: the order of files by name in small letters, ties by the name itself. One row per file."""
    return files.withColumn("file_rank", F.row_number().over(Window.orderBy(F.lower(name), name)))
