"""Rule files: listing, reading lines with exact numbers, and writing."""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import text
from gristmill.operators import files as file_operators
from gristmill.sources.shared import path_of, replace

BOM = "﻿"
TEXTS = "*.[tT][xX][tT]"


def _files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """path, name, length, modified and content of the files in a folder itself, not of those in folders below."""
    fs, at = path_of(spark, f"{folder}/{pattern}")
    there = [str(x.getPath()) for x in fs.globStatus(at) or () if x.isFile()]
    paths = [at.toString()] if there else None
    read = spark.read.format("binaryFile")
    found = read.load(paths) if paths else spark.createDataFrame([], "path string, modificationTime timestamp, length long, content binary")
    return found.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", F.col("modificationTime").alias("modified"), "content")


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """path, name, length, modified and rank of the *.txt files of a folder, whatever the case of the ending."""
    return file_operators.ranked(_files(spark, folder, TEXTS).drop("content"), "name")


def numbered(content: Column) -> Column:
    """Lines (line_no from 1, raw) of a text: cut at all three line ends, nothing after the last one."""
    cut = F.split(content, text.NEWLINE)
    cut = F.when(F.element_at(cut, -1) == "", F.slice(cut, F.lit(1), F.size(cut) - 1)).otherwise(cut)
    return F.transform(cut, lambda x, k: F.struct((k + 1).cast("long").alias("line_no"), x.alias("raw")))


def lines(spark: SparkSession, folder: str, keep_bom: bool = True, on_invalid: str = "error") -> DataFrame:
    """file, file_rank, line_no, raw of all rule files.

    Bytes are decoded here: invalid UTF-8 is an error or, with 'replace', U+FFFD. A byte order mark is kept for
    cleaning and validation, and dropped for merging.
    """
    found = _files(spark, folder, TEXTS)
    raw = F.col("content").cast("string")
    valid = F.is_valid_utf8(raw)
    decoded = F.make_valid_utf8(raw) if on_invalid == "replace" else F.when(valid, raw).otherwise(F.raise_error(F.concat(F.lit("invalid UTF-8 in "), "path")))
    decoded = decoded if keep_bom else F.regexp_replace(decoded, f"^{BOM}", "")
    rows = found.select(F.col("name").alias("file"), F.explode(numbered(decoded)).alias("l")).select("file", "l.line_no", "l.raw")
    ranks = listing(spark, folder).select(F.col("name").alias("file"), "file_rank")
    return rows.join(F.broadcast(ranks), "file").select("file", "file_rank", "line_no", "raw")  # one row per file


def source_urls(spark: SparkSession, path: str) -> DataFrame:
    """url per line; blank lines and lines that start with # are left out."""
    return urls(spark.read.text(path).withColumnRenamed("value", "raw"))


def urls(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col("raw").startswith("#") & (text.strip(F.col("raw")) != "")).select(text.strip(F.col("raw")).alias("url"))


def write_by_file(lines: DataFrame, path: str, names: list[str] | None = None) -> None:
    """One text file per rule file, of its name, as they were read; lines: file, line_no, raw. Files of `names` without
    lines are made empty."""
    kept = lines.repartition("file").sortWithinPartitions("file", "line_no").select("file", F.col("raw").alias("value"))
    _placed(kept, path, names or [])


def write_bodies(lists: DataFrame, path: str) -> None:
    """One text file per list (name, body), with the bytes of its body and a line end at its end."""
    body, n = F.col("body"), F.octet_length("body")
    whole = F.when(F.substring(body, -1, 1) == F.lit(b"\n"), F.substring(body, F.lit(1), n - 1)).otherwise(body)
    _placed(lists.repartition("name").select(F.col("name").alias("file"), whole.cast("string").alias("value")), path, [])


def _placed(rows: DataFrame, path: str, names: list[str]) -> None:
    """Writes rows (file, value), each file in one task, and gives each file its name in the folder `path`."""
    spark = rows.sparkSession
    fs, folder = path_of(spark, path)
    parts = folder.suffix(f".parts-{uuid.uuid4().hex}")
    rows.write.partitionBy("file").text(parts.toString())
    fs.mkdirs(folder)
    Path = spark._jvm.org.apache.hadoop.fs.Path
    written = set()
    for one in fs.listStatus(parts):  # one folder per rule file
        if one.isDirectory() and one.getPath().getName().startswith("file="):
            name = unquote(one.getPath().getName()[len("file=") :])
            part, *more = [x.getPath() for x in fs.listStatus(one.getPath()) if x.getPath().getName().startswith("part-")]
            if more:
                raise OSError(f"{name} was written in several parts")
            replace(spark, part, Path(folder, name))
            written.add(name)
    for name in set(names) - written:
        fs.create(Path(folder, name), True).close()
    fs.delete(parts, True)


def purge(spark: SparkSession, folder: str) -> list[str]:
    """Deletes the files of a folder that other steps left there; returns their names."""
    found = _files(spark, folder, "*").select("path", "name")
    gone = file_operators.auxiliary(found, "name").where("purge").collect()  # one row per file
    for r in gone:
        path = spark._jvm.org.apache.hadoop.fs.Path(r["path"])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)
    return sorted(r["name"] for r in gone)


def distinct_files(spark: SparkSession, folder: str) -> DataFrame:
    """name, digest, group_size and kept of a folder's files, by content."""
    found = _files(spark, folder, "*").select("name", "content")
    return file_operators.content_dedup(found.withColumn("key", F.col("name")), "name", "content", "key").drop("key")


def drop_copies(spark: SparkSession, folder: str) -> list[str]:
    """Deletes all but one of the files of a folder that have the same content; returns their names."""
    fs, at = path_of(spark, folder)
    gone = sorted(r["name"] for r in distinct_files(spark, folder).where("not kept and lower(name) like '%.txt'").collect())  # one row per file
    for name in gone:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(at, name), False)
    return gone


def write_merged(merged: DataFrame, path: str) -> None:
    """One text file of the rules by pos, put in place of the old one by a rename.

    Sorting within the only partition keeps the order; the list itself is small, one row per kept rule.
    """
    spark = merged.sparkSession
    fs, target = path_of(spark, path)
    folder = target.suffix(f".parts-{uuid.uuid4().hex}")
    merged.repartition(1).sortWithinPartitions("pos").select("rule").write.text(folder.toString())
    part = next(x.getPath() for x in fs.listStatus(folder) if x.getPath().getName().startswith("part-"))
    replace(spark, part, target)
    fs.delete(folder, True)
