"""Continuous ingestion: a folder of rule files as a stream; the merged list is made anew when files arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gristmill.operators import clean, merge, validate
from gristmill.sources import rulefiles

SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def rebuilt(spark: SparkSession, folder: str) -> DataFrame:
    """Clean, validate and merge all files of a folder: pos, rule, kind."""
    lines = rulefiles.lines(spark, folder)
    kept = validate.validate(clean.clean(lines), "file", "line_no")
    rows = kept.select(F.struct("file_rank", "line_no").alias("pos"), F.col("raw").alias("rule"))
    return merge.merge(rows)


def watch(spark: SparkSession, folder: str, checkpoint: str, sink: Callable[[DataFrame], None]) -> StreamingQuery:
    """Calls sink with the merged list after each batch of new files; one that fails is run again, so sink must replace."""
    found = spark.readStream.format("binaryFile").schema(SCHEMA).option("pathGlobFilter", "*.[tT][xX][tT]").load(folder)

    def batch(new: DataFrame, _: int) -> None:
        if not new.isEmpty():
            sink(rebuilt(spark, folder))

    return found.select("path").writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
