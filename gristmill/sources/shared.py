"""Tables kept in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one where that is unset and all runs in one process, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and (not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (named or f"file://{tempfile.gettempdir()}/gristmill-checkpoints").rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """df, written to the shared folder and read again: cuts the lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Deletes the files of a stored table that nothing reads any more."""
    spark = table.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def path_of(spark: SparkSession, path: str):
    """(Hadoop's file system of a path, the path in full)."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = found.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(found)


def replace(spark: SparkSession, source, target) -> None:
    """Renames a file over another one in one step."""
    jvm, options = spark._jvm, getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(options, 1)
    how[0] = options.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(source, target, how)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, put in place by a rename."""
    fs, target = path_of(spark, path)
    part = target.suffix(".part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    replace(spark, part, target)
