"""What the operators of this folder share: tables, the shared folder, Arrow helpers."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.sources.shared import discard, shared_dir, stored

__all__ = ["discard", "file_bytes", "free_name", "one_thread", "perhaps", "released", "rows_of", "shared_dir", "small_batches", "stored", "table", "with_row_key", "without", "worker_cache"]

#: Hash buckets of ids; a broadcast of buckets has at most this many rows of eight bytes.
ID_BUCKETS = 1 << 20
#: Rows of an Arrow batch of texts.
BATCH_ROWS = 500
#: Bytes of text that Python code holds as objects at once, beside the Arrow batch.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(docs: DataFrame, name: str) -> str:
    """name, with underscores until docs has no such column."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _split(docs: DataFrame, ids: DataFrame) -> tuple[str, DataFrame, DataFrame]:
    """(name, docs, ids) with the column of that name for the bucket, and the buckets of ids: bounded, so safe to broadcast."""
    name = free_name(docs, "_bucket")
    bucket = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(ID_BUCKETS)).cast("int")
    return name, docs.withColumn(name, bucket), F.broadcast(ids.select(bucket.alias(name)).distinct())


def perhaps(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of docs whose doc_id may be in ids: all that are, and few others while ids are fewer than ID_BUCKETS."""
    name, split, buckets = _split(docs, ids)
    return split.join(buckets, name, "left_semi").select(*docs.columns)


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of docs whose doc_id is not in ids (one column, doc_id). Only rows that share a bucket with an id are shuffled."""
    name, split, buckets = _split(docs, ids)
    far = split.join(buckets, name, "left_anti").select(*docs.columns)
    near = perhaps(docs, ids)
    gone = ids.select(F.col("doc_id").alias(name))
    return far.union(near.join(gone, near["doc_id"].eqNullSafe(gone[name]), "left_anti"))


def with_row_key(docs: DataFrame) -> tuple[str, DataFrame]:
    """(name, docs with a column of that name): a key of each row, as ids may repeat or be null.

    It is a hash of 128 bits of doc_id and text. Of rows with the same doc_id and text, one is left, any one. Only the keys
    are shuffled, and the rows that may have one that repeats.
    """
    name = free_name(docs, "_row")
    key = F.struct(*(F.xxhash64(F.lit(k), "doc_id", "text").alias(f"h{k}") for k in (1, 2)))
    keyed = docs.withColumn(name, key)
    repeated = stored(keyed.groupBy(name).count().where("count > 1").select(F.col(name).alias("doc_id")), "repeated")
    if repeated.isEmpty():
        return name, keyed
    own = free_name(keyed, "_own")
    moved = keyed.withColumnRenamed("doc_id", own).withColumnRenamed(name, "doc_id")
    once = perhaps(moved, repeated).join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    every = without(moved, repeated).unionByName(once)
    return name, every.withColumnRenamed("doc_id", name).withColumnRenamed(own, "doc_id").select(*keyed.columns)


def released() -> None:
    """Gives a worker's free memory back to the system; idle workers would keep it from those of other stages."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def small_batches(docs: DataFrame) -> DataFrame:
    """docs; its texts go to Python BATCH_ROWS at a time, unless the session sets another number than the default."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if docs.sparkSession.conf.get(key, "10000") == "10000":
        docs.sparkSession.conf.set(key, str(BATCH_ROWS))
    return docs


def rows_of(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, list]]:
    """Slices of a string or binary column as (first row, bytes or None), each of max_bytes or one value."""
    values = batch.column(batch.schema.get_field_index(column))
    if pa.types.is_string(values.type) or pa.types.is_large_string(values.type):
        values = values.cast(pa.large_binary())
    start, n = 0, len(values)
    while start < n:
        stop, held = start, 0
        while stop < n and (held == 0 or held < max_bytes):
            held += 1 + (len(values[stop].as_buffer()) if values[stop].is_valid else 0)
            stop += 1
        yield start, values.slice(start, stop - start).to_pylist()
        start = stop
    released()


_kept: dict[str, dict] = {}


def worker_cache(name: str) -> dict:
    """A dict that a Python worker keeps from task to task, until another operator asks for its own."""
    if name not in _kept:
        _kept.clear()
    return _kept.setdefault(name, {})


def file_bytes(path: str) -> bytes:
    """A vocabulary file of the driver, to be broadcast: executors need not have it."""
    with open(path, "rb") as f:
        return f.read()


def one_thread() -> None:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    os.environ.setdefault("RAYON_NUM_THREADS", "1")
