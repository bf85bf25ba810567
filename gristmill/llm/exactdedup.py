"""Exact dedup: binary-fuse filters over immutable snapshots screen incoming digests; positives join exact buckets.

A snapshot is a batch of documents that no longer changes. It is kept as tables: the digests of its rows, its groups (one
row per distinct normalised text, with the row that stays) and, per shard of the digest space, one static binary-fuse filter;
they can be written beside the documents and read for each later batch. Incoming documents are first grouped among
themselves; one digest per group is screened by the filter of its shard. Only positives reach the exact buckets, where
their normalised texts are compared byte for byte with the snapshot's.

Defined results: a null text is an empty one; empty texts are copies of one another; rows with the same doc_id are rows of
their own, and exactly one row of a group stays: if the largest texts tie in length and doc_id, one of the snapshot before
one of the batch, else any one; a null doc_id sorts after all others; an empty table gives no rows; other columns of the
input are ignored or kept, see dedup_new.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm.common import discard, perhaps, stored, table, with_row_key, without

WHITE_SPACE = " \t\n\x0b\x0c\r"
#: Digests that one filter is meant for at most, and the least number of shards that the digest space is cut into.
SHARD_KEYS, LEAST_SHARDS = 50_000, 256
#: Incoming digests that one task screens at a time, about.
SCREENED = 200_000


def normalised(text: str | Column = "text") -> Column:
    return F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), WHITE_SPACE, "")


def digests(docs: DataFrame, batch: bool) -> DataFrame:
    """doc_id, text_sha256 of the normalised text, the code points of the original one, and what tells the row from all others.

    The number of a row is only fixed once the table is stored.
    """
    row = F.struct(F.lit(batch).alias("batch"), F.monotonically_increasing_id().alias("k"))
    return docs.select("doc_id", F.sha2(normalised().cast("binary"), 256).alias("text_sha256"), F.length(F.coalesce("text", F.lit(""))).alias("n_points"), row.alias("row"))


class BinaryFuse8:
    """Static filter with three locations and eight bits a key in overlapping segments (Graf and Lemire 2022).

    About one in 256 other keys passes; no key of the set is ever refused. Peeling runs in rounds of NumPy calls.
    """

    def __init__(self, seed: int, segment: int, segments: int, prints: np.ndarray):
        self.seed, self.segment, self.segments, self.prints = seed, segment, segments, prints

    @staticmethod
    def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
        h = keys + np.uint64(seed)
        for by in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            h = (h ^ (h >> np.uint64(33))) * np.uint64(by)
        return h ^ (h >> np.uint64(33))

    @staticmethod
    def places(h: np.ndarray, segment: int, segments: int) -> np.ndarray:
        """Three locations in three segments in a row."""
        start = ((h >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64) * segment
        low = np.uint64(segment - 1)
        return np.stack([start + k * segment + ((h >> np.uint64(11 * k)) & low).astype(np.int64) for k in range(3)])

    @staticmethod
    def print_of(h: np.ndarray) -> np.ndarray:
        return ((h ^ (h >> np.uint64(29))) >> np.uint64(3)).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> BinaryFuse8:
        keys = np.unique(keys.astype(np.uint64))
        n = max(len(keys), 1)
        segment = min(1 << 11, 1 << max(2, int(np.log(n) / np.log(3.33) + 2.25)))
        size = int(n * max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 10)))) + 4
        segments = max(1, -(-size // segment) - 2)
        for seed in range(1, 200):
            if seed % 20 == 0:
                segments += 1 + segments // 10
            h = cls.mixed(keys, seed * 0x9E3779B97F4A7C15 % (1 << 64))
            at = cls.places(h, segment, segments)
            if (order := cls._peel(at, (segments + 2) * segment)) is not None:
                prints = np.zeros((segments + 2) * segment, dtype=np.uint8)
                own = cls.print_of(h)
                for ks, slots in reversed(order):  # the slots of a round are no slots of its other keys
                    prints[slots] = 0
                    prints[slots] = own[ks] ^ prints[at[0, ks]] ^ prints[at[1, ks]] ^ prints[at[2, ks]]
                return cls(seed, segment, segments, prints)
        raise RuntimeError("no seed peels")

    @staticmethod
    def _peel(at: np.ndarray, slots: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
        n = at.shape[1]
        count = np.bincount(at.ravel(), minlength=slots)
        which = np.zeros(slots, dtype=np.int64)  # XOR of the keys of a slot
        for row in at:
            np.bitwise_xor.at(which, row, np.arange(n))
        order, left = [], n
        while left:
            single = np.flatnonzero(count == 1)
            if not len(single):
                return None
            ks, first = np.unique(which[single], return_index=True)
            order.append((ks, single[first]))
            left -= len(ks)
            for row in at[:, ks]:
                np.subtract.at(count, row, 1)
                np.bitwise_xor.at(which, row, ks)
        return order

    def __contains__(self, key: int) -> bool:
        return bool(self.holds(np.array([key], dtype=np.uint64))[0])

    def holds(self, keys: np.ndarray) -> np.ndarray:
        h = self.mixed(keys.astype(np.uint64), self.seed * 0x9E3779B97F4A7C15 % (1 << 64))
        at = self.places(h, self.segment, self.segments)
        return self.print_of(h) == self.prints[at[0]] ^ self.prints[at[1]] ^ self.prints[at[2]]

    def dumped(self) -> dict:
        return {"seed": self.seed, "segment": self.segment, "segments": self.segments, "prints": self.prints.tobytes()}

    @classmethod
    def loaded(cls, row) -> BinaryFuse8:
        return cls(int(row["seed"]), int(row["segment"]), int(row["segments"]), np.frombuffer(row["prints"], dtype=np.uint8))


def _keys(rows: pa.Table) -> np.ndarray:
    return rows["_key"].to_numpy().view(np.uint64)


def keyed(rows: DataFrame, shards: int) -> DataFrame:
    """Adds the 64-bit key of a digest and the shard it falls in."""
    key = F.conv(F.substring("text_sha256", 1, 16), 16, -10).cast("long")
    shard = F.pmod(F.conv(F.substring("text_sha256", 17, 8), 16, 10).cast("long"), F.lit(shards)).cast("int")
    return rows.withColumn("_key", key).withColumn("_shard", shard)


def filters(snapshot: DataFrame, shards: int) -> DataFrame:
    """One filter per shard of the snapshot's digests: _shard, seed, segment, segments, prints."""

    kinds = pa.schema([("_shard", pa.int32()), ("seed", pa.int32()), ("segment", pa.int32()), ("segments", pa.int32()), ("prints", pa.binary())])

    def build(rows: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([{"_shard": rows["_shard"][0].as_py()} | BinaryFuse8.build(_keys(rows)).dumped()], schema=kinds)

    return keyed(snapshot, shards).select("_shard", "_key").groupBy("_shard").applyInArrow(build, "_shard int, seed int, segment int, segments int, prints binary")


def screened(groups: DataFrame, built: DataFrame, shards: int, count: int) -> DataFrame:
    """The digests of the incoming groups, `count` in number, that the filter of their shard lets through.

    A large batch is dealt to several tasks a shard, each with the filter of the shard.
    """
    parts = max(1, -(-count // (shards * SCREENED)))

    def screen(incoming: pa.Table, shard: pa.Table) -> pa.Table:
        digests = incoming.select(["text_sha256"])
        if not len(shard) or not len(incoming):
            return digests.slice(0, 0)
        return digests.filter(pa.array(BinaryFuse8.loaded(shard.to_pylist()[0]).holds(_keys(incoming))))

    part = F.pmod(F.xxhash64("text_sha256"), F.lit(parts)).cast("int")
    incoming = keyed(groups, shards).select("_shard", part.alias("_part"), "_key", "text_sha256").groupBy("_shard", "_part")
    copies = built.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return incoming.cogroup(copies.groupBy("_shard", "_part")).applyInArrow(screen, "text_sha256 string")


def grouped(rows: DataFrame) -> DataFrame:
    """One row per digest: the row that stays (most code points, then smallest doc_id) and the group's size."""
    best = F.min(F.struct((-F.col("n_points")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("best")
    return rows.groupBy("text_sha256").agg(best, F.count(F.lit(1)).alias("size"))


@dataclass
class Snapshot:
    """What is kept of documents that no longer change: digests, groups, filters of `shards` shards, all stored tables."""

    rows: DataFrame
    groups: DataFrame
    filters: DataFrame
    shards: int

    @classmethod
    def of(cls, docs: DataFrame) -> Snapshot:
        rows = stored(digests(docs, False), "digests")
        groups = stored(grouped(rows), "groups")
        shards = max(LEAST_SHARDS, -(-groups.count() // SHARD_KEYS))
        return cls(rows, groups, stored(filters(groups, shards), "filters"), shards)

    def write(self, path: str) -> None:
        self.rows.write.parquet(f"{path}/rows")
        self.groups.write.parquet(f"{path}/groups")
        self.filters.withColumn("shards", F.lit(self.shards)).write.parquet(f"{path}/filters")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Snapshot:
        built = spark.read.parquet(f"{path}/filters")
        shards = built.agg(F.max("shards")).first()[0] or LEAST_SHARDS
        return cls(spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/groups"), built.drop("shards"), shards)


def confirmed(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of pairs (text_sha256, new_id, old_id) those whose normalised texts are the same bytes.

    The two texts of a pair meet by digest: a row per digest and side, so no group of copies meets in one task.
    """
    sides = F.array(*(F.struct(F.col(c).alias("doc_id"), F.lit(k).alias("side"), "text_sha256") for k, c in enumerate(("new_id", "old_id"))))
    wanted = pairs.select(F.explode(sides).alias("w")).select("w.*")
    texts = perhaps(docs, wanted).select("doc_id", normalised().cast("binary").alias("bytes"))
    found = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["doc_id"])).where(F.sha2("bytes", 256) == F.col("text_sha256"))
    sides = [F.min(F.when(F.col("side") == k, F.col("bytes"))) for k in (0, 1)]
    return found.groupBy("text_sha256").agg((sides[0] == sides[1]).alias("same")).where("same").select("text_sha256")


def dedup(snapshot_docs: DataFrame, new_docs: DataFrame, snapshot: Snapshot | None = None) -> DataFrame:
    """Groups the rows of a snapshot and of a new batch; a row per document: doc_id, keep_id, group_size, kept, text_sha256.

    The snapshot's filters are made once, or given. The batch is grouped apart; its groups join those of the snapshot
    only if the filter passes them, the digest is in the exact bucket and the bytes agree.
    """
    old = snapshot or Snapshot.of(snapshot_docs)
    new_rows = stored(digests(new_docs, True), "digests")
    new = stored(grouped(new_rows), "groups")
    positives = screened(new, old.filters, old.shards, new.count())
    old_side = old.groups.select("text_sha256", F.col("best").alias("old_best"), F.col("size").alias("old_size"))
    met = stored(new.join(positives, "text_sha256").join(old_side, "text_sha256"), "met")
    texts = snapshot_docs.select("doc_id", "text").unionByName(new_docs.select("doc_id", "text"))
    same = confirmed(texts, met.select("text_sha256", F.col("best.doc_id").alias("new_id"), F.col("old_best.doc_id").alias("old_id")))
    both = met.join(same, "text_sha256").select("text_sha256", F.least("best", "old_best").alias("_b"), (F.col("size") + F.col("old_size")).alias("_s"))
    both = stored(both, "both")
    out = []
    for rows, groups in ((old.rows, old.groups), (new_rows, new)):
        final = groups.join(both, "text_sha256", "left").select("text_sha256", F.coalesce("_b", "best").alias("best"), F.coalesce("_s", "size").alias("size"))
        out.append(rows.join(stored(final, "final"), "text_sha256"))
    discard(met)
    every = out[0].unionByName(out[1])
    return every.select("doc_id", F.col("best.doc_id").alias("keep_id"), F.col("size").alias("group_size"), (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256")


def halves(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents as a snapshot and a new batch, by the checksum of the id: two thirds and one third."""
    late = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 2
    return docs.where(~late), docs.where(late)


def dedup_new(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns: one of each group, whether ids repeat or are null.

    Of rows that tie in length and doc_id, any one stays, whatever their other columns; a null doc_id sorts after all others.
    """
    row, rows = with_row_key(docs)
    ranked = rows.withColumn("doc_id", F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(row).alias("row")))
    stays = without(ranked, stored(dedup(*halves(ranked)).where("not kept").select("doc_id"), "dropped"))
    return stays.withColumn("doc_id", F.col("doc_id.id")).select(*docs.columns)


def op6_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup(*halves(table(spark, sf_dir, "documents")))


ORACLE = r"""
with d as (
  select doc_id, length(coalesce(text, '')) as p,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
  from documents),
g as (
  select text_sha256, arg_min(doc_id, (-p, doc_id)) as keep_id, count(*) as group_size
  from d group by 1)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256
from d join g using (text_sha256)
"""
