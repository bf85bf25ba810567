"""N-gram Jaccard join by signature trees.

1. One pass over the texts makes sets of 64-bit shingle hashes. Texts with the same set are one node, known by 128 bits.
2. Suspects: a set that links has at least t of its shingles in common with one other set. All shingles are dealt by
   ranges of the hash, as packed arrays; a range tells which of its shingles stand in several sets; sets with too few of
   those are out. A shingle that stands in several sets of a chunk is counted there and sent once, so one that stands in
   every text costs a range an entry per chunk, not per text. Only the suspects, few of a clean corpus, are looked at again.
3. Blocks: of two sets that link, one of the rarest shingles of the first (all but t of it, and one more) is among those of
   the second, by any order of the shingles. Frequent ones are last in the order, so passages that many texts share
   put few sets together. Sets that share one of their rarest shingles form buckets, and buckets that share a set blocks;
   nothing is lost by this.
4. In a block, a signature tree over the sets: a node holds the OR of its sets' token bitmaps and their size range. A
   dual traversal of the tree with itself drops pairs of nodes whose sizes are too far apart or whose largest possible
   overlap is too small, and pairs of nodes that are connected already; pairs of sets left over are compared exactly.
5. A block of more than BLOCK sets is cut into random parts. Each part is traversed together with some pivots of the
   block, which connects most of a large group of near copies at a cost of its size times the pivots. Blocks that aren't
   of one component then are traversed again: as a whole up to WHOLE_SETS sets, so that each is sent once; beyond that by
   bucket, as large blocks have few links: only buckets whose sets aren't of one component yet, and those with the same
   sets once. Sets of one component are dealt together; pairs of parts of one component are not traversed.

Defined results: a text with fewer words than a shingle has is one shingle; texts without words, empty and null ones have
no shingles, link with nothing and are their own component; texts of equal sets link; repeated rows (of one doc_id
too) are rows of their own; a row with a null doc_id links like any other, and has a null component only if no row of its
component has an id; an empty table gives no rows; other columns are ignored or kept, see keep_one.
"""

from __future__ import annotations

from fractions import Fraction
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm.common import discard, free_name, perhaps, rows_of, small_batches, stored, table, with_row_key, without, worker_cache
from gristmill.operators.components import components

#: Sets of a block's part that are traversed together, and pivots of a block that meet all its parts (expected).
BLOCK, PIVOTS = 64, 16
#: A larger block of at most so many sets and bytes is looked at again as a whole; beyond that by bucket.
WHOLE_SETS, WHOLE_BYTES = 2048, 48 << 20
FANOUT = 8
CACHE_WORDS = 30_000
#: Sets and shingles of a chunk at most (shingles: and one slice of texts); the number of no set of a chunk.
CHUNK_SETS, CHUNK_SHINGLES, SEVERAL = (1 << 16) - 1, 600_000, (1 << 16) - 1
#: Shingles that a range is meant for, bytes of text that one is reckoned to take, and the least number of ranges.
RANGE_SHINGLES, SHINGLE_BYTES, LEAST_RANGES = 2_000_000, 6, 256
#: Pairs of nodes whose children are looked at together, and bytes of bitmaps that are.
PAIRS, PAIR_BYTES = 2048, 4 << 20
#: Edges that a task holds before it contracts them.
HELD_EDGES = 1_000_000
_A, _B = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))


def mixed(h: np.ndarray) -> np.ndarray:
    for by in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(by)
    return h ^ (h >> np.uint64(31))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def shingles(text: bytes | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of `words` words of a text, ASCII capitals as small letters."""
    cut = (text or b"").lower().split()
    if not cut:
        return np.zeros(0, np.uint64)
    cache = worker_cache("ngramjoin").setdefault("words", None) or _Hashes()
    worker_cache("ngramjoin")["words"] = cache
    w = np.fromiter(map(cache.__getitem__, cut), dtype=np.uint64, count=len(cut))
    size = min(words, len(w))
    h = np.full(len(w) - size + 1, np.uint64(size), dtype=np.uint64)
    for k in range(size):
        h = mixed(h * _A + w[k : k + len(h)]) + _B
    return np.unique(h)


def node_of(found: np.ndarray) -> bytes:
    return blake2b(found.tobytes(), digest_size=16).digest()


# ---------------------------------------------------------------- suspects


def scanned(docs: DataFrame, words: int, ranges: int) -> DataFrame:
    """The only pass over all texts. Two kinds of rows, the other's columns null:

    doc_id, n, node (null without shingles) and print (a hash of the text) of every row;
    chunk, range, a, b: all shingles by range, as 32-bit hashes a and 16-bit numbers b of the sets in the chunk. A chunk is
    up to CHUNK_SETS sets of a task, each node once. A shingle of several sets of the chunk is there once, as of set
    SEVERAL; a row with a negative range has the chunk's nodes, their sizes and how many such shingles they have.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n", "node", "print", "chunk", "range", "a", "b"]

    def scan(batches):
        from pyspark import TaskContext

        chunk, seen, held, size = TaskContext.get().partitionId() << 24, set(), {}, 0
        for batch in batches:
            ids, prints = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "print"))
            for first, texts in rows_of(batch, "text"):
                found = [shingles(t, words) for t in texts]
                nodes = [node_of(x) if len(x) else None for x in found]
                told = [ids.slice(first, len(texts)), pa.array([len(x) for x in found], pa.int64()), pa.array(nodes, pa.binary()), prints.slice(first, len(texts))]
                none = [pa.nulls(len(texts), t) for t in (pa.int64(), pa.int32(), pa.binary(), pa.binary())]
                yield pa.RecordBatch.from_arrays([*told, *none], names=names)
                for node, x in zip(nodes, found, strict=True):
                    if node is None or node in seen:
                        continue
                    if len(seen) > 500_000:
                        seen = set(held)
                    seen.add(node)
                    held[node], size = x, size + len(x)
                    if len(held) == CHUNK_SETS:
                        yield dealt(held, chunk, ids.type)
                        held, size, chunk = {}, 0, chunk + 1
                if size > CHUNK_SHINGLES:
                    yield dealt(held, chunk, ids.type)
                    held, size, chunk = {}, 0, chunk + 1
        if held:
            yield dealt(held, chunk, ids.type)

    def dealt(held, chunk, id_type):
        n = np.array([len(x) for x in held.values()], dtype=np.uint32)
        h, owner = np.concatenate(list(held.values())), np.repeat(np.arange(len(held), dtype=np.uint16), n)
        order = np.argsort(h)
        h, owner = h[order], owner[order]
        first = np.r_[True, h[1:] != h[:-1]]
        alone = first & np.r_[first[1:], True]
        several = np.bincount(owner[~alone], minlength=len(held)).astype(np.uint32)
        owner[~alone] = SEVERAL
        h, owner = h[first], owner[first]
        part = ((h >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)  # ascends with h
        start = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        stop, low = np.r_[start[1:], len(part)], h.astype(np.uint32)
        a = [b"".join(held), *(low[x:y].tobytes() for x, y in zip(start, stop, strict=True))]
        b = [n.tobytes() + several.tobytes(), *(owner[x:y].tobytes() for x, y in zip(start, stop, strict=True))]
        none = [pa.nulls(len(a), t) for t in (id_type, pa.int64(), pa.binary(), pa.int64())]
        own = [pa.array([chunk] * len(a), pa.int64()), pa.array([-1 - chunk % ranges, *part[start].tolist()], pa.int32()), pa.array(a, pa.binary()), pa.array(b, pa.binary())]
        return pa.RecordBatch.from_arrays([*none, *own], names=names)

    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("print"))
    return texts.mapInArrow(scan, f"doc_id {kind}, n long, node binary, print long, chunk long, range int, a binary, b binary")


COUNTED = pa.schema([("chunk", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("counts", pa.bool_())])


def _shared_in_range(g: pa.Table) -> pa.Table:
    """Of a range: for each chunk, how many shingles of a set stand in other chunks too; nodes and sizes pass through."""
    if g["range"][0].as_py() < 0:
        return g.select(["chunk", "a", "b"]).append_column("counts", pa.array(np.zeros(len(g), dtype=bool)))
    a = [np.frombuffer(x, dtype=np.uint32) for x in g["a"].to_pylist()]
    low, owner = np.concatenate(a), np.concatenate([np.frombuffer(x, dtype=np.uint16) for x in g["b"].to_pylist()])
    source = np.repeat(np.arange(len(a), dtype=np.int64), [len(x) for x in a])
    order = np.argsort(low)
    same = low[order][1:] == low[order][:-1]
    twice = order[np.r_[False, same] | np.r_[same, False]]
    twice = twice[owner[twice] != SEVERAL]  # those are counted in their chunk
    key, n = np.unique(source[twice] << 16 | owner[twice], return_counts=True)
    start = np.flatnonzero(np.r_[True, key[1:] >> 16 != key[:-1] >> 16]) if len(key) else key
    chunk, out = g["chunk"].to_numpy(), []
    for x, y in zip(start, [*start[1:], len(key)], strict=False):
        out.append({"chunk": int(chunk[key[x] >> 16]), "a": (key[x:y] & 0xFFFF).astype(np.uint16).tobytes(), "b": n[x:y].astype(np.uint32).tobytes(), "counts": True})
    return pa.Table.from_pylist(out, schema=COUNTED)


def suspects(found: DataFrame, t: Fraction) -> DataFrame:
    """The nodes that have at least t of their shingles in common with others, out of the rows of `scanned`."""
    rows = found.where("chunk is not null").select("range", "chunk", "a", "b")
    shared = rows.groupBy("range").applyInArrow(_shared_in_range, "chunk long, a binary, b binary, counts boolean")
    p, q = t.numerator, t.denominator

    def summed(g: pa.Table) -> pa.Table:
        rows = list(zip(*(g[c].to_pylist() for c in ("a", "b", "counts")), strict=True))
        names, sizes, _ = next(r for r in rows if not r[2])
        size, n = np.frombuffer(sizes, dtype=np.uint32).astype(np.int64).reshape(2, -1)
        for a, b, counts in rows:
            if counts:
                n[np.frombuffer(a, dtype=np.uint16)] += np.frombuffer(b, dtype=np.uint32)
        return pa.table({"node": pa.array([names[16 * k : 16 * k + 16] for k in np.flatnonzero(n * q >= p * size)], pa.binary())})

    return shared.groupBy("chunk").applyInArrow(summed, "node binary").distinct()


# ---------------------------------------------------------------- blocks


def spanning(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the given ones connect: each node with the least of its component."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        for x in (a, b, label[a], label[b]):
            np.minimum.at(new, x, least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def contracted(edges: DataFrame) -> DataFrame:
    """Edges u, v that connect what those given connect: a spanning forest per task, so that few rows are left of the many
    buckets that near copies share; above HELD_EDGES a task sends on what it has."""

    def scan(batches):
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for batch in batches:
            held = tuple(np.concatenate([x, batch.column(k).to_numpy(zero_copy_only=False)]) for k, x in enumerate(held))
            if len(held[0]) > HELD_EDGES:
                held = spanning(*held)
                if len(held[0]) > HELD_EDGES // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names=["u", "v"])
                    held = (held[0][:0], held[1][:0])
        held = spanning(*held)
        if len(held[0]):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names=["u", "v"])

    return edges.mapInArrow(scan, "u long, v long").distinct()


def bucket_edges(prefix: DataFrame) -> DataFrame:
    """Edges u, v that connect the nodes of each bucket (sign, node), by the bucket's least node.

    The least ones come from a partial aggregate; a very full bucket meets its own by a join of two plain tables, which
    adaptive execution can split.
    """
    least = stored(prefix.groupBy("sign").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most").select("sign", "least"), "least")
    return contracted(prefix.join(least, "sign").where("node <> least").select(F.col("node").alias("u"), F.col("least").alias("v")))


def rarest(found: DataFrame, t: Fraction) -> DataFrame:
    """sign, node: of each set (node, set) the shingles of its prefix that stand in other sets too, by their number of sets."""

    def spread(batches):
        for batch in batches:
            for node, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                h = np.frombuffer(raw, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), node)), pa.array(np.full(len(h), len(h))), pa.array(h)], names=["node", "n", "sign"])

    every = found.select("node", "set").mapInArrow(spread, "node long, n long, sign long")
    often = stored(every.groupBy("sign").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1"), "often")
    both = every.join(often, "sign")
    own = Window.partitionBy("node")
    both = both.withColumn("k", F.count(F.lit(1)).over(own)).withColumn("r", F.row_number().over(own.orderBy("sets", "sign")))
    # shingles that no other set has come first in the order: n - k of them; the prefix has n - ceil(t n) + 1
    least = F.expr(f"({t.numerator} * n + {t.denominator - 1}) div {t.denominator}")
    return both.where(F.col("r") <= F.col("k") - least + 1).select("sign", "node")


# ---------------------------------------------------------------- signature trees


class Forest:
    """Union-find over the rows of a traversal."""

    def __init__(self, start: np.ndarray):
        _, self.up = np.unique(start, return_inverse=True)
        first = np.full(self.up.max(initial=-1) + 1, len(start))
        np.minimum.at(first, self.up, np.arange(len(start)))
        self.up = first[self.up]

    def root(self, k: int) -> int:
        while self.up[k] != k:
            self.up[k] = self.up[self.up[k]]
            k = int(self.up[k])
        return int(k)

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


class SignatureTree:
    """Levels of FANOUT nodes over sets sorted by size; a node has OR bitmap, size range, and spare: the most shingles of a set beyond its bits."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        n = np.array([len(s) for s in sets])
        width = 1 << int(np.clip(np.ceil(np.log2(max(8 * n.max(initial=1), 256))), 8, 16))
        bits = np.zeros((len(sets), width // 8), dtype=np.uint8)
        for k, s in enumerate(sets):
            at = (s % np.uint64(width)).astype(np.int64)
            np.bitwise_or.at(bits[k], at >> 3, (1 << (at & 7)).astype(np.uint8))
        bits = bits.view(np.uint64)
        spare = n - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
        self.levels = [(bits, n, n, spare)]
        while len(self.levels[-1][1]) > 1:
            bits, low, high, spare = self.levels[-1]
            first = np.arange(0, len(low), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(bits, first), np.minimum.reduceat(low, first), np.maximum.reduceat(high, first), np.maximum.reduceat(spare, first)))

    def possible(self, level: int, a: np.ndarray, b: np.ndarray, t: Fraction) -> np.ndarray:
        """Whether sets below nodes a and b can link, by size ranges and the largest possible overlap."""
        bits, low, high, spare = self.levels[level]
        p, q = t.numerator, t.denominator
        far = (high[a] * q < low[b] * p) | (high[b] * q < low[a] * p)
        out = ~far
        look = np.flatnonzero(out)
        step = max(64, PAIR_BYTES // (8 * bits.shape[1]))
        for at in range(0, len(look), step):
            k = look[at : at + step]
            shared = np.bitwise_count(bits[a[k]] & bits[b[k]]).sum(axis=1).astype(np.int64) + np.minimum(spare[a[k]], spare[b[k]])
            out[k] = shared * (p + q) >= p * (low[a[k]] + low[b[k]])
        return out

    def links(self, forest: Forest, t: Fraction) -> list[tuple[int, int]]:
        """Links that connect what links connect; pairs of one component are not looked at again."""
        p, q = t.numerator, t.denominator
        out: list[tuple[int, int]] = []
        a = b = np.zeros(1, dtype=np.int64)
        for level in range(len(self.levels) - 2, -1, -1):
            found = [self._below(forest, level, a[k : k + PAIRS], b[k : k + PAIRS], t) for k in range(0, len(a), PAIRS)]
            a, b = (np.concatenate([x[k] for x in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            if forest.root(i) == forest.root(j):
                continue
            s, u = self.sets[i], self.sets[j]
            at = np.minimum(np.searchsorted(u, s), len(u) - 1)
            both = int((u[at] == s).sum())
            if both * q >= p * (len(s) + len(u) - both):
                forest.join(i, j)
                out.append((i, j))
        return out

    def _below(self, forest: Forest, level: int, a: np.ndarray, b: np.ndarray, t: Fraction) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of nodes of a level below pairs of the level above that may hold links."""
        size, step = len(self.levels[level][1]), np.arange(FANOUT)
        x = (a[:, None, None] * FANOUT + step[None, :, None] + 0 * step[None, None, :]).ravel()
        y = (b[:, None, None] * FANOUT + step[None, None, :] + 0 * step[None, :, None]).ravel()
        ok = (x < size) & (y < size) & (x <= y if level else x < y)
        x, y = x[ok], y[ok]
        ok = self._open(forest, level, x, y)
        x, y = x[ok], y[ok]
        ok = self.possible(level, x, y, t) | (x == y if level else False)
        return x[ok], y[ok]

    def _open(self, forest: Forest, level: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Pairs of nodes whose sets aren't all connected already."""
        root = np.array([forest.root(k) for k in range(len(self.sets))])
        first = np.arange(0, len(root), FANOUT**level)
        low, high = np.minimum.reduceat(root, first), np.maximum.reduceat(root, first)
        return ~((low[x] == high[x]) & (low[y] == high[y]) & (low[x] == low[y]))


def linked(group: pa.Table, t: Fraction) -> pa.Table:
    """group: node, set, start (what is connected already). Links u, v that connect its nodes."""
    nodes, first = np.unique(group["node"].to_numpy(), return_index=True)  # a pivot stands in its own part too
    group = group.take(first)
    sets = [np.frombuffer(x, dtype=np.uint64) for x in group["set"].to_pylist()]
    order = sorted(range(len(sets)), key=lambda k: (len(sets[k]), sets[k][:1].tolist(), nodes[k]))
    nodes, start = nodes[order], group["start"].to_numpy()[order]
    found = SignatureTree([sets[k] for k in order]).links(Forest(start), t) if len(order) > 1 else []
    return pa.table({"u": pa.array([int(nodes[i]) for i, _ in found], pa.int64()), "v": pa.array([int(nodes[j]) for _, j in found], pa.int64())})


def _links(rows: DataFrame, keys: list[str], t: Fraction) -> DataFrame:
    return rows.select(*keys, "node", "set", "start").groupBy(*keys).applyInArrow(lambda g: linked(g, t), "u long, v long")


# ---------------------------------------------------------------- the join


def members(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """node (its number) and set of the wanted nodes, from one text each; wanted: node, key, doc_id, print.

    A text is known by its row's id and its hash, so null and repeated ids are no matter. Buckets of the wanted ids spare
    most texts the shuffle; the join decides.
    """
    own = wanted.select("node", "key", F.col("doc_id").alias("_id"), F.col("print").alias("_print"))
    texts = perhaps(docs.select("doc_id", "text"), wanted).withColumn("print", F.xxhash64("text"))
    found = texts.join(own, (F.col("print") == F.col("_print")) & F.col("doc_id").eqNullSafe(F.col("_id")))

    def sets(batches):
        for batch in batches:
            for first, texts in rows_of(batch, "text"):
                got = [shingles(t, words) for t in texts]
                node, key = (batch.column(batch.schema.get_field_index(c)).slice(first, len(texts)) for c in ("node", "key"))
                out = pa.RecordBatch.from_arrays([node, pa.array([x.tobytes() for x in got], pa.binary())], names=["node", "set"])
                yield out.filter(pa.array([node_of(x) == y for x, y in zip(got, key.to_pylist(), strict=True)], pa.bool_()))

    return found.select("text", "node", "key").mapInArrow(sets, "node long, set binary").dropDuplicates(["node"])  # of rows that repeat whole


def connected(docs: DataFrame, words: int, threshold: Fraction) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, node) of every row, and (node, root) of the nodes that link with others."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    every = stored(scanned(small_batches(docs), words, max(LEAST_RANGES, -(-size // (SHINGLE_BYTES * RANGE_SHINGLES)))), "rows")
    rows = stored(every.where("chunk is null").select("doc_id", "n", "node", "print"), "ids")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "print")).alias("at")
    wanted = rows.groupBy("node").agg(first).join(suspects(every, threshold), "node", "left_semi")  # copies are combined first
    wanted = stored(wanted.select(F.monotonically_increasing_id().alias("node"), F.col("node").alias("key"), "at.doc_id", "at.print"), "wanted")
    discard(every)
    sets = stored(members(docs, wanted, words), "sets")
    prefix = stored(rarest(sets, threshold), "prefix")
    edges = stored(bucket_edges(prefix), "buckets")
    blocks = stored(components(edges, "blocks").withColumnRenamed("root", "block"), "blocks")
    weighed = blocks.join(sets.select("node", F.octet_length("set").alias("bytes")), "node")
    total = stored(weighed.groupBy("block").agg(F.count(F.lit(1)).alias("size"), F.sum("bytes").alias("bytes")), "size")
    whole = (F.col("size") <= WHOLE_SETS) & (F.col("bytes") <= WHOLE_BYTES)
    dealt = blocks.join(total, "block").withColumn("parts", F.ceil(F.col("size") / BLOCK).cast("int")).withColumn("whole", whole)
    dealt = stored(dealt.drop("bytes"), "dealt")
    own = dealt.withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    pivots = dealt.where(F.col("parts") > 1).where(F.pmod(F.xxhash64(F.lit(7), "node"), "size") < PIVOTS)
    pivots = pivots.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    both = own.unionByName(pivots).select("block", "part", "node", F.col("node").alias("start"))
    links = stored(_links(both.join(sets, "node"), ["block", "part"], threshold), "links")
    large = dealt.where("parts > 1").select("block", "node", "whole")
    if not large.isEmpty():
        met = stored(components(links, "met"), "met")
        one = _undecided(large.where("whole").select("block", "node"), met)
        buckets = prefix.join(large.where("not whole").select("node"), "node").select(F.col("sign").alias("block"), "node")
        links = links.union(_links(one.join(sets, "node"), ["block"], threshold)).union(_between_parts(sets, _undecided(buckets, met), threshold))
    roots = components(links, "linked")
    key = lambda name: wanted.select(F.col("node").alias(f"_{name}"), F.col("key").alias(name))
    named = roots.join(key("k"), F.col("node") == F.col("_k")).join(key("r"), F.col("root") == F.col("_r"))
    named = stored(named.select(F.col("k").alias("node"), F.col("r").alias("root")), "roots")
    for used in (sets, prefix, total, blocks, edges, dealt, wanted):
        discard(used)
    return rows.drop("print"), named


def _undecided(rows: DataFrame, met: DataFrame) -> DataFrame:
    """Of rows (block, node) those of blocks with several components, with start, the node's; of blocks with the same nodes one."""
    rows = rows.join(met, "node", "left").select("block", "node", F.coalesce("root", "node").alias("start"))
    rows = stored(rows, "open")
    seen = rows.groupBy("block").agg(F.min("start").alias("low"), F.max("start").alias("high"), F.count(F.lit(1)).alias("n"), *(F.bit_xor(F.xxhash64(F.lit(k), "node")).alias(f"h{k}") for k in (1, 2)))
    once = stored(seen.where("low < high").groupBy("n", "h1", "h2").agg(F.min("block").alias("block")).select("block"), "once")
    return stored(rows.join(once, "block"), "contested")


def _between_parts(sets: DataFrame, found: DataFrame, threshold: Fraction) -> DataFrame:
    """Links between sets of a bucket that the first traversal left in different components; found: block, node, start.

    In a bucket sets of one component are dealt to parts of their own if they fill some; the others share parts. Pairs of
    parts are traversed, but for pairs within one component.
    """
    sizes = found.groupBy("block", "start").agg(F.count(F.lit(1)).alias("size"))
    mixed_size = sizes.groupBy("block").agg(F.sum(F.when(F.col("size") < BLOCK, F.col("size")).otherwise(0)).alias("mixed"))
    sizes = sizes.join(mixed_size, "block")
    owner = F.when(F.col("size") < BLOCK, F.lit(None)).otherwise(F.col("start"))
    cut = F.ceil(F.when(F.col("size") < BLOCK, F.col("mixed")).otherwise(F.col("size")) / BLOCK)
    plan = stored(sizes.select("block", "start", owner.alias("owner"), cut.alias("cut")), "plan")
    own = F.when(F.col("owner").isNull(), F.xxhash64("start")).otherwise(F.xxhash64("node"))
    part = F.concat_ws("/", F.coalesce(F.col("owner").cast("string"), F.lit("mixed")), F.pmod(own, "cut"))
    rows = stored(found.join(plan, ["block", "start"]).withColumn("part", part), "parts")
    parts = stored(rows.groupBy("block", "part").agg(F.first("owner").alias("owner")), "pairs")
    a, b = (parts.select("block", F.col("part").alias(f"part_{x}"), F.col("owner").alias(f"owner_{x}")) for x in "ab")
    pairs = a.join(b, "block").where("part_a < part_b").where(~(F.col("owner_a") == F.col("owner_b")) | F.col("owner_a").isNull() | F.col("owner_b").isNull())
    lone = parts.where("owner is null").select("block", F.col("part").alias("part_a"), F.col("part").alias("part_b"))
    pairs = pairs.select("block", "part_a", "part_b").union(lone)
    sides = pairs.select("block", "part_a", "part_b", F.explode(F.array_distinct(F.array("part_a", "part_b"))).alias("part"))
    return _links(sides.join(rows, ["block", "part"]).join(sets, "node"), ["block", "part_a", "part_b"], threshold)


def join(docs: DataFrame, words: int = 5, threshold: Fraction | float = Fraction(4, 5)) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id that links lead to)."""
    rows, roots = connected(docs, words, threshold if isinstance(threshold, Fraction) else Fraction(str(threshold)))
    nodes = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("m"))
    nodes = stored(nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "nodes")
    least = stored(nodes.groupBy("root").agg(F.min("m").alias("component_id")), "least")
    met = stored(nodes.join(least, "root").select("node", "component_id"), "met")  # joins of two plain tables: a hot key can be split
    found = rows.join(met, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return found.union(rows.where("node is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def keep_one(docs: DataFrame, words: int = 5, threshold: Fraction | float = Fraction(4, 5)) -> DataFrame:
    """The row with the smallest id of each component, with all its columns; ids may repeat or be null.

    Of rows that tie in doc_id, any one stays, also of rows with the same doc_id and a text without words, whatever their
    other columns; a null doc_id sorts after all others.
    """
    row, rows = with_row_key(docs)
    keyed = rows.select(F.col(row).alias("doc_id"), "text")
    found = stored(join(keyed, words, threshold).select(F.col("doc_id").alias(row), F.col("component_id").alias("_root")), "found")
    several = found.where(F.col(row) != F.col("_root")).select("_root").distinct()
    met = found.join(several, "_root").join(rows.select(row, F.col("doc_id").alias("_id")), row)
    met = stored(met.select("_root", row, F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col(row).alias("row")).alias("_rank")), "met")
    first = met.groupBy("_root").agg(F.min("_rank").alias("_least"))
    dropped = stored(met.join(first, "_root").where(F.col("_rank.row") != F.col("_least.row")).select(F.col(row).alias("doc_id")), "dropped")
    own = free_name(rows, "_own")
    stays = without(rows.withColumnRenamed("doc_id", own).withColumnRenamed(row, "doc_id"), dropped)
    return stays.withColumnRenamed("doc_id", row).withColumnRenamed(own, "doc_id").select(*docs.columns)


def op4_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"), 3, Fraction(9, 10))
