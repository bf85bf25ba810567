"""Near-duplicate embeddings by NN-descent.

A neighbour graph starts from leaves of random-hyperplane trees (pairs within a leaf) and is refined: each round joins,
around every vector, its neighbours and some that have it as theirs, compares them with one another and keeps the best K of
each (Dong, Moses and Li 2011). Rounds end when next to nothing changes. Entries at the threshold or above are links.

Equal vectors are collapsed first and counted by their number. A vector whose K entries all are links is saturated, and
may have more links than its list holds. Those that lead to other components are searched apart: lists of the best K
vectors of other components, until no link between two components is new. Those within its component are counted, in shells
of the angle to the component's first vector: the triangle inequality says of most pairs of shells that all their pairs
link, or none (of a tight group: all), which takes sums only; the vectors of the other pairs of shells are compared in tiles,
and only the numbers of links kept.

Leaves and rounds work on half precision, a quarter of the bytes; an entry so near the threshold that this doesn't
decide is computed anew in double precision.

Entries below MARGIN under the threshold are not kept, so a pair without other company is only found by a tree that has
both in a leaf. The number of trees therefore grows with the table: as many as find a pair at the threshold with
probability PAIR_RECALL (about n ** 0.15 of them). An audit compares a sample of vectors, and one of those in small groups or
alone, with all others; a vector counts if all its links were found. Below AUDIT_RECALL more trees and rounds follow; if
the last audit is below it too, the run fails. The recall that the audit found is returned with the rows.

Defined results: a vector that is null, zero, or has null or non-finite components links with nothing, and neither do two
of different lengths; links are between different rows, so equal vectors link; a repeated vec_id counts as one vector
(the smaller one in the order of arrays); a null vec_id stands alone with a null component; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm.common import discard, perhaps, stored, table, without
from gristmill.operators.components import components

THRESHOLD, NEIGHBOURS, TREES, LEAF, TILE = 0.95, 12, 6, 512, 1024
#: How far below the threshold entries are kept; share of changed entries that ends the rounds; most rounds.
MARGIN, STILL, ROUNDS = 0.2, 0.001, 8
#: Vectors of the audit (expected), the recall it asks for, and how often more trees may follow.
AUDIT, AUDIT_RECALL, RETRIES = 256, 0.99, 3
#: How surely the trees find a pair at the threshold; vectors with more links than SMALL have enough company.
PAIR_RECALL, SMALL = 0.995, 3
#: Further hyperplanes of a tree that cut its large leaves; how near the threshold half precision doesn't decide (a
#: component's error is at most 2 ** -11 of it, that of a product of unit vectors twice this, and sums round in single precision).
FURTHER, UNSURE = 24, 2e-3
#: Shells within the angle of the threshold; what rounding may do to an angle.
SHELLS, ANGLE_ERROR = 8, 1e-6


def units(vectors: DataFrame) -> DataFrame:
    """vec_id, u, the vector of length one in double precision, and h, it in half precision; only of vectors that can link.

    Stored as they are read: only vectors whose id may be one of the repeated ones are shuffled.
    """
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def scaled(batches):
        for batch in batches:
            lengths = np.nan_to_num(batch.column(1).value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            flat, ends = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.cumsum(lengths)
            for size in np.unique(lengths[lengths > 0]).tolist():
                row = np.flatnonzero(lengths == size)
                x = flat[(ends[row] - size)[:, None] + np.arange(size)]
                ok = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)  # a null component came as NaN
                row, x = row[ok], x[ok]
                x /= np.abs(x).max(axis=1, initial=0)[:, None]
                x = x / np.sqrt((x * x).sum(axis=1))[:, None] + 0.0  # no negative zeros
                u = pa.ListArray.from_arrays(pa.array(np.arange(len(row) + 1) * size, pa.int32()), pa.array(x.ravel()))
                h = pa.array([y.tobytes() for y in x.astype(np.float16)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), u, h], names=["doc_id", "u", "h"])

    read = vectors.where("embedding is not null and vec_id is not null").select("vec_id", "embedding")
    rows = stored(read.mapInArrow(scaled, f"doc_id {kind}, u array<double>, h binary"), "read")
    repeated = stored(rows.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if not repeated.isEmpty():
        again = perhaps(rows, repeated).join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct("u", "h")).alias("x"))
        rows = without(rows, repeated).union(again.select("doc_id", "x.u", "x.h"))
    return rows.withColumnRenamed("doc_id", "vec_id")


def collapsed(every: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the distinct vectors: vec_id, the smallest, u, h and root, itself; vec_id, first and m of those that have equals).

    Equal vectors are those of an equal hash of 128 bits. Vectors aren't shuffled, but for those that may go.
    """
    ids = every.select("vec_id", *(F.xxhash64(F.lit(k), "u").alias(f"_{k}") for k in (1, 2)))
    several = stored(ids.groupBy("_1", "_2").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("m")).where("m > 1"), "several")
    first = stored(ids.join(several, ["_1", "_2"]).select("vec_id", "first", "m"), "first")
    gone = first.where("vec_id <> first").select(F.col("vec_id").alias("doc_id"))
    left = without(every.withColumnRenamed("vec_id", "doc_id"), gone).withColumnRenamed("doc_id", "vec_id")
    return stored(left.withColumn("root", F.col("vec_id")), "distinct"), first


def _halves(column: pa.Array | list, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist() if isinstance(column, pa.Array) else column), dtype=np.float16).reshape(-1, size).astype(np.float32)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def bits_of(count: int) -> int:
    return max(0, int(np.ceil(np.log2(max(count, 1) / LEAF))))


def trees_for(count: int, threshold: float) -> int:
    """Trees that find a pair at the threshold with PAIR_RECALL; at least TREES.

    A hyperplane parts the two with probability angle / pi. A leaf has a bit more than the mean where vectors are dense;
    it is cut by two more hyperplanes, expected.
    """
    if (bits := bits_of(count)) == 0:
        return TREES
    together = (1 - np.arccos(min(1.0, max(-1.0, threshold))) / np.pi) ** (bits + 2)
    return TREES if together > 1 - 1e-9 else max(TREES, int(np.ceil(np.log(1 - PAIR_RECALL) / np.log1p(-together))))


def leaves(rows: DataFrame, size: int, bits: int, trees: range) -> DataFrame:
    """vec_id, root, h, tree, leaf (the signs of a tree's hyperplanes) and further (those of FURTHER more)."""

    def run(batches):
        planes = {t: np.random.default_rng(7919 * t + 1).standard_normal((size, bits + FURTHER)).astype(np.float32) for t in trees}
        for batch in batches:
            x = _halves(batch.column(2), size)
            for t in trees:
                signs = (x @ planes[t] > 0).astype(np.int64)
                code, further = ((y << np.arange(y.shape[1])).sum(axis=1).astype(np.int64) for y in (signs[:, :bits], signs[:, bits:]))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(x), t), pa.int32()), pa.array(code), pa.array(further)], names=["vec_id", "root", "h", "tree", "leaf", "further"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.select("vec_id", "root", "h").mapInArrow(run, f"vec_id {kind}, root {kind}, h binary, tree int, leaf long, further long")


def decided(entries: DataFrame, rows: DataFrame, threshold: float) -> DataFrame:
    """Entries (a, b, s) of half precision; those near the threshold with s in double precision."""
    unsure = F.abs(F.col("s") - threshold) < UNSURE
    u = lambda side: rows.select(F.col("vec_id").alias(side), F.col("u").alias(f"u{side}"))
    product = F.aggregate(F.zip_with("ua", "ub", lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
    return entries.where(~unsure).union(entries.where(unsure).join(u("a"), "a").join(u("b"), "b").select("a", "b", product.alias("s")))


def _best(ids: np.ndarray, roots: np.ndarray, x: np.ndarray, least: float, most: int) -> pd.DataFrame:
    """For each row of x its best `most` of other roots at `least` or above."""
    s = x @ x.T
    s[roots[:, None] == roots[None, :]] = -2
    k = min(most, len(ids) - 1)
    if k < 1:
        return pd.DataFrame({"a": [], "b": [], "s": []})
    best = np.argpartition(-s, k - 1, axis=1)[:, :k]
    row, col = np.repeat(np.arange(len(ids)), k), best.ravel()
    ok = s[row, col] >= least
    row, col = row[ok], col[ok]
    return pd.DataFrame({"a": ids[row], "b": ids[col], "s": s[row, col]})


def start(rows: DataFrame, size: int, count: int, trees: range, threshold: float, most: int) -> DataFrame:
    """First entries (a, b, s) from the leaves, as of decided.

    A leaf of very many vectors is cut by further hyperplanes, which keep near pairs together; what they cannot cut is
    dense, and is cut into random parts.
    """
    found = leaves(rows, size, bits_of(count), trees)
    cuts = found.groupBy("tree", "leaf").agg(F.least(F.ceil(F.log2(F.greatest(F.count(F.lit(1)) / LEAF, F.lit(1.0)))), F.lit(FURTHER)).cast("int").alias("cuts"))
    cut = found.join(cuts, ["tree", "leaf"]).withColumn("further", F.expr("further & (shiftleft(1L, cuts) - 1)"))
    parts = cut.groupBy("tree", "leaf", "further").agg(F.ceil(F.count(F.lit(1)) / (2 * LEAF)).alias("parts"))
    dealt = cut.join(parts, ["tree", "leaf", "further"]).withColumn("part", F.pmod(F.xxhash64("vec_id", "tree"), "parts"))
    kind = rows.schema["vec_id"].dataType.simpleString()
    best = lambda g: _best(g["vec_id"].to_numpy(), g["root"].to_numpy(), _halves(g["h"].tolist(), size), threshold - MARGIN, most)
    entries = dealt.select("tree", "leaf", "further", "part", "vec_id", "root", "h").groupBy("tree", "leaf", "further", "part").applyInPandas(best, f"a {kind}, b {kind}, s double")
    return decided(stored(entries.groupBy("a", "b").agg(F.max("s").alias("s")), "first"), rows, threshold)


def kept(entries: DataFrame, most: int) -> DataFrame:
    """The best `most` entries of each vector, once each."""
    once = entries.groupBy("a", "b").agg(F.max("s").alias("s"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("s"), "b"))
    return once.withColumn("_r", rank).where(F.col("_r") <= most).drop("_r")


def _around(lists: DataFrame, most: int) -> DataFrame:
    """a, b: the neighbours of each vector, forward and back (at most `most` back, chosen by hash)."""
    back = lists.select(F.col("b").alias("a"), F.col("a").alias("b"))
    some = F.row_number().over(Window.partitionBy("a").orderBy(F.xxhash64("b", "a")))
    return lists.select("a", "b").union(back.withColumn("_r", some).where(F.col("_r") <= most).drop("_r"))


def refined(rows: DataFrame, lists: DataFrame, size: int, threshold: float, most: int, own: DataFrame | None = None) -> DataFrame:
    """Entries among the neighbours of each vector, those by the lists `own` too; each member gives its best `most`."""
    around = _around(lists, most).union(lists.select("a", F.col("a").alias("b")))
    if own is not None:
        around = around.union(_around(own, most))
    members = around.distinct().join(rows.select(F.col("vec_id").alias("b"), "root", "h"), "b")
    groups = members.groupBy("a").agg(F.collect_list("b").alias("ids"), F.collect_list("root").alias("roots"), F.collect_list("h").alias("x"))  # at most 2 * most + 1 of each, or 4 * most + 1

    def run(batches):
        for batch in batches:
            ids, flat = batch.column(0), _halves(batch.column(2).flatten(), size)
            bounds = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))])
            names, roots = (batch.column(k).flatten().to_numpy(zero_copy_only=False) for k in (0, 1))
            out = [_best(names[a:b], roots[a:b], flat[a:b], threshold - MARGIN, most) for a, b in zip(bounds, bounds[1:], strict=False)]
            if out:
                yield pa.RecordBatch.from_pandas(pd.concat(out).astype({"a": names.dtype, "b": names.dtype, "s": float}).drop_duplicates(["a", "b"]), preserve_index=False)

    kind = rows.schema["vec_id"].dataType.simpleString()
    found = groups.select("ids", "roots", "x").mapInArrow(run, f"a {kind}, b {kind}, s double")
    new = found.groupBy("a", "b").agg(F.max("s").alias("s")).join(lists.select("a", "b"), ["a", "b"], "left_anti")
    return decided(stored(new, "refined"), rows, threshold)


def graph(rows: DataFrame, size: int, count: int, trees: range, threshold: float, most: int, before: DataFrame | None = None, own: DataFrame | None = None) -> DataFrame:
    """Neighbour lists (a, b, s) after the rounds; neighbours are of other roots."""
    first = start(rows, size, count, trees, threshold, most)
    lists = stored(kept(first if before is None else first.union(before), most), "lists")
    for _ in range(ROUNDS):
        after = stored(kept(lists.union(refined(rows, lists, size, threshold, most, own)), most), "lists")
        changed = after.join(lists, ["a", "b"], "left_anti").count()
        discard(lists)
        lists = after
        if changed <= STILL * max(1, count):
            break
    return lists


def bridged(rows: DataFrame, lists: DataFrame, size: int, trees: range, threshold: float, most: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links (a, b), components (vec_id, root) and saturated vectors (vec_id).

    A link is in neither list only if both its vectors are saturated; it matters to the components only if they differ.
    So the saturated ones get lists of vectors of other components, again after each merge, until no link is new.
    """
    edges = stored(lists.where(F.col("s") >= threshold).select("a", "b"), "edges")
    full = stored(edges.groupBy("a").count().where(F.col("count") >= most).select(F.col("a").alias("vec_id")), "full")
    crowd = stored(rows.join(full, "vec_id").select("vec_id", "u", "h"), "crowd")
    count = crowd.count()
    own = stored(lists.join(full.select(F.col("vec_id").alias("a")), "a", "left_semi").join(full.select(F.col("vec_id").alias("b")), "b", "left_semi"), "own")
    while True:
        found = stored(components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")), "near"), "near")
        found = found.select(F.col("node").alias("vec_id"), "root")
        apart = stored(crowd.join(found, "vec_id"), "apart")
        if apart.select("root").distinct().limit(2).count() < 2:
            return edges, found, full
        foreign = graph(apart, size, count, trees, threshold, most, own=own)
        new = foreign.where(F.col("s") >= threshold).select("a", "b")
        if new.isEmpty():
            return edges, found, full
        edges = stored(edges.union(new), "edges")


def enlarged(rows: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """vec_id, n: numbers of links within components; rows: vec_id, u, m; members: vec_id, root.

    A shell has the vectors whose angle to the component's first vector lies between two multiples of a SHELLS-th of the
    threshold's angle. Two vectors are no further from each other than the sum of their angles, and no nearer than the
    difference. So pairs of shells are of three kinds: all link, none does, or their vectors are compared in tiles.
    """
    step = float(np.arccos(threshold)) / SHELLS
    own = stored(members.join(rows, "vec_id"), "own")
    first = own.where("vec_id = root").select("root", F.col("u").alias("top"))
    product = F.aggregate(F.zip_with("u", "top", lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
    angle = F.acos(F.least(F.greatest(product, F.lit(-1.0)), F.lit(1.0)))
    own = stored(own.join(first, "root").withColumn("shell", F.floor((angle + ANGLE_ERROR) / step).cast("int")).drop("top"), "shells")
    shells = stored(own.groupBy("root", "shell").agg(F.sum("m").alias("w"), F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("parts")), "shells")
    other = shells.select("root", F.col("shell").alias("shell_b"), F.col("w").alias("w_b"), F.col("parts").alias("parts_b"))
    both = shells.join(other, "root")
    all_link = F.col("shell") + F.col("shell_b") + 2 <= SHELLS
    none = F.abs(F.col("shell") - F.col("shell_b")) > SHELLS + 1
    sums = stored(both.where(all_link).groupBy("root", "shell").agg(F.sum("w_b").alias("all")), "sums")
    itself = F.when(2 * F.col("shell") + 2 <= SHELLS, F.col("m")).otherwise(0)
    whole = own.join(sums, ["root", "shell"]).select("vec_id", (F.col("all") - itself).alias("n"))
    part = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    tiles = both.where(~all_link & ~none & (F.col("shell") <= F.col("shell_b"))).withColumn("a", part("parts")).withColumn("b", part("parts_b"))
    tiles = tiles.where("shell < shell_b or a <= b").select("root", F.struct("shell", F.col("a").alias("part")).alias("p"), F.struct(F.col("shell_b").alias("shell"), F.col("b").alias("part")).alias("q"))
    tiles = stored(tiles.select("root", "p", "q", F.explode(F.array_distinct(F.array("p", "q"))).alias("x")), "tiles")
    dealt = own.join(shells.select("root", "shell", "parts"), ["root", "shell"]).withColumn("x", F.struct("shell", F.pmod(F.xxhash64("vec_id"), "parts").cast("int").alias("part")))
    pairs = tiles.join(dealt.select("root", "x", "vec_id", "u", "m"), ["root", "x"])
    pairs = pairs.select("root", "p", "q", (F.col("x") == F.col("p")).alias("first"), (F.col("p") == F.col("q")).alias("one"), "vec_id", "u", "m")

    def count(g: pd.DataFrame) -> pd.DataFrame:
        ids, x, m = g["vec_id"].to_numpy(), np.stack(g["u"]), g["m"].to_numpy()
        if g["one"].iloc[0]:
            s = x @ x.T
            np.fill_diagonal(s, -2)
            n = (s >= threshold) @ m
        else:
            a = g["first"].to_numpy()
            s = x[a] @ x[~a].T >= threshold
            n = np.zeros(len(ids), dtype=np.int64)
            n[a], n[~a] = s @ m[~a], m[a] @ s
        return pd.DataFrame({"vec_id": ids, "n": n})

    kind = rows.schema["vec_id"].dataType.simpleString()
    compared = pairs.groupBy("root", "p", "q").applyInPandas(count, f"vec_id {kind}, n long")
    nothing = own.select("vec_id", F.lit(0).cast("long").alias("n"))
    return whole.union(compared).union(nothing).groupBy("vec_id").agg(F.sum("n").alias("n"))


def links_of(rows: DataFrame, lists: DataFrame, equals: DataFrame, size: int, trees: range, threshold: float, most: int) -> DataFrame:
    """vec_id, n_links, root of the distinct vectors with links; equal vectors (vec_id, m) count."""
    edges, found, full = bridged(rows, lists, size, trees, threshold, most)
    roots = found.join(full, "vec_id").select("root").distinct()
    large = stored(found.join(roots, "root").select("vec_id", "root"), "large")
    counted = lambda x, key: x.join(equals.select(F.col("vec_id").alias(key), "m"), key, "left").withColumn("m", F.coalesce("m", F.lit(1)))
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    short = both.join(large.select(F.col("vec_id").alias("a")), "a", "left_anti")
    few = counted(short, "b").groupBy(F.col("a").alias("vec_id")).agg(F.sum("m").alias("n"))
    if not large.isEmpty():
        few = few.union(enlarged(counted(large.select("vec_id").join(rows.select("vec_id", "u"), "vec_id"), "vec_id"), large, threshold))
    done = found.join(few, "vec_id").join(equals.select("vec_id", "m"), "vec_id", "full")
    return done.select("vec_id", (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(1)) - 1).alias("n_links"), F.coalesce("root", "vec_id").alias("root"))


def audit(every: DataFrame, rows: DataFrame, links: DataFrame, size: int, count: int, threshold: float) -> float:
    """Share of vectors with all their links found, of those with links; the lesser of two samples of about AUDIT by hash.

    One sample is of all vectors, one of those that have SMALL true links at most: a large group says nothing of them.
    Vectors for which few links were found make up a sample of their own, as these may have lost some. `every` has the
    equal vectors too, which are compared like all others.
    """
    few = links.where(F.col("n_links") > SMALL).select("vec_id")
    scarce = rows.join(few, "vec_id", "left_anti")
    paired = scarce.join(links.select("vec_id"), "vec_id", "left_semi")
    taken = lambda x, n, salt: x.where(F.pmod(F.xxhash64(F.lit(salt), "vec_id"), F.lit(max(1, n // AUDIT))) == 0).select("vec_id", "u")
    sample = taken(rows, count, 5).union(taken(scarce, scarce.count(), 6)).union(taken(paired, paired.count(), 7))
    asked = sample.dropDuplicates(["vec_id"]).toArrow()  # about 3 * AUDIT vectors
    if not asked.num_rows:
        return 1.0
    q, ids = np.array(asked["u"].to_pylist()).reshape(-1, size), asked["vec_id"].to_numpy()

    def run(batches):
        total = np.zeros(len(ids), dtype=np.int64)
        for batch in batches:
            x, own = _matrix(batch.column(1), size), batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(x), 4096):
                same = ids[:, None] == own[None, at : at + 4096]
                total += ((q @ x[at : at + 4096].T >= threshold) & ~same).sum(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], names=["vec_id", "n"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    true = every.select("vec_id", "u").mapInArrow(run, f"vec_id {kind}, n long").groupBy("vec_id").agg(F.sum("n").alias("n"))
    got = true.where("n > 0").join(links, "vec_id", "left").select((F.col("n") <= SMALL).alias("small"), (F.coalesce("n_links", F.lit(0)) >= F.col("n")).cast("int").alias("whole"))
    shares = got.agg(F.avg("whole"), F.avg(F.when(F.col("small"), F.col("whole")))).first()
    return min((x for x in shares if x is not None), default=1.0)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, most: int = NEIGHBOURS) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id (the smallest vec_id that links lead to), kept, and the recall that
    the audit found (the same in all rows; 1 if no vector of the sample has links)."""
    every = units(vectors)
    lengths = [r[0] for r in every.select(F.size("u").alias("d")).groupBy("d").count().collect()]  # as many as there are lengths
    distinct, first = collapsed(every)
    found, least = None, 1.0
    for size in lengths:
        rows = distinct.where(F.size("u") == size)
        same = every.where(F.size("u") == size)
        equals = first.where("vec_id = first").join(rows.select("vec_id"), "vec_id", "left_semi").select("vec_id", "m")
        count = rows.count()
        n = trees_for(count, threshold)
        lists = graph(rows, size, count, range(n), threshold, most)
        links = stored(links_of(rows, lists, equals, size, range(n), threshold, most), "links")
        for more in range(1, RETRIES + 2):
            if (recall := audit(same, rows, links, size, count, threshold)) >= AUDIT_RECALL:
                break
            if more > RETRIES:
                raise RuntimeError(f"{recall:.4f} of the audited vectors have all their links, less than {AUDIT_RECALL}")
            trees = range(n << (more - 1), n << more)
            lists = graph(rows, size, count, trees, threshold, most, lists)
            links = stored(links_of(rows, lists, equals, size, trees, threshold, most), "links")
        least = min(least, recall)
        found = links if found is None else found.union(links)
    ids = vectors.select("vec_id")
    if found is None:
        done = ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    else:
        others = first.where("vec_id <> first").join(found.withColumnRenamed("vec_id", "first"), "first").select("vec_id", "n_links", "root")
        told = stored(found.union(others), "told")
        done = ids.join(told, "vec_id", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "vec_id").alias("component_id"))
    return done.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))).withColumn("audited_recall", F.lit(least))


def op5_nn_descent(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
