"""Language-model scores by context-tree weighting over binary-decomposed bytes.

A byte is coded as eight binary decisions. Each decision has a context tree over the preceding bytes, of depth DEPTH;
its nodes hold Krichevsky-Trofimov estimates and are weighted over all depths (Willems, Shtarkov and Tjalkens 1995). The
block probability of an estimate depends on its two counts only, so the tree that sequential coding of the training texts
would leave follows from counts of DEPTH + 1 bytes in a row, which are summed over the cluster. A text is then scored by
that tree; it is not changed by the text scored.

The tree holds every context of the training texts, and grows with them; an unseen context is an empty node. It is never
in one place: what its contexts say above depth TOP is bounded (65,536 contexts) and sent to all; the subtrees below are
dealt by the last TOP bytes. A task fits its subtrees and scores the runs of bytes that occur after them, once per chunk
of texts; the chunks' texts then meet the scores of their runs.

Beside it, the word baseline: add-one-half unigrams with exact counts. The counts of the most frequent words (at most
COMMON) are broadcast; the other words of each text meet their counts by a join.

Defined results: a null text is an empty one: one end token, and the end symbol's probability as its score; a null
doc_id has the checksum of an empty one; repeated rows count and are scored each; without training rows the model is
uniform over bytes and each token has probability one; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import discard, rows_of, stored, table

DEPTH, TOP = 5, 2
#: Rows of runs that a part of the tree is meant for; bytes of text of a chunk.
PART, CHUNK = 1 << 20, 32 << 20
COMMON = 1 << 18
#: The byte that stands for both ends of a text; UTF-8 has no such byte.
END = 0xFF
#: Distinct words or byte runs that a task counts before it sends them on.
HELD_WORDS, HELD_RUNS = 400_000, 1_500_000
#: The key of the end token: longer than any word's key.
END_KEY = b"\x00" * 17


def held_out(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 1


# ---------------------------------------------------------------- the context tree


def runs(text: bytes, depth: int) -> np.ndarray:
    """For each byte of the text and its end: the byte in the low bits, before it the preceding ones."""
    b = np.frombuffer(bytes([END]) * depth + text + bytes([END]), dtype=np.uint8)
    n, out = len(text) + 1, np.zeros(len(text) + 1, dtype=np.uint64)
    for k in range(depth + 1):
        out |= b[depth - k : depth - k + n].astype(np.uint64) << np.uint64(8 * k)
    return out


def summed(keys: np.ndarray, *weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct sorted keys and, for each, the sums of the weights."""
    if not len(keys):
        return keys, *weights
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], *(np.add.reduceat(w[order], first) for w in weights)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural logarithm of the block probability of counts."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series from 8 on, by the recurrence below."""
    x = np.asarray(x, dtype=np.float64)
    low, y = np.zeros_like(x), x.copy()
    for _ in range(8):
        small = y < 8
        low[small] -= np.log(y[small])
        y[small] += 1
    z = 1 / (y * y)
    return low + (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y


def decisions(runs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From counts by (context, byte): nodes (context, decision 1 to 255) and their counts of 0 and 1."""
    context, byte = runs >> np.uint64(8), (runs & np.uint64(255)).astype(np.int64)
    keys, zeros, ones = [], [], []
    for level in range(8):
        step = (1 << level) | (byte >> (8 - level))
        bit = byte >> (7 - level) & 1
        k, z, o = summed(context << np.uint64(8) | step.astype(np.uint64), n * (1 - bit), n * bit)
        keys.append(k)
        zeros.append(z)
        ones.append(o)
    key = np.concatenate(keys)
    order = np.argsort(key)
    return key[order], np.concatenate(zeros)[order].astype(np.float64), np.concatenate(ones)[order].astype(np.float64)


class Tree:
    """Per depth: the sorted contexts, the sorted nodes, and for each node the chances of a 0 and of a 1 where a text's
    context ends in it. `passed` is of the last depth: the sums so far of either chance, and the weight left for what is deeper.

    Both chances are kept: next to one, a float can't tell what is left for the other.
    """

    def __init__(self, depth: int):
        self.depth, self.passed = depth, np.zeros((0, 3))
        self.contexts: list[np.ndarray] = []
        self.nodes: list[np.ndarray] = []
        self.chances: list[np.ndarray] = []

    @classmethod
    def fit(cls, run: np.ndarray, n: np.ndarray, depth: int) -> Tree:
        """The whole tree of runs of depth + 1 bytes with their numbers."""
        return cls(depth).grown(_bottom(run, n, 0, depth))

    def grown(self, levels: list[tuple]) -> Tree:
        """With the levels that follow its own added."""
        out, passed = Tree(self.depth), self.passed
        first = np.searchsorted(self.nodes[-1], _parents(levels[0][0], len(self.nodes) - 1)) if self.nodes else None
        out.contexts, out.nodes, out.chances = list(self.contexts), list(self.nodes), list(self.chances)
        for k, (key, zeros, ones, _, beta, up) in enumerate(levels):
            above = up if k else first
            before = np.tile([0.0, 0.0, 1.0], (len(key), 1)) if above is None else passed[above]
            own = before[:, 2:] * (beta / (zeros + ones + 1))[:, None] * (np.column_stack([zeros, ones]) + 0.5) + before[:, :2]
            left = before[:, 2] * (1 - beta)
            passed = np.column_stack([own, left])
            out.contexts.append(_contexts(key))
            out.nodes.append(key)
            out.chances.append(own + 0.5 * left[:, None])
        out.passed = passed
        return out

    def log2(self, runs: np.ndarray) -> np.ndarray:
        """log2 of the chance of each run's last byte after the others."""
        n, byte = len(runs), (runs & np.uint64(255)).astype(np.int64)
        context = runs >> np.uint64(8)
        deepest = np.zeros(n, dtype=np.int64)
        for d in range(1, self.depth + 1):
            own = context & np.uint64((1 << 8 * d) - 1)
            deepest[(deepest == d - 1) & _found(self.contexts[d], own)[1]] = d
        total = np.zeros(n)
        for level in range(8):
            step = ((1 << level) | (byte >> (8 - level))).astype(np.uint64)
            bit = byte >> (7 - level) & 1
            chance, todo = np.full(n, 0.5), np.ones(n, dtype=bool)
            for d in range(self.depth, -1, -1):
                look = np.flatnonzero(todo & (deepest >= d))
                if not len(look):
                    continue
                key = (context[look] & np.uint64((1 << 8 * d) - 1)) << np.uint64(8) | step[look]
                at, there = _found(self.nodes[d], key)
                look = look[there]
                chance[look] = self.chances[d][at[there], bit[look]]
                todo[look] = False
            total += np.log2(chance)
        return total


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def bits(texts: list[bytes], scores: Looked) -> np.ndarray:
    """Code length of each text and its end, in bits."""
    out, held, owners = np.zeros(len(texts)), [], []
    for k, text in enumerate(texts):
        for at in range(0, len(text) + 1, 1 << 22):
            held.append(_part(text, at, scores.depth))
            owners.append(k)
    sizes = np.array([len(x) for x in held])
    value = scores(np.concatenate(held))
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    np.subtract.at(out, owners, np.add.reduceat(value.astype(np.float64), first))
    return out


class Looked:
    """log2 chances of runs out of a table of them."""

    def __init__(self, runs: np.ndarray, values: np.ndarray, depth: int):
        order = np.argsort(runs)
        self.keys, self.values, self.depth = runs[order], values[order], depth

    def __call__(self, runs: np.ndarray) -> np.ndarray:
        new, back = np.unique(runs, return_inverse=True)
        at, there = _found(self.keys, new)
        if not there.all():
            raise RuntimeError("the texts of a chunk were not those that were counted")
        return self.values[at][back]


class Chunks:
    """Numbers of the chunks of a partition's texts, in their order; _row is numbered along."""

    def __init__(self):
        from pyspark import TaskContext

        self.part, self.held, self.row = TaskContext.get().partitionId(), 0, 0

    def __call__(self, size: int) -> int:
        chunk = self.part << 24 | self.held // CHUNK
        self.held += size + 1
        self.row += 1
        return chunk


def chunked(docs: DataFrame) -> DataFrame:
    """docs with _chunk and _row."""

    def run(batches):
        chunks = Chunks()
        for batch in batches:
            sizes = batch.column(batch.schema.get_field_index("text")).cast(pa.large_binary())
            row = chunks.part << 40 | chunks.row
            number = [chunks(len(v.as_buffer()) if v.is_valid else 0) for v in sizes]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(number, pa.int64()), pa.array(range(row, row + len(number)), pa.int64())], names=[*batch.schema.names, "_chunk", "_row"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{kinds}, _chunk long, _row long")


def count_runs(docs: DataFrame, depth: int) -> DataFrame:
    """_chunk, run, n (in texts that are not held out) of docs (text, held_out); a run may have several rows."""

    def count(batches):
        chunks, now = Chunks(), None
        kept, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        waiting: list[tuple[np.ndarray, bool]] = []

        def joined():
            keys, weights = [kept], [n]
            for held in (False, True):
                if some := [x for x, h in waiting if h == held]:
                    new = np.sort(np.concatenate(some))
                    first = np.flatnonzero(np.r_[True, new[1:] != new[:-1]])
                    keys.append(new[first])
                    weights.append(np.diff(np.r_[first, len(new)]) * (not held))
            waiting.clear()
            return summed(np.concatenate(keys), np.concatenate(weights))

        def rows():
            for at in range(0, len(kept), 100_000):
                part = kept[at : at + 100_000].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), now)), pa.array(part), pa.array(n[at : at + 100_000])], names=["_chunk", "run", "n"])

        for batch in batches:
            held = batch.column(batch.schema.get_field_index("held_out"))
            for start, texts in rows_of(batch, "text"):
                for k, text in enumerate(texts):
                    text = text or b""
                    if (chunk := chunks(len(text))) != now:
                        kept, n = joined()
                        yield from rows()
                        kept, n, now = kept[:0], n[:0], chunk
                    for at in range(0, len(text) + 1, 1 << 22):
                        waiting.append((_part(text, at, depth), held[start + k].as_py()))
                if sum(len(x) for x, _ in waiting) >= 1 << 21:
                    kept, n = joined()
                    if len(kept) > HELD_RUNS:
                        yield from rows()
                        kept, n = kept[:0], n[:0]
        kept, n = joined()
        yield from rows()

    return docs.select("text", "held_out").mapInArrow(count, "_chunk long, run long, n long")


def _part(text: bytes, at: int, depth: int) -> np.ndarray:
    """Runs of the bytes at, at + 1, ... of a text, 4 Mi at most; the last part has the end too."""
    size = 1 << 22
    if len(text) < size:
        return runs(text, depth)
    found = runs(text[max(0, at - depth) : at + size], depth)[min(at, depth) :]
    return found if at + size > len(text) else found[:size]


def _parents(key: np.ndarray, d: int) -> np.ndarray:
    """The nodes of depth d above nodes of depth d + 1."""
    return (key >> np.uint64(8) & np.uint64((1 << 8 * d) - 1)) << np.uint64(8) | key & np.uint64(255)


def raised(level: tuple, low: int, depth: int) -> list[tuple]:
    """From the nodes (key, zeros, ones, weighted) of depth `depth` those of each depth from low on, with beta and up.

    A level is key, zeros, ones, weighted, beta, up: the share of its own estimate, and where its parent is.
    """
    key, zeros, ones, weighted = level
    out = [[key, zeros, ones, weighted, np.ones(len(key)), None]]
    for d in range(depth - 1, low - 1, -1):
        key, zeros, ones = summed(above := _parents(key, d), zeros, ones)
        up = out[-1][5] = np.searchsorted(key, above)
        estimate = log_kt(zeros, ones)
        weighted = np.logaddexp(estimate, np.bincount(up, weighted, len(key))) - np.log(2)
        out.append([key, zeros, ones, weighted, np.exp(estimate - np.log(2) - weighted), None])
    return [tuple(x) for x in out[::-1]]


def _bottom(run: np.ndarray, n: np.ndarray, low: int, depth: int) -> list[tuple]:
    """The levels from low to depth of the training runs among these."""
    run, n = summed(run, n)
    run, n = run[n > 0], n[n > 0]
    key, zeros, ones = decisions(run, n)
    return raised((key, zeros, ones, log_kt(zeros, ones)), low, depth)


def _contexts(key: np.ndarray) -> np.ndarray:
    return np.unique(key >> np.uint64(8))


def dealt(counted: DataFrame, depth: int, part: int) -> DataFrame:
    """counted with _part: the subtrees that a run may be in have the same last bytes of the context."""
    parts = max(1, -(-counted.count() // part))
    last = F.shiftrightunsigned("run", 8).bitwiseAND(F.lit((1 << 8 * min(TOP, depth)) - 1))
    return counted.withColumn("_part", F.pmod(F.xxhash64(last), F.lit(parts)).cast("int"))


def top_tree(counted: DataFrame, depth: int) -> Tree:
    """The tree above depth TOP, out of the nodes at that depth; counted as dealt gives it."""
    low = min(TOP, depth)

    def fit(g: pd.DataFrame) -> pd.DataFrame:
        key, zeros, ones, weighted, _, _ = _bottom(g["run"].to_numpy().view(np.uint64), g["n"].to_numpy(), low, depth)[0]
        return pd.DataFrame({"key": key.view(np.int64), "zeros": zeros, "ones": ones, "weighted": weighted})

    rows = counted.where("n > 0").groupBy("_part", "run").agg(F.sum("n").alias("n")).groupBy("_part")
    found = rows.applyInPandas(fit, "key long, zeros double, ones double, weighted double").toArrow()  # at most 65,536 contexts
    key, zeros, ones, weighted = (found[k].to_numpy() for k in range(4))
    order = np.argsort(key.view(np.uint64))
    return Tree(depth).grown(raised((key.view(np.uint64)[order], zeros[order], ones[order], weighted[order]), 0, low)[:low])


def scored(counted: DataFrame, depth: int, part: int = PART) -> DataFrame:
    """_chunk, run, value: log2 of the chance of the run's last byte by the tree of all training runs."""
    counted, low = dealt(counted, depth, part), min(TOP, depth)
    sent = counted.sparkSession.sparkContext.broadcast(top_tree(counted, depth))

    def value(g: pd.DataFrame) -> pd.DataFrame:
        run = g["run"].to_numpy().view(np.uint64)
        tree = sent.value.grown(_bottom(run, g["n"].to_numpy(), low, depth))
        new, back = np.unique(run, return_inverse=True)
        out = pd.DataFrame({"_chunk": g["_chunk"], "run": g["run"], "value": tree.log2(new).astype(np.float32)[back]})
        return out.drop_duplicates(["_chunk", "run"])

    return counted.select("_part", "_chunk", "run", "n").groupBy("_part").applyInPandas(value, "_chunk long, run long, value float")


# ---------------------------------------------------------------- the word baseline


def key_of(word: bytes) -> bytes:
    """A word of up to 15 bytes itself, or 16 bytes of digest."""
    return word if len(word) < 16 else blake2b(word, digest_size=16).digest()


def count_words(docs: DataFrame) -> DataFrame:
    """key binary, n long over all texts, their ends included."""

    def count(batches):
        n = Counter()
        for batch in batches:
            for _, texts in rows_of(batch, "text"):
                for text in texts:
                    n.update((text or b"").lower().split())
                n[None] += len(texts)  # their ends
                if len(n) > HELD_WORDS:
                    yield from _rows(n)
                    n.clear()
        yield from _rows(n)

    def _rows(n):
        keys, values = [END_KEY if w is None else key_of(w) for w in n], list(n.values())
        for at in range(0, len(keys), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(keys[at : at + 50_000], pa.binary()), pa.array(values[at : at + 50_000], pa.int64())], names=["key", "n"])

    return docs.select("text").mapInArrow(count, "key binary, n long").groupBy("key").agg(F.sum("n").alias("n"))


def common_words(counted: DataFrame, most: int = COMMON) -> tuple[dict[bytes, float], int]:
    """Logarithms of the counts plus one half of at most `most` frequent words, and the least count among them."""
    step = F.floor(F.log2("n") * 8)
    sizes = sorted(counted.groupBy(step.alias("step")).count().collect(), reverse=True)  # a few hundred rows
    held, least = 0, None
    for s, rows in sizes:
        if held + rows > most:
            break
        held, least = held + rows, s
    if least is None:
        return {}, 1 << 62
    at = next(n for n in range(int(2 ** (least / 8)), 1 << 62) if int(np.floor(np.log2(n) * 8 + 1e-9)) >= least) if least else 1
    found = counted.where(F.col("n") >= at).toArrow()
    return dict(zip(found["key"].to_pylist(), np.log10(found["n"].to_numpy() + 0.5).tolist(), strict=True)), at


def rated(docs: DataFrame, values: DataFrame, common: dict[bytes, float], depth: int) -> DataFrame:
    """Per row: _row, doc_id, held_out, n_tokens, the common words' number and sum, bits, and the other words' keys.

    The texts of a chunk meet the values (_chunk, run, value) of their runs.
    """
    sent = docs.sparkSession.sparkContext.broadcast(({k: v for k, v in common.items() if k != END_KEY}, common.get(END_KEY)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["_row", "doc_id", "held_out", "n_tokens", "n_common", "common_log", "bits", "rest"]

    def rate(left: pa.Table, right: pa.Table) -> pa.Table:
        scores = Looked(right["run"].to_numpy().view(np.uint64), right["value"].to_numpy(), depth)
        (common, end), out = sent.value, []
        for batch in left.to_batches():
            for first, texts in rows_of(batch, "text", 2 << 20):
                texts = [t or b"" for t in texts]
                n_tokens, n_common, total, rest = [], [], [], []
                for text in texts:
                    words = text.lower().split()
                    n_tokens.append(len(words) + 1)
                    got = [*map(common.get, words), end]
                    other = []
                    if None in got:
                        for k in [k for k, x in enumerate(got) if x is None]:
                            key = key_of(words[k]) if k < len(words) else END_KEY
                            got[k] = common.get(key, 0.0)  # a long word is known by its key, an uncommon one not at all
                            if key not in common:
                                other.append(key)
                    n_common.append(len(got) - len(other))
                    total.append(sum(got))
                    rest.append(other)
                columns = {c: batch.column(batch.schema.get_field_index(c)).slice(first, len(texts)) for c in names[:3]}
                columns |= {"n_tokens": pa.array(n_tokens, pa.int64()), "n_common": pa.array(n_common, pa.int64()), "common_log": pa.array(total, pa.float64()), "bits": pa.array(bits(texts, scores)), "rest": pa.array(rest, pa.list_(pa.binary()))}
                out.append(pa.RecordBatch.from_pydict(columns))
        types = [pa.int64(), left.schema.field("doc_id").type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary())]
        return pa.Table.from_batches(out, pa.schema(list(zip(names, types, strict=True))))

    texts = chunked(docs.select("doc_id", "held_out", "text"))
    return texts.groupBy("_chunk").cogroup(values.groupBy("_chunk")).applyInArrow(rate, f"_row long, doc_id {kind}, held_out boolean, n_tokens long, n_common long, common_log double, bits double, rest array<binary>")


def score(docs: DataFrame, depth: int = DEPTH, part: int = PART, common: int = COMMON) -> DataFrame:
    """Scores documents (doc_id, text) by models of those that aren't held out; `part` sets only how the work is dealt.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte, the code length
    with the end's share.
    """
    docs = docs.select("doc_id", "text", held_out().alias("held_out"))
    train = docs.where(~F.col("held_out"))
    words = stored(count_words(train), "words")
    n, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    frequent, least = common_words(words, common)
    counted = stored(count_runs(docs, depth), "runs")
    rows = stored(rated(docs, scored(counted, depth, part), frequent, depth), "rated")
    discard(counted)
    others = rows.select("_row", F.explode("rest").alias("key")).groupBy("_row", "key").agg(F.count(F.lit(1)).alias("m"))
    met = others.join(words.where(F.col("n") < least), "key", "left")
    rest = met.groupBy("_row").agg(F.sum(F.when(F.col("n").isNotNull(), F.col("m")).otherwise(0)).alias("rest_known"), F.sum(F.col("m") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rest_log"))
    whole = float(np.log10(n + 0.5 * (v + 1)))
    known = F.col("n_common") + F.coalesce("rest_known", F.lit(0))
    base = F.col("common_log") + F.coalesce("rest_log", F.lit(0.0)) - F.col("n_tokens") * F.lit(whole)
    return rows.drop("rest").join(rest, "_row", "left").select("doc_id", "held_out", "n_tokens", known.alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), (-F.col("bits") * float(np.log10(2))).alias("score"))


def op9_context_tree_weighting(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
