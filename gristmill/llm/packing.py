"""Best-fit packing of tokenised documents with Martello-Toth dominance reduction.

Only the lengths of the pieces decide a packing, and a length is at most the capacity. So the instance is a histogram of
at most `capacity` counts, however many documents there are: the driver reduces and packs that histogram, and the plan
it makes (ranges of equal bins) is applied to the pieces by their rank among the pieces of their length.

Defined results: a null text is an empty one; a document always has at least its end id; repeated rows are packed as
documents of their own; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm.common import file_bytes, one_thread, rows_of, small_batches, stored, table, worker_cache

CAPACITY, END_ID = 4096, 1
#: Pieces of one length that are numbered together, so that a very common length is no single group; so many groups beyond
#: one a length at most (they grow then).
GROUP, GROUPS = 256, 1 << 16
#: Entries of a worker's cache of pre-tokens, after which it starts anew (about 200 bytes each).
CACHE_PARTS = 700_000
#: Texts of these characters (ASCII but controls, Latin letters) are lower-cased and cut here; others go through the library.
_LETTERS = "a-zß-öø-įĵ-ķĺ-ň"
_SIMPLE = re.compile(f"[\t-\r -~À-ÖØ-öø-įĴ-ķĹ-ň]*").fullmatch
#: The pre-tokeniser pattern that the vocabulary file states, for those characters.
_PRETOKENS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\\s{_LETTERS}0-9]+").findall


class WordIds:
    """Ids of a text as little-endian unsigned 32-bit integers, by a cache of pre-tokens.

    The vocabulary encodes each pre-token apart, so the ids of a text are those of its pre-tokens in a row.
    """

    def __init__(self, vocabulary: str | bytes, most: int = CACHE_PARTS):
        """vocabulary: a file's path or what it holds; most: entries of the cache."""
        one_thread()
        self.most = most
        from tokenizers import Tokenizer

        raw = file_bytes(vocabulary) if isinstance(vocabulary, str) else vocabulary
        self.tokenizer, self.parts = Tokenizer.from_str(raw.decode()), {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4").tobytes()

    def learn(self, parts: list[str]) -> None:
        """Encodes pre-tokens with blanks between them; the vocabulary marks the last id of each."""
        if len(self.parts) + len(parts) > self.most:
            self.parts.clear()
        for at in range(0, len(parts), 2000):
            some = parts[at : at + 2000]
            raw = self._whole(" ".join(some))
            ends = np.flatnonzero(self.ends[np.frombuffer(raw, dtype="<u4")]) + 1
            if len(ends) == len(some):
                bounds = [0, *(4 * ends).tolist()]
                self.parts.update(zip(some, (raw[a:b] for a, b in zip(bounds, bounds[1:], strict=False)), strict=True))
            else:
                self.parts.update((x, self._whole(x)) for x in some)

    def __call__(self, texts: list[bytes | None]) -> list[bytes]:
        out: list = []
        missed: dict[str, None] = {}
        waiting = []
        for raw in texts:
            text = (raw or b"").decode("utf-8", "replace")
            if "<|" in text or not _SIMPLE(text):
                out.append(self._whole(text))
                continue
            parts = _PRETOKENS(text.lower())
            ids = list(map(self.parts.get, parts))
            if None in ids:
                new = [k for k, x in enumerate(ids) if x is None]
                missed.update((parts[k], None) for k in new)
                waiting.append((len(out), [parts[k] for k in new], new))
                out.append(ids)
            else:
                out.append(b"".join(ids))
        if missed:
            self.learn(list(missed))
            for at, parts, new in waiting:
                for k, part in zip(new, parts, strict=True):
                    out[at][k] = self.parts[part]
                out[at] = b"".join(out[at])
        return out


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, most: int = CACHE_PARTS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if wanted, ids."""
    end = np.array([end_id], dtype="<u4").tobytes()
    kind = docs.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(file_bytes(tokenizer))

    def cut(batches):
        coder = worker_cache("packing").setdefault(tokenizer, None) or WordIds(sent.value, most)
        worker_cache("packing")[tokenizer] = coder
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            for first, texts in rows_of(batch, "text"):
                at, piece, start, length, crc, kept = [], [], [], [], [], []
                for k, found in enumerate(coder(texts)):
                    found += end
                    for n, p in enumerate(range(0, len(found), 4 * capacity)):
                        part = found[p : p + 4 * capacity]
                        at.append(first + k)
                        piece.append(n)
                        start.append(p // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            kept.append(np.frombuffer(part, dtype="<u4").astype(np.int32))
                columns = [ids.take(pa.array(at, pa.int32())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(kept, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return small_batches(docs).select("doc_id", "text").mapInArrow(cut, schema)


class Instance:
    """Counts by length, with the plan so far: rows (length, first rank, bins, first bin, offset, pieces of a bin)."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.bins, self.plan = capacity, 0, []
        self.counts = np.zeros(capacity + 1, dtype=np.int64)
        for length, n in counts.items():
            self.counts[length] = n
        self.used = np.zeros(capacity + 1, dtype=np.int64)

    def take(self, length: int, bins: int, first: int, offset: int, each: int = 1) -> None:
        self.plan.append((length, int(self.used[length]), bins, first, offset, each))
        self.used[length] += bins * each
        self.counts[length] -= bins * each

    def fix(self, sizes: list[int], times: int) -> None:
        """times new bins of one piece of each of the sizes."""
        offset = 0
        for s in sizes:
            self.take(s, times, self.bins, offset)
            offset += s
        self.bins += times


def reduce_by_dominance(x: Instance) -> int:
    """Martello-Toth reduction: fixes sets of up to three pieces that dominate all other sets with the same piece.

    For a piece j with room r = capacity - j beside it: alone if nothing fits; with the largest fitting piece if that
    fills the bin, if no two pieces fit, or if at most two fit and no pair of them is larger; with the best pair if it
    holds the largest fitting piece and no two pieces larger than its smaller one fit. Returns the bins fixed.
    """
    before, changed = x.bins, True
    while changed:
        changed = False
        j = int(np.flatnonzero(x.counts).max(initial=0))
        while j > 0:
            if times := _fix_with(x, j):
                changed = True
            if not times or not x.counts[j]:
                below = np.flatnonzero(x.counts[:j])
                j = int(below[-1]) if len(below) else 0
    return x.bins - before


def _fix_with(x: Instance, j: int) -> int:
    room = x.capacity - j
    free = x.counts.copy()
    free[j] -= 1
    fits = np.flatnonzero(free[: room + 1] > 0)
    if not len(fits):
        times = int(x.counts[j])
        x.fix([j], times)
        return times
    best = int(fits[-1])
    smallest = np.repeat(fits[:3], np.minimum(free[fits[:3]], 3))[:3]
    two, three = len(smallest) > 1 and smallest[:2].sum() <= room, len(smallest) > 2 and smallest.sum() <= room
    if best == room or not two:
        return _times(x, [j, best])
    if three:
        return 0
    pair = _best_pair(free, fits, room)
    if best >= sum(pair):
        return _times(x, [j, best])
    larger = np.flatnonzero(free[pair[1] + 1 : room + 1] > 0)[:2] + pair[1] + 1
    larger = np.repeat(larger, np.minimum(free[larger], 2))[:2]
    if pair[0] == best and (len(larger) < 2 or larger.sum() > room):
        return _times(x, [j, *pair], one=True)
    return 0


def _times(x: Instance, sizes: list[int], one: bool = False) -> int:
    """Fixes the set as often as its pieces last, or once where what fits may change after it."""
    need = defaultdict(int)
    for s in sizes:
        need[s] += 1
    times = 1 if one else int(min(x.counts[s] // n for s, n in need.items()))
    if not one and sizes[0] + sizes[-1] != x.capacity:  # leave one so that the next look sees what is left
        times = max(1, times - 1)
    x.fix(sizes, times)
    return times


def _best_pair(free: np.ndarray, fits: np.ndarray, room: int) -> tuple[int, int]:
    best = (0, 0)
    for a in fits[::-1]:
        if 2 * a < sum(best):
            break
        b = fits[fits <= min(room - a, a)]
        if len(b) and b[-1] == a and free[a] < 2:
            b = b[:-1]
        if len(b) and a + b[-1] > sum(best):
            best = (int(a), int(b[-1]))
    return best


def best_fit(x: Instance) -> None:
    """Best-fit decreasing for what is left, many equal bins at a time."""
    open_bins: dict[int, list[tuple[int, int]]] = defaultdict(list)  # by room left: (first bin, bins)
    rooms = np.zeros(x.capacity + 1, dtype=bool)
    for s in np.flatnonzero(x.counts)[::-1].tolist():
        while n := int(x.counts[s]):
            found = np.flatnonzero(rooms[s:])
            if not len(found):
                each = min(x.capacity // s, n)
                bins = n // each
                first, room = x.bins, x.capacity
                x.bins += bins
            else:
                room = int(found[0]) + s
                first, bins = open_bins[room].pop()
                each = min(room // s, n)
                if (take := min(bins, n // each)) < bins:
                    open_bins[room].append((first + take, bins - take))
                bins = take
                rooms[room] = bool(open_bins[room])
            x.take(s, bins, first, x.capacity - room, each)
            if left := room - each * s:
                open_bins[left].append((first, bins))
                rooms[left] = True


def plan_of(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, dict]:
    """Rows (length, first rank, bins, first bin, offset, pieces of a bin), sorted by length and rank, and figures."""
    x = Instance(counts, capacity)
    fixed = reduce_by_dominance(x)
    best_fit(x)
    total = sum(length * n for length, n in counts.items())
    plan = np.array(sorted(x.plan), dtype=np.int64).reshape(-1, 6)
    return plan, {"sequences": x.bins, "fixed_by_dominance": fixed, "least_possible": -(-total // capacity)}


def packed(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to rows with doc_id, piece, length and ids_crc32; found is read three times."""
    counts = {r["length"]: r["count"] for r in found.groupBy("length").count().collect()}  # at most capacity rows
    size = max(GROUP, sum(counts.values()) // GROUPS)
    parts = found.sparkSession.createDataFrame([(length, -(-n // size)) for length, n in counts.items() if n > size], "length long, _parts long")
    salt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.coalesce("_parts", F.lit(1)))
    found = found.join(F.broadcast(parts), "length", "left").withColumn("_salt", salt).select(*found.columns, "_salt")
    first = np.zeros(capacity + 1, dtype=np.int64)  # where the groups of a length begin among all
    for length, n in counts.items():
        first[length] = -(-n // size)
    first = np.cumsum(first) - first
    sizes = np.zeros(int(first[-1]) + 2 + GROUPS, dtype=np.int64)
    for length, s, n in found.groupBy("length", "_salt").count().collect():  # at most capacity + GROUPS rows
        sizes[first[length] + s] = n
    plan, _ = plan_of(counts, capacity)
    before = np.cumsum(sizes) - sizes
    before -= before[np.repeat(first, np.diff(np.r_[first, len(sizes)]))]
    span = 1 << 40
    keys = plan[:, 0] * span + plan[:, 1]
    rank = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")).cast("long") - 1
    model = found.sparkSession.sparkContext.broadcast((plan, keys, first, before))  # bounded by the capacity and GROUPS

    def assign(batches):
        plan, keys, first, before = model.value
        for batch in batches:
            length, salt, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "_salt", "_rank"))
            rank = rank + before[first[length] + salt]
            row = plan[np.searchsorted(keys, length * span + rank, side="right") - 1]
            rank = rank - row[:, 1]
            out = {"sequence_id": row[:, 3] + rank // row[:, 5], "offset": row[:, 4] + rank % row[:, 5] * length}
            kept = [c for c in batch.schema.names if c not in ("_salt", "_rank")]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept), *map(pa.array, out.values())], names=[*kept, *out])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema if f.name != "_salt")
    return found.withColumn("_rank", rank).mapInArrow(assign, f"{kept}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, most: int = CACHE_PARTS) -> DataFrame:
    """Packs documents (doc_id, text) into sequences of at most capacity ids; documents above it are cut.

    most: pre-tokens that a worker remembers, a matter of its memory and speed only.

    Returns per piece: doc_id, piece, start, length, ids_crc32, ids if wanted, sequence_id, offset.
    """
    return packed(stored(pieces(docs, tokenizer, capacity, end_id, with_ids, most), "pieces"), capacity)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), default_tokenizer())
