"""SentencePiece encoding by Gumbel top-k sampling without replacement, and decoding.

The segmentations of a text are the paths of a lattice: from each character, every piece of the vocabulary that matches
there, with a weight. Summing weights backward gives each piece its chance at its place, so a path is a row of choices.
A perturbed A-star search (Maddison et al. 2014; Kool et al. 2019) visits subtrees of choices by the largest Gumbel
perturbed log-chance in them: the best path is walked down first; at each choice the subtree of all other choices
gets a Gumbel truncated at its parent's; the queue's best subtree gives the next path. Samples come out in order of
their perturbed log-chance, distinct, as by sampling without replacement. The inclusion score of a sample is the log-chance that it passes
the threshold, the largest perturbed value that was left: log(1 - exp(-exp(log_prob - threshold))).

All randomness is a hash of the row key, the sample's number and the place in the text; so results don't depend on
partitions or retries. The lattice is cut where white space begins, as no piece of the vocabulary reaches over that.
A vocabulary of ranks (BPE) gets weights 1 / (rank + SHIFT); characters without a piece become byte pieces.

Defined results: null and empty texts have one sample without pieces; a text with fewer than k segmentations gives all;
rows with the same key and text have the same samples; a null key is a key of its own; U+2581 in a text reads as a blank;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import itertools
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from gristmill.llm.common import file_bytes, rows_of, table, worker_cache

SAMPLES, SHIFT = 2, 2.7
BLANK = "▁"
#: Where the lattice may be cut: at white space, and between letters, digits and others if no piece has two of them.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ʯͰ-ԯḀ-ỿ"
_AT_BLANKS = re.compile(f"{BLANK}+[^{BLANK}\n]*|\n|[^{BLANK}\n]+")
_AT_KINDS = re.compile(f"{BLANK}*(?:[{_LETTERS}]+|[0-9]+|[^{BLANK}\n0-9{_LETTERS}]+)|{BLANK}+|\n")
_P, _G = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
SLICE = 8 << 20


def uniform(key: np.ndarray, stream: int, place: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from hashes."""
    h = key + np.uint64(stream * 0x632BE59BD9B4E019 % (1 << 64)) + place.astype(np.uint64) * _G
    for by in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(by)
    return ((h ^ (h >> np.uint64(32))) >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54


class Vocabulary:
    """Pieces with log weights, as hashes of their characters; hashes of their beginnings."""

    def __init__(self, vocabulary: str | bytes):
        """vocabulary: a model file's path or what it holds."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=file_bytes(vocabulary) if isinstance(vocabulary, str) else vocabulary)
        size = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(size)]
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(pieces) if model.is_byte(i)}
        usable = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)) for i in range(size)]
        scores = np.array([model.get_score(i) for i in range(size)])
        ranked = all(s == int(s) for s in scores[usable])
        order = np.argsort(np.where(usable, -scores, np.inf), kind="stable")
        rank = np.empty(size)
        rank[order] = np.arange(size)
        self.weight = -np.log(rank + SHIFT) if ranked else scores
        self.unknown = float(self.weight[usable].min())
        self.text = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(BLANK, " ").encode() if usable[i] else b"" for i, p in enumerate(pieces)]
        crossing = [p for p, ok in zip(pieces, usable, strict=True) if ok and len(_AT_KINDS.findall(p)) > 1]
        self.cut = (_AT_BLANKS if crossing else _AT_KINDS).findall
        self.longest = max(len(p) for p, ok in zip(pieces, usable, strict=True) if ok)
        self.byte_of = np.array([self.bytes.get(b, 0) for b in range(256)])
        known: dict[int, int] = {}
        for i, p in enumerate(pieces):
            if usable[i]:
                h = 0
                for c in p:
                    h = (h * int(_P) + ord(c) + 1) % (1 << 64)
                    known.setdefault(h, -1)
                if known[h] != -1:
                    raise ValueError("two pieces with one hash")
                known[h] = i
        self.hashes = np.array(sorted(known), dtype=np.uint64)
        self.ids = np.array([known[h] for h in sorted(known)])

    def look(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether a piece begins so, its id or -1)."""
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        there = self.hashes[at] == h
        return there, np.where(there, self.ids[at], -1)


class Lattice:
    """Lattices of distinct chunks, end to end: edges sorted by their start with log-chances and their running sums."""

    def __init__(self, chunks: list[str], vocabulary: Vocabulary):
        self.v = vocabulary
        self.chars = np.frombuffer("".join(chunks).encode("utf-32-le"), dtype=np.uint32)
        lengths = np.array([len(c) for c in chunks], dtype=np.int64)
        self.begin = np.concatenate([[0], np.cumsum(lengths)])
        self.end = np.repeat(self.begin[1:], lengths)
        n = len(self.chars)
        starts, ids = [], []
        at, h = np.arange(n, dtype=np.int32), np.zeros(n, dtype=np.uint64)
        room = (self.end - np.arange(n)).astype(np.int32)
        count = np.zeros(n, dtype=np.int32)  # edges from a character
        for size in range(1, vocabulary.longest + 1):
            if size > 1:
                ok = room[at] >= size
                at, h = at[ok], h[ok]
            h = h * _P + self.chars[at + (size - 1)] + np.uint64(1)
            there, found = vocabulary.look(h)
            at, h, found = at[there], h[there], found[there]
            hit = found >= 0
            starts.append(at[hit])
            ids.append(found[hit])
            count[at[hit]] += 1
            if size == 1:  # a character without a piece
                none = np.flatnonzero(count == 0).astype(np.int32)
                code = self.chars[none].astype(np.int32)
                starts[0] = np.concatenate([starts[0], none])
                ids[0] = np.concatenate([ids[0], np.where(code < 128, vocabulary.byte_of[np.minimum(code, 127)], -code)])  # -code: several bytes
                count[none] = 1
            if not len(at):
                break
        self.first = np.concatenate([[0], np.cumsum(count)])
        free = self.first[:-1].copy()
        total = int(self.first[-1])
        self.to, self.id, self.start = (np.empty(total, dtype=np.int32) for _ in range(3))
        for size, (start, found) in enumerate(zip(starts, ids, strict=True), 1):
            e = free[start]
            free[start] += 1
            self.start[e], self.to[e], self.id[e] = start, start + size, found
        bytes_of = 1 + (self.id <= -0x80) + (self.id <= -0x800) + (self.id <= -0x10000)
        weight = np.where(self.id >= 0, vocabulary.weight[np.maximum(self.id, 0)], vocabulary.unknown * bytes_of)
        self._chances(weight, room)

    def _chances(self, weight: np.ndarray, room: np.ndarray) -> None:
        """Sums of weights backward, characters at the same distance from their chunk's end together."""
        n = len(self.chars)
        beta = np.zeros(n + 1)
        after = np.where(self.to - self.start == room[self.start], n, self.to)  # the end has weight one
        longest = int(room.max(initial=0))
        left = room.astype(np.int16) if longest < 1 << 15 else room
        order = np.argsort(left, kind="stable").astype(np.int32)
        bounds = np.searchsorted(left[order], np.arange(1, longest + 2))
        for a, b in zip(bounds, bounds[1:], strict=False):
            chars = order[a:b]
            first, size = self.first[chars], self.first[chars + 1] - self.first[chars]
            group = np.cumsum(size) - size
            e = np.repeat(first - group, size) + np.arange(int(size.sum()))
            value = weight[e] + beta[after[e]]
            top = np.maximum.reduceat(value, group)
            beta[chars] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, size)), group))
        self.log = np.minimum(weight + beta[after] - beta[self.start], 0)
        total = np.cumsum(np.exp(self.log))
        self.sum = (total - np.concatenate([[0], total])[self.first[self.start]]).astype(np.float32)
        self.sum[self.first[1:] - 1] = 2.0  # rounding never leads past the last edge

    def choose(self, at: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge from each place by a number in (0, 1)."""
        e = self.first[at]
        open_ = np.flatnonzero(u >= self.sum[e])
        while len(open_):
            e[open_] += 1
            open_ = open_[u[open_] >= self.sum[e[open_]]]
        return e


class Sampler:
    """Top-k samples of a slice of texts."""

    def __init__(self, texts: list[str], keys: np.ndarray, vocabulary: Vocabulary, samples: int):
        index: dict[str, int] = defaultdict(itertools.count().__next__)
        chunk, self.count = [], []
        for t in texts:
            cut = vocabulary.cut(BLANK + t.replace(" ", BLANK)) if t else []
            chunk += map(index.__getitem__, cut)
            self.count.append(len(cut))
        self.lattice = Lattice(list(index), vocabulary)
        self.chunk = np.array(chunk, dtype=np.int64)
        lengths = np.diff(self.lattice.begin)[self.chunk] if len(chunk) else np.zeros(0, np.int64)
        self.place = np.concatenate([[0], np.cumsum(lengths)])  # of each chunk among all characters
        self.docs = np.concatenate([[0], np.cumsum(self.count)]).astype(np.int64)
        self.begin = self.place[self.docs]  # of each text
        self.owner = np.repeat(np.arange(len(texts)), self.count)
        self.keys, self.samples = keys, samples
        self.paths: list[np.ndarray] = []  # by sample: the edge that begins at a character, or -1

    def _walk(self, out: np.ndarray, which: np.ndarray, at: np.ndarray, stream: int) -> None:
        """Chooses pieces to the end of the chunks numbered `which`, from places `at` in the lattice."""
        x = self.lattice
        shift = self.place[which] - x.begin[self.chunk[which]]
        owner = self.owner[which]
        key, start = self.keys[owner], self.begin[owner]
        end = x.begin[self.chunk[which] + 1]
        while len(at):
            ok = at < end
            if not ok.all():
                at, end, shift, key, start = at[ok], end[ok], shift[ok], key[ok], start[ok]
                if not len(at):
                    break
            e = x.choose(at, uniform(key, stream, at + shift - start))
            out[at + shift] = e
            at = x.to[e]

    def run(self) -> list[list[tuple[float, float, np.ndarray]]]:
        """For each text the samples (log_prob, perturbed, edges), then (threshold,) as the last entry."""
        n_docs, total = len(self.count), int(self.place[-1])
        found: list[list] = [[] for _ in range(n_docs)]
        queue: list[list] = [[] for _ in range(n_docs)]  # (-perturbed, sample, place, excluded edges, log-chance before)
        top = -np.log(-np.log(uniform(self.keys, 1, np.zeros(n_docs))))
        path = np.full(total, -1, dtype=np.int32)
        every = np.arange(len(self.chunk))
        self._walk(path, every, self.lattice.begin[self.chunk], 2)
        self.paths.append(path)
        self._collect(path, 0, np.arange(n_docs), top, np.zeros(n_docs, np.int64), found, queue, self.samples)
        for m in range(1, self.samples):
            doc, perturbed, fork = [], [], []
            path = np.full(total, -1, dtype=np.int32)
            chunks, places = [], []
            for d in range(n_docs):
                if not queue[d]:
                    continue
                value, s, at, excluded, before = heapq.heappop(queue[d])
                doc.append(d)
                perturbed.append(-value)
                fork.append(at)
                path[self.begin[d] : at] = self.paths[s][self.begin[d] : at]
                k = int(np.searchsorted(self.place, at, side="right")) - 1
                here = int(self.lattice.begin[self.chunk[k]] + at - self.place[k])
                edge = self._other(here, excluded, d, m, at)
                path[at] = edge
                self._push(queue[d], d, m, here, at, (*excluded, edge), before, -value)
                chunks.append(k)
                places.append(int(self.lattice.to[edge]))
            if not doc:
                break
            rest = [np.arange(k + 1, self.docs[d + 1]) for k, d in zip(chunks, doc, strict=True)]
            which = np.concatenate([np.array(chunks), *rest])
            at = np.concatenate([np.array(places), *(self.lattice.begin[self.chunk[r]] for r in rest)])
            self._walk(path, which, at, 2 + m)
            self.paths.append(path)
            self._collect(path, m, np.array(doc), np.array(perturbed), np.array(fork), found, queue, self.samples - m)
        for d in range(n_docs):
            found[d].append((-queue[d][0][0] if queue[d] else -np.inf,))
        return found

    def _other(self, here: int, excluded: tuple[int, ...], d: int, m: int, at: int) -> int:
        """An edge from a place that is not excluded, by the chances of the others."""
        edges = [e for e in range(self.lattice.first[here], self.lattice.first[here + 1]) if e not in excluded]
        sums = np.cumsum(np.exp(self.lattice.log[edges]))
        u = uniform(self.keys[d : d + 1], 1000 + m, np.array([at - self.begin[d]]))[0]
        return edges[min(int(np.searchsorted(sums, u * sums[-1], side="right")), len(edges) - 1)]

    def _push(self, queue: list, d: int, m: int, here: int, at: int, excluded: tuple[int, ...], before: float, limit: float) -> None:
        """The subtree of what is left at a choice that was forked before."""
        edges = [e for e in range(self.lattice.first[here], self.lattice.first[here + 1]) if e not in excluded]
        left = float(np.exp(self.lattice.log[edges]).sum()) if edges else 0.0
        if left > 0:
            u = uniform(self.keys[d : d + 1], 2000 + m, np.array([at - self.begin[d]]))[0]
            g = -np.logaddexp(-limit, np.log(-np.log(u)) - before - np.log(left))
            heapq.heappush(queue, (-g, m, at, excluded, before))

    def _collect(self, path, m, doc, perturbed, fork, found, queue, keep) -> None:
        """Adds sample m of each text, and the subtrees beside its choices after the fork, the best `keep` of a text."""
        x = self.lattice
        limit = np.full(len(self.count), -np.inf)
        limit[doc] = perturbed
        from_ = self.begin[1:].copy()
        from_[doc] = np.maximum(fork + (m > 0), self.begin[doc])
        place = np.flatnonzero(path >= 0)
        edge = path[place]
        bounds = np.searchsorted(place, self.begin)
        owner = np.repeat(np.arange(len(self.count)), np.diff(bounds))
        log = x.log[edge]
        sums = np.concatenate([[0.0], np.cumsum(log)])
        before = sums[:-1] - sums[bounds[owner]]
        with np.errstate(divide="ignore", invalid="ignore"):
            beside = before + np.log(-np.expm1(log))
            rest = np.log(-np.log(uniform(self.keys[owner], 3000 + m, place - self.begin[owner])))
            g = -np.logaddexp(-limit[owner], rest - beside)
        g[(place < from_[owner]) | ~np.isfinite(beside)] = -np.inf
        for d, value in zip(doc.tolist(), perturbed.tolist(), strict=True):
            a, b = int(bounds[d]), int(bounds[d + 1])
            found[d].append((float(sums[b] - sums[a]), value, edge[a:b]))
            if b > a:
                best = np.argpartition(-g[a:b], min(keep, b - a - 1))[: keep + 1] if b - a > keep + 1 else np.arange(b - a)
                for k in best.tolist():
                    if g[a + k] > -np.inf:
                        heapq.heappush(queue[d], (-float(g[a + k]), m, int(place[a + k]), (int(edge[a + k]),), float(before[a + k])))

    def ids(self, edges: np.ndarray) -> np.ndarray:
        ids = self.lattice.id[edges]
        if (ids < 0).any():
            spelled = [[i] if i >= 0 else [self.lattice.v.bytes[b] for b in chr(-i).encode("utf-8", "replace")] for i in ids.tolist()]
            ids = np.array([i for part in spelled for i in part])
        return ids.astype(np.uint32)


def vocabulary_of(path: str, raw: bytes) -> Vocabulary:
    """A worker's vocabulary of a model, whose bytes the driver sent."""
    kept = worker_cache("pieces")
    if path not in kept:
        kept[path] = Vocabulary(raw)
    return kept[path]


def decoded(ids: list[int] | np.ndarray, vocabulary: Vocabulary) -> bytes:
    """The text of ids: pieces with blanks for marks, without the first blank, which encoding adds."""
    text = b"".join(map(vocabulary.text.__getitem__, ids))
    return text[1:] if text[:1] == b" " else text


def encode(docs: DataFrame, model: str, samples: int = SAMPLES, with_ids: bool = True) -> DataFrame:
    """Per row of docs (doc_id, text) up to `samples` segmentations, best first.

    Returns doc_id, sample (from 0), n_pieces, log_prob, perturbed, log_inclusion, ids_crc32, decodes (the pieces give
    back the text) and, if wanted, ids.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(file_bytes(model))

    def run(batches):
        vocabulary = vocabulary_of(model, sent.value)
        blank = BLANK.encode()
        for batch in batches:
            own = batch.column(batch.schema.get_field_index("doc_id"))
            names = own.cast(pa.string()).to_pylist()
            for first, raw in rows_of(batch, "text", SLICE):
                raw = [(t or b"").replace(blank, b" ") for t in raw]
                texts = [t.decode("utf-8", "replace") for t in raw]
                keys = np.array([xxhash.xxh3_64_intdigest("" if x is None else x, seed=x is None) for x in names[first : first + len(raw)]], dtype=np.uint64)
                sampler = Sampler(texts, keys, vocabulary, samples)
                rows: list[tuple] = []
                for k, (*found, (threshold,)) in enumerate(sampler.run()):
                    for s, (log, perturbed, edges) in enumerate(found):
                        ids = sampler.ids(edges)
                        far = log - threshold
                        score = 0.0 if threshold == -np.inf else float(np.log(-np.expm1(-np.exp(far)))) if far > -30 else far
                        rows.append((first + k, s, len(ids), log, perturbed, score, zlib.crc32(ids.astype("<u4").tobytes()), decoded(ids.tolist(), vocabulary) == texts[k].encode(), ids.astype(np.int32) if with_ids else None))
                at, *columns = zip(*rows, strict=True)
                kinds = [pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.bool_(), pa.list_(pa.int32())]
                heads = ["sample", "n_pieces", "log_prob", "perturbed", "log_inclusion", "ids_crc32", "decodes", "ids"]
                out = {"doc_id": own.take(pa.array(at, pa.int32()))} | {h: pa.array(c, t) for h, c, t in zip(heads, columns, kinds, strict=True) if with_ids or h != "ids"}
                yield pa.RecordBatch.from_pydict(out)

    schema = f"doc_id {kind}, sample int, n_pieces int, log_prob double, perturbed double, log_inclusion double, ids_crc32 long, decodes boolean" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """Adds text to rows with ids; null ids give a null text, ids out of the vocabulary an error."""
    from pyspark.sql.types import StringType, StructField, StructType

    sent = encoded.sparkSession.sparkContext.broadcast(file_bytes(model))

    def run(batches):
        vocabulary = vocabulary_of(model, sent.value)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids")).to_pylist()
            text = [None if x is None else decoded(x, vocabulary).decode("utf-8", "replace") for x in ids]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(text, pa.string())], names=[*batch.schema.names, "text"])

    rows = encoded.drop("text")
    return rows.mapInArrow(run, StructType([*rows.schema, StructField("text", StringType())]))


def op3_gumbel_topk_pieces(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)
