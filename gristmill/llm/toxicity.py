"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a text: densities of a lexicon learned from the training rows (whole words, word beginnings, words found
behind character substitutions), lexicon hits near second-person words, capitals, punctuation, obfuscation, length.
The lexicon, the trees and the calibration are fitted on a bounded sample of labelled rows (LABELLED_ROWS, in
expectation, chosen by a hash of the id), of which equal texts with the same label count once; the model depends on these
rows only, not on where they lie. Every row is scored, over its whole text.

Defined results: null and empty texts have zero features and get the score of those; labels other than 0 and 1 are left
out; a text that is labelled both ways counts as each; without positive or negative training rows every score is
the share of positive ones (0 without any); a null doc_id is scored and has the checksum of an empty one; other columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import discard, free_name, rows_of, small_batches, stored, table, worker_cache

#: Labelled rows that the lexicon, the trees and the calibration are fitted on, in expectation.
LABELLED_ROWS = 20_000
#: Lexicon terms: at least this share of the positive rows, this many of them, and this ratio of the two rates.
TERM_SHARE, TERM_ROWS, TERM_RATIO, TERMS = 0.01, 4, 15.0, 4096
BEGINNINGS = range(4, 11)
#: Words that a worker remembers what the lexicon says of.
KNOWN = 20_000
#: Terms that a task counts before it sends them on.
HELD_TERMS = 150_000
#: Parts of the sample: lexicons and margins that a row is judged by in training come from the others.
PARTS = 5
TREES, DEPTH, RATE, BINS, LEAST_HESSIAN = 60, 3, 0.2, 32, 2.0
THRESHOLD, NEAR = 0.3, 5
#: Characters of a very long text that are looked at together, and on to the next white space: no feature reaches over it
#: but the nearness of words, which is found from their places in the whole text.
CHUNK = 1 << 20
#: A word of more letters is known by these of its first letters and a digest.
LONG_WORD = 24
#: Second-person words of the four languages of the corpus, and usual substitutions for letters.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton vous votre tú ti usted ustedes vos".split())
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l", "*": None})
WORD = re.compile(r"[^\W\d_]+")
BLANK = re.compile(r"\s")
DISGUISED = re.compile(r"\b[^\W\d_]+(?:[0-9@$*!|]+[^\W\d_]+)+")
REPEATED = re.compile(r"([!?*#$%&.])\1")
NAMES = ("words", "hits", "starts", "disguised_hits", "near_you", "you", "shouted", "disguised", "repeated", "upper", "lower", "punct", "bang", "digits", "bytes")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def whole(word: str) -> str:
    """What a whole word is known by."""
    return word if len(word) <= LONG_WORD else word[:LONG_WORD] + blake2b(word.encode(), digest_size=12).hexdigest()


class Lexicon:
    """Whole words and word beginnings; remembers what it said of a word."""

    def __init__(self, words: set[str], starts: set[str]):
        self.words, self.starts = frozenset(words), frozenset(starts)
        self.known: dict[str, int] = {}

    def __call__(self, word: str) -> int:
        """1: a word of the lexicon, 2: begins like one, 0: neither."""
        if (found := self.known.get(word)) is None:
            if len(self.known) > KNOWN:
                self.known.clear()
            found = 1 if whole(word) in self.words else 2 if any(word[:k] in self.starts for k in BEGINNINGS) else 0
            self.known[word] = found
        return found


def chunks(text: str):
    """A text in parts of about CHUNK characters, cut at white space only."""
    at = 0
    while at < len(text):
        blank = BLANK.search(text, at + CHUNK)
        end = blank.end() if blank else len(text)
        yield text[at:end]
        at = end


_PUNCT = np.array([33 <= b < 48 or 58 <= b < 65 or 91 <= b < 97 or 123 <= b < 127 for b in range(256)])


def measured(raw: bytes | None, lexicon: Lexicon) -> np.ndarray:
    """The sums in NAMES over a whole text."""
    out = np.zeros(len(NAMES))
    if not raw:
        return out
    n = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    out[9:] = n[65:91].sum(), n[97:123].sum(), n[_PUNCT].sum(), n[33], n[48:58].sum(), len(raw)
    hits, you = [], []  # their places among all words, by part
    for part in chunks(raw.decode("utf-8", "replace")):
        low = part.lower()
        words = WORD.findall(low)
        said = np.fromiter(map(lexicon, words), dtype=np.int8, count=len(words))
        before = int(out[0])
        hits.append(before + np.flatnonzero(said))
        you.append(np.array([before + k for k, w in enumerate(words) if w in SECOND_PERSON], dtype=np.int64))
        out[0] += len(words)
        out[1] += (said == 1).sum()
        out[2] += (said == 2).sum()
        out[5] += len(you[-1])
        hidden = DISGUISED.findall(low)
        out[3] += sum(bool(lexicon("".join(WORD.findall(x.translate(LEET))))) for x in hidden)
        out[7] += len(hidden)
        out[6] += len(_SHOUTED.findall(part))
        out[8] += len(REPEATED.findall(part))
    if out[1] + out[2] and out[5]:
        at, y = np.concatenate(hits), np.concatenate([[-(10**12)], *you, [10**12]])
        k = np.searchsorted(y, at)
        out[4] = (np.minimum(at - y[k - 1], y[k] - at) <= NEAR).sum()
    return out


_SHOUTED = re.compile(r"\b[A-Z]{3,}\b")


def dense(sums: np.ndarray) -> np.ndarray:
    """Feature rows from rows of sums."""
    s = {name: sums[:, k] for k, name in enumerate(NAMES)}
    words, size = np.maximum(s["words"], 1), np.maximum(s["bytes"], 1)
    letters = np.maximum(s["upper"] + s["lower"], 1)
    of_words = ("hits", "starts", "disguised_hits", "near_you", "you", "shouted", "disguised")
    counts = ("hits", "starts", "disguised_hits", "near_you")
    return np.column_stack([*(s[x] / words for x in of_words), *(np.log1p(s[x]) for x in counts), s["upper"] / letters, *(s[x] / size for x in ("punct", "bang", "repeated", "digits")), np.log1p(s["words"])])


class Trees:
    """Boosted regression trees of one depth for the logistic loss, over binned features."""

    def __init__(self, cuts: list[np.ndarray], base: float):
        self.cuts, self.base = cuts, base
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # features, bins, leaf values

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(self.cuts)]) if len(x) else np.zeros((0, len(self.cuts)), int)

    @staticmethod
    def leaves(b: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
        node = np.zeros(len(b), dtype=np.int64)
        for level in range(DEPTH):
            at = (1 << level) - 1 + node
            node = 2 * node + (b[np.arange(len(b)), feature[at]] > cut[at])
        return node

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> Trees:
        cuts = [np.unique(np.quantile(c[c > c.min()], np.linspace(0, 1, BINS - 1)) if (c > c.min()).any() else c[:1]) for c in x.T]
        cuts = [np.unique(np.concatenate([[c.min()], q])) for c, q in zip(x.T, cuts, strict=True)]
        p = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        model = cls(cuts, float(np.log(p / (1 - p))))
        b, wide = model.binned(x), BINS + 2
        margin = np.full(len(y), model.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            g, h = p - y, p * (1 - p)
            feature, cut = np.zeros((1 << DEPTH) - 1, int), np.full((1 << DEPTH) - 1, wide)
            node = np.zeros(len(y), dtype=np.int64)
            for level in range(DEPTH):
                n = 1 << level
                best = np.full(n, 1e-9)
                for k in range(x.shape[1]):
                    at = node * wide + b[:, k]
                    gs, hs = (np.cumsum(np.bincount(at, v, n * wide).reshape(n, wide), axis=1) for v in (g, h))
                    gt, ht = gs[:, -1:], hs[:, -1:]
                    gain = gs**2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt**2 / (ht + 1)
                    gain[(hs < LEAST_HESSIAN) | (ht - hs < LEAST_HESSIAN)] = 0
                    at = gain.argmax(axis=1)
                    found = gain[np.arange(n), at]
                    for q in np.flatnonzero(found > best):
                        best[q], feature[n - 1 + q], cut[n - 1 + q] = found[q], k, at[q]
                at = n - 1 + node
                node = 2 * node + (b[np.arange(len(b)), feature[at]] > cut[at])
            leaf = -np.bincount(node, g, 1 << DEPTH) / (np.bincount(node, h, 1 << DEPTH) + 1) * RATE
            model.trees.append((feature, cut, leaf))
            margin += leaf[node]
        return model

    def margins(self, x: np.ndarray) -> np.ndarray:
        b, out = self.binned(x), np.full(len(x), self.base)
        for feature, cut, leaf in self.trees:
            out += leaf[self.leaves(b, feature, cut)]
        return out


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the calibration: pooled adjacent violators. A block's value is its share of positive rows, one of no label
    added, and half a positive one where there is any; a block without any has the value zero."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # sum of labels, rows, sum of margins
    for m, v in zip(margin[order], y[order], strict=True):
        blocks.append([float(v), 1.0, float(m)])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + c for a, c in zip(blocks[-1], last, strict=True)]
    at = np.array([b[2] / b[1] for b in blocks])
    return at, np.maximum.accumulate(np.array([(b[0] + 0.5 * (b[0] > 0)) / (b[1] + 1) for b in blocks]))


class Scorer:
    def __init__(self, lexicon: Lexicon, trees: Trees | None, knots: tuple[np.ndarray, np.ndarray] | None, share: float):
        self.lexicon, self.trees, self.knots, self.share = lexicon, trees, knots, share

    def __call__(self, texts: list[bytes | None]) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.share)
        margin = self.trees.margins(dense(np.array([measured(t, self.lexicon) for t in texts])))
        # a thousandth of the uncalibrated score keeps the order inside a block
        return 0.999 * np.interp(margin, *self.knots) + 0.001 / (1 + np.exp(-margin))


def sample(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> DataFrame:
    """Labelled training rows: text, toxic, part (by a hash of the text); equal texts of a label are one row."""
    labels = labels.where("toxic in (0, 1)").where(~held_out()).select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    share = min(1.0, rows / max(1, labels.count()))
    hashed = F.pmod(F.xxhash64(F.lit(17), "_id"), F.lit(1_000_000))
    few = labels.where(hashed < int(share * 1_000_000)).distinct()  # about `rows` rows of 12 bytes
    found = docs.select("doc_id", "text").join(F.broadcast(few), F.col("doc_id") == F.col("_id"))  # joined where the texts lie
    found = found.select(F.coalesce("text", F.lit("")).alias("text"), "toxic", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("digest"))
    once = found.groupBy("digest", "toxic").agg(F.first("text").alias("text"))  # bounded by the sample, copies combined before the shuffle
    return once.select("text", "toxic", F.pmod(F.xxhash64(F.lit(29), "digest"), F.lit(PARTS)).cast("int").alias("part"))


def _terms(batches):
    """Terms of a partition's rows with their numbers of rows by label and part."""
    worker_cache("toxicity")
    n = Counter()
    for batch in batches:
        toxic, part = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        for first, texts in rows_of(batch, "text"):
            for k, raw in enumerate(texts, first):
                found = set()
                for piece in chunks((raw or b"").decode("utf-8", "replace")):
                    words = set(WORD.findall(piece.lower()))
                    found |= {f"={whole(w)}" for w in words}
                    found |= {w[:x] for w in words for x in BEGINNINGS if len(w) > x}
                n.update((t, toxic[k], part[k]) for t in found)
                n["", toxic[k], part[k]] += 1
                if len(n) > HELD_TERMS:
                    yield from _counted(n)
                    n.clear()
    yield from _counted(n)


def _counted(n: Counter):
    items = iter(n.items())
    while rows := list(itertools.islice(items, 20_000)):
        yield pa.RecordBatch.from_pydict({"term": [r[0][0] for r in rows], "toxic": pa.array([r[0][1] for r in rows], pa.int32()), "part": pa.array([r[0][2] for r in rows], pa.int32()), "n": [r[1] for r in rows]})


def lexicons(rows: DataFrame) -> list[Lexicon]:
    """For each part the lexicon of all other parts; the last one is of all."""
    n = rows.mapInArrow(_terms, "term string, toxic int, part int, n long").groupBy("term")
    cells = {(k, y): F.sum(F.when((F.col("part") == k) & (F.col("toxic") == y), F.col("n")).otherwise(0)).alias(f"n{k}{y}") for k in range(PARTS) for y in (0, 1)}
    found = stored(n.agg(*cells.values()), "terms")
    total = found.where("term = ''").first()
    out = []
    for but in range(PARTS + 1):
        parts = [k for k in range(PARTS) if k != but]
        neg, pos = (sum((F.col(f"n{k}{y}") for k in parts), F.lit(0)) for y in (0, 1))
        n_neg, n_pos = (sum(total[f"n{k}{y}"] for k in parts) if total else 0 for y in (0, 1))
        least = max(TERM_ROWS * len(parts) / PARTS, TERM_SHARE * n_pos)
        ratio = (pos / (n_pos + 1)) / ((neg + 0.5) / (n_neg + 1))
        terms = [r[0] for r in found.where("term != ''").where((pos >= least) & (ratio >= TERM_RATIO)).orderBy(pos.desc(), "term").limit(TERMS).select("term").collect()]
        out.append(Lexicon({t[1:] for t in terms if t[0] == "="}, {t for t in terms if t[0] != "="}))
    discard(found)
    return out


def train(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> Scorer:
    """Lexicon, trees, and a calibration of margins out of PARTS parts; a row's lexicon features come from the other parts' lexicon."""
    picked = stored(sample(docs, labels, rows), "labelled")
    *others, full = lexicons(picked)

    def features(batches):
        worker_cache("toxicity")
        for batch in batches:
            toxic, part = batch.column(1), batch.column(2).to_pylist()
            for first, texts in rows_of(batch, "text"):
                sums = np.array([measured(t, others[part[k]]) for k, t in enumerate(texts, first)])
                yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.list_(pa.float64())), toxic.slice(first, len(texts)), pa.array(part[first : first + len(texts)], pa.int32())], names=["sums", "toxic", "part"])

    got = picked.mapInArrow(features, "sums array<double>, toxic int, part int").toArrow()  # bounded by the sample
    discard(picked)
    y, part = got["toxic"].to_numpy().astype(float), got["part"].to_numpy()
    if not len(y) or y.min() == y.max():
        return Scorer(full, None, None, float(y.mean()) if len(y) else 0.0)
    order = np.lexsort([*np.array(got["sums"].to_pylist()).T, y, part])  # the order of the rows doesn't matter
    x, y, part = dense(np.array(got["sums"].to_pylist()))[order], y[order], part[order]
    return Scorer(full, Trees.fit(x, y), isotonic(_out_of_part(x, y, part), y), float(y.mean()))


def _out_of_part(x: np.ndarray, y: np.ndarray, part: np.ndarray) -> np.ndarray:
    """The margin of each row by trees that were fitted without its part."""
    out = np.zeros(len(y))
    for k in np.unique(part):
        rest = part != k
        out[~rest] = Trees.fit(x[rest], y[rest]).margins(x[~rest]) if len(set(y[rest])) == 2 else 0.0
    return out


def scored(docs: DataFrame, scorer: Scorer, name: str = "score") -> DataFrame:
    """All columns of docs and a last one, the score, under a name that docs doesn't have."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    model = docs.sparkSession.sparkContext.broadcast(scorer)  # at most TERMS terms and TREES trees

    def score(batches):
        worker_cache("toxicity")  # what another operator kept in this worker goes
        for batch in batches:
            found = [model.value(texts) for _, texts in rows_of(batch, "text")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([*found, []]), pa.float64())], names=[*batch.schema.names, name])

    return small_batches(docs).mapInArrow(score, StructType([*docs.schema, StructField(name, DoubleType())]))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with their columns."""
    name = free_name(docs, "score")
    return scored(docs, train(docs, labels), name).where(F.col(name) < threshold).select(*docs.columns)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scored(docs, train(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
