import math
from collections import Counter

import numpy as np
import pytest
from helpers import ODD, documents, near_copies, odd, remainder

from gristmill.llm import ctw


def tree_of(texts, depth):
    k = np.concatenate([ctw.runs(t, depth) for t in texts])
    return ctw.Tree.fit(*ctw.summed(k, np.ones(len(k))), depth)


def sequential(texts, depth):
    """The weighting as it is usually coded: bit by bit, one tree per decision, updated along each path."""
    trees = {}

    def node(step, context):
        return trees.setdefault((step, context), [0, 0, 0.0, 0.0])  # zeros, ones, log estimate, log weighted

    for text in texts:
        past = bytes([ctw.END]) * depth
        for byte in [*text, ctw.END]:
            step = 1
            for level in range(7, -1, -1):
                bit = byte >> level & 1
                for d in range(depth, -1, -1):
                    context = past[len(past) - d :]
                    x = node(step, context)
                    x[2] += math.log((x[bit] + 0.5) / (x[0] + x[1] + 1))
                    x[bit] += 1
                    if d == depth:
                        x[3] = x[2]
                    else:
                        split = sum(y[3] for (s, c), y in trees.items() if s == step and len(c) == d + 1 and c[1:] == context)
                        x[3] = np.logaddexp(x[2], split) - math.log(2)
                step = step * 2 + bit
            past = (past + bytes([byte]))[-depth:] if depth else b""
    return trees


def test_tree_is_that_of_sequential_coding():
    texts, depth = [b"abab", b"aab", b""], 2
    trees = sequential(texts, depth)
    tree = tree_of(texts, depth)

    def chance(past, byte):
        total = 1.0
        step = 1
        for level in range(7, -1, -1):
            bit = byte >> level & 1
            q = None
            for d in range(depth, -1, -1):
                zeros, ones, estimate, weighted = trees.get((step, past[len(past) - d :]), (0, 0, 0.0, 0.0))
                p = (ones + 0.5) / (zeros + ones + 1)
                if q is None:
                    q = p if (step, past[len(past) - d :]) in trees else 0.5
                else:
                    beta = math.exp(estimate - math.log(2) - weighted) if zeros + ones else 0.5
                    q = beta * p + (1 - beta) * q
            total *= q if bit else 1 - q
            step = step * 2 + bit
        return total

    for past in (b"\xff\xff", b"\xffa", b"ab", b"ba", b"aa"):
        for byte in (97, 98, 255):
            run = np.array([past[0] << 16 | past[1] << 8 | byte], dtype=np.uint64)
            assert abs(2 ** tree.log2(run)[0] - chance(past, byte)) < 1e-6


def test_chances_sum_to_one():
    tree = tree_of([t.encode() for t in near_copies(4, 6)], 3)
    for past in (b"\xff\xff\xff", b"the", b"xyz", b" th"):
        start = np.uint64(int.from_bytes(past, "big") << 8)
        runs = start | np.arange(256, dtype=np.uint64)
        assert abs((2 ** tree.log2(runs)).sum() - 1) < 1e-9


@pytest.mark.parametrize("n", [10**8, 10**12, 10**15])
def test_very_frequent_contexts_stay_finite(n):
    """One byte that nearly always follows: what is left for others is small, but not nothing."""
    run = np.array([int.from_bytes(b"aaaa", "big"), int.from_bytes(b"aaab", "big")], dtype=np.uint64)
    for counts in ([n, 0], [n, 1]):
        tree = ctw.Tree.fit(run, np.array(counts), 3)
        start = np.uint64(int.from_bytes(b"aaa", "big") << 8)
        got = tree.log2(start | np.arange(256, dtype=np.uint64))
        assert np.isfinite(got).all() and abs((2**got).sum() - 1) < 1e-9
        assert got[97] > -1e-6 and -200 < got[98] < -20
        other = tree.log2(np.array([int.from_bytes(b"zzzz", "big")], dtype=np.uint64))
        assert np.isfinite(other).all()


def test_long_texts():
    texts = [t.encode() for t in near_copies(5, 6)]
    tree = tree_of(texts, 3)
    long = (b" ".join(texts) * 1500)[: (1 << 22) + 7]
    every = np.unique(np.concatenate([ctw.runs(t, 3) for t in [long, b"", texts[0]]]))
    scores = ctw.Looked(every, tree.log2(every), 3)
    got = ctw.bits([b"", long, texts[0]], scores)
    for k, t in enumerate([b"", long, texts[0]]):
        assert abs(got[k] + tree.log2(ctw.runs(t, 3)).sum()) < 1e-9 * max(1, got[k])


def base_of(texts):
    words = {k: (t or "").encode().lower().split() + ["END"] for k, t in enumerate(texts)}
    c = Counter(w for k, ws in words.items() if remainder(k, 5) != 1 for w in ws)
    n, v = sum(c.values()), len(c)
    return {k: (remainder(k, 5) == 1, len(ws), sum(w in c for w in ws), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for k, ws in words.items()}


def test_scores(spark):
    texts = [*ODD, "longerthanfifteenletters again", *near_copies(6, 40), "longerthanfifteenletters again", *["x " + "\x00" * 17] * 6]  # as long as the end's key
    for common in (1 << 18, 20):
        rows = {r["doc_id"]: r for r in ctw.score(documents(spark, texts, extra=True), 4, 1 << 12, common).collect()}
        for k, (held, tokens, known, n, base) in base_of(texts).items():
            r = rows[k]
            assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, tokens, known, n), k
            assert abs(r["base_score"] - base) < 1e-6 * max(1, -base)
            assert r["score"] < 0
    assert rows[0]["score"] == rows[1]["score"]


def test_copies_score_better_than_noise(spark):
    texts = near_copies(6, 60)
    held = {k for k in range(len(texts)) if remainder(k, 5) == 1}
    rows = {r["doc_id"]: r for r in ctw.score(documents(spark, texts), 5, 1 << 14).collect()}
    assert np.mean([-rows[k]["score"] / math.log10(2) / (len(texts[k]) + 1) for k in held]) < 3.5


def test_empty_and_untrained(spark):
    assert ctw.score(odd(spark).where("false")).count() == 0
    held = next(k for k in range(100) if remainder(k, 5) == 1)
    df = spark.createDataFrame([(held, "ab")], "doc_id long, text string")
    r = ctw.score(df).first()
    assert (r["n_known"], r["train_tokens"]) == (0, 0) and abs(r["score"] + 24 * math.log10(2)) < 1e-6


def test_every_context_is_in_the_model(spark):
    """As one tree of all training texts in one place, with no context left out, however the work is dealt."""
    texts = near_copies(8, 30)
    train = [t.encode() for k, t in enumerate(texts) if remainder(k, 5) != 1]
    tree = tree_of(train, 4)
    for part in (1 << 6, 1 << 10):
        for r in ctw.score(documents(spark, texts), 4, part).collect():
            want = tree.log2(ctw.runs(texts[r["doc_id"]].encode(), 4)).sum() * math.log10(2)
            assert abs(r["score"] - want) < 1e-3 * -want
