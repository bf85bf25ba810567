from fractions import Fraction

import numpy as np
import pytest
from helpers import ODD, documents, groups, near_copies, odd

from gristmill.llm import ngramjoin


def sets_of(texts, words):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        k = min(words, len(w))
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    return out


def brute(texts, words, t):
    s = sets_of(texts, words)
    links = [(a, b) for a in range(len(s)) for b in range(a) if s[a] and s[b] and len(s[a] & s[b]) * t.denominator >= t.numerator * len(s[a] | s[b])]
    root = groups(range(len(s)), links)
    return {k: (len(s[k]), root[k]) for k in range(len(s))}


@pytest.mark.parametrize("words, t", [(3, Fraction(9, 10)), (5, Fraction(4, 5)), (1, Fraction(1, 2))])
def test_against_all_pairs(spark, words, t):
    texts = [*ODD, *near_copies(7, 30)]
    got = {r["doc_id"]: tuple(r)[1:] for r in ngramjoin.join(documents(spark, texts, extra=True), words, t).collect()}
    assert got == brute(texts, words, t)


@pytest.mark.parametrize("whole", [0, 2048])
def test_large_block_in_parts(spark, monkeypatch, whole):
    """Near copies in a chain: blocks far above BLOCK, links that no pivot sees; looked at again by bucket or as a whole."""
    monkeypatch.setattr(ngramjoin, "WHOLE_SETS", whole)
    base = [f"w{k}" for k in range(60)]
    texts = [" ".join(base[:k] + [f"n{k}"] + base[k + 1 :]) for k in range(60)] * 2 + [" ".join([*(f"m{k}x{j}" for j in range(j0)), *base[j0:]]) for k in range(60) for j0 in (1, 2, 9)]
    t = Fraction(4, 5)
    got = {r["doc_id"]: tuple(r)[1:] for r in ngramjoin.join(documents(spark, texts), 3, t).collect()}
    assert got == brute(texts, 3, t)


def test_stays_with_its_columns(spark):
    docs = documents(spark, [*ODD, *near_copies(9, 8)], extra=True)
    kept = ngramjoin.keep_one(docs)
    want = {v[1] for v in brute([*ODD, *near_copies(9, 8)], 5, Fraction(4, 5)).values()}
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == want


def test_empty_null_and_repeated_ids(spark):
    assert ngramjoin.join(odd(spark).where("false")).count() == 0
    docs = spark.createDataFrame([(None, "a b c d e f"), (7, "a b c d e f"), (7, "other words here are these"), (None, ""), (8, "a b c d e f")], "doc_id long, text string")
    got = sorted(ngramjoin.join(docs).collect(), key=repr)
    assert len(got) == 5 and sum(r["component_id"] == 7 for r in got) == 4


def test_suspects_in_many_chunks(spark, monkeypatch):
    """Sets are counted across chunks and ranges."""
    texts = [*ODD, *near_copies(11, 25)]
    monkeypatch.setattr(ngramjoin, "CHUNK_SETS", 3)
    t = Fraction(4, 5)
    docs = documents(spark, texts).repartition(3)
    s = sets_of(texts, 3)
    alike = {k for k in range(len(s)) if s[k] and sum(any(g in o for j, o in enumerate(s) if o != s[k]) for g in s[k]) >= t * len(s[k])}
    found = ngramjoin.scanned(docs, 3, 200)
    rows = found.where("chunk is null").collect()
    got = {r["node"] for r in ngramjoin.suspects(found, t).collect()}
    assert found.where("range < 0").count() >= len(texts) // 4
    assert {r["node"] for r in rows if r["doc_id"] in alike} <= got
    assert not {r["node"] for r in rows if r["node"] and r["doc_id"] not in alike and sum(x["node"] == r["node"] for x in rows) == 1} & got


def test_spanning():
    rng = np.random.default_rng(0)
    for n, m in ((1, 0), (10, 5), (1000, 400), (1000, 900)):
        u, v = rng.integers(0, n, m), rng.integers(0, n, m)
        a, b = ngramjoin.spanning(u, v)
        root = groups(set(u.tolist()) | set(v.tolist()), zip(u.tolist(), v.tolist(), strict=True))
        assert dict(zip(a.tolist(), b.tolist(), strict=True)) == {k: r for k, r in root.items() if k != r}


def test_null_and_repeated_ids_link(spark):
    """A near copy whose id is null, or that other rows have too, links like any other."""
    base = [f"w{k}" for k in range(60)]
    near = [" ".join([*base, x]) for x in ("tail", "", "end")] + [" ".join(["v", *base[1:]])]
    rows = [(1, near[0]), (None, near[1]), (None, near[2]), (None, near[1]), (9, near[3]), (9, "quite another text"), (None, "lone text of null"), (4, " ".join(f"u{k}" for k in range(50))), (None, " ".join(f"u{k}" for k in range(51)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngramjoin.join(docs, 3, Fraction(9, 10)).collect()), key=repr)
    assert got == sorted([(1, 59, 1), (None, 58, 1), (None, 59, 1), (None, 58, 1), (9, 58, 1), (9, 1, 9), (None, 2, None), (4, 48, 4), (None, 49, 4)], key=repr)


def test_common_shingles_are_sent_once_a_chunk(spark):
    """A passage that every text has costs a range one entry per chunk."""
    passage = " ".join(f"p{k}" for k in range(20))
    texts = [f"{passage} " + " ".join(f"t{j}x{k}" for k in range(40)) for j in range(300)]
    found = ngramjoin.scanned(documents(spark, texts).coalesce(1), 3, 64).where("range >= 0").collect()
    sent = np.concatenate([np.frombuffer(r["b"], dtype=np.uint16) for r in found])
    assert (sent == ngramjoin.SEVERAL).sum() == 18 and len(sent) == 18 + 300 * 40


@pytest.mark.parametrize("whole", [0, 2048])
def test_blocks_that_grow_together(spark, monkeypatch, whole):
    """A chain of unlinked sets that share a rare shingle each: one block, by bucket or as a whole."""
    monkeypatch.setattr(ngramjoin, "WHOLE_SETS", whole)
    words = [[f"a{k}x{j}" for j in range(30)] for k in range(400)]
    texts = [" ".join([*words[k][:28], *words[(k + 1) % 400][:6]]) for k in range(400)] + [" ".join([*words[k][:28], *words[(k + 1) % 400][:5], "z"]) for k in (3, 250)]
    t = Fraction(4, 5)
    got = {r["doc_id"]: tuple(r)[1:] for r in ngramjoin.join(documents(spark, texts), 1, t).collect()}
    assert got == brute(texts, 1, t) and sum(k != v[1] for k, v in got.items()) == 2
