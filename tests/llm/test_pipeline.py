import os
from fractions import Fraction

import pytest
from helpers import near_copies, remainder
from test_exactdedup import brute as copies
from test_ngramjoin import brute as near

DATA = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def test_stages(spark, tmp_path):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in p.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard_join", "secret_scan", "best_fit_packing"]
    for k, (name, stage) in enumerate(p.STAGES):
        out = stage(spark, docs, DATA)
        out.write.parquet(path := str(tmp_path / name))
        out = spark.read.parquet(path)
        rows, before = out.collect(), docs.select("doc_id", "text").collect()
        ids, texts = [r["doc_id"] for r in before], [r["text"] for r in before]
        if k < 4:
            assert out.columns == columns
        if name == "toxicity":
            assert 0 < len(rows) < len(before)
        if name == "exact_dedup":
            assert {r["doc_id"] for r in rows} == {ids[a] for a, v in copies(texts).items() if v[2]}
        if name == "ngram_jaccard_join":
            want = near(texts, 5, Fraction(4, 5))
            group = {}
            for a, (_, root) in want.items():
                group.setdefault(root, []).append(ids[a])
            assert {r["doc_id"] for r in rows} == {min(g) for g in group.values()}
        if name == "secret_scan":
            assert len(rows) == len(before) and not any('token = "' in r["text"] and "[SECRET]" not in r["text"] for r in rows)
        if name == "best_fit_packing":
            assert {r["doc_id"] for r in rows} == set(ids)
        docs = out


def test_registered(spark):
    import __spark_entry__

    q = __spark_entry__.queries()
    assert "pipeline" in q and sorted(n for n in q if n.startswith("op")) == sorted(n for n in q if n.startswith("op") and q[n].__module__.startswith("gristmill.llm"))
    assert {int(n[2:].split("_")[0]) for n in q if n.startswith("op")} == set(range(1, 11))
    assert near_copies() and remainder(None, 4) == 0


def test_repeated_and_null_ids(spark):
    """Both dedup stages drop rows, not ids: a unique text stays and an exact copy goes, whatever its id."""
    from gristmill.llm import exactdedup, ngramjoin

    one, two, three, four = (" ".join(f"{w}{k}" for k in range(12)) for w in ("ab", "cd", "ef", "gh"))
    rows = [(3, one), (5, two), (5, one), (None, three), (None, one), (7, four), (7, four), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    want = sorted([(3, one), (5, two), (None, three), (7, four), (None, None)], key=repr)
    for stage in (exactdedup.dedup_new, lambda d: ngramjoin.keep_one(d, 5, Fraction(4, 5))):
        out = stage(docs)
        assert out.columns == docs.columns
        assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr) == want
