import hashlib
import re

import numpy as np
import pytest
from helpers import ODD, documents, near_copies, odd

from gristmill.llm import exactdedup


def brute(texts):
    groups = {}
    for k, t in enumerate(texts):
        groups.setdefault(hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t or "").encode()).hexdigest(), []).append(k)
    out = {}
    for digest, ids in groups.items():
        keep = min(ids, key=lambda k: (-len(texts[k] or ""), k))
        out |= {k: (keep, len(ids), k == keep, digest) for k in ids}
    return out


@pytest.mark.parametrize("n", [0, 1, 2, 3, 50, 3000])
def test_filters_refuse_no_key(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 2**63, n).astype(np.uint64)
    f = exactdedup.BinaryFuse8.loaded(exactdedup.BinaryFuse8.build(np.r_[keys, keys]).dumped())
    assert f.holds(keys).all()
    assert f.holds(rng.integers(0, 2**63, 50_000).astype(np.uint64)).mean() < 0.006


def test_groups(spark):
    texts = [*ODD, *near_copies(3, 15), "a b c ", " abc", "a\x0bb\x0cc", "a bc"]
    got = {r["doc_id"]: tuple(r)[1:] for r in exactdedup.dedup(*exactdedup.halves(documents(spark, texts, extra=True))).collect()}
    assert got == brute(texts)


def test_stays_with_its_columns(spark):
    docs = odd(spark, extra=True)
    kept = exactdedup.dedup_new(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {k for k, v in brute(ODD).items() if v[2]}


def test_empty_and_null_ids(spark):
    assert exactdedup.dedup(*exactdedup.halves(odd(spark).where("false"))).count() == 0
    docs = spark.createDataFrame([(None, "x"), (None, "x"), (3, " x"), (3, "y")], "doc_id long, text string")
    got = exactdedup.dedup(*exactdedup.halves(docs)).collect()
    assert len(got) == 4 and sorted(r["group_size"] for r in got) == [1, 3, 3, 3]
    assert {r["keep_id"] for r in got if r["group_size"] == 3} == {3}


def test_collisions_of_the_filter_do_not_pass(spark):
    """A snapshot without any of the new texts: whatever the filter passes, the exact bucket refuses."""
    old, new = (documents(spark, [f"{x}{k}" for k in range(3000)]) for x in "ab")
    assert exactdedup.dedup(old, new.selectExpr("doc_id + 5000 as doc_id", "text")).where("group_size > 1").count() == 0


def test_one_row_of_repeated_rows_stays(spark):
    """Ids that repeat in the snapshot, in the batch and in both: one row of each group is kept, none of a unique text goes."""
    rows = [(k % 3, t) for k, t in enumerate(["same", "s ame", "same", "b", "b", "c", "c ", " c"] * 2 + ["only", None, ""])]
    docs = spark.createDataFrame([*rows, (None, "same"), (None, "alone"), (None, "alone")], "doc_id long, text string")
    got = exactdedup.dedup(docs, docs.union(docs.where("text = 'b'"))).collect()
    groups = {}
    for r in got:
        groups.setdefault(r["text_sha256"], []).append(r)
    assert len(groups) == 6 and len(got) == 2 * 22 + 4
    assert all(sum(r["kept"] for r in g) == 1 and {r["group_size"] for r in g} == {len(g)} for g in groups.values())


def test_a_snapshot_is_kept(spark, tmp_path, monkeypatch):
    """Filters that were written serve later batches, also one that is dealt to several tasks a shard."""
    texts = [*ODD, *near_copies(3, 15)]
    old, new = exactdedup.halves(documents(spark, [*texts, "a b c ", " abc", "a bc"]))
    exactdedup.Snapshot.of(old).write(str(tmp_path / "s"))
    monkeypatch.setattr(exactdedup, "SCREENED", 1)
    monkeypatch.setattr(exactdedup, "LEAST_SHARDS", 4)
    kept = exactdedup.Snapshot.read(spark, str(tmp_path / "s"))
    want = {tuple(r) for r in exactdedup.dedup(old, new).collect()}
    assert {tuple(r) for r in exactdedup.dedup(old, new, kept).collect()} == want and kept.shards == 256
