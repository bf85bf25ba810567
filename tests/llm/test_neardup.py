import numpy as np
from helpers import groups
from pyspark.sql import functions as F

from gristmill.llm import neardup


def table(spark, x, ids=None):
    rows = [(int(i), None if v is None else [None if c is None else float(c) for c in v], 0) for i, v in zip(ids or range(len(x)), x, strict=True)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def brute(x, t=0.95):
    x = np.array(x, dtype=np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    s = x @ x.T >= t
    np.fill_diagonal(s, False)
    root = groups(range(len(x)), zip(*np.nonzero(s), strict=True))
    return {k: (int(s[k].sum()), root[k], root[k] == k) for k in range(len(x))}


def test_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(60, 32))
    x = [c + rng.normal(size=32) * 0.08 for c, n in zip(centres, [*([1] * 40), *([4] * 18), 60, 150], strict=True) for _ in range(n)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(table(spark, x)).collect()}
    want = brute(x)
    found, true = (sum(v[0] for v in y.values()) for y in (got, want))
    assert found >= 0.99 * true and all(got[k][0] <= want[k][0] for k in want)
    assert np.mean([got[k] == want[k] for k in want]) > 0.98


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    x = [v, v, [2.0, 4.0, 6.0], None, [0.0, 0.0, 0.0], [1.0, None, 2.0], [1.0, float("nan"), 2.0], [float("inf"), 1.0, 1.0], [1.0, 2.0], [], [1e-30, 2e-30, 3e-30], [-1.0, -2.0, -3.0]]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in neardup.near_duplicates(table(spark, x)).collect()}
    assert got == {k: (3, 0) if k in (0, 1, 2, 10) else (0, k) for k in range(len(x))}


def test_empty_null_and_repeated_ids(spark):
    assert neardup.near_duplicates(table(spark, [])).count() == 0
    df = table(spark, [[1.0, 0.0], [1.0, 0.0], [0.0, 1.0]], [5, 5, 6]).withColumn("root", F.lit(1)).union(table(spark, [[1.0, 0.0]]).select(F.lit(None).cast("long"), "embedding", "label", F.lit(2)))
    got = neardup.near_duplicates(df).collect()
    assert len(got) == 4 and all(r["n_links"] == 0 for r in got)


def two_densities():
    """Five loose versions that link with one another, each with 20 tight copies; and repeated rows of one of them."""
    rng = np.random.default_rng(7)
    base = rng.normal(size=64)
    base /= np.linalg.norm(base)
    out = []
    for _ in range(5):
        away = rng.normal(size=64)
        away -= (away @ base) * base
        version = base + 0.18 * away / np.linalg.norm(away)
        out += [version + rng.normal(size=64) * 0.001 for _ in range(20)]
    return [*out, *(out[3] for _ in range(15)), *rng.normal(size=(300, 64))]


def test_tight_copies_do_not_hide_looser_links(spark):
    x = two_densities()
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(table(spark, x)).collect()}
    want = brute(x)
    assert want[0][0] > 100 and got == want


def test_trees_grow_with_the_table():
    for n in (100_000, 1_000_000, 10_000_000):
        missed = (1 - (1 - np.arccos(0.95) / np.pi) ** neardup.bits_of(n)) ** neardup.trees_for(n, 0.95)
        assert missed <= 0.005
    assert neardup.trees_for(100, 0.95) == neardup.TREES < neardup.trees_for(1_000_000, 0.95) < neardup.trees_for(10_000_000, 0.95) < 100


def test_audit_sees_lost_pairs_beside_a_large_group(spark):
    rng = np.random.default_rng(3)
    pairs = np.repeat(rng.normal(size=(60, 32)), 2, axis=0) + rng.normal(size=(120, 32)) * 0.05
    x = [*(rng.normal(size=32) + rng.normal(size=(100, 32)) * 0.02), *pairs]
    every = neardup.units(table(spark, x))
    rows, _ = neardup.collapsed(every)
    want = brute(x)
    told = [(k, n, root) for k, (n, root, _) in want.items() if n]
    whole = spark.createDataFrame(told, "vec_id long, n_links long, root long")
    assert neardup.audit(every, rows, whole, 32, len(x), 0.95) == 1.0
    assert neardup.audit(every, rows, whole.where("vec_id < 100"), 32, len(x), 0.95) < 0.5


def test_counts_within_components(spark, monkeypatch):
    """Shells that link wholly, not at all, and tiles in between, against all pairs; equal vectors weigh what they are."""
    monkeypatch.setattr(neardup, "TILE", 7)
    rng = np.random.default_rng(11)
    base = rng.normal(size=24)
    x = [base + rng.normal(size=24) * s for s in (0.001, 0.05, 0.1, 0.2, 0.4, 1.5) for _ in range(25)]
    x = np.array(x) / np.linalg.norm(x, axis=1)[:, None]
    m = rng.integers(1, 4, len(x))
    rows = spark.createDataFrame([(k, v.tolist(), int(w)) for k, (v, w) in enumerate(zip(x, m, strict=True))], "vec_id long, u array<double>, m long")
    members = rows.selectExpr("vec_id", "vec_id % 2 as root")
    links = (x @ x.T >= 0.95) & (np.arange(len(x))[:, None] % 2 == np.arange(len(x))[None, :] % 2)
    np.fill_diagonal(links, False)
    got = {r["vec_id"]: r["n"] for r in neardup.enlarged(rows, members, 0.95).collect()}
    assert got == dict(enumerate((links @ m).tolist())) and len(set(got.values())) > 20


def test_tight_groups_are_not_compared(spark):
    """Of a group within half the threshold's angle no vector goes to a tile."""
    rng = np.random.default_rng(12)
    base = rng.normal(size=16)
    x = [base + rng.normal(size=16) * 0.01 for _ in range(400)]
    found = neardup.near_duplicates(table(spark, x)).collect()
    assert {(r["n_links"], r["component_id"], r["audited_recall"]) for r in found} == {(399, 0, 1.0)}
