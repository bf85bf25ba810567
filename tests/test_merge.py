import random
from pathlib import Path

import merge_model
import pytest
from pyspark.sql import functions as F

from gristmill.operators import coverage, merge
from gristmill.plans import queries


def run(spark, lines, **how):
    df = spark.createDataFrame(list(enumerate(lines)), "pos long, rule string")
    return [r["rule"] for r in merge.merge(df, **how).orderBy("pos", "kind").collect()]


GOLDEN = [
    (["||a.com^", "||b.a.com^"], ["||a.com^"]),
    (["||*.a.com^", "||a.com^"], ["||a.com^"]),
    (["@@||a.com^", "||a.com^", "0.0.0.0 s.a.com"], []),
    (["@@||*.a.com^", "a.com", "s.a.com"], ["a.com"]),
    (["0.0.0.0 a.com", "127.0.0.1 a.com"], ["127.0.0.1 a.com"]),
    (["0.0.0.0 a.x b.x", "127.0.0.1 a.x b.x"], ["127.0.0.1 a.x b.x b.x"]),
    (["a.com", "0.0.0.0 a.com"], ["0.0.0.0 a.com"]),
    (["||a.x^$important", "||a.x^$dnstype=A", "||a.x^", "||a.x^$important"], ["||a.x^$important", "||a.x^$dnstype=A"]),
    (["||a.x^", "||a.x^$dnstype=A", "||a.x^$important"], ["||a.x^", "||a.x^$dnstype=A", "||a.x^$important"]),
    (["||a.x^$important", "||a.x^$dnstype=A", "||a.x^", "||a.x^$important"], ["||a.x^$important", "||a.x^$dnstype=A"]),
    (["1a.com", "b.1a.com", "c.com", "d.c.com"], ["1a.com", "b.1a.com", "c.com"]),
    (["0.0.0.0 localhost", "", "/re/", "/re/"], ["/re/"]),
    (["0.0.0.0 bücher.de", "0.0.0.0 xn--bcher-kva.de"], ["0.0.0.0 bücher.de"]),
    (["::1 a.com", "0.0.0.0 a.com"], ["::1 a.com"]),
    (["dead beef", "127.0.0.1 beef"], ["dead beef"]),
]


@pytest.mark.parametrize("lines, kept", GOLDEN)
def test_golden(spark, lines, kept):
    assert run(spark, lines) == kept


def world(rng, n):
    """Lines of a few domains that no other world has."""
    root = f"w{n}"
    labels = [f"{x}{root}" for x in ("", "a.", "b.a.", "1a.", "c.1a.", "a.a.")]
    some = lambda: rng.choice(labels)
    spell = lambda d: rng.choice([d, d, d.upper(), d + "."])
    out = []
    for _ in range(rng.randint(2, 7)):
        k = rng.random()
        if k < 0.45:
            out.append(f"{rng.choice(['0.0.0.0', '127.0.0.1', '10.0.0.1', 'dead'])} {' '.join(spell(some()) for _ in range(rng.randint(1, 3)))}")
        elif k < 0.7:
            out.append(f"||{rng.choice(['', '', '*.'])}{some()}^{rng.choice(['', '', '$important', '$dnstype=A'])}")
        elif k < 0.76:
            out.append(f"@@||{rng.choice(['', '*.'])}{some()}^")
        elif k < 0.95:
            out.append(spell(some()))
        else:
            out.append(f"/x{root}/")
    return out


def test_against_the_sequential_model(spark):
    rng = random.Random(5)
    worlds = [world(rng, n) for n in range(2500)]
    rows = [(n, k, line) for n, lines in enumerate(worlds) for k, line in enumerate(lines)]
    df = spark.createDataFrame(rows, "w long, k long, rule string").select(F.struct("w", "k").alias("pos"), "rule")
    found: dict = {}
    for r in merge.merge(df).orderBy("pos").collect():
        found.setdefault(r["pos"]["w"], {}).setdefault(r["kind"], []).append(r["rule"])
    bad = []
    for n, lines in enumerate(worlds):
        want = {k: sorted(v) for k, v in merge_model.merge(lines).items() if v}
        got = {k: sorted(v) for k, v in found.get(n, {}).items()}
        if want != got:
            bad.append((lines, want, got))
    assert not bad, (len(bad), bad[0])


def test_dispositions_account_for_every_line(spark):
    rng = random.Random(6)
    lines = [x for n in range(50) for x in world(rng, n)] + ["", "  "]
    df = spark.createDataFrame(list(enumerate(lines)), "pos long, rule string")
    told = merge.dispositions(df)
    assert told.count() == len(lines)
    assert told.where("disposition = 'kept'").count() == merge.merge(df).count()


def test_minimal_cover_and_empty_sets(spark):
    d = spark.createDataFrame([("a.b.c",), ("b.c",), ("x.y",), ("",)], "norm string")
    assert {r[0] for r in coverage.minimal_cover(d).collect()} == {"b.c", "x.y"}
    none = d.where("false")
    assert coverage.memberships(d, {"abp": none, "wildcard": none}).count() == 0
    assert merge.merge(spark.createDataFrame([], "pos long, rule string")).count() == 0


def test_ascii_plan_has_no_python_and_no_product(spark):
    df = spark.createDataFrame([(1, "||a.com^"), (2, "0.0.0.0 b.com"), (3, "c.com")], "pos long, rule string")
    plan = merge.merge(df, idna=False, ipv6=False, multi=False)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "CartesianProduct", "NestedLoop"))


@pytest.mark.parametrize("data", [f"/root/testdata/{n}" for n in ("sf0.001", "sf0.1")])
def test_whole_queries_against_the_sequential_model(spark, data):
    """All rows of the fixture, lines of several hosts included."""
    if not Path(data).is_dir():
        pytest.skip("no test data")
    lines = [r["rule"] for r in queries.rules(spark, data).orderBy("pos").collect()]
    want = merge_model.merge(lines)
    assert any(len(line.split()) == 3 and "#" not in line for line in lines)
    assert sorted(r["rule"] for r in queries.QUERIES["hosts_conflicts_all"](spark, data).collect()) == sorted(want["hosts"])
    told = queries.QUERIES["merge_reduction_all"](spark, data).first()
    n = sum(map(len, want.values()))
    assert (told["lines_in"], told["lines_out"]) == (len(lines), n)
    assert told["reduction"] == pytest.approx((len(lines) - n) * 100 / len(lines))
