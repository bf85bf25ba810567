import random

import pytest
from pyspark.sql import functions as F

from gristmill.llm import revisits

SCHEMA = "record_id long, type string, url string, captured long, status int, digest string, headers map<string,string>"


@pytest.mark.parametrize("url, want", [("http://www.A.com/", "a.com"), ("HTTPS://u:p@a.com:443/x/?b=2&utm_source=q&a=1#f", "a.com/x?a=1&b=2"), ("a.com:8080/X", "a.com:8080/X"), ("http://a.com?ref=x", "a.com"), ("", None), (None, None), ("http:///x", None)])
def test_canonical(spark, url, want):
    assert spark.createDataFrame([(url,)], "u string").select(revisits.canonical(F.col("u"))).first()[0] == want


def brute(rows):
    full = [r for r in rows if r[1] == "response" and r[4] == 200 and r[3] is not None and r[2]]
    tag = lambda e: e.removeprefix("W/").strip('"')
    out = {}
    some = lambda h: {k: v for k, v in (h or {}).items() if v is not None}
    full = [(*r[:6], some(r[6])) for r in full]
    for i, kind, url, at, _, digest, told in rows:
        if kind != "revisit":
            continue
        headers = some(told)
        before = [r for r in full if url and at is not None and r[2] == url and r[3] < at]
        if not url or not before:
            out[i] = (None, "no_url" if not url else "no_earlier", told)
            continue
        to = max(before, key=lambda r: (r[3], r[0]))
        if "etag" in headers and "etag" in to[6]:
            same = tag(headers["etag"]) == tag(to[6]["etag"])
        elif "last-modified" in headers and "last-modified" in to[6]:
            same = headers["last-modified"] == to[6]["last-modified"]
        else:
            same = digest is not None and digest == to[5]
        merged = to[6] | {k: v for k, v in headers.items() if k in revisits.PERMITTED}
        out[i] = (to[0], "resolved", merged) if same else (None, "changed", told)
    return out


@pytest.mark.parametrize("span", [7, 4096])
def test_against_brute_force(spark, span):
    rng = random.Random(9)
    rows = []
    for i in range(1500):
        headers = None if rng.random() < 0.1 else {k: v for k, v in (("etag", rng.choice(['"1"', 'W/"1"', '"2"'])), ("last-modified", rng.choice(["a", "b", None])), ("date", str(i)), ("server", rng.choice("xy"))) if rng.random() < 0.7}
        rows.append((i, rng.choice(["response", "revisit"] * 10 + ["request", None]), rng.choice(["a.com", "b.com/x", "hot.org"] + ["hot.org"] * 5 + [None]), rng.choice([rng.randint(0, 300)] * 30 + [None]), rng.choice([200, 200, 200, 404, None]), rng.choice(["p", "q", None]), headers))
    df = spark.createDataFrame(rows, SCHEMA).withColumn("_span", F.lit("clash"))
    got = {r["record_id"]: (r["refers_to"], r["outcome"], r["headers"]) for r in revisits.resolved(df, span).collect()}
    assert got == brute(rows)


def test_empty_and_payload(spark):
    assert revisits.resolved(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, "response", "a.com", 1, 200, "d", {"etag": "x"}), (2, "revisit", "http://www.a.com/", 2, 304, "d", {"etag": "x"})]
    found = revisits.resolved(spark.createDataFrame(rows, SCHEMA))
    body = spark.createDataFrame([(1, "<html>")], "record_id long, body string")
    assert revisits.payload(found, body).first()["body"] == "<html>"


def test_null_headers_lose_none(spark):
    """A resolved revisit has the headers of either side, if the other side has none."""
    kept = {"etag": "x", "server": "s"}
    rows = [(1, "response", "a.com", 1, 200, "d", None), (2, "revisit", "a.com", 2, 304, "d", kept), (3, "response", "b.com", 1, 200, "d", kept), (4, "revisit", "b.com", 2, 304, "d", None)]
    got = {r["record_id"]: (r["outcome"], r["headers"]) for r in revisits.resolved(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {2: ("resolved", {"etag": "x"}), 4: ("resolved", kept)}
