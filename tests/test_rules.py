import pytest
from pyspark.sql import functions as F

from gristmill.functions import idna, text
from gristmill.operators import clean, parse, patch, validate
from gristmill.sources import fetch, rulefiles


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x"))).first()[0]


CLEAN = [("! x", None), ("# x", None), ("-----", None), ("a.com # c", "a.com"), ("a.com#c", "a.com"), (r"a.com \# c", r"a.com \# c"), ("/a#b/ # c", "/a#b/"), ("/a#b", "/a#b"), ("a.com##.ad # c", "a.com##.ad # c"), ("  x  ", "x"), ("﻿a.com", "﻿a.com"), ("", None), (None, None), ("a\x1c", "a")]


def test_clean(spark):
    df = spark.createDataFrame([(k, raw) for k, (raw, _) in enumerate(CLEAN)], "k int, raw string")
    got = {r["k"]: r["cleaned"] for r in clean.disposition(df).collect()}
    assert got == {k: want for k, (_, want) in enumerate(CLEAN)}
    again = clean.clean(clean.clean(df))
    assert again.collect() == clean.clean(df).collect()


VALID = [
    ("||example.com^", "kept_adblock_domain"), ("||example^", "kept_adblock_domain"), ("example", "kept_other_adblock"), ("||example.com^$script", "removed_bad_modifier"),
    ("||example.com^$IMPORTANT", "removed_bad_modifier"), ("||a_b.com^", "removed_malformed"), ("0.0.0.0 a_b.com", "removed_invalid_host"), ("||*.example.com^", "kept_wildcard_tld"),
    ("||a*b.com^", "removed_malformed"), ("||a.com^*", "removed_malformed"), ("||a.com^x", "removed_malformed"), ("||a.com^|", "kept_adblock_domain"), ("a.com##.ad", "removed_element_hiding"),
    ("/re/$script", "kept_regex"), ("/ads/banner", "kept_regex"), ("||1.2.3.4^", "kept_adblock_domain"), ("@@||a.com^", "kept_adblock_domain"), ("! c", "comment"), (" ", "blank"), ("0.0.0.0 a.com b.com", "kept_hosts"),
    ("0.0.0.0 bücher.de", "kept_hosts"), ("||bücher.de^", "removed_malformed"), ("0.0.0.0 a.com", "kept_hosts"), ("@@", "removed_malformed"), ("||^", "removed_invalid_host"), ("||a.com^$client=a\\,b,important", "kept_adblock_domain"),
]


def test_verdicts(spark):
    df = spark.createDataFrame([(k, raw) for k, (raw, _) in enumerate(VALID)], "k int, raw string")
    got = {VALID[r["k"]][0]: r["verdict"] for r in validate.with_verdict(df).collect()}
    assert got == dict(VALID)
    no_ip = spark.createDataFrame([("||1.2.3.4^",), ("0.0.0.0 1.2.3.4",)], "raw string")
    assert [r["verdict"] for r in validate.with_verdict(no_ip, allow_ip=False).collect()] == ["removed_invalid_host"] * 2


def test_comments_share_the_fate_of_what_follows(spark):
    lines = ["! a", "||a_b^", "! b", "", "! c", "! d", "x.com", "! e"]
    df = spark.createDataFrame([("f", k, x) for k, x in enumerate(lines)], "file string, line_no int, raw string")
    assert [r["raw"] for r in validate.validate(df).orderBy("line_no").collect()] == ["! c", "! d", "x.com", "! e"]


def test_validation_is_idempotent(spark):
    df = spark.createDataFrame([("f", k, x) for k, (x, _) in enumerate(VALID)], "file string, line_no int, raw string")
    once = validate.validate(df)
    assert sorted(once.collect()) == sorted(validate.validate(once).collect())


@pytest.mark.parametrize("raw, want", [("*.A.com.", "a.com"), ("..a..b.", "a.b"), ("Bücher.DE", "xn--bcher-kva.de"), ("straße.de", "strasse.de"), ("", ""), ("*.", ""), ("*.*.a", "*.a")])
def test_normalised(spark, raw, want):
    assert idna.with_normalised(spark.createDataFrame([(raw,)], "x string"), "x", "y").first()["y"] == want


@pytest.mark.parametrize("raw, want", [("0.0.0.0", 0), ("127.9.0.1", 2), ("1.2.3.4", 1), ("::1", 2), ("::", 0), ("[fe80::1%eth0]", 1), ("01.2.3.4", None), ("dead", None), ("1.2.3", None)])
def test_ranks(spark, raw, want):
    got = idna.with_address(spark.createDataFrame([(raw,)], "x string"), "x", "a")
    assert got.select(idna.rank(F.col("a"))).first()[0] == want


def test_suffixes(spark):
    assert one(spark, "a.b.c", text.suffixes) == ["a.b.c", "b.c", "c"]
    assert one(spark, "c", text.parents) == [] and one(spark, "", text.suffixes) == []


def test_parsing(spark):
    df = spark.createDataFrame([("@@||a.com^$client=a\\,b,important,,x=",), ("/re$/",), ("a\\$b",), ("@@",)], "rule string")
    got = [r["p"] for r in parse.with_adblock(df, "rule", "p").collect()]
    assert (got[0]["pattern"], got[0]["whitelist"], got[0]["hostname"]) == ("||a.com^", True, "a.com")
    assert [tuple(o) for o in got[0]["options"]] == [("client", "a,b"), ("important", None), ("x", "")]
    assert got[1]["pattern"] == "/re$/" and got[1]["options"] is None and got[2]["pattern"] == "a\\$b" and got[3] is None
    hosts = one(spark, " 0.0.0.0%x  a.com\tb # c", parse.hosts)
    assert (hosts["ip"], hosts["hostnames"]) == ("0.0.0.0%x", ["a.com", "b"])
    assert one(spark, "0.0.0.0 # c", parse.hosts) is None


def test_patches(spark):
    text_ = "1\n2\n3\n"
    cases = [("diff name:a\nd 2 1\na 1 2\nx\ny\n", "a", "1\nx\ny\n3\n", None), ("diff name:a\nd 2 1\n", "b", None, "no block of that name"), ("x\n", "", None, "no blocks"), ("diff a:b\nd 9 1\n", "", None, "out of range"), ("diff checksum:00\nd 1 1\n", "", None, "checksum differs"), ("diff a:b\na 0 2\nx\n", "", None, "the patch ends within an addition")]
    df = spark.createDataFrame([(k, text_, p, r) for k, (p, r, _, _) in enumerate(cases)], "k int, text string, patch string, resource string")
    got = {r["k"]: (r["result"], r["error"]) for r in patch.patched(df).collect()}
    assert got == {k: c[2:] for k, c in enumerate(cases)}


def test_patch_lines_are_cut_as_python_does(spark):
    raw = "a\r\nb\rc\nd\x0be\x0cf\x1cg\x85h i"
    assert one(spark, raw, patch.lines_of) == raw.splitlines(keepends=True)


def test_checksums(spark):
    import base64
    import hashlib

    body = "! Title\n! Checksum: abc\nx\n\n"
    want = base64.b64encode(hashlib.md5(b"! Title\n\nx\n").digest()).decode().rstrip("=")
    df = spark.createDataFrame([(body, want + "=="), (body, "zzz"), (body, None)], "c string, e string")
    assert [r[0] for r in df.select(text.checksum_matches(F.col("c"), F.col("e"))).collect()] == [base64.b64encode(hashlib.md5(b"! Title\nx\n").digest()).decode().rstrip("=") == want or want in one(spark, body, text.checksum_candidates), False, True]


def test_rule_files(spark, tmp_path):
    (tmp_path / "b.TXT").write_bytes(b"\xef\xbb\xbfx\r\ny\rz\x0bw\n\n")
    (tmp_path / "A.txt").write_bytes(b"q")
    (tmp_path / "c.md").write_bytes(b"no")
    got = [tuple(r) for r in rulefiles.lines(spark, str(tmp_path)).orderBy("file_rank", "line_no").collect()]
    assert got == [("A.txt", 1, 1, "q"), ("b.TXT", 2, 1, "﻿x"), ("b.TXT", 2, 2, "y"), ("b.TXT", 2, 3, "z\x0bw"), ("b.TXT", 2, 4, "")]
    assert rulefiles.lines(spark, str(tmp_path), keep_bom=False).where("raw = 'x'").count() == 1
    (tmp_path / "d.txt").write_bytes(b"\xff\n")
    with pytest.raises(Exception, match="invalid UTF-8"):
        rulefiles.lines(spark, str(tmp_path)).collect()
    assert rulefiles.lines(spark, str(tmp_path), on_invalid="replace").where("file = 'd.txt'").first()["raw"] == "�"


def test_merged_file_keeps_order(spark, tmp_path):
    out = str(tmp_path / "out.txt")
    for n in (300, 3):
        rulefiles.write_merged(spark.range(n).select(F.col("id").alias("pos"), F.concat(F.lit("r"), "id").alias("rule")).repartition(4), out)
        assert open(out).read() == "".join(f"r{k}\n" for k in range(n))


def transport(url, headers):
    """A server for tests: what it answers is in the URL."""
    import hashlib
    import os
    import tempfile

    if "flaky" in url:
        mark = os.path.join(tempfile.gettempdir(), "gm" + hashlib.md5(url.encode()).hexdigest())
        if not os.path.exists(mark):
            open(mark, "w").close()
            return 503, {}, b""
        os.remove(mark)
    if "down" in url:
        raise OSError("no route")
    if headers.get("If-None-Match") == "e1":
        return 304, {}, b""
    return (404, {}, b"") if "gone" in url else (200, {"ETag": "e2"}, b"body")


def test_fetch(spark):
    import uuid

    transport.__module__ = "__main__"  # goes to the workers by value
    flaky = f"http://a.org/flaky{uuid.uuid4().hex}"
    urls = spark.createDataFrame([("http://a.org/x",), ("http://a.org/known",), (flaky,), ("http://b.org/gone",), ("http://b.org/down",)], "url string")
    meta = spark.createDataFrame([("http://a.org/known", "e1", None)], "url string, etag string, last_modified string")
    got = {r["url"]: r for r in fetch.fetch(fetch.requests(urls, meta), transport, retries=2, delay=0.0, sleep=lambda s: None).collect()}
    assert (got["http://a.org/x"]["status_code"], bytes(got["http://a.org/x"]["body"]), got["http://a.org/x"]["etag"]) == (200, b"body", "e2")
    assert got["http://a.org/known"]["status_code"] == 304 and got["http://b.org/gone"]["attempts"] == 1
    assert (got[flaky]["status_code"], got[flaky]["attempts"]) == (200, 2)
    assert got["http://b.org/down"]["status_code"] is None and got["http://b.org/down"]["attempts"] == 3


def test_meta_files(spark, tmp_path):
    path = str(tmp_path / "meta")
    assert fetch.read_meta(spark, path).count() == 0
    fetch.write_meta(spark.createDataFrame([("u", "p")], "url string, path string"), path)
    assert fetch.read_meta(spark, path).first()["path"] == "p"


def test_patch_urls(spark):
    df = spark.createDataFrame([("http://a.org/l/x.txt", "../p/y.patch#r"), ("http://a.org/x.txt", "")], "l string, p string")
    got = [tuple(r[0]) for r in df.select(fetch.patch_url("l", "p")).collect()]
    assert got == [("http://a.org/p/y.patch", "r"), (None, None)]


def test_watched_folder(spark, tmp_path):
    from gristmill.streaming import ingest

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("! c\na.com # x\n||b.com^\ns.b.com\n")
    out = []
    for name in ("", "b.txt"):
        if name:
            (tmp_path / "in" / name).write_text("0.0.0.0 a.com\n")
        ingest.watch(spark, str(tmp_path / "in"), str(tmp_path / "state"), lambda m: out.append([r["rule"] for r in m.orderBy("pos").collect()])).awaitTermination(120)
    assert out == [["! c", "a.com", "||b.com^"][1:], ["||b.com^", "0.0.0.0 a.com"]]
