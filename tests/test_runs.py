import json

from gristmill import __main__ as cli
from gristmill.functions import sql
from gristmill.plans import pipeline
from gristmill.sources import fetch, rulefiles

A = "! list a\n||ads.com^\nx.ads.com # tail\n0.0.0.0 b.org\n||bad_^\nbanner##.x\n"
B = "# list b\n127.0.0.1 b.org\nc.net\n@@||c.net^\n/ads[0-9]/\n"


def folder(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/B.txt").write_text(B)
    (tmp_path / "in/a.TXT").write_text(A)
    return str(tmp_path / "in")


def test_run(spark, tmp_path, capsys):
    out = str(tmp_path / "out.txt")
    cli.main(["run", folder(tmp_path), out], spark)
    assert open(out).read().splitlines() == ["||ads.com^", "127.0.0.1 b.org", "/ads[0-9]/"]
    told = json.loads(capsys.readouterr().out)
    assert told["clean"]["lines_in"] == 11 and told["clean"]["dropped_comments"] == 2 and told["clean"]["lines_out"] == 9
    assert told["validate"]["removed_invalid"] == 2 and told["validate"]["removed_element_hiding"] == 1
    assert (told["merge"]["lines_in"], told["merge"]["lines_out"], round(told["merge"]["reduction"], 6)) == (7, 3, round(400 / 7, 6))


def test_steps(spark, tmp_path, capsys):
    source = folder(tmp_path)
    for step in ("clean", "validate"):
        cli.main([step, source, str(tmp_path / step)], spark)
    assert (tmp_path / "clean/a.TXT").read_text().splitlines() == ["||ads.com^", "x.ads.com", "0.0.0.0 b.org", "||bad_^", "banner##.x"]
    assert sorted(f.name for f in (tmp_path / "clean").iterdir() if not f.name.startswith(".")) == ["B.txt", "a.TXT"]
    cli.main(["merge", source, str(tmp_path / "m.txt")], spark)
    assert "127.0.0.1 b.org" in open(tmp_path / "m.txt").read()
    assert len(capsys.readouterr().out) > 100


def test_folder_upkeep(spark, tmp_path):
    for name, body in (("long_name.txt", "x"), ("a.txt", "x"), ("b.txt", "y"), ("c.part", "z"), ("d_clean.txt", "w")):
        (tmp_path / name).write_text(body)
    assert rulefiles.purge(spark, str(tmp_path)) == ["c.part", "d_clean.txt"]
    assert {r["name"]: r["kept"] for r in rulefiles.distinct_files(spark, str(tmp_path)).collect()} == {"long_name.txt": False, "a.txt": True, "b.txt": True}


def answers(url, headers):
    if url.endswith("p.patch"):
        return 200, {}, b"diff name:r\nd 1 1\na 1 1\nnew\n"
    if url.endswith("none.patch"):
        return 204, {}, b""
    if headers.get("If-None-Match"):
        return 304, {}, b""
    return (500, {}, b"") if "down" in url else (200, {"ETag": "e"}, b"body")


answers.__module__ = "__main__"  # goes to the workers by value


def test_patched_lists(spark):
    rows = [("http://a/l.txt", "old\nx\n", "p.patch#r", None), ("http://b/l.txt", "old\n", "none.patch", None), ("http://c/l.txt", "old\n", None, None), ("http://d/l.txt", "old\nx\n", "p.patch#other", None), ("http://e/l.txt", "old\nx\n", "p.patch", "zzz")]
    df = spark.createDataFrame(rows, "url string, text string, diff_path string, list_checksum string")
    got = {r["url"][7]: (r["result"], r["why"]) for r in fetch.updated_by_patch(df, answers, delay=0.0, sleep=lambda s: None).collect()}
    assert got["a"] == ("x\nnew\n", "patched")
    assert {k: v[1] for k, v in got.items() if k != "a"} == {"b": "unavailable", "c": "no path", "d": "no block of that name", "e": "list checksum differs"}


def test_refresh_twice(spark, tmp_path):
    urls = spark.createDataFrame([("http://a/x",), ("http://a/down",)], "url string")
    how = dict(retries=0, delay=0.0, sleep=lambda s: None)
    first = fetch.refresh(spark, urls, fetch.read_meta(spark, f"{tmp_path}/meta"), str(tmp_path), 1, answers, **how)
    again = fetch.refresh(spark, urls, fetch.read_meta(spark, f"{tmp_path}/meta"), str(tmp_path), 2, answers, **how)
    assert first == {"ok": 1, "not-modified": 0, "used-cache-on-fail": 0, "failed": 1, "processed": 2}
    assert again == {"ok": 0, "not-modified": 1, "used-cache-on-fail": 0, "failed": 1, "processed": 2}
    assert spark.read.parquet(f"{tmp_path}/lists").count() == 1
    assert json.loads((tmp_path / "fetch_summary.json").read_text()) == {"summary": again, "timestamp": 2}


def test_sql_functions(spark):
    assert len(sql.register(spark)) == len(sql.FUNCTIONS)
    r = spark.sql("select gm_normalised_domain('*.A..b.'), gm_suffixes('a.b'), gm_is_domain('a_b'), gm_is_hosts('0.0.0.0 a.com'), gm_is_bare('||a^')").first()
    assert list(r) == ["a.b", ["a.b", "b"], False, True, True]
    assert pipeline.report({"a": 1}) == '{\n  "a": 1\n}'


def test_steps_read_what_steps_wrote(spark, tmp_path, capsys):
    """clean, validate and merge one after the other give what run gives; no step sees a line twice, or one from a folder below."""
    source = folder(tmp_path)
    (tmp_path / "in/below").mkdir()
    (tmp_path / "in/below/B.txt").write_text("||below.com^\n")
    (tmp_path / "in/only.txt").write_text("! nothing but a comment\n")
    cli.main(["clean", source, str(tmp_path / "1")], spark)
    cli.main(["validate", str(tmp_path / "1"), str(tmp_path / "2")], spark)
    cli.main(["merge", str(tmp_path / "2"), str(tmp_path / "steps.txt")], spark)
    cli.main(["run", source, str(tmp_path / "run.txt")], spark)
    out, err = capsys.readouterr()
    assert (tmp_path / "1/only.txt").read_text() == "" and rulefiles.lines(spark, str(tmp_path / "1")).count() == 9
    assert (tmp_path / "steps.txt").read_text() == (tmp_path / "run.txt").read_text() == "||ads.com^\n127.0.0.1 b.org\n/ads[0-9]/\n"
    assert json.loads(out[out.rindex('{\n  "clean"') :])["validate"]["lines_in"] == 9
    assert "clean: files=3 lines_in=12 lines_out=9" in err and "merge: lines_in=7 lines_out=3 reduction=57.1%" in err
    assert not [f for f in tmp_path.rglob("*") if ".parts-" in f.name]


def test_folders_without_files(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert rulefiles.lines(spark, str(tmp_path / "none")).count() == 0 == rulefiles.listing(spark, str(tmp_path / "none")).count()


ONE = "! Diff-Path: p.patch\n||one.com^\n0.0.0.0 x.org\n"


def web_of(told):
    """A fake web: what each URL answers; 304 to the validator that it gave."""

    def ask(url, headers):
        assert headers["User-Agent"]
        status, got, body = told[url]
        if status == 200 and headers.get("If-None-Match") == got.get("ETag", "-"):
            return 304, {"Last-Modified": "later"}, b""
        return status, got, body

    return ask  # goes to the workers by value


def test_from_the_web_to_the_merged_file(spark, tmp_path):
    import base64
    import hashlib

    good = "||sum.com^\n"
    digest = hashlib.md5(f"\n{good}".encode()).digest()  # without the words of its line, which leaves a line end
    good = f"! Checksum: {base64.b64encode(digest).decode().rstrip('=')}\n{good}"
    web = {
        "http://a/one.txt": (200, {"ETag": "1"}, ONE.encode()),
        "http://a/p.patch": (404, {}, b""),
        "http://b/sum.txt": (200, {"ETag": "2"}, good.encode()),
        "http://c/bad.txt": (200, {}, b"! Checksum: AAAAAAAAAAAAAAAAAAAAAA\n||bad.com^\n"),
        "http://d/gone.txt": (304, {}, b""),
        "http://e/down.txt": (200, {}, b"||down.com^\n"),
        "http://f/copy.txt": (200, {}, b"||down.com^\n"),
    }
    (tmp_path / "urls").write_text("# lists\n" + "\n".join(u for u in web if u.endswith(".txt")) + "\n")

    def fetched():
        cli.main(["fetch", str(tmp_path / "urls"), str(tmp_path / "raw"), "--cache", str(tmp_path / "cache"), "--retries", "0", "--per-host-delay", "0"], spark, web_of(web))
        meta = {r["url"][7]: r for r in fetch.read_meta(spark, f"{tmp_path}/cache/meta").collect()}
        return json.loads((tmp_path / "cache/fetch_summary.json").read_text())["summary"], meta

    told, meta = fetched()
    assert told == {"ok": 4, "not-modified": 0, "used-cache-on-fail": 0, "failed": 2, "processed": 6}
    assert set(meta) == set("abef") and meta["a"]["diff_path"] == "p.patch" and meta["b"]["etag"] == "2"
    assert len([f for f in (tmp_path / "raw").iterdir() if f.suffix == ".txt"]) == 3  # one of two equal files
    cli.main(["run", str(tmp_path / "raw"), str(tmp_path / "out.txt")], spark)
    assert sorted((tmp_path / "out.txt").read_text().splitlines()) == ["0.0.0.0 x.org", "||down.com^", "||one.com^", "||sum.com^"]

    # a second run: a patch, a 304 that refreshes, a checksum that doesn't fit, a failure; cached bodies stay
    web["http://a/p.patch"] = (200, {}, b"diff name:l\nd 3 1\na 2 1\n0.0.0.0 y.org\n")
    web["http://e/down.txt"] = (500, {}, b"")
    web["http://f/copy.txt"] = web["http://c/bad.txt"]
    told, meta = fetched()
    assert told == {"ok": 1, "not-modified": 1, "used-cache-on-fail": 2, "failed": 2, "processed": 6}
    assert (meta["a"]["status_code"], meta["a"]["etag"]) == (226, "1")
    assert (meta["b"]["status_code"], meta["b"]["etag"], meta["b"]["last_modified"]) == (304, "2", "later") and meta["b"]["content_sha256"]
    assert spark.read.parquet(f"{tmp_path}/cache/lists").count() == 4
    cli.main(["run", str(tmp_path / "raw"), str(tmp_path / "out.txt")], spark)
    assert sorted((tmp_path / "out.txt").read_text().splitlines()) == ["0.0.0.0 y.org", "||down.com^", "||one.com^", "||sum.com^"]


def test_unknown_bodies_get_no_validators(spark, tmp_path):
    """Metadata without a body: the list is fetched whole, and a failure doesn't claim a cached copy."""
    meta = spark.createDataFrame([("http://a/x", "p", "e", None, None, 200, 1, None, None), ("http://a/down", "q", "e", None, None, 200, 1, None, None)], fetch.META)
    urls = meta.select("url")
    told = fetch.refresh(spark, urls, meta, str(tmp_path), 3, answers, retries=0, delay=0.0, sleep=lambda s: None)
    assert (told["ok"], told["failed"], told["used-cache-on-fail"]) == (1, 1, 0)


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from gristmill.sources import shared

    class Elsewhere:
        class sparkContext:
            master = "spark://host:7077"

            @staticmethod
            def getConf():
                return {}

        conf = {}

    try:
        shared.shared_dir(Elsewhere)
    except RuntimeError as e:
        assert "spark.checkpoint.dir" in str(e)
    else:
        raise AssertionError("a machine's own folder was taken")
