"""Fetching of lists: conditional requests, status, retries, patches, metadata.

The transport is a parameter: a function from (url, request headers) to (status, response headers, body), which must be
picklable; the default one uses urllib. Requests run on executors, grouped by origin, so that each origin is paced in
one task.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions import text
from gristmill.operators import patch
from gristmill.sources import rulefiles
from gristmill.sources.shared import discard, path_of, stored, write_text

# The defaults of a fetch.
CONCURRENCY, RETRIES, TIMEOUT, DELAY = 8, 3, 30, 0.2
HEADER_LINES, PATCHED = 200, 226
AGENT = "Mozilla/5.0 (compatible; gristmill/1.0)"
META = "url string, path string, etag string, last_modified string, content_sha256 string, status_code int, fetched_at long, diff_path string, list_checksum string"
LISTS = "url string, name string, body binary"
RESULT = "url string, status_code int, body binary, etag string, last_modified string, attempts int, error string"

Transport = Callable[[str, dict[str, str]], tuple[int, dict[str, str], bytes]]


def retryable(status: Column) -> Column:
    return (status == 429) | status.between(500, 599)


def backoff(attempt: Column, jitter: Column | float = 0.0) -> Column:
    """Seconds before the next attempt: doubled each time, a tenth more by jitter (0 to 1), ten at most."""
    base = F.lit(0.5) * F.pow(F.lit(2.0), attempt - 1)
    return F.least(base + base * F.lit(0.1) * (F.lit(jitter) if isinstance(jitter, float) else jitter), F.lit(10.0))


def outcome(status: Column, has_cache: Column) -> Column:
    return (
        F.when(status == 200, "ok")
        .when((status == 304) & has_cache, "not-modified")
        .when(has_cache, "used-cache-on-fail")
        .otherwise("failed")
    )


def requests(urls: DataFrame, meta: DataFrame) -> DataFrame:
    """url, origin, and the validators to send, from what is known of the URL."""
    known = meta.select("url", F.col("etag").alias("if_none_match"), F.col("last_modified").alias("if_modified_since"))
    return urls.join(known, "url", "left").withColumn("origin", text.origin(F.col("url")))


def paced(asked: DataFrame, order: str, delay: float = DELAY) -> DataFrame:
    """Adds ordinal (from 0 within an origin) and the earliest start in seconds."""
    n = F.row_number().over(Window.partitionBy("origin").orderBy(order)) - 1
    return asked.withColumn("ordinal", n).withColumn("not_before", n * F.lit(delay))


def urllib_transport(url: str, headers: dict[str, str], timeout: float = TIMEOUT) -> tuple[int, dict[str, str], bytes]:
    from urllib.error import HTTPError
    from urllib.request import Request, urlopen

    try:
        with urlopen(Request(url, headers=headers), timeout=timeout) as r:
            return r.status, dict(r.headers), r.read()
    except HTTPError as e:
        return e.code, dict(e.headers), b""


def fetch(asked: DataFrame, transport: Transport = urllib_transport, retries: int = RETRIES, delay: float = DELAY, sleep: Callable[[float], None] = time.sleep, concurrency: int = CONCURRENCY) -> DataFrame:
    """Runs the requests; a row per URL as in RESULT. 429, 5xx and errors are tried again, other answers are final.

    Each origin's requests run in one task, at most `concurrency` tasks. When they start is `paced`, what is waited
    before another attempt is `backoff`, with a jitter by the hash of URL and attempt; both come as columns.
    """
    jitter = lambda k: F.pmod(F.xxhash64("url", k), F.lit(1000)) / 1000.0
    waits = F.transform(F.sequence(F.lit(1), F.lit(retries)), lambda k: backoff(k, jitter(k))) if retries else F.array().cast("array<double>")

    def one(row) -> tuple:
        told = (("User-Agent", AGENT), ("If-None-Match", row.if_none_match), ("If-Modified-Since", row.if_modified_since))
        headers = {k: v for k, v in told if isinstance(v, str)}
        for attempt, wait in enumerate([*row.waits, None], 1):
            try:
                status, got, body = transport(row.url, headers)
                error = None
            except Exception as e:  # any failure of a transport counts as an attempt
                status, got, body, error = None, {}, None, f"{type(e).__name__}: {e}"
            if wait is None or status is not None and status != 429 and not 500 <= status <= 599:
                break
            sleep(wait)
        low = {k.lower(): v for k, v in got.items()}
        return row.url, status, body if status == 200 else None, low.get("etag"), low.get("last-modified"), attempt, error

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        begun: dict[str, float] = {}
        last: dict[str, float] = {}
        for frame in frames:
            out = []
            for row in frame.itertuples():
                now = time.time()
                wait = max(begun.setdefault(row.origin, now) + row.not_before, last.get(row.origin, 0.0) + delay) - now
                if wait > 0:
                    sleep(wait)
                out.append(one(row))
                last[row.origin] = time.time()
            yield pd.DataFrame(out, columns=["url", "status_code", "body", "etag", "last_modified", "attempts", "error"]).astype({"status_code": "Int32"})

    rows = paced(asked, "url", delay).withColumn("waits", waits).repartition(concurrency, "origin").sortWithinPartitions("origin", "ordinal")
    return rows.select("url", "origin", "if_none_match", "if_modified_since", "not_before", "waits").mapInPandas(run, RESULT)


def patch_outcome(status: Column, body: Column) -> Column:
    """What a patch's answer means: patch, unavailable (none is there, or an empty one) or error."""
    empty = F.coalesce(text.strip(body) == "", F.lit(True))
    return F.when(status.isin(204, 404) | ((status == 200) & empty), "unavailable").when(status == 200, "patch").otherwise("error")


def updated_by_patch(lists: DataFrame, transport: Transport = urllib_transport, **how) -> DataFrame:
    """lists: url, text, diff_path, list_checksum. Adds result (null: fetch the whole list), and why.

    The patch is fetched from the list's diff path and applied; the result must have the checksum that the list states.
    """
    asked = lists.withColumn("_at", patch_url("url", "diff_path"))
    wanted = asked.where("_at.url is not null").select(F.col("_at.url").alias("url")).distinct()
    nothing = F.lit(None).cast("string")
    sent = fetch(requests(wanted, wanted.select("url", nothing.alias("etag"), nothing.alias("last_modified"))), transport, **how)
    answers = sent.select(F.col("url").alias("_u"), "status_code", F.col("body").cast("string").alias("patch"))
    met = asked.join(answers, F.col("_at.url") == F.col("_u"), "left").withColumn("resource", F.col("_at.resource"))
    what = F.when(F.col("_at.url").isNull(), "no path").otherwise(patch_outcome(F.col("status_code"), F.col("patch")))
    done = patch.patched(met.withColumn("_what", what).withColumn("patch", F.when(F.col("_what") == "patch", F.col("patch")).otherwise("")))
    good = F.coalesce(text.checksum_matches(F.col("result"), F.col("list_checksum")), F.lit(False))
    why = F.when(F.col("_what") != "patch", F.col("_what")).when(F.col("error").isNotNull(), F.col("error")).when(~good, "list checksum differs").otherwise("patched")
    return done.withColumn("why", why).withColumn("result", F.when(F.col("why") == "patched", F.col("result"))).select(*lists.columns, "result", "why")


def read_lists(spark, folder: str) -> DataFrame:
    """url, name and body of the lists that a cache folder holds; none without one."""
    fs, path = path_of(spark, f"{folder}/lists")
    return spark.read.schema(LISTS).parquet(path.toString()) if fs.exists(path) else spark.createDataFrame([], LISTS)


def _write_lists(lists: DataFrame, folder: str) -> None:
    """Puts the table in place of the one before by a rename, once it is written whole."""
    spark = lists.sparkSession
    fs, path = path_of(spark, f"{folder}/lists")
    new = path.suffix(f"-{uuid.uuid4().hex}")
    lists.write.parquet(new.toString())
    fs.delete(path, True)
    if not fs.rename(new, path):
        raise OSError(f"could not write {path.toString()}")


def stated(lists: DataFrame) -> DataFrame:
    """url, diff_path and list_checksum as the header lines of lists (url, body) state them; null where they don't."""
    every = rulefiles.numbered(F.col("body").cast("string"))
    rows = lists.select("url", F.explode(F.slice(every, 1, HEADER_LINES)).alias("l")).select("url", "l.line_no", "l.raw")
    return header_meta(directives(rows)).select("url", "diff_path", "list_checksum")


def refresh(spark, urls: DataFrame, meta: DataFrame, folder: str, now: int, transport: Transport = urllib_transport, out: str | None = None, **how) -> dict[str, int]:
    """Brings the lists of a cache folder up to date; returns the numbers by status.

    A cached list that names a patch is patched; if that fails, and all others, are fetched, with validators where a body
    is cached. A new body must have the checksum that it states, else the cached one stays. An answer of 304 refreshes
    the metadata, and is a failure without a cached body. The folder keeps one body per URL (lists), metadata (meta) and
    fetch_summary.json. With `out`, all lists that are there are written to that folder as text files, left-over and
    repeated files are deleted.
    """
    known = stored(meta, "meta")
    lists = stored(read_lists(spark, folder).join(urls.distinct(), "url", "left_semi"), "lists")
    own = known.select("url", F.col("diff_path").alias("_d"), F.col("list_checksum").alias("_c"))
    told = lists.join(stated(lists), "url", "left").join(own, "url", "left")
    told = told.select("url", F.col("body").cast("string").alias("text"), F.coalesce("diff_path", "_d").alias("diff_path"), F.coalesce("list_checksum", "_c").alias("list_checksum"))
    patched = stored(updated_by_patch(told.where("diff_path is not null"), transport, **how).where("result is not null").select("url", F.col("result").cast("binary").alias("body")), "patched")
    rest = urls.distinct().join(patched, "url", "left_anti")
    got = stored(fetch(requests(rest, known.join(lists, "url", "left_semi")), transport, **how), "fetched")
    news = stated(got.where("status_code = 200").select("url", "body"))
    met = got.join(news, "url", "left").join(lists.select("url", F.lit(True).alias("_cached")), "url", "left")
    cached, right = F.coalesce("_cached", F.lit(False)), text.checksum_matches(F.col("body").cast("string"), F.col("list_checksum"))
    wrong = (F.col("status_code") == 200) & ~F.coalesce(right, F.lit(True)) & (F.octet_length("body") > 0)
    status = F.when(wrong, F.when(cached, "used-cache-on-fail").otherwise("failed")).otherwise(outcome(F.coalesce("status_code", F.lit(0)), cached))
    met = stored(met.withColumn("status", status), "met")
    fresh = met.where("status = 'ok'").select("url", "body").union(patched)
    name = text.safe_file_name(F.col("url")).alias("name")
    kept = read_lists(spark, folder).join(fresh.select("url"), "url", "left_anti").select("url", "name", "body")
    _write_lists(kept.union(fresh.select("url", name, "body")), folder)
    changed = stated(fresh).select("url", F.col("diff_path").alias("_d"), F.col("list_checksum").alias("_c"))
    answers = met.where("status in ('ok', 'not-modified')").select("url", "status_code", "etag", "last_modified").union(patched.select("url", F.lit(PATCHED), F.lit(None), F.lit(None)))
    old = known.select("url", *(F.col(c).alias(f"old_{c}") for c in ("etag", "last_modified", "content_sha256", "diff_path", "list_checksum")))
    rows = answers.join(old, "url", "left").join(changed, "url", "left").join(fresh.select("url", F.sha2("body", 256).alias("sha")), "url", "left")
    whole = F.col("status_code") == 200  # else what was known stays where the answer says nothing
    keep = lambda new, c: F.when(whole, F.col(new)).otherwise(F.coalesce(new, f"old_{c}")).alias(c)
    columns = [keep("etag", "etag"), keep("last_modified", "last_modified"), F.coalesce("sha", "old_content_sha256").alias("content_sha256"), "status_code", F.lit(now).cast("long").alias("fetched_at"), keep("_d", "diff_path"), keep("_c", "list_checksum")]
    records = rows.select("url", text.safe_file_name(F.col("url")).alias("path"), *columns)
    write_meta(stored(record(known, records), "meta"), f"{folder}/meta")
    results = met.select("status").union(patched.select(F.lit("ok")))
    counted = {"ok": 0, "not-modified": 0, "used-cache-on-fail": 0, "failed": 0} | {r["status"]: r["n"] for r in summary(results).collect()}
    write_text(spark, f"{folder}/fetch_summary.json", json.dumps({"summary": counted, "timestamp": now}, indent=2))
    if out:
        rulefiles.write_bodies(read_lists(spark, folder).join(urls.distinct(), "url", "left_semi"), out)
        rulefiles.purge(spark, out)
        rulefiles.drop_copies(spark, out)
    for used in (known, lists, patched, got, met):
        discard(used)
    return counted


def directives(lines: DataFrame, by: str = "url") -> DataFrame:
    """Per list a map of the `! Key: Value` lines that start it: keys in small letters, the last one of a key wins."""
    head = Window.partitionBy(by).orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    top = lines.where(F.col("line_no") <= HEADER_LINES).withColumn("_ok", F.bool_and(F.col("raw").startswith("!")).over(head)).where("_ok")
    body = text.strip(text.after(F.col("raw"), 1))
    at = F.instr(body, ":")
    pairs = top.where(at > 0).select(by, "line_no", F.lower(text.strip(body.substr(F.lit(1), at - 1))).alias("key"), text.strip(body.substr(at + 1, F.length(body))).alias("value"))
    last = pairs.groupBy(by, "key").agg(F.max_by("value", "line_no").alias("value"))
    return last.groupBy(by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("directives"))


def header_meta(found: DataFrame) -> DataFrame:
    """diff_path and list_checksum of directives; empty ones are null."""
    d = F.col("directives")
    return found.withColumn("diff_path", F.nullif(d["diff-path"], F.lit(""))).withColumn("list_checksum", F.nullif(d["checksum"], F.lit("")))


@F.pandas_udf(T.StructType([T.StructField("url", T.StringType()), T.StructField("resource", T.StringType())]))
def patch_url(lists: pd.Series, paths: pd.Series) -> pd.DataFrame:
    """The absolute URL of a list's patch, and the resource that its fragment names; nulls for an empty path."""
    from urllib.parse import urldefrag, urljoin

    out = []
    for base, path in zip(lists, paths, strict=True):
        rest, fragment = urldefrag((path or "").strip())
        out.append((urljoin(base, rest), fragment or None) if rest and base else (None, None))
    return pd.DataFrame(out, columns=["url", "resource"])


def record(meta: DataFrame, fetched: DataFrame) -> DataFrame:
    """Metadata after a fetch: a record replaces the one of its URL; the latest wins."""
    newest = F.row_number().over(Window.partitionBy("url").orderBy(F.desc("fetched_at"), F.desc("_new")))
    both = meta.withColumn("_new", F.lit(0)).unionByName(fetched.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return both.withColumn("_n", newest).where("_n = 1").drop("_n", "_new")


def update(meta: DataFrame, updates: DataFrame) -> DataFrame:
    """Merges updates (url, set map<string,string>, unset array<string>) into the text columns of metadata.

    A URL that isn't known gets a record with its computed file name.
    """
    texts = [f.name for f in meta.schema if f.dataType.simpleString() == "string" and f.name not in ("url",)]
    joined = meta.join(updates, "url", "full")
    path = F.coalesce("path", text.safe_file_name(F.col("url")))
    out = {}
    for c in texts:
        own = path if c == "path" else F.col(c)
        gone = F.coalesce(F.array_contains("unset", c), F.lit(False))
        out[c] = F.when(gone, F.lit(None)).otherwise(F.coalesce(F.col("set")[c], own))
    return joined.select("url", *(out.get(c, F.col(c)).alias(c) for c in meta.columns if c != "url"))


def cached(urls: DataFrame, meta: DataFrame, files: DataFrame) -> DataFrame:
    """url and cached: the recorded path if that file is there, else the computed one if it is, else null."""
    there = files.select(F.col("path").alias("_p")).distinct()
    known = urls.join(meta.select("url", "path"), "url", "left").withColumn("_c", text.safe_file_name(F.col("url")))
    a, b = there.withColumnRenamed("_p", "_a"), there.withColumnRenamed("_p", "_b")
    found = known.join(a, F.col("path") == F.col("_a"), "left").join(b, F.col("_c") == F.col("_b"), "left")
    return found.select("url", F.coalesce("_a", "_b").alias("cached"))


def read_meta(spark, path: str) -> DataFrame:
    """Metadata records; lines that aren't JSON are left out, a missing folder is an empty table."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], META)
    rows = spark.read.schema(f"{META}, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return rows.where("_corrupt is null and url is not null").drop("_corrupt")


def write_meta(meta: DataFrame, path: str) -> None:
    meta.orderBy("url").write.mode("overwrite").json(path)


def summary(results: DataFrame) -> DataFrame:
    """status, n and the number of all."""
    counted = results.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return counted.union(results.agg(F.lit("processed").alias("status"), F.count(F.lit(1)).alias("n")))
