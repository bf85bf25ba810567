"""Not-modified revisits of a web archive: each is resolved to the latest earlier full response of its canonical URL.

A revisit record says that a server answered 304: its payload is that of a response captured before. The as-of join is
made in two steps, so that a URL that was captured very often is no single group: within a span of time the latest
response is carried forward by a window; from span to span only one row per URL and span is carried. Payloads don't
travel: the join carries record ids, and payload() fetches what is wanted.

Validators: the revisit's ETag must equal the response's by weak comparison (W/ and quotes aside); without an ETag on
either side its Last-Modified must be equal; without any validator the payload digests must be equal. Headers: those of
the response, with those that a 304 may update taken from the revisit where it has them.

Defined results: full responses are those of status 200; others, and those without a status, are never referred to, and
neither are records of another type. A null URL or time takes no part as a response, and a revisit with one stays unresolved
(no_url or no_earlier). Null headers are empty ones, and stay null only where a revisit is not resolved; a header of a null
value is one that isn't there. Responses of the same time as a revisit are not earlier; of responses of the same time the one with the
larger record id is the later; repeated record ids are records of their own; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm.common import table

#: Seconds of a span of time: a URL's records are one group within a span only.
SPAN = 4096
#: Headers that a 304 response may update (RFC 9110, 15.4.5, and RFC 9111, 3.2).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary", "last-modified", "age", "set-cookie")
#: Query parameters that say nothing about the page.
TRACKING = r"(?i)(?:utm_[a-z]+|fbclid|gclid|ref|sessionid|phpsessid|jsessionid)=[^&#]*"


def canonical(url: Column) -> Column:
    """A URL without scheme, user, www., default port, fragment, tracking parameters and closing slash; host in small letters."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    bare = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.\-]*://", "")
    host = F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"^www[0-9]*\.", ""), r":(80|443)?$", "")
    rest = F.regexp_replace(bare, r"^[^/?]*", "")
    path, query = F.regexp_extract(rest, r"^([^?]*)", 1), F.regexp_extract(rest, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda q: (q != "") & ~q.rlike(f"^{TRACKING}$")))
    query = F.array_join(kept, "&")
    path = F.regexp_replace(path, r"/+$", "")
    return F.when(host != "", F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def _tag(etag: Column) -> Column:
    return F.regexp_replace(F.trim(etag), r'^(?:W/)?"?|"?$', "")


def resolved(records: DataFrame, span: int = SPAN) -> DataFrame:
    """records: record_id, type ('response' or 'revisit'), url, captured (seconds), status, digest, headers (map, small names).

    Returns a row per revisit: record_id, canonical_url, captured, refers_to, outcome (resolved, changed, no_earlier or
    no_url), headers, and the digest of the payload it stands for.
    """
    is_full = (F.col("type") == "response") & (F.col("status") == 200) & F.col("captured").isNotNull()
    present = F.map_filter(F.coalesce("headers", F.create_map().cast("map<string,string>")), lambda _, v: v.isNotNull())
    one = F.struct("captured", "record_id", "digest", F.array_sort(F.map_entries(present)).alias("entries"))
    rows = records.where(is_full | (F.col("type") == "revisit")).select("record_id", "type", canonical(F.col("url")).alias("canonical_url"), "captured", "digest", "headers", present.alias("_present"))
    rows = rows.withColumn("_span", F.floor(F.col("captured") / span)).withColumn("_full", F.when(F.col("type") == "response", one))
    rows = rows.where("type = 'revisit' or canonical_url is not null")
    # within a span: the latest response before; a range frame leaves out records of the same second
    here = Window.partitionBy("canonical_url", "_span").orderBy("captured").rangeBetween(Window.unboundedPreceding, -1)
    in_span = rows.withColumn("_near", F.max("_full").over(here)).where("type = 'revisit'").drop("_full")
    # from span to span: one row per URL and span
    ends = rows.where("_full is not null").groupBy("canonical_url", "_span").agg(F.max("_full").alias("_end"))
    asked = in_span.where("_near is null and canonical_url is not null and _span is not null").select("canonical_url", "_span").distinct()
    before = Window.partitionBy("canonical_url").orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_asked", F.lit(False)).unionByName(asked.withColumn("_end", F.lit(None).cast(ends.schema["_end"].dataType)).withColumn("_asked", F.lit(True)))
    carried = carried.groupBy("canonical_url", "_span").agg(F.max("_end").alias("_end"), F.max("_asked").alias("_asked"))
    carried = carried.withColumn("_far", F.last("_end", ignorenulls=True).over(before)).where("_asked").select("canonical_url", "_span", "_far")
    found = in_span.join(carried, ["canonical_url", "_span"], "left").withColumn("_to", F.coalesce("_near", "_far"))
    etag, modified = (F.col("_present")[name] for name in ("etag", "last-modified"))
    theirs = F.map_from_entries("_to.entries")
    their_etag, their_modified = (theirs[name] for name in ("etag", "last-modified"))
    same = (
        F.when(etag.isNotNull() & their_etag.isNotNull(), _tag(etag) == _tag(their_etag))
        .when(modified.isNotNull() & their_modified.isNotNull(), modified == their_modified)
        .otherwise(F.col("digest") == F.col("_to.digest"))
    )
    outcome = F.when(F.col("canonical_url").isNull(), "no_url").when(F.col("_to").isNull(), "no_earlier").when(F.coalesce(same, F.lit(False)), "resolved").otherwise("changed")
    permitted = F.map_filter("_present", lambda k, _: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter(theirs, lambda k, _: ~F.map_contains_key(permitted, k)), permitted)
    done = found.withColumn("outcome", outcome)
    ok = F.col("outcome") == "resolved"
    return done.select("record_id", "canonical_url", "captured", F.when(ok, F.col("_to.record_id")).alias("refers_to"), "outcome", F.when(ok, merged).otherwise(F.col("headers")).alias("headers"), F.when(ok, F.col("_to.digest")).alias("payload_digest"))


def payload(found: DataFrame, bodies: DataFrame) -> DataFrame:
    """Adds body to resolved revisits, from bodies (record_id, body)."""
    wanted = bodies.select(F.col("record_id").alias("refers_to"), "body")
    return found.join(wanted, "refers_to", "left")


def captures(pages: DataFrame) -> DataFrame:
    """Records of an archive from the pages, for the query: each page is a response, and is revisited later.

    The response of page p is captured at second 40 p. Its revisit follows p % 7 hours after and has another spelling of
    the URL; for p % 11 = 3 its ETag is another one, for p % 13 = 5 it comes before the response, for p % 17 = 6 it has
    Last-Modified only, for p % 19 = 7 no validator at all.
    """
    p = F.col("page_id")
    etag = F.concat(F.lit('"'), F.left(F.md5(F.coalesce("html", F.lit(""))), F.lit(16)), F.lit('"'))
    date = lambda seconds: F.concat(F.lit("t"), seconds.cast("string"))
    digest = F.md5(F.coalesce("html", F.lit("")))
    headers = F.map_from_arrays(F.array(*map(F.lit, ("content-type", "etag", "last-modified", "date", "server"))), F.array(F.lit("text/html"), etag, date(p * 40 - 9), date(p * 40), F.lit("a")))
    full = pages.select((p * 2).alias("record_id"), F.lit("response").alias("type"), "url", (p * 40).alias("captured"), F.lit(200).alias("status"), digest.alias("digest"), headers.alias("headers"))
    at = F.when(p % 13 == 5, p * 40 - 20).otherwise(p * 40 + 3600 * (p % 7) + 20)
    tag = F.when(p % 11 == 3, F.lit('"changed"')).otherwise(F.concat(F.lit("W/"), etag))
    names = F.when(p % 19 == 7, F.array(F.lit("date"), F.lit("server"))).when(p % 17 == 6, F.array(F.lit("date"), F.lit("server"), F.lit("last-modified"))).otherwise(F.array(F.lit("date"), F.lit("server"), F.lit("etag")))
    values = F.when(p % 19 == 7, F.array(date(at), F.lit("b"))).when(p % 17 == 6, F.array(date(at), F.lit("b"), date(p * 40 - 9))).otherwise(F.array(date(at), F.lit("b"), tag))
    spelled = F.when(p % 2 == 0, F.concat(F.lit("HTTPS://"), F.regexp_replace("url", r"^[a-z]+://", ""), F.lit("#again"))).otherwise(F.regexp_replace("url", r"(#.*)?$", ""))
    again = pages.select((p * 2 + 1).alias("record_id"), F.lit("revisit").alias("type"), spelled.alias("url"), at.alias("captured"), F.lit(304).alias("status"), digest.alias("digest"), F.map_from_arrays(names, values).alias("headers"))
    return full.union(again)


def op1_warc_revisits(spark, sf_dir: str) -> DataFrame:
    found = resolved(captures(table(spark, sf_dir, "pages")))
    entries = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat_ws("=", e["key"], e["value"]))), "; ")
    return found.withColumn("headers", entries)


ORACLE = r"""
with p as (
  select page_id as p, url, md5(coalesce(html, '')) as digest, '"' || left(md5(coalesce(html, '')), 16) || '"' as etag from pages),
f as (select p * 2 as record_id, url, p * 40 as captured, digest, etag, p from p),
r as (
  select p * 2 + 1 as record_id,
    case when p % 2 = 0 then 'HTTPS://' || regexp_replace(url, '^[a-z]+://', '') || '#again' else regexp_replace(url, '#.*$', '') end as url,
    case when p % 13 = 5 then p * 40 - 20 else p * 40 + 3600 * (p % 7) + 20 end as captured, digest,
    case when p % 11 = 3 then '"changed"' else 'W/' || etag end as etag, p
  from p),
u as (select *, true as is_full from f union all by name select *, false as is_full from r),
a as (select *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.\-]*://', '') as bare from u),
b as (
  select *, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), '^.*@', ''), '^www[0-9]*\.', ''), ':(80|443)?$', '') as host,
    regexp_replace(regexp_extract(regexp_replace(bare, '^[^/?]*', ''), '^([^?]*)', 1), '/+$', '') as path,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(regexp_replace(bare, '^[^/?]*', ''), '\?(.*)$', 1), '&'),
      lambda q: q <> '' and not regexp_matches(q, '^(?i)(?:utm_[a-z]+|fbclid|gclid|ref|sessionid|phpsessid|jsessionid)=[^&#]*$'))), '&') as query
  from a),
c as (select *, case when host <> '' then host || path || case when query <> '' then '?' || query else '' end end as canonical_url from b),
j as (
  select r.record_id, r.canonical_url, r.captured, r.digest, r.etag, r.p,
    (select arg_max(struct_pack(record_id := f.record_id, digest := f.digest, etag := f.etag, p := f.p), (f.captured, f.record_id))
     from c f where f.is_full and f.canonical_url = r.canonical_url and f.captured < r.captured) as t
  from c r where not is_full),
k as (
  select *, case when canonical_url is null then 'no_url' when t is null then 'no_earlier'
    when (case when p % 19 = 7 then digest = t.digest when p % 17 = 6 then p = t.p
               else regexp_replace(regexp_replace(etag, '^(W/)?"', ''), '"$', '') = replace(t.etag, '"', '') end) then 'resolved' else 'changed' end as outcome
  from j)
select record_id, canonical_url, captured, case when outcome = 'resolved' then t.record_id end as refers_to, outcome,
  case when outcome = 'resolved' then
    'content-type=text/html; date=t' || captured || '; etag=' || (case when p % 19 = 7 or p % 17 = 6 then t.etag else etag end) || '; last-modified=t' || (t.p * 40 - 9) || '; server=a'
  else 'date=t' || captured || (case when p % 19 = 7 then '' when p % 17 = 6 then '; last-modified=t' || (p * 40 - 9) else '; etag=' || etag end) || '; server=b' end as headers,
  case when outcome = 'resolved' then t.digest end as payload_digest
from k
"""
