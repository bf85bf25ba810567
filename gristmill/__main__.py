"""Command line: clean, validate, merge or run a folder of rule files, or fetch the lists of a URL file."""

from __future__ import annotations

import argparse
import functools
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from gristmill.operators import clean
from gristmill.plans import pipeline
from gristmill.sources import fetch, rulefiles


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="gristmill", description=__doc__)
    p.add_argument("step", choices=("clean", "validate", "merge", "run", "fetch"))
    p.add_argument("source", help="a folder of rule files, or for fetch a file of URLs")
    p.add_argument("target", help="a folder, or for merge and run a file")
    p.add_argument("--disallow-ip", action="store_true", help="hosts that are addresses are invalid")
    p.add_argument("--cache", help="fetch: the folder of bodies and metadata (TARGET.cache)")
    p.add_argument("--concurrency", type=int, default=fetch.CONCURRENCY)
    p.add_argument("--timeout", type=float, default=fetch.TIMEOUT)
    p.add_argument("--retries", type=int, default=fetch.RETRIES)
    p.add_argument("--per-host-delay", type=float, default=fetch.DELAY)
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None, transport: fetch.Transport | None = None) -> None:
    a = arguments(argv)
    spark = spark or SparkSession.builder.appName("gristmill").getOrCreate()
    if a.step == "fetch":
        cache = a.cache or f"{a.target.rstrip('/')}.cache"
        ask = transport or functools.partial(fetch.urllib_transport, timeout=a.timeout)
        urls, meta = rulefiles.source_urls(spark, a.source), fetch.read_meta(spark, f"{cache}/meta")
        told = fetch.refresh(spark, urls, meta, cache, int(time.time()), ask, a.target, retries=a.retries, delay=a.per_host_delay, concurrency=a.concurrency)
    elif a.step == "run":
        told = pipeline.run(spark, a.source, a.target, not a.disallow_ip)
        for step, counters in told.items():
            print(pipeline.line(step, counters), file=sys.stderr)
    elif a.step == "merge":
        told = pipeline.merged_file(spark, rulefiles.lines(spark, a.source, keep_bom=False, on_invalid="replace"), a.target)
        print(pipeline.line("merge", told), file=sys.stderr)
    else:
        kept, counted = pipeline.cleaned(spark, a.source) if a.step == "clean" else pipeline.validated(rulefiles.lines(spark, a.source), not a.disallow_ip)
        names = [r["name"] for r in rulefiles.listing(spark, a.source).select("name").collect()]  # one row per file
        rulefiles.write_by_file(kept, a.target, names)
        told = {r["file"]: r.asDict() for r in counted.orderBy(F.lower("file")).collect()}
        whole = clean.summed(counted, "file").first().asDict()
        print(pipeline.line(a.step, {"files": len(names)} | whole), file=sys.stderr)
    print(pipeline.report(told))


if __name__ == "__main__":
    main()
