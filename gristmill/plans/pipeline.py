"""The whole run over a folder of rule files: clean, validate, merge, write; with counters of each step."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.operators import clean, merge, validate
from gristmill.sources import rulefiles
from gristmill.sources.shared import discard, stored


def cleaned(spark: SparkSession, folder: str, on_invalid: str = "error") -> tuple[DataFrame, DataFrame]:
    """Lines of a folder after cleaning (file, file_rank, line_no, raw), and the counters per file."""
    disposed = stored(clean.disposition(rulefiles.lines(spark, folder, on_invalid=on_invalid)), "disposed")
    kept = disposed.where("dropped is null").select("file", "file_rank", "line_no", F.col("cleaned").alias("raw"))
    return kept, clean.counters(disposed, "file")


def validated(lines: DataFrame, allow_ip: bool = True) -> tuple[DataFrame, DataFrame]:
    """Lines that a DNS filter can use, and the counters per file."""
    fated = stored(validate.with_fate(validate.with_verdict(lines, "raw", allow_ip), "file", "line_no"), "fated")
    return fated.where("keep").select("file", "file_rank", "line_no", "raw"), validate.counters(fated, "file")


def merged(lines: DataFrame) -> DataFrame:
    """The merged list of lines: pos, rule, kind."""
    return merge.merge(lines.select(F.struct("file_rank", "line_no").alias("pos"), F.col("raw").alias("rule")))


def merged_file(spark: SparkSession, lines: DataFrame, out: str) -> dict:
    """Writes the merged list of lines to the file `out`; returns lines_in, lines_out and reduction."""
    final = stored(merged(lines), "merged")
    rulefiles.write_merged(final, out)
    n = {"lines_in": lines.count(), "lines_out": final.count()}
    ratio = spark.createDataFrame([n]).select(merge.reduction(F.col("lines_in"), F.col("lines_out"))).first()[0]
    discard(final)
    return n | {"reduction": ratio}


def run(spark: SparkSession, folder: str, out: str, allow_ip: bool = True) -> dict:
    """Writes the merged list to the file `out`; returns the counters of the steps."""
    kept, clean_counts = cleaned(spark, folder)
    valid, valid_counts = validated(kept, allow_ip)
    told = merged_file(spark, valid, out)
    return {"clean": clean.summed(clean_counts, "file").first().asDict(), "validate": clean.summed(valid_counts, "file").first().asDict(), "merge": told}


def line(step: str, counters: dict) -> str:
    """One line of a step's counters, thousands apart and shares as per cent."""
    shown = (f"{k}={v:.1f}%" if isinstance(v, float) else f"{k}={v:,}" for k, v in counters.items())
    return f"{step}: {' '.join(shown)}"


def report(counters: dict) -> str:
    return json.dumps(counters, indent=2, sort_keys=True)
