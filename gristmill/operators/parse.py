"""Parsing of adblock-style and hosts-style rules into structs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions import text


def options(raw: Column) -> Column:
    """name and value of each option: split at commas that no backslash precedes; null without options."""
    cut = F.filter(F.split(raw, r"(?<!\\),"), lambda x: x != "")
    cut = F.transform(cut, lambda x: F.replace(x, F.lit("\\,"), F.lit(",")))
    named = F.transform(cut, lambda x: F.struct(F.regexp_extract(x, r"(?s)^([^=]*)", 1).alias("name"), F.when(x.contains("="), F.regexp_extract(x, r"(?s)^[^=]*=(.*)\z", 1)).alias("value")))
    return F.when(F.size(named) > 0, named)


def with_adblock(rows: DataFrame, column: str, to: str) -> DataFrame:
    """Adds struct(rule_text, pattern, whitelist, options, hostname); null where a rule is too short.

    In steps, so that no expression is written out many times in the generated code.
    """
    rule, body, head = F.col(column), F.col("_body"), F.col("_head")
    found = rows.withColumn("_s", text.strip(rule)).withColumn("_allow", F.col("_s").startswith("@@"))
    found = found.withColumn("_body", F.when(F.col("_allow"), text.after(F.col("_s"), 2)).otherwise(F.col("_s")))
    literal = body.startswith("/") & body.endswith("/") & ~body.contains("replace=")
    found = found.withColumn("_head", F.when(~literal, text.before_last_dollar(body)))
    tail = F.when(head.isNotNull(), body.substr(F.length(head) + 2, F.length(body)))
    found = found.withColumns({"_pattern": F.coalesce(head, body), "_tail": tail})
    found = found.withColumns({"_options": options(F.col("_tail")), "_host": F.regexp_extract(text.strip(F.col("_pattern")), text.BARE, 1)})
    made = F.struct(rule.alias("rule_text"), F.col("_pattern").alias("pattern"), F.col("_allow").alias("whitelist"), F.col("_options").alias("options"), F.nullif(F.col("_host"), F.lit("")).alias("hostname"))
    return found.withColumn(to, F.when(body != "", made)).drop("_s", "_allow", "_body", "_head", "_pattern", "_tail", "_options", "_host")


def hosts(rule: Column) -> Column:
    """struct(rule_text, ip, hostnames); null with fewer than two words. A # that starts the rule doesn't cut it."""
    s = text.strip(rule)
    s = F.when(F.instr(s, "#") > 1, F.substring_index(s, "#", 1)).otherwise(s)
    parts = text.words(s)
    made = F.struct(rule.alias("rule_text"), F.get(parts, F.lit(0)).alias("ip"), F.slice(parts, F.lit(2), F.size(parts)).alias("hostnames"))
    return F.when(F.size(parts) >= 2, made)
