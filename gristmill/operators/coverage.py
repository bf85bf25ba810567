"""Membership tests on the domain hierarchy, as equi-joins on exploded suffixes.

A domain is covered through itself or a parent. All tests of a set of domains share one explode and one join: the
dimension has one row per domain of any set, with a flag per set, so that no test needs an OR in a join condition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions import text

SETS = ("abp", "wildcard", "allow", "allow_wildcard")


def edges(domains: DataFrame, column: str = "norm") -> DataFrame:
    """norm, depth (0 for the domain itself) and suffix of distinct domains."""
    return domains.select(F.col(column).alias("norm")).where("norm <> ''").distinct().select("norm", F.posexplode(text.suffixes(F.col("norm"))).alias("depth", "suffix"))


def dimension(sets: dict[str, DataFrame]) -> DataFrame:
    """suffix and a boolean per set; each set has one column of domains."""
    parts = [d.toDF("suffix").where("suffix <> ''").select("suffix", *(F.lit(name == other).alias(other) for other in sets)) for name, d in sets.items()]
    return reduce(DataFrame.union, parts).groupBy("suffix").agg(*(F.max(name).alias(name) for name in sets))


def memberships(domains: DataFrame, sets: dict[str, DataFrame], column: str = "norm") -> DataFrame:
    """norm, and for each set <name>_self and <name>_parent, of the domains that are in or below any set."""
    met = edges(domains, column).join(dimension(sets), "suffix")
    own = [F.max(F.col(s) & (F.col("depth") == 0)).alias(f"{s}_self") for s in sets]
    above = [F.max(F.col(s) & (F.col("depth") > 0)).alias(f"{s}_parent") for s in sets]
    return met.groupBy("norm").agg(*own, *above)


def flag(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def allowed() -> Column:
    """Allow rules cover a domain and all below; their wildcards only what is below."""
    return flag("allow_self") | flag("allow_parent") | flag("allow_wildcard_parent")


def covered() -> Column:
    """Blocking rules cover a domain and all below; wildcards only what is below. Modifiers don't matter."""
    return flag("abp_self") | flag("abp_parent") | flag("wildcard_parent")


def minimal_cover(domains: DataFrame, column: str = "norm") -> DataFrame:
    """The domains without a strict parent among them."""
    all_ = domains.select(F.col(column).alias("norm")).where("norm <> ''").distinct()
    above = edges(all_).where("depth > 0").join(all_.select(F.col("norm").alias("suffix")), "suffix", "left_semi").select("norm").distinct()
    return all_.join(above, "norm", "left_anti")


def below(domains: DataFrame, roots: DataFrame, column: str = "norm") -> DataFrame:
    """The distinct domains that have a strict parent among the roots (one column)."""
    return edges(domains, column).where("depth > 0").join(roots.toDF("suffix"), "suffix", "left_semi").select("norm").distinct()
