"""Python functions for what Spark lacks: internationalised names (IDNA 2003) and IPv6 addresses."""

from __future__ import annotations

import ipaddress

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions import text


def to_ascii(name: str) -> str:
    """The IDNA form, or the name itself where it has none."""
    try:
        return name.encode("idna").decode("ascii")
    except UnicodeError:
        return name


def _normalised(name: str | None) -> str | None:
    if name is None:
        return None
    d = name.strip().lower().removeprefix("*.").rstrip(".")
    while ".." in d:
        d = d.replace("..", ".")
    d = d.lstrip(".")
    return d if d.isascii() else to_ascii(d)


@F.pandas_udf(T.StringType())
def _normalised_udf(names: pd.Series) -> pd.Series:
    return names.map(_normalised, na_action="ignore")


@F.pandas_udf(T.StringType())
def _checked_udf(names: pd.Series) -> pd.Series:
    """A host as validation reads it: a leading *. and brackets are kept."""

    def one(name: str) -> str:
        d = name.strip()
        wild = "*." if d.startswith("*.") else ""
        d = d.removeprefix("*.")
        if d.startswith("[") and d.endswith("]"):
            return wild + d
        found = to_ascii(d)
        return wild + (found if found != d or d.isascii() else name)

    return names.map(one, na_action="ignore")


@F.pandas_udf(T.StructType([T.StructField("ip", T.StringType()), T.StructField("unspecified", T.BooleanType()), T.StructField("loopback", T.BooleanType())]))
def _address_udf(addresses: pd.Series) -> pd.DataFrame:
    def one(raw: str | None) -> tuple:
        try:
            found = ipaddress.ip_address((raw or "").strip().strip("[]").split("%", 1)[0])
        except ValueError:
            return None, False, False
        return str(found), found.is_unspecified, found.is_loopback

    return pd.DataFrame([one(x) for x in addresses], columns=["ip", "unspecified", "loopback"])


def with_normalised(rows: DataFrame, column: str, to: str, idna: bool = True) -> DataFrame:
    """Adds the normalised form of a domain column. With idna, rows with other than ASCII letters go through Python.

    They are a branch of their own, so that all other rows stay in native code.
    """
    c = F.col(column)
    if not idna:
        return rows.withColumn(to, text.normalised_domain(c))
    plain = F.coalesce(text.is_ascii(c), F.lit(True))
    native = rows.where(plain).withColumn(to, text.normalised_domain(c))
    return native.unionByName(rows.where(~plain).withColumn(to, _normalised_udf(c)))


def checked_host(c: Column) -> Column:
    return _checked_udf(c)


def ipv4(c: Column) -> Column:
    """struct(ip, unspecified, loopback) of IPv4 addresses; a null ip for all else."""
    a = F.regexp_replace(F.regexp_replace(text.strip(c), r"^[\[\]]+|[\[\]]+\z", ""), r"(?s)%.*\z", "")
    ip = F.when(a.rlike(text.IPV4), a)
    return F.struct(ip.alias("ip"), F.coalesce(ip == "0.0.0.0", F.lit(False)).alias("unspecified"), F.coalesce(ip.startswith("127."), F.lit(False)).alias("loopback"))


def with_address(rows: DataFrame, column: str, to: str, ipv6: bool = True) -> DataFrame:
    """Adds struct(ip, unspecified, loopback); with ipv6, rows with a colon go through Python, once per distinct address."""
    native = rows.withColumn(to, ipv4(F.col(column)))
    if not ipv6:
        return native
    other = F.coalesce(F.col(column).contains(":"), F.lit(False))
    known = rows.where(other).select(F.col(column).alias("_raw")).distinct().withColumn("_address", _address_udf("_raw"))
    joined = rows.where(other).join(known, F.col(column) == F.col("_raw")).withColumn(to, F.col("_address")).drop("_raw", "_address")
    return native.where(~other).unionByName(joined)


def rank(address: Column) -> Column:
    """Which address of a host wins: loopback over others over unspecified; null for what is no address."""
    return F.when(address["ip"].isNull(), F.lit(None).cast("int")).when(address["loopback"], 2).when(address["unspecified"], 0).otherwise(1)
