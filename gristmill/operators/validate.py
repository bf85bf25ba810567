"""Validation of rules for filtering at the DNS level: one verdict per line, and the fate of comments above it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.functions import text
from gristmill.functions.idna import checked_host
from gristmill.operators import parse
from gristmill.sources.shared import stored

# The modifiers that a DNS filter knows.
MODIFIERS = ("important", "ctag", "dnstype", "dnsrewrite", "denyallow", "badfilter", "client")
VERDICTS = ("removed_element_hiding", "removed_bad_modifier", "removed_invalid_host", "removed_malformed", "kept_regex", "kept_hosts", "kept_adblock_domain", "kept_wildcard_tld", "kept_other_adblock")


def valid_host(host: Column, allow_ip: bool = True, idna: bool = False) -> Column:
    """A domain, or a single label that may have underscores. IPv4 passes as a domain unless it isn't allowed.

    Without idna a host with other than ASCII letters is invalid; with it, such hosts alone get a value in Python.
    """
    ascii_ = F.when(text.is_ascii(host), host)
    checked = F.coalesce(ascii_, checked_host(F.when(~text.is_ascii(host), host))) if idna else host
    bare = F.when((F.length(checked) > 1) & checked.endswith("."), checked.substr(F.lit(1), F.length(checked) - 1)).otherwise(checked)
    ok = (host != "") & (bare.rlike(text.DOMAIN) | bare.rlike(text.SINGLE_LABEL))
    if not allow_ip:
        ok = ok & ~F.regexp_replace(text.strip(host), r"^\[(.*)\]\z", "$1").rlike(text.IPV4)
    return F.coalesce(ok, F.lit(False))


def _judged(lines: DataFrame, column: str, allow_ip: bool, idna: bool) -> DataFrame:
    """Adds verdict: blank, comment, or one of VERDICTS. In steps, each a column that the next ones read."""
    rule, s, pattern, domain = F.col(column), F.col("_rule"), F.col("_pattern"), F.col("_domain")
    rows = lines.withColumn("_rule", text.strip(F.coalesce(rule, F.lit(""))))
    rows = rows.withColumns({"_comment": text.is_comment(rule), "_regex": text.is_pure_regex(s), "_hosts": s.rlike(text.HOSTS), "_hiding": text.is_element_hiding(s)})
    rows = rows.withColumn("_names", text.words(F.regexp_extract(s, text.HOSTS, 2)))
    rows = rows.withColumn("_good", (F.size("_names") > 0) & F.forall("_names", lambda h: valid_host(h, allow_ip)))
    rows = parse.with_adblock(rows, "_rule", "_props")
    rows = rows.withColumn("_pattern", F.coalesce("_props.pattern", F.lit("")))
    rows = rows.withColumns({"_domain": F.coalesce(text.between(pattern, "||", "^"), F.lit("")), "_caret": F.instr(pattern, "^"), "_star": F.instr(pattern, "*")})
    rows = rows.withColumn("_host_ok", valid_host(domain, allow_ip, idna))
    caret, star = F.col("_caret"), F.col("_star")
    known = F.coalesce(F.forall("_props.options", lambda o: o["name"].isin(*MODIFIERS)), F.lit(True))
    one_star = domain.startswith("*.") & (F.instr(text.after(domain, 1), "*") == 0)
    following = pattern.substr(caret + 1, F.lit(1))
    verdict = (
        F.when(s == "", "blank")
        .when(F.col("_comment"), "comment")
        .when(F.col("_regex"), "kept_regex")
        .when(F.col("_hosts"), F.when(F.col("_good"), "kept_hosts").otherwise("removed_invalid_host"))
        .when(F.col("_hiding"), "removed_element_hiding")
        .when(F.col("_props").isNull(), "removed_malformed")
        .when(~known, "removed_bad_modifier")
        .when(text.has_closing_slash(pattern) & ~pattern.contains("replace="), "kept_regex")
        .when(~F.regexp_replace(pattern, "^://", "").rlike(text.RULE_CHARACTERS), "removed_malformed")
        .when((caret > 0) & (star > caret), "removed_malformed")
        .when(~(pattern.startswith("||") & (caret > 0)), "kept_other_adblock")
        .when(domain.contains("*"), F.when(one_star, "kept_wildcard_tld").otherwise("removed_malformed"))
        .when(~F.col("_host_ok"), "removed_invalid_host")
        .when((following != "") & (following != "|"), "removed_malformed")
        .otherwise("kept_adblock_domain")
    )
    helpers = ("_rule", "_comment", "_regex", "_hosts", "_hiding", "_names", "_good", "_props", "_pattern", "_domain", "_caret", "_star", "_host_ok")
    return rows.withColumn("verdict", verdict).drop(*helpers)


def with_verdict(lines: DataFrame, column: str = "raw", allow_ip: bool = True, idna: bool = True) -> DataFrame:
    """Adds verdict. Lines with other than ASCII characters, if idna is wanted, are a branch of their own.

    In that branch the hosts of a line get their IDNA form first; all other lines stay in native code.
    """
    c = F.col(column)
    if not idna:
        return _judged(lines, column, allow_ip, False)
    plain = F.coalesce(text.is_ascii(c), F.lit(True))
    native = _judged(lines.where(plain), column, allow_ip, False)
    rest = lines.where(~plain).withColumn("_s", text.strip(c))
    is_names = F.col("_s").rlike(text.HOSTS) & ~text.is_pure_regex(F.col("_s")) & ~text.is_comment(c)
    keyed = stored(rest.withColumn("_names", is_names).withColumn("_line", F.monotonically_increasing_id()), "names")
    hosts = keyed.where("_names").select("_line", F.explode(text.words(F.regexp_extract("_s", text.HOSTS, 2))).alias("_host"))
    judged = hosts.groupBy("_line").agg(F.bool_and(valid_host(F.col("_host"), allow_ip, True)).alias("_good"))
    verdict = F.when(F.coalesce("_good", F.lit(False)), "kept_hosts").otherwise("removed_invalid_host")
    one = keyed.where("_names").join(judged, "_line", "left").withColumn("verdict", verdict).drop("_good", "_line", "_names", "_s")
    two = _judged(keyed.where("not _names").drop("_line", "_names", "_s"), column, allow_ip, True)
    return native.unionByName(one).unionByName(two)


def with_fate(judged: DataFrame, file: str, line_no: str) -> DataFrame:
    """Adds keep. A comment shares the fate of the next line that is none; a blank line is removed, the end of a file is not.

    Looked at from below, the window is a running last value, so each file is one linear pass.
    """
    valid = F.when(F.col("verdict") == "blank", False).when(F.col("verdict") != "comment", F.col("verdict").startswith("kept"))
    below = Window.partitionBy(file).orderBy(F.desc(line_no)).rowsBetween(Window.unboundedPreceding, -1)
    next_ = F.coalesce(F.last(valid, ignorenulls=True).over(below), F.lit(True))
    return judged.withColumn("keep", F.when(F.col("verdict") == "comment", next_).otherwise(valid))


def validate(lines: DataFrame, file: str = "file", line_no: str = "line_no", column: str = "raw", allow_ip: bool = True, idna: bool = True) -> DataFrame:
    """The lines that stay, as they are."""
    return with_fate(with_verdict(lines, column, allow_ip, idna), file, line_no).where("keep").drop("verdict", "keep")


def counters(fated: DataFrame, by: str) -> DataFrame:
    """Per file the counts of lines in and out, of every verdict, and of removed comments, blank and invalid lines."""
    verdict_ = F.col("verdict")
    return fated.groupBy(by).agg(
        F.count(F.lit(1)).alias("lines_in"),
        F.count_if("keep").alias("lines_out"),
        F.count_if(verdict_.startswith("removed")).alias("removed_invalid"),
        *(F.count_if(verdict_ == v).alias(v) for v in VERDICTS),
        F.count_if((verdict_ == "comment") & ~F.col("keep")).alias("removed_comments"),
        F.count_if(verdict_ == "blank").alias("removed_empty"),
    )
