"""Scalar expressions over rule lines. All are native Column expressions; Java regexes follow Python's where they differ.

Python's white space is wider than Java's \\s: the (?U) flag adds Unicode's, the range 1C-1F is named.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's white space.
WHITE_CHARACTERS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

# The formats that a line is told by.
WHITE = r"[\s\x1c-\x1f]"
SEPARATOR = r"^[-=*_.]{3,}\z"
ELEMENT_HIDING = r"##|#@#|#%#"
LABEL = r"[0-9A-Za-z](?:[0-9A-Za-z-]{0,61}[0-9A-Za-z])?"
DOMAIN = rf"^(?=.{{1,255}}\z){LABEL}(?:\.{LABEL})*\.?\z"
HOSTS = rf"(?Us)^([0-9A-Fa-f:.\[\]]+)(?:%[a-zA-Z0-9]+)?{WHITE}+([^#]+)(?:#.*)?\z"
BARE = r"^\|\|([^\^]+)\^\z"
RULE_CHARACTERS = r"^[a-zA-Z0-9\-.*|^:/]+\z"
SINGLE_LABEL = r"^[A-Za-z0-9_-]+\z"
IPV4 = r"^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\.(?!\z)|\z)){4}\z"
CHECKSUM_LINE = r"(?im)^!\s*checksum:\s*\S+"
NEWLINE = r"\r\n|\r|\n"


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(WHITE_CHARACTERS))


def lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(WHITE_CHARACTERS))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(WHITE_CHARACTERS))


def words(c: Column) -> Column:
    """Split at white space, without empty words."""
    return F.filter(F.split(strip(c), rf"(?U){WHITE}+"), lambda x: x != "")


def is_blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def is_comment(c: Column) -> Column:
    s = lstrip(c)
    return F.coalesce(s.rlike(r"^[!#]") | s.rlike(SEPARATOR), F.lit(False))


def is_element_hiding(c: Column) -> Column:
    return c.rlike(ELEMENT_HIDING)


def is_hosts(c: Column) -> Column:
    return strip(c).rlike(HOSTS)


def is_domain(c: Column) -> Column:
    return c.rlike(DOMAIN)


def is_bare(c: Column) -> Column:
    return c.rlike(BARE)


def is_ascii(c: Column) -> Column:
    return ~c.rlike(r"[^\x00-\x7F]")


def between(c: Column, start: str, end: str) -> Column:
    """What stands between the first start and the next end; null without either."""
    at = F.instr(c, start)
    rest = c.substr(at + len(start), F.length(c))
    stop = F.instr(rest, end)
    return F.when((at > 0) & (stop > 0), rest.substr(F.lit(1), stop - 1))


def after(c: Column, n: int) -> Column:
    return c.substr(F.lit(n + 1), F.length(c))


def without_inline_comment(c: Column) -> Column:
    """Cuts at the first unescaped # outside /.../; a line of element hiding or with an open / is kept whole.

    The prefix that can hold no comment is consumed possessively: other characters, escaped pairs, closed literals.
    """
    prefix = F.regexp_extract(c, r"(?s)^((?:[^#/\\]++|\\.|/(?:[^/\\]++|\\.)*+/)*+)", 1)
    next_ = c.substr(F.length(prefix) + 1, F.lit(1))
    return rstrip(F.when(~is_element_hiding(c) & (next_ == "#"), prefix).otherwise(c))


def before_last_dollar(c: Column) -> Column:
    """What stands before the last unescaped $; null without one."""
    pattern = r"(?s)^(.*(?<!\\)(?:\\\\)*)\$"
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 1))


def has_closing_slash(c: Column) -> Column:
    """Starts with / and has a later unescaped one."""
    return c.rlike(r"(?s)^/(?:[^/\\]++|\\.)*+/")


def is_pure_regex(c: Column) -> Column:
    """A /literal/, perhaps after @@, with flags of letters and options after a $."""
    t = strip(c)
    t = F.when(t.startswith("@@"), lstrip(after(t, 2))).otherwise(t)
    literal = F.regexp_extract(t, r"(?s)^(/(?:[^/\\]++|\\.)*+/)", 1)
    rest = t.substr(F.length(literal) + 1, F.length(t))
    flags = strip(F.coalesce(before_last_dollar(rest), rest))
    return (literal != "") & ~literal.contains("replace=") & flags.rlike(r"(?U)^\p{L}*\z")


def normalised_domain(c: Column) -> Column:
    """Small letters; without a leading *., trailing and repeated dots. Non-ASCII names need functions.idna."""
    d = F.lower(strip(F.coalesce(c, F.lit(""))))
    d = F.regexp_replace(d, r"^\*\.", "")
    d = F.regexp_replace(F.regexp_replace(d, r"\.+\z", ""), r"\.{2,}", ".")
    return F.regexp_replace(d, r"^\.+", "")


def suffixes(c: Column) -> Column:
    """The domain and its parents, longest first; none of an empty one."""
    parts = F.split(c, r"\.")
    every = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    return F.when(c != "", every).otherwise(F.array().cast("array<string>"))


def parents(c: Column) -> Column:
    """The strict parents of a domain. A sequence from 1 to 0 would run backward, so slice instead."""
    every = suffixes(c)
    return F.slice(every, F.lit(2), F.greatest(F.size(every) - 1, F.lit(0)))


def safe_file_name(url: Column, longest: int = 180) -> Column:
    digest = F.left(F.sha2(url.cast("binary"), 256), F.lit(16))
    body = F.regexp_replace(F.regexp_replace(url, r"(?i)^https?://", ""), r"[^A-Za-z0-9._-]", "_")
    return F.concat(F.left(body, F.lit(longest - 17)), F.lit("_"), digest, F.lit(".txt"))


def origin(url: Column) -> Column:
    """scheme://host[:port], https where no scheme is given, the host in small letters without user."""
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))
    authority = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)
    authority = F.regexp_replace(authority, r"^.*@", "")
    host = F.lower(F.regexp_replace(authority, r":[0-9]*\z", ""))
    port = F.regexp_extract(authority, r":([0-9]+)\z", 1).try_cast("int")
    scheme = F.when(scheme == "", "https").otherwise(scheme)
    return F.concat(scheme, F.lit("://"), host, F.when(port > 0, F.concat(F.lit(":"), port.cast("string"))).otherwise(""))


def checksum_candidates(content: Column) -> Column:
    """Sorted distinct base64 MD5 sums, unpadded, of the usual normalisations of a list with and without its checksum line."""
    bare = F.regexp_replace(content, CHECKSUM_LINE, "")
    bases = [content, bare, F.replace(content, F.lit("\r"), F.lit("")), F.replace(bare, F.lit("\r"), F.lit(""))]
    texts = [x for b in bases for x in (b, F.regexp_replace(b, r"\n+", "\n"))]
    texts = [x for t in texts for x in (t, F.regexp_replace(t, r"\n+\z", ""))]
    return F.array_sort(F.array_distinct(F.array(*(F.regexp_replace(F.base64(F.unhex(F.md5(t.cast("binary")))), r"=+\z", "") for t in texts))))


def checksum_matches(content: Column, expected: Column) -> Column:
    wanted = F.regexp_replace(strip(expected), r"=+\z", "")
    return F.when(F.coalesce(expected, F.lit("")) == "", F.lit(True)).otherwise(F.array_contains(checksum_candidates(content), wanted))
