"""The queries of the rule engine, each with DuckDB SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import idna, text
from gristmill.operators import clean, coverage, files, merge, parse, patch, validate
from gristmill.plans import fixtures
from gristmill.sources import fetch, rulefiles
from gristmill.sources.shared import stored

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept in the shared folder, as lines of files would be: else each step would make the rules anew."""
    return stored(fixtures.of(spark, sf_dir, fixtures.RULES), "rules")


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(fixtures.of(spark, sf_dir, fixtures.RAW), "raw")


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.classified(rules(spark, sf_dir).select("pos", "rule"), idna=False)


# ---------------------------------------------------------------- SQL that several queries share

LABEL = "[0-9A-Za-z]([0-9A-Za-z-]{0,61}[0-9A-Za-z])?"
HOSTS_RE = r"^([0-9A-Fa-f:.\[\]]+)(%[a-zA-Z0-9]+)?\s+([^#]+)(#.*)?$"


def _domain(x: str) -> str:
    return rf"(regexp_matches({x}, '^{LABEL}(\.{LABEL})*\.?$') and length({x}) between 1 and 255)"


def _norm(x: str) -> str:
    return rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim({x})), '^\*\.', ''), '\.+$', ''), '\.\.+', '.', 'g'), '^\.+', '')"


def _between(x: str) -> str:
    """The text between || and ^ of x, '' without."""
    return rf"regexp_extract({x}, '^[^|]*(?:\|[^|]+)*\|\|([^\^]*)\^', 1)"


CLASSIFIED = rf"""
lines as ({fixtures.RULES}),
k0 as (select pos, rule, {_between("rule")} as between_ from lines),
k1 as (select *, case when regexp_matches(rule, '[ \t]') and regexp_matches(rule, '^[0-9\[:a-fA-F]') and regexp_matches(rule, '{HOSTS_RE}') then 'hosts'
    when between_ <> '' then 'abp' when rule like '@@%' then 'allow' when contains(rule, '.') and {_domain("rule")} then 'plain' else 'other' end as kind from k0),
k2 as (select *, case kind when 'abp' then between_ when 'plain' then rule end as name from k1),
k as (select pos, rule, kind, {_norm("coalesce(name, '')")} as norm, rule like '@@%' as allow,
    coalesce(kind = 'abp' and name like '*.%' and contains(substr(name, 3), '.'), false) as wildcard,
    regexp_matches(rule, '^\|\|([^\^]+)\^$') or (coalesce(kind = 'abp' and name like '*.%' and contains(substr(name, 3), '.'), false) and not contains(rule, '$')) as bare,
    contains(lower(rule), '$important') as important from k2),
abp as (select distinct norm from k where kind = 'abp' and not allow and not wildcard and norm <> ''),
wc as (select distinct norm from k where kind = 'abp' and not allow and wildcard and norm <> ''),
wl as (select distinct norm from k where kind = 'abp' and allow and not wildcard and norm <> ''),
wlw as (select distinct norm from k where kind = 'abp' and allow and wildcard and norm <> '')"""


def _suffixes(source: str) -> str:
    """norm, i (1 for the domain itself) and suffix of the distinct domains of a table."""
    return f"""(select norm, i, array_to_string(list_slice(string_split(norm, '.'), i, len(string_split(norm, '.'))), '.') as suffix
        from (select norm, unnest(range(1, len(string_split(norm, '.')) + 1)) as i from (select distinct norm from {source} where norm <> '')))"""


HOST_ENTRIES = """
h0 as (select pos, rule, list_filter(regexp_split_to_array(regexp_replace(rule, '#.*$', ''), '\\s+'), lambda x: x <> '') as parts from k where kind = 'hosts'),
h1 as (select pos, rule, parts[1] as ip, unnest(parts[2:]) as host, unnest(range(1, len(parts))) as i from h0),
h2 as (select pos, rule, ip, arg_min(host, i) as host, norm, min(i) as i from (select *, NORM as norm from h1) group by pos, rule, ip, norm),
h as (select *, case when ip = '127.0.0.1' then 2 when ip = '0.0.0.0' then 0 else 1 end as rank from h2 where norm <> '')""".replace("NORM", _norm("host"))

FLAGS = f"""
every as (select norm from k where kind in ('abp', 'plain') union select norm from h),
sfx as {_suffixes("every")},
flags as (select norm,
    bool_or(suffix in (select norm from wl)) or bool_or(i > 1 and suffix in (select norm from wlw)) as allowed,
    bool_or(suffix in (select norm from abp)) or bool_or(i > 1 and suffix in (select norm from wc)) as covered,
    bool_or(i > 1 and suffix in (select norm from abp)) as abp_parent, bool_or(i = 1 and suffix in (select norm from abp)) as abp_self,
    bool_or(i > 1 and suffix in (select norm from wc)) as wc_parent, bool_or(i = 1 and suffix in (select norm from wlw)) as wlw_self
  from sfx group by norm)"""

PLAIN = f"""
roots as (select distinct norm from k join flags using (norm) where kind = 'plain' and not regexp_matches(rule, '^[0-9\\[]') and not covered),
plain0 as (select norm, min(pos) as pos, arg_min(rule, pos) as rule from k join flags using (norm) where kind = 'plain' and not allowed and not covered group by norm),
hostcand as (select h.* from h join flags using (norm) where not allowed and not covered and norm not in ({", ".join(f"'{x}'" for x in merge.LOCAL_NAMES)})),
under as (select distinct norm from sfx where i > 1 and suffix in (select norm from roots)),
plain as (select pos, rule, norm from plain0 where norm not in (select norm from hostcand) and norm not in (select norm from under))"""

HOSTS_WON = """
first as (select norm, arg_min(rank, pos) as r, arg_min(host, pos) as host from hostcand group by norm),
tops as (select norm, max(rank) as top from hostcand group by norm),
won as (select norm, min(pos) as pos, arg_min(ip, pos) as ip from hostcand join tops using (norm) where rank = top group by norm),
hosts_kept as (select pos, ip || ' ' || host as rule from won join first using (norm))"""

ABP_KEPT = """
ak as (select case when wildcard then '*.' || norm else norm end as key, pos, rule, bare, important from k join flags using (norm)
  where kind = 'abp' and not allow and not (bare and (abp_parent or (wildcard and abp_self) or wc_parent)) and not allowed and not (wildcard and wlw_self)),
an as (select *, row_number() over (partition by key order by pos) as n from ak),
fold as (
  select key, 0::bigint as n, []::struct(pos bigint, rule varchar)[] as out, null::varchar as prev, false as pb, false as pi from (select distinct key from ak)
  union all
  select key, n, case when skip or seen then base else list_append(base, {'pos': pos, 'rule': rule}) end,
    case when skip then prev when seen and repl then null when seen then prev else rule end,
    case when skip then pb when seen then pb and not repl else bare end, case when skip then pi when seen then pi and not repl else important end
  from (select *, len(list_filter(base, lambda x: x.rule = rule)) > 0 as seen from (
    select f.key, r.n, r.pos, r.rule, r.bare, r.important, f.prev, f.pb, f.pi,
      f.prev is not null and ((r.bare and f.pb) or (r.bare and f.pi and not (r.important and f.pb))) as skip,
      coalesce(f.prev is not null and r.important and f.pb and not (r.bare and f.pb), false) as repl,
      case when f.prev is not null and r.important and f.pb and not (r.bare and f.pb) then list_filter(f.out, lambda x: x.rule <> f.prev) else f.out end as base
    from fold f join an r on r.key = f.key and r.n = f.n + 1) a) b),
abp_kept as (select x.pos as pos, x.rule as rule from (select unnest(out) as x from fold where (key, n) in (select key, max(n) from an group by key)))"""


# ---------------------------------------------------------------- the flagship


@query(f"""
with {CLASSIFIED}, {HOST_ENTRIES}, named as (select kind, norm from k where kind = 'plain' union all select 'hosts', norm from h),
s as {_suffixes("named")},
cov as (select norm from s group by norm having bool_or(suffix in (select norm from abp)) or bool_or(i > 1 and suffix in (select norm from wc)))
select distinct kind, norm as domain from named where norm <> '' and norm not in (select norm from cov)
""")
def classify_covered(spark, sf_dir):
    """Domains of plain and hosts rules that no blocking rule covers, once per kind."""
    rows = _rows(spark, sf_dir)
    entries = merge.host_entries(rows, idna=False, ipv6=False)
    named = rows.where("kind = 'plain'").select("kind", "norm").union(entries.select(F.lit("hosts"), "norm")).where("norm <> ''").distinct()
    flags = coverage.memberships(named, merge.rule_sets(rows, idna=False))
    return named.join(flags, "norm", "left").where(~coverage.covered()).select("kind", F.col("norm").alias("domain"))


# ---------------------------------------------------------------- cleaning

_PREFIX = r"regexp_extract(t, '^((?:[^#/\\]|\\.|/(?:[^/\\]|\\.)*/)*)', 1)"
CLEANED = rf"""
lines as ({fixtures.RAW}), c0 as (select *, trim(raw) as t from lines),
c1 as (select *, case when regexp_matches(t, '##|#@#|#%#') or substr(t, length({_PREFIX}) + 1, 1) <> '#' then rtrim(t) else rtrim({_PREFIX}) end as cut,
  regexp_matches(t, '^[!#]') or regexp_full_match(t, '[-=*_.]{{3,}}') as comment from c0),
c as (select *, case when t = '' then 'empty' when comment then 'comment' when trim(cut) = '' then 'empty_after_strip' end as dropped, t <> raw as trimmed from c1)"""


@query(f"with {CLEANED} select line_no, file_id, cut as cleaned from c where dropped is null")
def clean_lines(spark, sf_dir):
    return clean.disposition(raw_lines(spark, sf_dir)).where("dropped is null").select("line_no", "file_id", "cleaned")


@query(f"""with {CLEANED} select file_id, count(*) as lines_in, count(*) filter (dropped is null) as lines_out, count(*) filter (trimmed) as trimmed,
count(*) filter (dropped = 'comment') as dropped_comments, count(*) filter (dropped in ('empty', 'empty_after_strip')) as dropped_empty from c group by file_id""")
def clean_stats(spark, sf_dir):
    return clean.counters(clean.disposition(raw_lines(spark, sf_dir)), "file_id")


@query(f"""with {CLEANED} select count(*) as lines_in, count(*) filter (dropped is null) as lines_out, count(*) filter (trimmed) as trimmed,
count(*) filter (dropped = 'comment') as dropped_comments, count(*) filter (dropped in ('empty', 'empty_after_strip')) as dropped_empty from c""")
def clean_summary(spark, sf_dir):
    return clean.summed(clean_stats(spark, sf_dir), "file_id").select(*(F.col(c).cast("long") for c in ("lines_in", "lines_out", "trimmed", "dropped_comments", "dropped_empty")))


@query(f"with {CLEANED} select line_no, trimmed, dropped from c")
def trim_flag(spark, sf_dir):
    return clean.disposition(raw_lines(spark, sf_dir)).select("line_no", "trimmed", "dropped")


# ---------------------------------------------------------------- parsing

PARSED = rf"""
lines as ({fixtures.RULES}), p0 as (select *, rule like '@@%' as whitelist, case when rule like '@@%' then substr(rule, 3) else rule end as body from lines),
p1 as (select *, body like '/%' and body like '%/' and not contains(body, 'replace=') as literal, regexp_matches(body, '\$') as dollar from p0),
p as (select *, case when not literal and dollar then regexp_extract(body, '^(.*)\$', 1) else body end as pattern,
  case when not literal and dollar then regexp_extract(body, '\$([^$]*)$', 1) end as tail from p1)"""


@query(f"""with {PARSED} select pos, pattern, whitelist, nullif(regexp_extract(pattern, '^\\|\\|([^\\^]+)\\^$', 1), '') as hostname,
coalesce(len(string_split(tail, ',')), 0)::int as n_options, array_to_string(list_transform(string_split(tail, ','), lambda x: string_split(x, '=')[1]), ' ') as names,
array_to_string(list_transform(string_split(tail, ','), lambda x: coalesce(string_split(x, '=')[2], '-')), ' ') as vals from p""")
def parse_adblock(spark, sf_dir):
    p = parse.with_adblock(rules(spark, sf_dir), "rule", "p")
    joined = lambda f: F.array_join(F.transform("p.options", f), " ")
    return p.select("pos", "p.pattern", "p.whitelist", "p.hostname", F.coalesce(F.when(F.col("p.options").isNotNull(), F.size("p.options")), F.lit(0)).alias("n_options"), joined(lambda o: o["name"]).alias("names"), joined(lambda o: F.coalesce(o["value"], F.lit("-"))).alias("vals"))


@query(f"with {CLASSIFIED}, {HOST_ENTRIES} select pos, parts[1] as ip, (len(parts) - 1)::int as n_hosts, array_to_string(parts[2:], ' ') as hosts from h0")
def parse_hosts(spark, sf_dir):
    p = _rows(spark, sf_dir).where("kind = 'hosts'").select("pos", parse.hosts(F.col("rule")).alias("p"))
    return p.select("pos", "p.ip", F.size("p.hostnames").alias("n_hosts"), F.array_join("p.hostnames", " ").alias("hosts"))


# ---------------------------------------------------------------- validation


def _valid_host(x: str) -> str:
    bare = f"(case when length({x}) > 1 and {x} like '%.' then left({x}, length({x}) - 1) else {x} end)"
    return f"({x} <> '' and ({_domain(bare)} or regexp_matches({bare}, '^[A-Za-z0-9_-]+$')))"


JUDGED = rf"""
lines as ({fixtures.RAW}), v0 as (select *, trim(raw) as s from lines),
v1 as (select *, case when s like '@@%' then substr(s, 3) else s end as body, regexp_extract(s, '{HOSTS_RE}', 3) as hostnames from v0),
v2 as (select *, case when regexp_matches(body, '\$') and not (body like '/%' and body like '%/') then regexp_extract(body, '^(.*)\$', 1) else body end as pattern,
  case when regexp_matches(body, '\$') and not (body like '/%' and body like '%/') then regexp_extract(body, '\$([^$]*)$', 1) end as tail from v1),
v3 as (select *, {_between("pattern")} as domain, instr(pattern, '^') as caret, instr(pattern, '*') as star from v2),
v as (select line_no, file_id, raw, case when s = '' then 'blank'
  when regexp_matches(ltrim(raw), '^[!#]') or regexp_full_match(ltrim(raw), '[-=*_.]{{3,}}') then 'comment'
  when regexp_matches(body, '^/[^/]*/([A-Za-z]*)(\$.*)?$') then 'kept_regex'
  when regexp_matches(s, '{HOSTS_RE}') then case when len(list_filter(string_split(trim(hostnames), ' '), lambda x: not {_valid_host("x")})) = 0 then 'kept_hosts' else 'removed_invalid_host' end
  when regexp_matches(s, '##|#@#|#%#') then 'removed_element_hiding'
  when len(list_filter(string_split(coalesce(tail, 'client'), ','), lambda x: string_split(x, '=')[1] not in ({", ".join(f"'{m}'" for m in validate.MODIFIERS)}))) > 0 then 'removed_bad_modifier'
  when regexp_matches(pattern, '^/.*/') then 'kept_regex'
  when not regexp_matches(regexp_replace(pattern, '^://', ''), '^[a-zA-Z0-9\-.*|^:/]+$') then 'removed_malformed'
  when caret > 0 and star > caret then 'removed_malformed'
  when not (pattern like '||%' and caret > 0) then 'kept_other_adblock'
  when contains(domain, '*') then case when domain like '*.%' and not contains(substr(domain, 2), '*') then 'kept_wildcard_tld' else 'removed_malformed' end
  when not {_valid_host("domain")} then 'removed_invalid_host'
  when substr(pattern, caret + 1, 1) not in ('', '|') then 'removed_malformed'
  else 'kept_adblock_domain' end as verdict from v3),
w as (select *, case verdict when 'blank' then false when 'comment' then null else verdict like 'kept%' end as ok from v),
fate as (select * exclude (ok), case when verdict = 'comment' then coalesce(first_value(ok ignore nulls) over (partition by file_id order by line_no rows between 1 following and unbounded following), true) else ok end as keep from w)"""


@query(f"with {JUDGED} select line_no, verdict from v")
def validate_verdict(spark, sf_dir):
    return validate.with_verdict(raw_lines(spark, sf_dir), idna=False).select("line_no", "verdict")


@query(f"with {JUDGED} select line_no, file_id, raw from fate where keep")
def validate_lines(spark, sf_dir):
    return validate.validate(raw_lines(spark, sf_dir), "file_id", "line_no", idna=False).select("line_no", "file_id", "raw")


@query(f"""with {JUDGED} select file_id, count(*) as lines_in, count(*) filter (keep) as lines_out, count(*) filter (verdict like 'removed%') as removed_invalid,
{", ".join(f"count(*) filter (verdict = '{x}') as {x}" for x in validate.VERDICTS)},
count(*) filter (verdict = 'comment' and not keep) as removed_comments, count(*) filter (verdict = 'blank') as removed_empty from fate group by file_id""")
def validate_stats(spark, sf_dir):
    judged = validate.with_verdict(raw_lines(spark, sf_dir), idna=False)
    return validate.counters(validate.with_fate(judged, "file_id", "line_no"), "file_id")


# ---------------------------------------------------------------- domains


@query(f"with {CLASSIFIED} select pos, kind, norm, allow, wildcard, bare, important from k")
def classify_rules(spark, sf_dir):
    return _rows(spark, sf_dir).select("pos", "kind", F.coalesce("norm", F.lit("")).alias("norm"), "allow", "wildcard", "bare", "important")


MESSY = r"""select page_id, case page_id % 6 when 0 then upper(host) when 1 then '*.' || host when 2 then host || '...' when 3 then '..' || regexp_replace(host, '[.]', '..')
  when 4 then '  ' || host || '. ' else '*.*.' || host end as name from (select page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) as host from pages) a"""


@query(f"select page_id, {_norm('name')} as norm from ({MESSY})")
def normalize_domain(spark, sf_dir):
    return idna.with_normalised(fixtures.of(spark, sf_dir, MESSY), "name", "norm", idna=False).select("page_id", "norm")


HOSTS_OF = "select distinct regexp_extract(url, '^https?://([^/?#]+)', 1) as norm from pages"


@query(f"with h as ({HOSTS_OF}) select norm, (i - 1)::int as depth, suffix from {_suffixes('h')}")
def domain_suffixes(spark, sf_dir):
    return coverage.edges(fixtures.of(spark, sf_dir, HOSTS_OF)).select("norm", "depth", "suffix")


NESTED = f"""select norm from ({HOSTS_OF}) a union all select regexp_replace(norm, '^[^.]+[.]', '') from ({HOSTS_OF}) b where length(norm) % 3 = 0
union all select 'a.b.' || norm from ({HOSTS_OF}) c"""


@query(f"with d as ({NESTED}), s as {_suffixes('d')} select distinct norm from d where norm not in (select norm from s where i > 1 and suffix in (select norm from d))")
def minimal_cover(spark, sf_dir):
    return coverage.minimal_cover(fixtures.of(spark, sf_dir, NESTED))


def _covers(sets: str, flag: str) -> str:
    return f"with {CLASSIFIED}, s as {_suffixes('k')} select norm, {flag} as covered from s group by norm"


def _covered(spark, sf_dir, flag) -> DataFrame:
    rows = _rows(spark, sf_dir)
    domains = rows.where("norm <> ''").select("norm").distinct()
    return domains.join(coverage.memberships(domains, merge.rule_sets(rows, idna=False)), "norm", "left").select("norm", flag().alias("covered"))


@query(_covers("abp", "bool_or(suffix in (select norm from abp)) or bool_or(i > 1 and suffix in (select norm from wc))"))
def abp_coverage(spark, sf_dir):
    return _covered(spark, sf_dir, coverage.covered)


@query(_covers("wc", "bool_or(i > 1 and suffix in (select norm from wc))"))
def wildcard_coverage(spark, sf_dir):
    return _covered(spark, sf_dir, lambda: coverage.flag("wildcard_parent"))


@query(_covers("wl", "bool_or(suffix in (select norm from wl)) or bool_or(i > 1 and suffix in (select norm from wlw))"))
def whitelist_coverage(spark, sf_dir):
    return _covered(spark, sf_dir, coverage.allowed)


def _context(spark, sf_dir, without_pairs: bool = False):
    rows = _rows(spark, sf_dir)
    if without_pairs:
        rows = rows.where("pos % 16 <> 14")
    entries = stored(merge.host_entries(rows, idna=False, ipv6=False), "hosts")
    flags = merge.decided(rows.where("kind in ('abp', 'plain')").select("norm").union(entries.select("norm")), merge.rule_sets(rows, idna=False))
    return rows, entries, stored(flags, "flags")


@query(f"with {CLASSIFIED}, {HOST_ENTRIES}, {FLAGS} select pos, rule from k join flags using (norm) where kind = 'abp' and not allow and bare and (abp_parent or (wildcard and abp_self) or wc_parent)")
def abp_redundant(spark, sf_dir):
    rows, _, flags = _context(spark, sf_dir)
    redundant = F.col("bare") & (coverage.flag("abp_parent") | (F.col("wildcard") & coverage.flag("abp_self")) | coverage.flag("wildcard_parent"))
    return rows.where("kind = 'abp' and not allow").join(flags, "norm", "left").where(redundant).select("pos", "rule")


@query(f"with {CLASSIFIED}, {HOST_ENTRIES}, {FLAGS}, {PLAIN} select pos, rule, norm from plain0 where norm not in (select norm from under)")
def plain_subdomain_prune(spark, sf_dir):
    rows, entries, flags = _context(spark, sf_dir)
    return merge.plain_kept(rows, flags, entries.where("false"))


ADDRESSES = """select distinct case page_id % 9 when 0 then '0.0.0.0' when 1 then '127.0.0.' || cast(page_id % 5 as string) when 2 then '10.0.' || cast(page_id % 300 as string) || '.1'
  when 3 then '[192.168.1.1]' when 4 then '127.0.0.1%lo' when 5 then 'abc' when 6 then '01.2.3.4' when 7 then '1.2.3' else '8.8.8.8' end as raw from pages"""


@query(rf"""with a as ({ADDRESSES}), b as (select raw, regexp_replace(regexp_replace(raw, '^[\[]+|[\]]+$', '', 'g'), '%.*$', '') as ip from a),
c as (select raw, case when regexp_matches(ip, '^((25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){{3}}(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$') then ip end as ip from b)
select raw, ip, case when ip is null then null when ip like '127.%' then 2 when ip = '0.0.0.0' then 0 else 1 end::int as rank from c""")
def ip_rank(spark, sf_dir):
    rows = idna.with_address(fixtures.of(spark, sf_dir, ADDRESSES), "raw", "a", ipv6=False)
    return rows.select("raw", "a.ip", idna.rank(F.col("a")).alias("rank"))


# ---------------------------------------------------------------- conflicts and the merge

SINGLE = CLASSIFIED.replace(f"lines as ({fixtures.RULES})", f"lines as (select * from ({fixtures.RULES}) where pos % 16 <> 14)")


@query(f"with {SINGLE}, {HOST_ENTRIES}, {FLAGS}, {PLAIN}, {HOSTS_WON} select pos, rule from hosts_kept")
def hosts_conflicts(spark, sf_dir):
    rows, entries, flags = _context(spark, sf_dir, without_pairs=True)
    return merge.hosts_kept(merge.host_candidates(entries, flags), "bigint", multi=False)


@query()
def hosts_conflicts_all(spark, sf_dir):
    """Over all rows: lines with several hosts too, whose conflicts are folded by component; other scripts and IPv6."""
    rows = merge.classified(rules(spark, sf_dir).select("pos", "rule"))
    entries = stored(merge.host_entries(rows), "hosts")
    flags = stored(merge.decided(rows.where("kind in ('abp', 'plain')").select("norm").union(entries.select("norm")), merge.rule_sets(rows)), "flags")
    return merge.hosts_kept(merge.host_candidates(entries, flags), "bigint")


@query(f"with recursive {CLASSIFIED}, {HOST_ENTRIES}, {FLAGS}, {ABP_KEPT} select pos, rule from abp_kept")
def abp_conflicts(spark, sf_dir):
    rows, _, flags = _context(spark, sf_dir)
    return merge.fold_rules(merge.abp_kept(rows, flags))


@query(f"with {CLASSIFIED}, {HOST_ENTRIES}, {FLAGS}, {PLAIN} select pos, rule from plain")
def plain_dedup(spark, sf_dir):
    rows, entries, flags = _context(spark, sf_dir)
    return merge.plain_kept(rows, flags, merge.host_candidates(entries, flags)).select("pos", "rule")


@query(f"""with recursive {SINGLE}, {HOST_ENTRIES}, {FLAGS}, {PLAIN}, {HOSTS_WON}, {ABP_KEPT}
select pos, rule, 'abp' as kind from abp_kept union all select pos, rule, 'hosts' from hosts_kept union all select pos, rule, 'plain' from plain
union all select min(pos), rule, 'other' from k where kind = 'other' group by rule""")
def merge_rules(spark, sf_dir):
    """The whole merge, over lines with one host each."""
    lines = rules(spark, sf_dir).where("pos % 16 <> 14").select("pos", "rule")
    return merge.merge(lines, idna=False, ipv6=False, multi=False)


@query()
def merge_rules_all(spark, sf_dir):
    """The whole merge with lines of several hosts, other scripts and IPv6; tests compare it with a sequential model."""
    return merge.merge(rules(spark, sf_dir).select("pos", "rule"))


@query()
def merge_stats(spark, sf_dir):
    return merge.counters(merge.dispositions(rules(spark, sf_dir).select("pos", "rule"), idna=False, ipv6=False))


@query(f"with recursive {SINGLE}, {HOST_ENTRIES}, {FLAGS}, {PLAIN}, {HOSTS_WON}, {ABP_KEPT}, o as (select pos from abp_kept union all select pos from hosts_kept union all select pos from plain union all select min(pos) from k where kind = 'other' group by rule) select (select count(*) from lines) as lines_in, (select count(*) from o) as lines_out, ((select count(*) from lines) - (select count(*) from o)) * 100.0::double / (select count(*) from lines) as reduction")
def merge_reduction(spark, sf_dir):
    lines = rules(spark, sf_dir).where("pos % 16 <> 14").select("pos", "rule")
    n = lines.agg(F.count(F.lit(1)).alias("lines_in")).crossJoin(merge_rules(spark, sf_dir).agg(F.count(F.lit(1)).alias("lines_out")))  # one row each
    return n.withColumn("reduction", merge.reduction(F.col("lines_in"), F.col("lines_out")))


@query()
def merge_reduction_all(spark, sf_dir):
    """The reduction of the whole list, lines with several hosts included."""
    lines = rules(spark, sf_dir).select("pos", "rule")
    n = lines.agg(F.count(F.lit(1)).alias("lines_in")).crossJoin(merge.merge(lines).agg(F.count(F.lit(1)).alias("lines_out")))  # one row each
    return n.withColumn("reduction", merge.reduction(F.col("lines_in"), F.col("lines_out")))


# ---------------------------------------------------------------- files, names, patches, metadata


@query("""with d as (select doc_id, 'd' || doc_id as name, sha256(coalesce(text, '')) as digest, strlen(coalesce(text, '')) as size from documents)
select doc_id, digest, count(*) over (partition by size, digest) as group_size,
  row_number() over (partition by size, digest order by length(name), name, doc_id) = 1 as kept from d""")
def content_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.concat(F.lit("d"), "doc_id").alias("name"), F.coalesce("text", F.lit("")).alias("text"))
    return files.content_dedup(docs, "name", "text", "doc_id").select("doc_id", "digest", "group_size", "kept")


@query("select page_id, left(regexp_replace(regexp_replace(url, '^https?://', '', 'i'), '[^A-Za-z0-9._-]', '_', 'g'), 163) || '_' || left(sha256(url), 16) || '.txt' as file_name from pages")
def safe_filename(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", text.safe_file_name(F.col("url")).alias("file_name"))


ASKED = """select page_id, case page_id % 4 when 0 then url when 1 then regexp_replace(url, '^(https?)://([^/?#]+)', '\\1://USER@\\2:8443') when 2 then upper(url)
 else regexp_replace(url, '^https?:', '') end as url from pages"""
_ORIGIN = r"""(case when regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*):', 1) = '' then 'https' else lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*):', 1)) end
 || '://' || lower(regexp_replace(regexp_replace(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', ''))
 || case when regexp_extract(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1), ':([0-9]+)$', 1) = '' then ''
    else ':' || regexp_extract(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1), ':([0-9]+)$', 1) end)"""


def _asked(spark, sf_dir) -> DataFrame:
    return fixtures.of(spark, sf_dir, ASKED.replace("\\1", "$1").replace("\\2", "$2"))


@query(f"select page_id, {_ORIGIN} as origin from ({ASKED})")
def url_origin(spark, sf_dir):
    return _asked(spark, sf_dir).select("page_id", text.origin(F.col("url")).alias("origin"))


@query(f"select page_id, origin, row_number() over (partition by origin order by page_id) - 1 as ordinal, (row_number() over (partition by origin order by page_id) - 1) * 0.2::double as not_before from (select page_id, {_ORIGIN} as origin from ({ASKED}))")
def origin_pacing(spark, sf_dir):
    rows = _asked(spark, sf_dir).withColumn("origin", text.origin(F.col("url")))
    return fetch.paced(rows, "page_id").select("page_id", "origin", F.col("ordinal").cast("long").alias("ordinal"), "not_before")


HEADED = """select page_id % 40 as list, page_id as line_no, case page_id % 5 when 0 then '! Title : T' || cast(page_id as string) when 1 then '! Diff-Path: p/' || cast(page_id % 3 as string) || '.patch#r'
 when 2 then '!Checksum:' || case when page_id % 2 = 0 then '' else ' abc' end when 3 then '! no directive' else case when page_id % 400 < 200 then '! Expires: 4 days' else 'rule' end end as raw from pages"""
_HEAD = """with l as (select list, row_number() over (partition by list order by line_no) as line_no, raw from (HEADED)),
t as (select *, bool_and(raw like '!%') over (partition by list order by line_no) as ok from l where line_no <= 200),
p as (select list, line_no, lower(trim(split_part(substr(raw, 2), ':', 1))) as key, trim(substr(raw, instr(raw, ':') + 1)) as value from t where ok and instr(raw, ':') > 0)""".replace("HEADED", HEADED)


@query(f"{_HEAD} select list, key, arg_max(value, line_no) as value from p group by list, key")
def header_directives(spark, sf_dir):
    return _directives(spark, sf_dir).select("list", F.explode("directives"))


def _directives(spark, sf_dir) -> DataFrame:
    from pyspark.sql import Window

    rows = fixtures.of(spark, sf_dir, HEADED)
    rows = rows.withColumn("line_no", F.row_number().over(Window.partitionBy("list").orderBy("line_no")))
    return fetch.directives(rows, "list")


@query(f"{_HEAD} select list, nullif(arg_max(value, line_no) filter (key = 'diff-path'), '') as diff_path, nullif(arg_max(value, line_no) filter (key = 'checksum'), '') as list_checksum from p group by list")
def header_meta(spark, sf_dir):
    return fetch.header_meta(_directives(spark, sf_dir)).select("list", "diff_path", "list_checksum")


CONTENT = "select page_id, '! Title' || chr(13) || chr(10) || '! Checksum: x' || cast(page_id as string) || chr(10) || chr(10) || chr(10) || url || chr(10) || case when page_id % 3 = 0 then chr(10) else '' end as content from pages"


@query(rf"""with c as ({CONTENT}), b as (select page_id, unnest([content, bare, replace(content, chr(13), ''), replace(bare, chr(13), '')]) as x
  from (select *, regexp_replace(content, '(?im)^!\s*checksum:\s*\S+', '', 'g') as bare from c)),
n as (select page_id, unnest([x, regexp_replace(x, '\n+', chr(10), 'g')]) as x from b), t as (select page_id, unnest([x, regexp_replace(x, '\n+$', '')]) as x from n)
select page_id, string_agg(sum, ' ' order by sum) as sums from (select distinct page_id, rtrim(to_base64(unhex(md5(x))), '=') as sum from t) group by page_id""")
def checksum_candidates(spark, sf_dir):
    return fixtures.of(spark, sf_dir, CONTENT).select("page_id", F.array_join(text.checksum_candidates(F.col("content")), " ").alias("sums"))


@query("select page_id, 'a' || chr(10) || 'x' || chr(10) || url || chr(10) || 'c' || chr(10) as result, null::varchar as error from pages where page_id % 5 <> 0 union all select page_id, null, 'out of range' from pages where page_id % 5 = 0")
def apply_patch(spark, sf_dir):
    """Three lines; the second goes and two come, or a command is out of range."""
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    nl = F.lit("\n")
    old = F.concat(F.lit("a"), nl, F.lit("b"), nl, F.lit("c"), nl)
    bad = F.when(F.col("page_id") % 5 == 0, F.lit("d 9 1\n")).otherwise("")
    new = F.concat(F.lit("junk\ndiff name:n lines:2\nd 2 1\n; note\n"), bad, F.lit("a 1 2\nx\n"), F.col("url"), nl)
    done = patch.patched(rows.select("page_id", old.alias("text"), new.alias("patch"), F.lit("n").alias("resource")))
    return done.select("page_id", "result", "error")


META = "select page_id, url, 'p' || cast(page_id as string) as path, case when page_id % 3 = 0 then null else 'e' || cast(page_id as string) end as etag, 200 as status_code, 1000 + page_id % 50 as fetched_at from (select min(page_id) as page_id, url from pages group by url) a"


@query(f"""with m as ({META}), n as (select url, 'q' || page_id as path, 'new' as etag, 304 as status_code, 1000 + page_id % 70 as fetched_at from m where page_id % 2 = 0)
select url, path, etag, status_code, fetched_at from (select *, row_number() over (partition by url order by fetched_at desc, is_new desc) as r
  from (select url, path, etag, status_code, fetched_at, 0 as is_new from m union all select *, 1 from n)) where r = 1""")
def meta_upsert(spark, sf_dir):
    known = fixtures.of(spark, sf_dir, META)
    new = known.where("page_id % 2 = 0").select("url", F.concat(F.lit("q"), "page_id").alias("path"), F.lit("new").alias("etag"), F.lit(304).alias("status_code"), (F.lit(1000) + F.col("page_id") % 70).alias("fetched_at"))
    return fetch.record(known.drop("page_id"), new)


@query(f"""with m as ({META}) select url, coalesce(case when page_id % 4 = 1 then 'z' end, path) as path,
  case when page_id % 4 = 2 then null else etag end as etag, status_code, fetched_at from m""")
def meta_update(spark, sf_dir):
    known = fixtures.of(spark, sf_dir, META)
    new = known.where("page_id % 4 in (1, 2)").select("url", F.when(F.col("page_id") % 4 == 1, F.create_map(F.lit("path"), F.lit("z"))).alias("set"), F.when(F.col("page_id") % 4 == 2, F.array(F.lit("etag"))).alias("unset"))
    return fetch.update(known.drop("page_id"), new).select("url", "path", "etag", "status_code", "fetched_at")


ANSWERS = "select page_id, case page_id % 7 when 0 then 200 when 1 then 304 when 2 then 429 when 3 then 500 when 4 then 404 when 5 then 599 else 600 end as status_code, page_id % 2 = 0 as has_cache from pages"
_STATUS = "case when status_code = 200 then 'ok' when status_code = 304 and has_cache then 'not-modified' when has_cache then 'used-cache-on-fail' else 'failed' end"


@query(f"select page_id, status_code = 429 or status_code between 500 and 599 as again, {_STATUS} as status from ({ANSWERS})")
def fetch_status(spark, sf_dir):
    rows = fixtures.of(spark, sf_dir, ANSWERS)
    return rows.select("page_id", fetch.retryable(F.col("status_code")).alias("again"), fetch.outcome(F.col("status_code"), F.col("has_cache")).alias("status"))


@query(f"with s as (select {_STATUS} as status from ({ANSWERS})) select status, count(*) as n from s group by status union all select 'processed', count(*) from s")
def fetch_summary(spark, sf_dir):
    return fetch.summary(fetch_status(spark, sf_dir))


@query("select page_id, least(0.5::double * pow(2.0, page_id % 8), 10.0)::double as seconds from pages")
def retry_backoff(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", fetch.backoff((F.col("page_id") % 8 + 1).cast("int")).alias("seconds"))


@query(f"with m as ({META}) select p.page_id, p.url, {_ORIGIN.replace('url', 'p.url')} as origin, case when m.page_id % 2 = 0 then etag end as if_none_match, null::varchar as if_modified_since from pages p left join m on p.url = m.url")
def conditional_requests(spark, sf_dir):
    known = fixtures.of(spark, sf_dir, META).select("url", F.when(F.col("page_id") % 2 == 0, F.col("etag")).alias("etag"), F.lit(None).cast("string").alias("last_modified"))
    return fetch.requests(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"), known).select("page_id", "url", "origin", "if_none_match", "if_modified_since")


@query(f"""with m as ({META}), f as (select page_id, url, path, left(regexp_replace(regexp_replace(url, '^https?://', '', 'i'), '[^A-Za-z0-9._-]', '_', 'g'), 163) || '_' || left(sha256(url), 16) || '.txt' as name from m)
select url, case when page_id % 3 = 0 then path when page_id % 3 = 1 then name end as cached from f""")
def cached_files(spark, sf_dir):
    known = fixtures.of(spark, sf_dir, META)
    there = known.where("page_id % 3 = 0").select("path").union(known.where("page_id % 3 = 1").select(text.safe_file_name(F.col("url"))))
    return fetch.cached(known.select("url"), known.where("page_id % 2 = 0 or page_id % 3 = 0").select("url", "path"), there)


NAMES = "select page_id, 'List' || cast(page_id % 13 as string) || case page_id % 6 when 0 then '_clean.txt' when 1 then '.TXT' when 2 then '.txt.bak' when 3 then '_VALID.txt' when 4 then '.part' else '.txt' end || cast(page_id as string) as name from pages"


@query(f"select page_id, name, regexp_matches(lower(name), '_clean|_valid|[.]part|[.]bak|[.]swp') as purge from ({NAMES})")
def purge_files(spark, sf_dir):
    return files.auxiliary(fixtures.of(spark, sf_dir, NAMES), "name")


@query(f"select page_id, name, row_number() over (order by lower(name), name) as file_rank from ({NAMES})")
def file_order(spark, sf_dir):
    return files.ranked(fixtures.of(spark, sf_dir, NAMES), "name").withColumn("file_rank", F.col("file_rank").cast("long"))


SOURCES = "select page_id, case page_id % 5 when 0 then '# ' || url when 1 then '   ' when 2 then '  ' || url || ' ' when 3 then ' # kept ' || url else url end as raw from pages"


@query(f"select trim(raw) as url from ({SOURCES}) where raw not like '#%' and trim(raw) <> ''")
def source_urls(spark, sf_dir):
    return rulefiles.urls(fixtures.of(spark, sf_dir, SOURCES))
