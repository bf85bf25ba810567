"""Merging of rule lists into one ordered list, set-based.

Lines have pos (any sortable value, such as struct(file_rank, line_no)) and rule. Two passes: first the sets of domains
that rules of each class name, then every line is decided by joins with them. What the order of lines decides is decided
per domain: the first line, the winning address of a host, the fold of the rules of one domain.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.functions import idna as idna_functions
from gristmill.functions import text
from gristmill.operators import coverage, parse
from gristmill.operators.components import components
from gristmill.sources.shared import stored

# Names that only mean the machine itself.
LOCAL_NAMES = (
    "localhost", "localhost.localdomain", "localhost4", "localhost4.localdomain4", "localhost6", "localhost6.localdomain6",
    "localdomain", "localdomain.localhost", "local", "ip6-localhost", "ip6-loopback", "ip6-localnet", "ip6-mcastprefix",
    "ip6-allnodes", "ip6-allrouters", "ip6-allhosts", "broadcasthost",
)


def kind_of(rule: Column) -> Column:
    """blank, hosts, abp, allow, plain or other, of a stripped line, by precedence."""
    hosts = rule.rlike(r"[ \t]") & rule.rlike(r"^[0-9\[:a-fA-F]") & rule.rlike(text.HOSTS)
    named = F.coalesce(text.between(rule, "||", "^"), F.lit("")) != ""
    return (
        F.when(rule == "", "blank")
        .when(hosts, "hosts")
        .when(named, "abp")
        .when(rule.startswith("@@"), "allow")
        .when(rule.contains(".") & text.is_domain(rule), "plain")
        .otherwise("other")
    )


def classified(lines: DataFrame, idna: bool = True) -> DataFrame:
    """Adds to stripped lines: kind, name (of abp and plain rules), norm, allow, wildcard, bare, important.

    The result is kept in the shared folder: all later steps read it, most by kind, and none parses a line again.
    """
    rows = lines.withColumn("rule", text.strip(F.col("rule"))).withColumn("kind", kind_of(F.col("rule")))
    name = F.when(F.col("kind") == "abp", text.between(F.col("rule"), "||", "^")).when(F.col("kind") == "plain", F.col("rule"))
    rows = idna_functions.with_normalised(rows.withColumn("name", name), "name", "norm", idna)
    wildcard = F.coalesce((F.col("kind") == "abp") & F.col("name").startswith("*.") & text.after(F.col("name"), 2).contains("."), F.lit(False))
    bare = text.is_bare(F.col("rule")) | (wildcard & ~F.col("rule").contains("$"))
    return stored(rows.withColumns({"allow": F.col("rule").startswith("@@"), "wildcard": wildcard, "bare": bare, "important": F.lower("rule").contains("$important")}), "classified")


def rule_sets(rows: DataFrame, idna: bool = True) -> dict[str, DataFrame]:
    """First pass: the distinct domains of each class, one column each. Here an anchored name comes before all else."""
    named = rows.withColumn("_name", text.between(F.col("rule"), "||", "^")).where("_name <> ''")
    wild = F.col("_name").startswith("*.") & text.after(F.col("_name"), 2).contains(".")
    named = idna_functions.with_normalised(named.withColumn("_wild", wild), "_name", "_norm", idna).where("_norm <> ''")
    pick = lambda allow, wildcard: named.where((F.col("allow") == allow) & (F.col("_wild") == wildcard)).select("_norm").distinct()
    return {"abp": pick(False, False), "wildcard": pick(False, True), "allow": pick(True, False), "allow_wildcard": pick(True, True)}


def plain_candidates(rows: DataFrame) -> DataFrame:
    """Plain domains that cover others: not those that start like an address."""
    return rows.where((F.col("kind") == "plain") & ~F.col("rule").rlike(r"^[0-9\[]") & (F.col("norm") != "")).select("norm").distinct()


def host_entries(rows: DataFrame, idna: bool = True, ipv6: bool = True) -> DataFrame:
    """pos, rule, ip, rank, k, host, norm of hosts lines: the first host of each norm of a line."""
    hosts = rows.where("kind = 'hosts'").select("pos", "rule", parse.hosts(F.col("rule")).alias("h"))
    cut = hosts.select("pos", "rule", F.col("h.ip").alias("ip"), F.posexplode("h.hostnames").alias("k", "host"))
    named = idna_functions.with_normalised(cut, "host", "norm", idna).where("norm <> ''")
    first = named.groupBy("pos", "rule", "ip", "norm").agg(F.min("k").alias("k"), F.min_by("host", "k").alias("host"))
    return idna_functions.with_address(first, "ip", "address", ipv6).withColumn("rank", idna_functions.rank(F.col("address"))).drop("address")


def host_candidates(entries: DataFrame, flags: DataFrame) -> DataFrame:
    """Entries that are neither allow-listed nor local nor covered by a blocking rule."""
    return entries.join(flags, "norm", "left").where(~coverage.allowed() & ~F.col("norm").isin(*LOCAL_NAMES) & ~coverage.covered()).select(*entries.columns)


def single_host_winners(candidates: DataFrame) -> DataFrame:
    """pos and rule of what stays of lines with one candidate, domain by domain.

    The first line wins if its address is none; else the first of those with the best address. Its text has the
    spelling of the domain's first line.
    """
    by_first = F.struct("pos", "rank", "host")
    tops = candidates.groupBy("norm").agg(F.min(by_first).alias("first"), F.min_by("ip", "pos").alias("first_ip"), F.max("rank").alias("top"))
    top = candidates.join(tops.select("norm", "top"), "norm").where("rank = top").groupBy("norm").agg(F.min(F.struct("pos", "ip")).alias("best"))
    won = tops.join(top, "norm", "left")
    keeps = F.col("first.rank").isNull() | F.col("best").isNull()
    pos, ip = F.when(keeps, F.col("first.pos")).otherwise(F.col("best.pos")), F.when(keeps, F.col("first_ip")).otherwise(F.col("best.ip"))
    return won.select(pos.alias("pos"), F.concat_ws(" ", ip, F.col("first.host")).alias("rule"))


def fold_hosts(group: list[tuple]) -> list[tuple]:
    """The lines of one component in order; group: (pos, ip, rank, [(host, norm)]). Returns (pos, rule).

    A line of a better address replaces the lines that hold its hosts and takes over their other hosts.
    """
    kept: dict[str, tuple] = {}  # rule -> pos
    holder: dict[str, tuple] = {}  # norm -> (rule, rank)
    inside: dict[str, list[tuple]] = {}
    for pos, ip, rank, pairs in group:
        taken: list[tuple] = []
        for host, norm in pairs:
            held = holder.get(norm)
            if held is None:
                taken.append((host, norm))
                continue
            rule, other = held
            if rank is None or other is None or rank <= other:
                continue
            for h, n in inside[rule]:
                if holder.get(n, ("",))[0] == rule:
                    del holder[n]
                if n not in {x for _, x in taken}:
                    taken.append((h, n))
            kept.pop(rule, None)
            if norm not in {x for _, x in taken}:
                taken.append((host, norm))
        rule = f"{ip} {' '.join(h for h, _ in taken)}"
        if taken and rule not in kept:
            kept[rule], inside[rule] = pos, taken
            for _, norm in taken:
                holder[norm] = (rule, rank)
    return [(pos, rule) for rule, pos in kept.items()]


def multi_host_winners(candidates: DataFrame, pos_type: str) -> DataFrame:
    """Lines of components that hold a line with several candidates, folded one component at a time."""
    heads = candidates.groupBy("pos", "rule").agg(F.min("norm").alias("v"))
    links = candidates.join(heads, ["pos", "rule"]).select(F.col("norm").alias("u"), "v")
    roots = components(links, "hosts")
    keyed = candidates.join(roots.withColumnRenamed("node", "norm"), "norm")
    order = F.dense_rank().over(Window.partitionBy("root").orderBy("pos"))
    ordered = keyed.withColumn("order", order).withColumn("pos", F.to_json(F.struct("pos")))

    def fold(frame: pd.DataFrame) -> pd.DataFrame:
        lines = []
        for _, line in frame.sort_values(["order", "k"]).groupby("order", sort=True):
            rank = line["rank"].iloc[0]
            lines.append((line["pos"].iloc[0], line["ip"].iloc[0], None if pd.isna(rank) else int(rank), list(zip(line["host"], line["norm"], strict=True))))
        return pd.DataFrame(fold_hosts(lines), columns=["pos", "rule"])

    out = ordered.select("root", "pos", "order", "ip", "rank", "k", "host", "norm").groupBy("root").applyInPandas(fold, "pos string, rule string")
    return out.select(F.from_json("pos", f"pos {pos_type}")["pos"].alias("pos"), "rule")


def hosts_kept(candidates: DataFrame, pos_type: str, multi: bool = True) -> DataFrame:
    """Lines of hosts that stay: in closed form where a domain stands in single lines only, else by the fold."""
    if not multi:
        return single_host_winners(candidates)
    several = candidates.groupBy("pos", "rule").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    wide = candidates.join(several.select("pos", "rule"), ["pos", "rule"], "left_semi")
    linked = wide.select("norm").distinct()
    # a component is all lines that share a domain with a wide line, and so on; single lines join by their one domain
    touched = candidates.join(linked, "norm", "left_semi")
    alone = candidates.join(linked, "norm", "left_anti")
    return single_host_winners(alone).unionByName(multi_host_winners(touched, pos_type))


def fold_rules(rows: DataFrame) -> DataFrame:
    """rows: key, pos, rule, bare, important. What stays of the rules of each key: pos, rule.

    In order: a bare rule after a bare or important one goes; an important one replaces a bare one directly before it;
    other rules stay once each. Keys with a single text take a plain aggregate.
    """
    texts = rows.groupBy("key").agg(F.min("rule").alias("a"), F.max("rule").alias("b"), F.min("pos").alias("pos"))
    single = texts.where("a = b").select("pos", F.col("a").alias("rule"))
    several = rows.join(texts.where("a <> b").select("key"), "key", "left_semi")
    entry = F.struct("pos", "rule", "bare", "important")
    lists = several.groupBy("key").agg(F.array_sort(F.collect_list(entry)).alias("rows"))
    kind = several.schema["pos"].dataType.simpleString()
    start = F.expr(f"named_struct('out', cast(array() as array<struct<pos:{kind},rule:string>>), 'rule', cast(null as string), 'bare', false, 'important', false)")

    def step(s: Column, r: Column) -> Column:
        held = s["rule"].isNotNull()
        skip = held & ((r["bare"] & s["bare"]) | (r["bare"] & s["important"] & ~(r["important"] & s["bare"])))
        replaced = held & r["important"] & s["bare"] & ~skip
        out = F.when(replaced, F.filter(s["out"], lambda x: x["rule"] != s["rule"])).otherwise(s["out"])
        seen = F.exists(out, lambda x: x["rule"] == r["rule"])
        added = F.concat(out, F.array(F.struct(r["pos"].alias("pos"), r["rule"].alias("rule"))))
        unchanged = F.struct(out.alias("out"), F.when(~replaced, s["rule"]).alias("rule"), (~replaced & s["bare"]).alias("bare"), (~replaced & s["important"]).alias("important"))
        changed = F.struct(added.alias("out"), r["rule"].alias("rule"), r["bare"].alias("bare"), r["important"].alias("important"))
        return F.when(skip, s).when(seen, unchanged).otherwise(changed)

    folded = lists.select(F.explode(F.aggregate("rows", start, step, lambda s: s["out"])).alias("x")).select("x.pos", "x.rule")
    return single.unionByName(folded)


def decided(rows: DataFrame, sets: dict[str, DataFrame]) -> DataFrame:
    """Flags of every domain that hosts, abp or plain rules name."""
    return coverage.memberships(rows.select("norm"), sets)


def abp_kept(rows: DataFrame, flags: DataFrame) -> DataFrame:
    """Blocking rules that neither a broader rule nor an allow rule removes: key, pos, rule, bare, important."""
    abp = rows.where("kind = 'abp' and norm <> '' and not allow").join(flags, "norm", "left")
    redundant = F.col("bare") & (coverage.flag("abp_parent") | (F.col("wildcard") & coverage.flag("abp_self")) | coverage.flag("wildcard_parent"))
    apex = F.col("wildcard") & coverage.flag("allow_wildcard_self")
    key = F.when(F.col("wildcard"), F.concat(F.lit("*."), F.col("norm"))).otherwise(F.col("norm"))
    return abp.where(~redundant & ~coverage.allowed() & ~apex).select(key.alias("key"), "pos", "rule", "bare", "important")


def plain_kept(rows: DataFrame, flags: DataFrame, hosts: DataFrame) -> DataFrame:
    """The first line of each plain domain that nothing covers: pos, rule, norm. hosts: norms of hosts candidates."""
    free = rows.where("kind = 'plain' and norm <> ''").join(flags, "norm", "left")
    free = free.where(~coverage.allowed() & ~coverage.covered()).select("pos", "rule", "norm")
    roots = plain_candidates(rows).join(flags, "norm", "left").where(~coverage.covered()).select("norm")
    first = free.groupBy("norm").agg(F.min("pos").alias("pos"), F.min_by("rule", "pos").alias("rule"))
    left = first.join(hosts.select("norm").distinct(), "norm", "left_anti")
    return left.join(coverage.below(left, roots), "norm", "left_anti").select("pos", "rule", "norm")


def merge(lines: DataFrame, idna: bool = True, ipv6: bool = True, multi: bool = True) -> DataFrame:
    """lines: pos, rule. The merged list: pos, rule, kind; order by pos.

    idna, ipv6 and multi turn off what needs Python, for lists known to have no such names, addresses or lines.
    """
    pos_type = lines.schema["pos"].dataType.simpleString()
    rows = classified(lines, idna)
    sets = rule_sets(rows, idna)
    entries = host_entries(rows, idna, ipv6)
    entries = stored(entries, "hosts")
    flags = stored(decided(rows.where("kind in ('abp', 'plain')").select("norm").union(entries.select("norm")), sets), "flags")
    candidates = host_candidates(entries, flags)
    parts = {
        "abp": fold_rules(abp_kept(rows, flags)),
        "hosts": hosts_kept(candidates, pos_type, multi),
        "plain": plain_kept(rows, flags, candidates).select("pos", "rule"),
        "other": rows.where("kind = 'other'").groupBy("rule").agg(F.min("pos").alias("pos")).select("pos", "rule"),
    }
    out = None
    for kind, part in parts.items():
        part = part.withColumn("kind", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return out


def dispositions(lines: DataFrame, idna: bool = True, ipv6: bool = True) -> DataFrame:
    """pos, rule, kind and what became of each line: kept or the reason why it went.

    A line is kept if the merged list has a rule at its place; else the first reason that holds, in the merge's order.
    """
    rows = classified(lines, idna)
    sets = rule_sets(rows, idna)
    entries = host_entries(rows, idna, ipv6)
    flags = decided(rows.where("kind in ('abp', 'plain')").select("norm").union(entries.select("norm")), sets)
    by_line = entries.join(flags, "norm", "left").groupBy("pos").agg(
        F.max(coverage.allowed()).alias("h_allowed"), F.min(F.col("norm").isin(*LOCAL_NAMES)).alias("h_local"), F.max(coverage.covered()).alias("h_covered"),
        F.max(~coverage.allowed() & ~F.col("norm").isin(*LOCAL_NAMES) & ~coverage.covered()).alias("h_free"),
    )
    kept = merge(lines, idna, ipv6).select("pos", F.lit(True).alias("is_kept"))
    roots = plain_candidates(rows).join(flags, "norm", "left").where(~coverage.covered()).select("norm")
    under = coverage.below(rows.where("kind = 'plain'"), roots).withColumn("under", F.lit(True))
    all_ = rows.join(flags, "norm", "left").join(by_line, "pos", "left").join(under, "norm", "left").join(kept, "pos", "left")
    redundant = F.col("bare") & (coverage.flag("abp_parent") | (F.col("wildcard") & coverage.flag("abp_self")) | coverage.flag("wildcard_parent"))
    apex = F.col("wildcard") & coverage.flag("allow_wildcard_self")
    hosts = F.when(F.col("h_free").isNull(), "invalid").when(coverage.flag("h_free"), "duplicate_or_conflict").when(coverage.flag("h_allowed"), "hosts_allowed").when(coverage.flag("h_local"), "hosts_local").otherwise("hosts_covered")
    abp = F.when(F.col("norm") == "", "invalid").when(redundant & ~F.col("allow"), "abp_covered").when(F.col("allow"), "allow_rule").when(coverage.allowed() | apex, "abp_allowed").otherwise("duplicate_or_conflict")
    plain = F.when(F.col("norm") == "", "invalid").when(coverage.allowed(), "plain_allowed").when(coverage.covered(), "plain_covered").when(coverage.flag("under"), "plain_under_parent").otherwise("duplicate_or_conflict")
    what = F.when(F.col("is_kept"), "kept").when(F.col("kind") == "blank", "blank").when(F.col("kind") == "hosts", hosts).when(F.col("kind") == "abp", abp).when(F.col("kind") == "allow", "allow_rule").when(F.col("kind") == "plain", plain).otherwise("duplicate_or_conflict")
    return all_.select("pos", "rule", "kind", what.alias("disposition"))


def counters(disposed: DataFrame) -> DataFrame:
    """disposition and lines of each, blank ones included."""
    return disposed.groupBy("disposition").agg(F.count(F.lit(1)).alias("lines"))


def reduction(lines_in: Column, lines_out: Column) -> Column:
    return F.when(lines_in == 0, 0.0).otherwise((lines_in - lines_out) / lines_in * 100)
