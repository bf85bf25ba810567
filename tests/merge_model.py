"""A sequential model of merging one list, written from its rules, for property tests: slow, plain, one line at a time."""

from __future__ import annotations

import re

LOCAL = {"localhost", "local", "broadcasthost"}
RANKS = {"0.0.0.0": 0, "127.0.0.1": 2, "10.0.0.1": 1}
DOMAIN = re.compile(r"[0-9A-Za-z-]+(\.[0-9A-Za-z-]+)*\.?")


def norm(name: str) -> str:
    name = name.strip().lower()
    name = name[2:] if name[:2] == "*." else name
    return re.sub(r"\.{2,}", ".", name.rstrip(".")).lstrip(".")


def parents(d: str) -> list[str]:
    return [d[m.end() :] for m in re.finditer(r"\.", d)]


def kind(line: str) -> tuple[str, str]:
    if " " in line and re.match(r"[0-9a-fA-F\[:]", line) and re.match(r"[0-9A-Fa-f:.\[\]]+\s+[^#]+", line):
        return "hosts", ""
    if named := re.search(r"\|\|([^\^]+)\^", line):
        return "abp", named[1]
    if line.startswith("@@"):
        return "allow", ""
    return ("plain", line) if "." in line and DOMAIN.fullmatch(line) else ("other", "")


def merge(lines: list[str]) -> dict[str, set[str]]:
    """What stays, by kind."""
    sets: dict[str, set[str]] = {k: set() for k in ("block", "below", "allow", "allow_below", "plain")}
    for line in lines:
        named = re.search(r"\|\|([^\^]+)\^", line)
        if named:
            wild = named[1].startswith("*.") and "." in named[1][2:]
            sets[("allow" if line.startswith("@@") else "block" if not wild else "") + ("_below" if wild and line.startswith("@@") else "") or "below"].add(norm(named[1]))
        elif kind(line)[0] == "plain" and not line[0].isdigit():
            sets["plain"].add(norm(line))
    allowed = lambda d: any(x in sets["allow"] for x in [d, *parents(d)]) or any(x in sets["allow_below"] for x in parents(d))
    covered = lambda d: any(x in sets["block"] for x in [d, *parents(d)]) or any(x in sets["below"] for x in parents(d))
    roots = {d for d in sets["plain"] if not covered(d)}
    final: dict[str, str] = {}
    owner: dict[str, tuple[str, str]] = {}  # domain -> kind, rule
    names: dict[str, list[tuple[str, str]]] = {}  # hosts rule -> its hosts

    def put(rule: str, what: str, domains: list[str]) -> None:
        final[rule] = what
        owner.update((d, (what, rule)) for d in domains)

    for line in lines:
        what, name = kind(line)
        d = norm(name)
        if what == "hosts":
            ip, *hosts = line.split("#")[0].split()
            rank, free = RANKS.get(ip), {}
            for h in hosts:
                if norm(h) and not allowed(norm(h)) and norm(h) not in LOCAL and not covered(norm(h)):
                    free.setdefault(norm(h), h)
            mine: list[tuple[str, str]] = []
            for n, h in free.items():
                held = owner.get(n)
                if held and held[0] == "plain":
                    final.pop(held[1], None)
                    del owner[n]
                    held = None
                if not held:
                    mine.append((h, n))
                    continue
                theirs = RANKS.get(held[1].split()[0])
                if rank is not None and theirs is not None and rank > theirs:
                    final.pop(held[1], None)
                    for h2, n2 in names[held[1]]:
                        if owner.get(n2) == held:
                            del owner[n2]
                        if all(n2 != x for _, x in mine):
                            mine.append((h2, n2))
                    if all(n != x for _, x in mine):
                        mine.append((h, n))
            rule = " ".join([ip, *(h for h, _ in mine)])
            if mine and rule not in final:
                names[rule] = mine
                put(rule, "hosts", [n for _, n in mine])
        elif what == "abp":
            wild = name.startswith("*.") and "." in name[2:]
            bare = bool(re.fullmatch(r"\|\|[^\^]+\^", line)) or (wild and "$" not in line)
            if not d or line.startswith("@@") or allowed(d) or (wild and d in sets["allow_below"]):
                continue
            if bare and (any(p in sets["block"] for p in parents(d)) or (wild and d in sets["block"]) or any(p in sets["below"] for p in parents(d))):
                continue
            key = ("*." if wild else "") + d
            held = owner.get(key)
            if held and held[0] == "abp":
                was_bare = "$" not in held[1]
                if bare and (was_bare or "$important" in held[1]):
                    continue
                if was_bare and "$important" in line:
                    final.pop(held[1], None)
                    del owner[key]
            if line not in final:
                put(line, "abp", [key])
        elif what == "plain":
            if d and d not in owner and line not in final and not allowed(d) and not covered(d) and not any(p in roots for p in parents(d)):
                put(line, "plain", [d])
        elif what == "other":
            final.setdefault(line, "other")
    return {k: [r for r, w in final.items() if w == k] for k in ("hosts", "abp", "plain", "other")}
