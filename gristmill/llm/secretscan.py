"""Secret scan by a random forest over candidates; DataFrame operations only.

Candidates are runs of 16 or more key characters that hold a digit or start as a known format does, values of 6 or more
characters, of any kind but quotes and brackets, after a word that names secrets, and passwords in URLs. Each gets numbers: its length, its shares of character kinds, the
transitions between kinds and between letters that are usual or not in words, how much of it a small dictionary covers,
what its path (the source) and the neighbouring words say, its entropy. A forest trained on labelled findings tells
secrets from false positives: checksums named as such, numbers, words, paths, placeholders.

The labelled findings are a parameter (text, label: candidates in their surroundings, 1 for a secret). The default
table is made by rule from hashes of row numbers: TRAINING rows of the kinds of secret and of non-secret below. The
forest is grown level by level from histograms that Spark sums (bootstrap weights, random features per node); it has at
most TREES * 2 ** DEPTH leaves, and is applied as an SQL expression over the numbers.

Defined results: null and empty texts have no candidates; the same candidate at two places of a text is two findings; a
null source counts as an empty one; repeated rows give their findings each; an empty table gives none; other columns
are ignored or, by redact, kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm.common import free_name, stored, table

TRAINING, TREES, DEPTH, BINS = 24_000, 16, 6, 16
THRESHOLD = 0.5
#: How keys of known formats start.
KNOWN = r"AKIA|ASIA|AIza|gh[pousr]_|github_pat_|xox[abeoprs]-|sk[-_]|glpat-|eyJ"
#: A candidate: the value after a secret-naming key or scheme; a password within a URL; or a whole run of 16 or more key
#: characters with a digit among them or a known start, and its padding.
_KEY = r"A-Za-z0-9+/_.\-"
_NAMES = r"secret|token|passw|pass|pwd|api.?key|access.?key|private.?key|credential|auth"
_VALUE = r"""[^\s"'`<>{}()\[\]]{5,}+(?<![,;.])|[^\s"'`<>{}()\[\]]{5,}[^\s"'`<>{}()\[\],;.]"""
_ASSIGNED = rf"""(?<=[=:]\s?[\s"']?)(?<=(?i:{_NAMES})[A-Za-z_]{{0,8}}["']?\s?[=:]\s?["']?)(?![\s"'=:])(?:{_VALUE})"""
_BEARER = r"""(?<=\s)(?<=(?i:bearer) )[^\s"'`<>{}()\[\],;]{6,}"""
_IN_URL = r"""(?<=:)(?<=://[^\s:@/"']{1,64}:)[^\s@/"']{3,}+(?=@)"""
CANDIDATE = rf"{_ASSIGNED}|{_BEARER}|{_IN_URL}|(?<![{_KEY}])(?=[{_KEY}]{{16}})(?=[A-Za-z+/_.\-]*+[0-9]|{KNOWN})[{_KEY}]++={{0,2}}"
#: Characters before and after a candidate that are looked at.
BEFORE, AFTER = 32, 4
#: Words of a dictionary, and words that stand beside secrets or beside what only looks like one.
DICTIONARY = "the and for with that this from have test example sample user name file data index image page content value default public version release license apache general http https www com org html node table time date".split()
SAYS_SECRET = r"(?i)(secret|token|passw|pwd|api.?key|access.?key|private|credential|auth|bearer)"
SAYS_NOT = r"(?i)(sha-?\d|md5|checksum|digest|hash|commit|uuid|guid|fingerprint|integrity|etag|revision|example|placeholder|dummy)"
CODE_PATH = r"(?i)(config|\.env|settings|deploy|\.ya?ml|\.json|\.ini|credential|\.pem|\.key)"
#: Pairs of letters that are usual in words.
USUAL = "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea ra ce li ch ll be ma si om ur".split()
NAMES = ("length", "digits", "upper", "lower", "other", "changes", "usual", "covered", "entropy", "hex", "spread", "assigned", "quoted", "says_secret", "says_not", "path_code", "parts", "repeats", "known", "code", "in_url")


def numbers(c: Column, before: Column, after: Column, source: Column) -> Column:
    """The numbers in NAMES of a candidate, as an array."""
    size = F.greatest(F.length(c), F.lit(1))
    share = lambda pattern: 1 - F.length(F.regexp_replace(c, pattern, "")) / size
    kinds = F.translate(F.translate(F.translate(c, "bcdefghijklmnopqrstuvwxyz", "a" * 25), "BCDEFGHIJKLMNOPQRSTUVWXYZ", "A" * 25), "123456789", "0" * 9)
    chars = F.filter(F.split(c, ""), lambda x: x != "")
    counts = F.transform(F.array_distinct(chars), lambda x: (F.length(c) - F.length(F.replace(c, x, F.lit("")))) / size)
    values = {
        "length": F.length(c),
        "digits": share("[0-9]"),
        "upper": share("[A-Z]"),
        "lower": share("[a-z]"),
        "other": share("[^0-9A-Za-z]"),
        "changes": F.length(F.regexp_replace(kinds, r"(.)\1*", "x")) / size,
        "usual": F.regexp_count(F.lower(c), F.lit(f"(?=({'|'.join(USUAL)}))")) / size,
        "covered": 1 - F.length(F.regexp_replace(F.lower(c), "|".join(DICTIONARY), "")) / size,
        "entropy": F.aggregate(counts, F.lit(0.0), lambda total, p: total - p * F.log2(p)),
        "hex": c.rlike(r"^(?:[0-9a-f]+|[0-9A-F]+)$").cast("int"),
        "spread": F.size(F.array_distinct(chars)) / size,
        "assigned": before.rlike(r"[=:]\s*[\"']?$").cast("int"),
        "quoted": (before.rlike(r"[\"']$") & after.rlike(r"^[\"']")).cast("int"),
        "says_secret": (before.rlike(SAYS_SECRET) | c.rlike(rf"^({KNOWN})")).cast("int"),
        "says_not": (before.rlike(SAYS_NOT) | c.rlike(r"(?i)example|xxxx|placeholder")).cast("int"),
        "path_code": source.rlike(CODE_PATH).cast("int"),
        "parts": F.size(F.split(c, r"[/_.=+\-]+")),
        "repeats": share(r"(.)\1{2,}"),
        "known": c.rlike(rf"^({KNOWN})").cast("int"),
        "code": (c.rlike(r"[$%]\w*$|^[$%]|^[A-Za-z_]+(\.[A-Za-z_]+)+$|^/") | after.rlike(r"^[({\[]")).cast("int"),
        "in_url": (before.rlike(r"://[^\s:@/]*:$") & after.startswith("@")).cast("int"),
    }
    return F.array(*(F.coalesce(values[name].cast("double"), F.lit(0.0)) for name in NAMES))


def judged(docs: DataFrame, forest: list[dict], parts: str = "_parts", found: str = "_found") -> DataFrame:
    """Rows of docs whose text has candidates, with the text between them and the candidates, two arrays, under these names.

    All happens within the row: nothing is exploded or shuffled.
    """
    keys, measured = free_name(docs, "_keys"), free_name(docs, "_numbers")
    rows = docs.where(F.col("text").rlike(CANDIDATE))
    rows = rows.withColumn(parts, F.split("text", CANDIDATE)).withColumn(keys, F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)))
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))

    def one(key: Column, k: Column) -> Column:
        before, after = F.right(F.get(parts, k), F.lit(BEFORE)), F.left(F.get(parts, k + 1), F.lit(AFTER))
        return F.struct(k.alias("ordinal"), key.alias("candidate"), numbers(key, before, after, source).alias("x"))

    rows = rows.withColumn(measured, F.transform(keys, one))
    with_score = F.expr(f"transform(`{measured}`, v -> struct(v.ordinal as ordinal, v.candidate as candidate, {score_of(forest, 'v.x')} as score))")
    return rows.withColumn(found, with_score).drop(keys, measured)


# ---------------------------------------------------------------- labelled findings


def labelled(spark: SparkSession, rows: int = TRAINING) -> DataFrame:
    """Labelled findings by rule: source, before, candidate, after, label. Half of the rows are secrets."""
    h = lambda salt: F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    base64 = lambda salt: F.regexp_replace(F.base64(F.unhex(h(salt))), "=", "")
    pick = lambda salt, values: F.element_at(F.array(*map(F.lit, values)), (F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(len(values))) + 1).cast("int"))
    kind = F.pmod(F.xxhash64(F.lit("kind"), "id"), F.lit(26))
    named = pick("named", ['token = "', 'secret: "', "password=", 'api_key = "', "Authorization: Bearer ", 'access_key: "', "export AUTH_TOKEN=", 'client_secret="', "passwd: "])
    plain = pick("plain", ["the ", "with ", "see ", "is ", "", "for ", "at ", "id ", "value "])
    sums = pick("sums", ["sha1: ", "sha256=", "md5 ", "checksum: ", "commit ", 'integrity="', "uuid ", "etag: ", "fingerprint "])
    words = F.concat_ws("_", *(pick(f"w{k}", ["user", "table", "index", "page", "data", "content", "value", "version", "release"]) for k in range(4)))
    path = F.concat_ws("/", *(pick(f"p{k}", ["usr", "local", "share", "docs", "images", "html", "2024", "index", "static.html"]) for k in range(5)))
    uuid = F.regexp_replace(h("u"), r"^(.{8})(.{4})(.{4})(.{4})(.{12}).*$", "$1-$2-$3-$4-$5")
    host = F.concat(pick("h1", ["mail", "www", "ftp", "node", "cdn"]), F.pmod("id", F.lit(97)), F.lit("."), pick("h2", ["example", "mirror", "static", "users"]), pick("h3", [".com", ".example.net", ".org.example", ".co.uk"]))
    number = F.left(F.regexp_replace(F.concat(h("n"), h("m")), "[^0-9]", ""), F.lit(16))
    cases = [
        (1, named, F.left(h("a"), F.lit(40))), (1, named, F.left(h("a"), F.lit(32))), (1, named, base64("b")), (1, named, F.left(base64("b"), F.lit(24))),
        (1, named, F.concat(F.lit("ghp_"), F.left(F.regexp_replace(base64("c"), "[+/]", "x"), F.lit(36)))), (1, plain, F.concat(F.lit("AKIA"), F.upper(F.left(h("d"), F.lit(16))))),
        (1, named, F.concat(F.lit("sk-"), F.left(F.regexp_replace(base64("e"), "[+/]", "z"), F.lit(40)))), (1, named, F.concat(F.lit("xoxb-"), F.left(F.regexp_replace(h("f"), "[a-f]", "7"), F.lit(12)), F.lit("-"), F.left(base64("g"), F.lit(24)))),
        (0, sums, F.left(h("i"), F.lit(40))), (0, sums, h("j")), (0, sums, uuid), (0, plain, words), (0, plain, path),
        (0, pick("nums", ["card ", "no. ", "", "number ", "the "]), number),
        (0, plain, F.when(F.pmod(F.xxhash64("id"), F.lit(2)) == 0, F.upper(F.left(h("k"), F.lit(40)))).otherwise(host)), (0, named, pick("dummy", ["your_api_key_here_example", "xxxxxxxxxxxxxxxxxxxxxxxx", "REPLACE_WITH_YOUR_TOKEN", "changeme-placeholder-value", "<placeholder-example-key>"])),
    ]
    letters = F.translate(F.left(F.regexp_replace(base64("l"), "[^A-Za-z]", ""), F.lit(24)), "AEIOU", "aeiou")
    lower = F.left(F.lower(F.regexp_replace(F.concat(base64("l"), base64("o")), "[^A-Za-z]", "")), F.lit(24))
    mixed = F.concat(pick("m1", ["hunter", "Summer", "Sup3r", "dragon", "P4ss", "Tr0ub", "winter", "qwerty", "letmein"]), F.left(base64("q"), F.lit(3)), pick("m2", ["!", "#9", "$", "7secret", "2024!", "@x", "PassW0rd", "_1", "99"]))
    short = F.concat(F.left(base64("r"), F.lit(7)), pick("m3", ["", "!", "#", "%k", "&2", "*"]))
    aws = F.concat(F.lit("AKIA"), F.translate(F.upper(F.left(h("t"), F.lit(16))), "0123456789", "GHIJKLMNOP"))
    word = pick("word", ["required", "string", "optional", "undefined", "password", "changeme", "invalid", "expired", "missing", "forgotten", "please", "management", "protected", "username", "whatever", "default", "version", "content", "example"])
    code = pick("code", ["$PASSWORD", "os.environ", "process.env.TOKEN", "$DB_TOKEN", "%TOKEN%", "/run/secrets/token", "config.password", "self.token", "settings.SECRET", "request.token"])
    cases += [
        (1, named, letters), (1, named, lower), (1, named, mixed), (1, named, short), (1, plain, aws),
        (0, named, word), (0, named, word), (0, named, code), (0, pick("prose", ["the token: ", "password: ", "secret: the ", "auth: "]), F.concat(word, pick("end", ["", "-only", "_field", "s"]))), (1, pick("url", ["postgres://u:", "mysql://root:", "https://bot:", "amqp://app:", "redis://x:"]), F.when(F.pmod(F.xxhash64(F.lit("p"), "id"), F.lit(2)) == 0, mixed).otherwise(short)),
    ]
    of = lambda at: F.coalesce(*(F.when(kind == k, case[at] if at else F.lit(case[0])) for k, case in enumerate(cases)))
    source = pick("source", ["src0", "src7", "config/app.yaml", "docs/index.html", ".env", "src3", "README", "settings.json"])
    return spark.range(rows).select(source.alias("source"), of(1).alias("before"), of(2).alias("candidate"), F.when(of(1).endswith(":") & of(1).contains("://"), "@db.h").otherwise(pick("after", ['"', '"', " ", "\n", ""])).alias("after"), of(0).alias("label"))


# ---------------------------------------------------------------- the forest


def train(findings: DataFrame, trees: int = TREES, depth: int = DEPTH) -> list[dict]:
    """Grows a forest from labelled findings. A tree is a dict: node -> (feature, cut) or (None, share of secrets).

    A level costs one job: sums of weights by tree, node, feature and bin. Each row has a Poisson-like weight per tree,
    each node looks at a third of the features; both by hash, so that the forest is the same wherever rows are.
    """
    x = numbers(F.col("candidate"), F.col("before"), F.col("after"), F.col("source"))
    rows = stored(findings.select(x.alias("_x"), F.col("label").cast("int").alias("label"), F.xxhash64("candidate", "before").alias("id")), "labelled")
    n = len(NAMES)
    cuts = rows.select(*(F.percentile_approx(F.col("_x")[k], [b / BINS for b in range(1, BINS)], 10_000).alias(str(k)) for k in range(n))).first()
    cuts = [sorted(set(c or [])) for c in cuts]
    edges = F.array(*(F.array(*map(F.lit, c)) if c else F.array().cast("array<double>") for c in cuts))
    binned = F.transform(F.col("_x"), lambda v, k: F.size(F.filter(F.get(edges, k), lambda e: v > e)))
    u = F.pmod(F.xxhash64(F.lit("weight"), "tree", "id"), F.lit(1000)) / 1000.0
    weight = F.when(u < 0.368, 0).when(u < 0.736, 1).when(u < 0.920, 2).when(u < 0.981, 3).otherwise(4)
    grown = rows.select("label", "id", binned.alias("b")).withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn("w", weight).where("w > 0")
    grown = stored(grown.withColumn("node", F.lit(1)), "grown")
    forest: list[dict] = [{} for _ in range(trees)]
    for level in range(depth + 1):
        picked = F.pmod(F.xxhash64(F.lit("feature"), "tree", "node", "f"), F.lit(3)) == 0
        cells = grown.select("tree", "node", "label", "w", F.posexplode("b").alias("f", "bin")).where(picked | (F.col("f") == 0))
        sums = cells.groupBy("tree", "node", "f", "bin").agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("label")).alias("y")).collect()  # at most trees * 2^level * features * bins
        nodes: dict[tuple, dict] = {}
        for r in sums:
            nodes.setdefault((r["tree"], r["node"]), {}).setdefault(r["f"], {})[r["bin"]] = (r["w"], r["y"])
        for (tree, node), features in nodes.items():
            forest[tree][node] = _split(features, cuts, last=level == depth)
        split = {(t, k): v for t, f in enumerate(forest) for k, v in f.items() if v[0] is not None and k >> level == 1}
        if not split:
            break
        values = ", ".join(f"({t}, {k}, {v[0]}, {len([c for c in cuts[v[0]] if c < v[1]])})" for (t, k), v in sorted(split.items()))
        table = grown.sparkSession.sql(f"select * from values {values} as t(tree, node, f, cut)")
        moved = grown.join(F.broadcast(table), ["tree", "node"])  # rows of nodes that are split
        grown = moved.select("label", "id", "b", "tree", "w", (F.col("node") * 2 + (F.get("b", F.col("f")) > F.col("cut")).cast("int")).alias("node"))
    return forest


def _split(features: dict, cuts: list, last: bool) -> tuple:
    """The best cut of a node by Gini impurity, or its share of secrets."""
    w, y = (sum(c[k] for c in next(iter(features.values())).values()) for k in (0, 1))
    best = (0.0, None, 0.0)
    for f, bins in sorted(features.items()):
        lw = ly = 0
        for b in sorted(bins)[:-1]:
            lw, ly = lw + bins[b][0], ly + bins[b][1]
            rw, ry = w - lw, y - ly
            gain = ly**2 / lw + (lw - ly) ** 2 / lw + ry**2 / rw + (rw - ry) ** 2 / rw - (y**2 + (w - y) ** 2) / w
            if gain > best[0] + 1e-9 and min(lw, rw) >= 3:
                best = (gain, f, b)
    if last or best[1] is None or y in (0, w):
        return None, (y + 0.5) / (w + 1)
    return best[1], cuts[best[1]][best[2]]


def score_of(forest: list[dict], x: str) -> str:
    """The forest as SQL over the array x: the mean of the trees' shares."""

    def at(tree: dict, node: int) -> str:
        feature, value = tree[node]
        if feature is None:
            return f"{float(value)!r}D"
        return f"if({x}[{feature}] > {float(value)!r}D, {at(tree, 2 * node + 1)}, {at(tree, 2 * node)})"

    return f"({' + '.join(at(t, 1) for t in forest)}) / {float(len(forest))!r}D"


def _forest(docs: DataFrame, findings: DataFrame | None) -> list[dict]:
    return train(labelled(docs.sparkSession) if findings is None else findings)


def scan(docs: DataFrame, findings: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Findings of documents (doc_id, text, source): doc_id, ordinal (in the text, from 0), candidate, score, is_secret."""
    found = judged(docs.select("doc_id", "text", "source"), _forest(docs, findings)).select("doc_id", F.inline("_found"))
    return found.withColumn("is_secret", F.col("score") >= threshold)


def redact(docs: DataFrame, findings: DataFrame | None = None, threshold: float = THRESHOLD, mark: str = "[SECRET]") -> DataFrame:
    """The documents with their columns; each secret in a text is replaced by the mark, and n_chars follows."""
    has = F.coalesce(F.col("text").rlike(CANDIDATE), F.lit(False))
    parts, found = free_name(docs, "_parts"), free_name(docs, "_found")
    done = judged(docs, _forest(docs, findings), parts, found)
    put = F.transform(found, lambda v: F.when(v["score"] >= threshold, F.lit(mark)).otherwise(v["candidate"]))
    whole = F.array_join(F.flatten(F.zip_with(parts, put, lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    done = done.withColumn("text", whole)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return docs.where(~has).unionByName(done.select(*docs.columns))


def op7_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "ordinal", F.sha2("candidate", 256).alias("candidate_sha256"), F.length("candidate").alias("length"), "score", "is_secret")
