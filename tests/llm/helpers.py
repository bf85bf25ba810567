"""Small tables and brute-force versions for the tests of the corpus operators."""

from __future__ import annotations

import random
import zlib

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: What every operator must stand: nulls, empty and white texts, ties, repeated texts, one long text.
ODD = [None, "", "  \n", "a", "a b c", "A  b\tc", "a b c d e f g h i j", "a b c d e f g h i j", "x" * 5000, "w " * 30_000, 'é ü   token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "\x1c<|endoftext|> ▁ 中文 \x85"]


def documents(spark, texts, extra=False):
    rows = [(k, t, "en", f"src{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:  # columns with names that operators may use themselves
        from pyspark.sql import functions as F

        df = df.select("*", *(F.lit(n).alias(n) for n in ("_bucket", "score", "node", "_parts", "_found", "_keys", "_numbers", "_row", "_salt", "held_out")))
    return df


def odd(spark, extra=False):
    return documents(spark, ODD, extra)


def prose(rng, n):
    return " ".join("".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def near_copies(seed=1, groups=12):
    """Texts of 1 to 300 words; some are copies of others with a few words changed."""
    rng = random.Random(seed)
    out = []
    for _ in range(groups):
        base = prose(rng, rng.choice([1, 2, 5, 12, 40, 120, 300])).split()
        for _ in range(rng.randint(1, 9)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, len(words) // 40, len(words) // 12])):
                words[rng.randrange(len(words))] = prose(rng, 1)
            out.append(" ".join(words))
    rng.shuffle(out)
    return out


def groups(ids, links):
    """The smallest id that links lead to, for each id."""
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def remainder(doc_id, n):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n
