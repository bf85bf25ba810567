import random

import numpy as np
import pytest
from helpers import ODD, documents, odd, prose, remainder

from gristmill.llm import toxicity

BAD = ["zorgol", "vipp", "grannok"]


def corpus(spark, n=600):
    rng = random.Random(4)
    texts, labels = [], []
    for k in range(n):
        words = prose(rng, rng.randint(3, 120)).split()
        bad = k % 5 == 0
        for _ in range(3 if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        texts.append(" ".join(words))
        labels.append((k, 1, int(bad)))
    return documents(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rows(spark):
    docs, labels = corpus(spark)
    scorer = toxicity.train(docs, labels)
    rows = toxicity.scored(docs, scorer).collect()
    held = [(r["doc_id"] % 5 == 0, r["score"]) for r in rows if remainder(r["doc_id"], 4) == 2]
    assert len(held) > 50 and all(0 <= s <= 1 for _, s in held)
    assert np.mean([(s >= toxicity.THRESHOLD) == bad for bad, s in held]) > 0.97
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in rows if r["score"] < toxicity.THRESHOLD}


def test_labels_of_held_out_rows_are_not_used(spark):
    docs, labels = corpus(spark, 200)
    from pyspark.sql import functions as F

    lies = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ([r["score"] for r in toxicity.scored(docs, toxicity.train(docs, x)).orderBy("doc_id").collect()] for x in (labels, lies))
    assert a == b


@pytest.mark.parametrize("toxic", [None, 0, 1])
def test_odd_rows_and_one_sided_labels(spark, toxic):
    docs = odd(spark, extra=True)
    labels = spark.createDataFrame([(k, toxic) for k in range(len(ODD))] + [(None, 1)], "doc_id long, toxic int")
    name = "_s"
    rows = toxicity.scored(docs, toxicity.train(docs, labels), name).collect()
    assert len(rows) == len(ODD) and all(r[name] == (toxic or 0) for r in rows)
    assert toxicity.without_toxic(docs.where("false"), labels).count() == 0


def test_isotonic_and_trees():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(800, 3))
    y = (x[:, 0] + 0.5 * (x[:, 1] > 0.3) > 0.4).astype(float)
    m = toxicity.Trees.fit(x[:600], y[:600]).margins(x[600:])
    assert ((m > 0) == y[600:]).mean() > 0.93
    at, value = toxicity.isotonic(m, y[600:])
    assert (np.diff(at) > 0).all() and (np.diff(value) >= 0).all() and 0 <= value.min() <= value.max() <= 1


LEXICON = toxicity.Lexicon({"zorgol", "grannok", toxicity.whole("z" * 40)}, {"vipp"})


def test_long_texts_are_measured_whole(monkeypatch):
    text = ("You zorgol! " * 50 + "gr4nnok %%% ABC " + "z" * 40 + " ").encode() * 3
    whole = toxicity.measured(text, LEXICON)
    for size in (1, 7, 600):
        monkeypatch.setattr(toxicity, "CHUNK", size)
        assert np.array_equal(whole, toxicity.measured(text, LEXICON))
    assert whole[1] == 153 and whole[3] == 3


def plainly(text):
    """The sums of a text, character by character and pair by pair."""
    raw = text.encode()
    low, words, word = text.lower(), [], ""
    for c in low + " ":
        if c.isalpha():
            word += c
        else:
            words, word = words + [word] * (word != ""), ""
    hits = [k for k, w in enumerate(words) if w in ("zorgol", "grannok", "z" * 40) or w.startswith("vipp") and len(w) > 3]
    exact = [k for k in hits if words[k] in ("zorgol", "grannok", "z" * 40)]
    you = [k for k, w in enumerate(words) if w in toxicity.SECOND_PERSON]
    count = lambda chars: sum(c in chars for c in text if ord(c) < 128)
    near = sum(any(abs(h - y) <= 5 for y in you) for h in hits)
    punct = [chr(b) for b in range(33, 127) if not chr(b).isalnum()]
    return {"words": len(words), "hits": len(exact), "starts": len(hits) - len(exact), "near_you": near, "you": len(you), "upper": count("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "lower": count("abcdefghijklmnopqrstuvwxyz"), "punct": count(punct), "bang": count("!"), "digits": count("0123456789"), "bytes": len(raw)}


@pytest.mark.parametrize("text", [t for t in ODD if t is not None] + ["You are a VIPPERX, zorgol!! du " + "x " * 4 + "grannok9vipp 5zorgol" + " z" * 3 + "z" * 39])
def test_features_against_plain_code(text):
    got = dict(zip(toxicity.NAMES, toxicity.measured(text.encode(), LEXICON), strict=True))
    want = plainly(text)
    assert {k: got[k] for k in want} == want


def test_model_does_not_depend_on_partitions(spark):
    docs, labels = corpus(spark, 300)
    docs = docs.union(docs.where("doc_id % 3 = 0").selectExpr("doc_id + 1000 as doc_id", "text", "lang", "source", "n_chars"))  # repeated texts
    labels = labels.union(labels.where("doc_id % 3 = 0").selectExpr("doc_id + 1000", "quality", "toxic")).selectExpr("doc_id", "if(doc_id % 17 = 3, 1 - toxic, toxic) as toxic")
    found = []
    for n in (1, 3, 8):
        scorer = toxicity.train(docs.repartition(n, "n_chars", "doc_id"), labels.repartition(n))
        found.append({r["doc_id"]: r["score"] for r in toxicity.scored(docs.coalesce(1), scorer).collect()})
    assert found[0] == found[1] == found[2] and len(set(found[0].values())) > 2
