import itertools
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from helpers import ODD, documents, near_copies, odd

from gristmill.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(MODEL)


def segmentations(text, v):
    """Every segmentation with its log-chance."""
    x = pieces.Lattice(v.cut(pieces.BLANK + text.replace(" ", pieces.BLANK)), v)

    def paths(at, end):
        if at == end:
            yield (), 0.0
        else:
            for e in range(x.first[at], x.first[at + 1]):
                for rest, log in paths(int(x.to[e]), end):
                    yield (int(x.id[e]), *rest), float(x.log[e]) + log

    chunks = [list(paths(a, b)) for a, b in zip(x.begin, x.begin[1:], strict=False)]
    return {sum((c[0] for c in combo), ()): sum(c[1] for c in combo) for combo in itertools.product(*chunks)}


def test_samples_follow_the_chances(vocabulary):
    text, n = "a the", 30_000
    every = segmentations(text, vocabulary)
    assert abs(sum(np.exp(list(every.values()))) - 1) < 1e-9
    sampler = pieces.Sampler([text] * n, np.random.default_rng(0).integers(0, 2**63, n).astype(np.uint64), vocabulary, 3)
    first, second = Counter(), Counter()
    for *found, (threshold,) in sampler.run():
        ids = [tuple(sampler.lattice.id[e].tolist()) for _, _, e in found]
        assert len(set(ids)) == 3 and all(abs(every[i] - log) < 1e-9 for i, (log, _, _) in zip(ids, found, strict=True))
        values = [g for _, g, _ in found] + [threshold]
        assert values == sorted(values, reverse=True)
        first[ids[0]] += 1
        second[tuple(ids[:2])] += 1
    for a, log in every.items():
        p = np.exp(log)
        assert abs(first[a] / n - p) < 5 * np.sqrt(p * (1 - p) / n) + 1e-4
        for b in every:
            if a != b:
                q = p * np.exp(every[b]) / (1 - p)
                assert abs(second[a, b] / n - q) < 5 * np.sqrt(q / n) + 1e-4


def test_all_segmentations_of_a_short_text(vocabulary):
    every = segmentations("the", vocabulary)
    sampler = pieces.Sampler(["the"], np.array([7], dtype=np.uint64), vocabulary, 50)
    *found, (threshold,) = sampler.run()[0]
    assert {tuple(sampler.lattice.id[e].tolist()) for _, _, e in found} == set(every) and threshold == -np.inf


def test_round_trip(spark):
    texts = [*ODD, "  two  blanks ", "tabs\tand\nlines\n", "𝔘nicode ½², Ünïcode", *near_copies(2, 6)]
    out = pieces.encode(documents(spark, texts, extra=True), MODEL, 3)
    rows = pieces.decode(out, MODEL).collect()
    for r in rows:
        assert r["decodes"] and r["text"] == (texts[r["doc_id"]] or "").replace("▁", " "), r["doc_id"]
        assert r["log_inclusion"] <= 0 and r["n_pieces"] == len(r["ids"])
    per = Counter(r["doc_id"] for r in rows)
    assert per[0] == per[1] == 1 and set(per) == set(range(len(texts)))
    assert len({(r["doc_id"], tuple(r["ids"])) for r in rows}) == len(rows)
    again = pieces.encode(documents(spark, texts).repartition(7), MODEL, 3, with_ids=False).collect()
    assert {(r["doc_id"], r["sample"], r["ids_crc32"]) for r in again} == {(r["doc_id"], r["sample"], r["ids_crc32"]) for r in rows}


def test_ids_are_pieces_of_the_library(vocabulary):
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    sampler = pieces.Sampler(["Hello there, 12 中 world\n\x01"], np.array([3], dtype=np.uint64), vocabulary, 4)
    for _, _, e in sampler.run()[0][:-1]:
        assert m.decode(sampler.ids(e).tolist()) == "Hello there, 12 中 world\n\x01"


def test_empty_table_and_null_keys(spark):
    assert pieces.encode(odd(spark).where("false"), MODEL).count() == 0
    df = spark.createDataFrame([(None, "abc def"), (None, "abc def"), (1, "abc def")], "doc_id long, text string")
    got = [r["ids_crc32"] for r in pieces.encode(df, MODEL, 1).orderBy("doc_id").collect()]
    assert got[0] == got[1]
