import random
import zlib
from collections import defaultdict

import numpy as np
from helpers import ODD, documents, near_copies, odd
from hypothesis import given, settings
from hypothesis import strategies as st

from gristmill.llm import packing


def library(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_tokenizer())
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_ids_are_the_librarys():
    rng = random.Random(3)
    letters = [*"abcXYZ019 '  \t\n.,!?_-$*éÉßüÜñÑçĀōŐŁłĶķĴĵ×÷ŇňœªºµΣσİı\x1c\x85\xa0中", "'s", "'LL", "<|endoftext|>", "<|ENDOFTEXT|>"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    got = packing.WordIds(packing.default_tokenizer())([t.encode() for t in texts])
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == library(texts)


def check(rows, texts, capacity):
    ids = {k: x + [1] for k, x in enumerate(library(texts))}
    places = defaultdict(list)
    seen = defaultdict(list)
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] <= capacity and zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
        assert r["start"] == r["piece"] * capacity
        places[r["sequence_id"]].append((r["offset"], r["length"]))
        seen[r["doc_id"]].append(r["length"])
    assert {k: sum(v) for k, v in seen.items()} == {k: len(x) for k, x in ids.items()}
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_packed_documents(spark):
    texts = [*ODD, *near_copies(2, 40)]
    for capacity in (64, 4096):
        df = packing.pack_documents(documents(spark, texts, extra=True), packing.default_tokenizer(), capacity, with_ids=True)
        rows = df.collect()
        sequences = check(rows, texts, capacity)
        total = sum(r["length"] for r in rows)
        assert sequences <= -(-total // capacity) * 1.05 + 1
        assert all(len(r["ids"]) == r["length"] for r in rows)


def test_odd_and_empty_tables(spark):
    check(packing.pack_documents(odd(spark), packing.default_tokenizer()).collect(), ODD, 4096)
    assert packing.pack_documents(odd(spark).where("false"), packing.default_tokenizer()).count() == 0


def fewest(sizes, capacity):
    """The least number of bins, by trying all."""
    best = [len(sizes)]
    sizes = sorted(sizes, reverse=True)

    def place(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(sizes):
            best[0] = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + sizes[k] <= capacity and bins[i] not in bins[:i]:
                bins[i] += sizes[k]
                place(k + 1, bins)
                bins[i] -= sizes[k]
        bins.append(sizes[k])
        place(k + 1, bins)
        bins.pop()

    place(0, [])
    return best[0]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=0, max_size=9))
def test_reduction_never_costs_a_bin(sizes):
    """What dominance fixes leaves an instance whose best packing is no worse."""
    counts = defaultdict(int)
    for s in sizes:
        counts[s] += 1
    x = packing.Instance(dict(counts), 20)
    fixed = packing.reduce_by_dominance(x)
    left = [s for s in range(21) for _ in range(int(x.counts[s]))]
    assert fixed + fewest(left, 20) == fewest(sizes, 20)
    plan, figures = packing.plan_of(dict(counts), 20)
    assert figures["sequences"] >= fewest(sizes, 20)
    used = defaultdict(int)
    for length, _, bins, _, _, each in plan.tolist():
        used[length] += bins * each
    assert used == counts


def test_very_common_lengths_are_numbered_in_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 3)
    texts = [*ODD, *near_copies(5, 20), *(f"common words {k % 7}" for k in range(200)), *["same text here"] * 60]
    rows = packing.pack_documents(documents(spark, texts), packing.default_tokenizer(), 64).collect()
    check(rows, texts, 64)
