import random

from pyspark.sql import functions as F

from gristmill.llm import chat

SCHEMA = "pair_id long, side string, turn long, role string, text string"


def brute(turns):
    sides = {}
    for pair, side, turn, role, text in turns:
        if side in ("chosen", "rejected"):
            sides.setdefault(pair, {}).setdefault(side, []).append((turn is None, turn or 0, role or "", text or ""))
    out = {}
    for pair, both in sides.items():
        if len(both) < 2:
            continue
        c, r = ([t[2:] for t in sorted(both[s])] for s in ("chosen", "rejected"))
        n = 0
        while n < min(len(c), len(r)) and c[n] == r[n]:
            n += 1
        show = lambda ts: "".join(f"<|im_start|>{a}\n{b}<|im_end|>\n" for a, b in ts)

        def spans(ts):
            at, found = 0, []
            for a, b in ts:
                head, body = len(a) + 13, len(b) + 11
                if a == "assistant":
                    found.append((at + head, body))
                at += head + body
            return found

        out[pair] = (n, show(c[:n]), show(c[n:]), show(r[n:]), spans(c[n:]), spans(r[n:]))
    return out


def test_against_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for pair in range(120):
        common = rng.randint(0, 4)
        for side in rng.choice([("chosen", "rejected")] * 9 + [("chosen",)]):
            for k in range(common + rng.randint(0, 3)):
                own = "" if k < common else side + str(rng.randint(0, 1))
                rows.append((pair, side, rng.choice([k] * 20 + [None]), rng.choice(["user", "assistant"]) if own else ["user", "assistant"][k % 2], rng.choice([f"t{k}{own}", f"t{k}{own}", None]) if own else f"t{k}é"))
    rows += [(500, "chosen", 1, "user", "x"), (500, "chosen", 1, "user", "x"), (500, "rejected", 1, "user", "x"), (501, "other", 1, "user", "x"), (502, "chosen", 1, "assistant", ""), (502, "rejected", 1, "assistant", None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("common", F.lit("clash"))
    got = {r["pair_id"]: (r["common"], r["prompt"], r["chosen"], r["rejected"], [tuple(s) for s in r["chosen_mask"]], [tuple(s) for s in r["rejected_mask"]]) for r in chat.preferences(df).collect()}
    assert got == brute(rows)
    for n, _, c, r, a, b in got.values():
        assert all(c[s : s + x].endswith("<|im_end|>\n") for s, x in a) and all(len(r[s : s + x]) == x for s, x in b) and n >= 0


def test_empty_and_native(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert chat.preferences(df).count() == 0
    plan = chat.preferences(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_pairs_of_conversations(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (2, 0, "user", "q2"), (2, 1, "assistant", "b"), (3, 0, "system", None), (None, 0, "user", "lost")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["pair_id"]: r for r in chat.formatted(chat.paired(df)).collect()}
    assert got[1]["common"] == 1 and "b<|im_end|>" in got[1]["rejected"] and "a<|im_end|>" in got[1]["chosen"]
    assert set(got) == {1, 2, 3}


def test_dropped_rows_are_those_stated(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 1, "user", "z"), (1, None, "user", "n"), (None, 0, "user", "x"), (2, 0, "assistant", "c"), (2, None, "assistant", "late"), (5, None, "user", None)]
    got = {r["pair_id"]: ([t["text"] for t in r["chosen"]], [t["text"] for t in r["rejected"]]) for r in chat.paired(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got == {1: (["a", "b", "z", "n"], ["a", "c"]), 2: (["c", "late"], [""]), 5: ([""], [""])}
    assert "null conv_id" in chat.paired.__doc__ and "without a number" in chat.paired.__doc__


def test_turns_are_shuffled_once(spark):
    df = spark.createDataFrame([(1, 0, "user", "q")], "conv_id long, turn long, role string, text string")
    plan = chat.formatted(chat.paired(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3  # the turns of either use of a conversation, and its reply
