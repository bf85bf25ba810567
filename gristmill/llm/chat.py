"""Preference formatting of chosen and rejected conversations; DataFrame operations only.

The longest common prefix of turns is rendered once, as the prompt; what follows it on either side is rendered as a
completion with a loss mask: the spans of characters (start, length) that assistant turns cover, their end mark included.

The turns of a pair are shuffled once, by its id, and become two arrays of one row, as they end in strings of one row
anyway; all else happens within that row. Nothing is grouped or joined by a turn's text, so a turn that many conversations
share is no hot key.

Defined results: a null role or text counts as an empty one; turns without a number come last; of repeated turns (the
same conversation and number) every one counts, ordered by role and text; if one side is a prefix of the other its completion
is empty; pairs of equal conversations have two empty completions; a conversation without turns has none; other columns
are ignored; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import table

#: The marks of a rendered turn.
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
LEARNED = "assistant"


def _turn() -> Column:
    """A turn as it sorts: those without a number last, then by number, role and text."""
    return F.struct(F.col("turn").isNull().alias("last"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def _said(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def sides(turns: DataFrame) -> DataFrame:
    """pair_id, chosen and rejected (arrays of role and text in order) of the pairs that have both."""
    side = lambda name: _said(F.array_sort(F.collect_list(F.when(F.col("side") == name, _turn())))).alias(name)
    both = turns.where(F.col("side").isin("chosen", "rejected")).groupBy("pair_id").agg(side("chosen"), side("rejected"))
    return both.where((F.size("chosen") > 0) & (F.size("rejected") > 0))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(MIDDLE), t["text"], F.lit(CLOSE))), "")


def mask(turns: Column) -> Column:
    """Spans (start, length) of what is learned in the rendered turns."""
    head = lambda t: F.length(t["role"]) + F.lit(len(OPEN) + len(MIDDLE))
    body = lambda t: F.length(t["text"]) + F.lit(len(CLOSE))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(state: Column, t: Column) -> Column:
        span = F.array(F.struct((state["at"] + head(t)).alias("start"), body(t).alias("length")))
        return F.struct((state["at"] + head(t) + body(t)).alias("at"), F.when(t["role"] == LEARNED, F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(turns, empty, step, lambda state: state["spans"])


def preferences(turns: DataFrame) -> DataFrame:
    """turns: pair_id, side ('chosen' or 'rejected'), turn, role, text. A row per pair that has both sides, as of formatted."""
    return formatted(sides(turns))


def formatted(both: DataFrame) -> DataFrame:
    """both: pair_id, chosen, rejected, as of sides.

    Returns pair_id, common (turns of the prefix), prompt, chosen, rejected, chosen_mask, rejected_mask.
    """
    least = F.least(F.size("chosen"), F.size("rejected"))
    differs = F.filter(F.transform(F.sequence(F.lit(0), least - 1), lambda k: F.when(F.get("chosen", k) != F.get("rejected", k), k)), lambda k: k.isNotNull())
    cut = both.withColumn("common", F.when(least == 0, F.lit(0)).otherwise(F.coalesce(F.get(differs, F.lit(0)), least)))
    rest = lambda c: F.slice(c, F.col("common") + 1, F.greatest(F.size(c) - F.col("common"), F.lit(0)))
    cut = cut.withColumns({"_prompt": F.slice("chosen", F.lit(1), F.col("common")), "_chosen": rest("chosen"), "_rejected": rest("rejected")})
    return cut.select("pair_id", "common", rendered(F.col("_prompt")).alias("prompt"), rendered(F.col("_chosen")).alias("chosen"), rendered(F.col("_rejected")).alias("rejected"), mask(F.col("_chosen")).alias("chosen_mask"), mask(F.col("_rejected")).alias("rejected_mask"))


def paired(conversations: DataFrame) -> DataFrame:
    """Pairs from single conversations, for the query: pair_id, chosen, rejected. Pair p has conversation p as chosen; as
    rejected the same with its last turn taken from conversation p + 1 (its last assistant turn), or an empty assistant
    turn where there is none.

    Dropped, as by the SQL: turns with a null conv_id, which have no next conversation; and from the rejected side turns
    without a number and those that share the last number, which the taken turn replaces. The chosen side keeps both.
    """
    t = conversations.select("conv_id", "turn", "role", "text").where("conv_id is not null")
    whole = t.groupBy("conv_id").agg(F.array_sort(F.collect_list(_turn())).alias("turns"))
    of_role = F.filter("turns", lambda x: x["role"] == LEARNED)
    reply = F.array_max(F.transform(of_role, lambda x: F.struct(x["turn"].alias("turn"), x["text"].alias("text"))))["text"]
    replies = whole.select((F.col("conv_id") - 1).alias("conv_id"), reply.alias("reply"))
    last = F.array_max(F.transform("turns", lambda x: x["turn"]))
    before = F.filter("turns", lambda x: F.coalesce(x["turn"] < last, F.lit(False)))
    taken = F.array(F.struct(F.lit(LEARNED).alias("role"), F.coalesce("reply", F.lit("")).alias("text")))
    return whole.join(replies, "conv_id", "left").select(F.col("conv_id").alias("pair_id"), _said(F.col("turns")).alias("chosen"), F.concat(_said(before), taken).alias("rejected"))


def op8_preference_format(spark, sf_dir: str) -> DataFrame:
    found = formatted(paired(table(spark, sf_dir, "conversations")))
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("+", s["start"].cast("string"), s["length"].cast("string"))), " ")
    return found.select("pair_id", "common", F.md5("prompt").alias("prompt_md5"), F.md5("chosen").alias("chosen_md5"), F.md5("rejected").alias("rejected_md5"), spans("chosen_mask").alias("chosen_mask"), spans("rejected_mask").alias("rejected_mask"))


ORACLE = r"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
l as (select conv_id, max(turn) as last from t group by 1),
r as (select conv_id - 1 as conv_id, arg_max(text, (turn, text)) as reply from t where role = 'assistant' group by 1),
s as (
  select conv_id as pair_id, 0 as side, turn, role, text from t
  union all select t.conv_id, 1, turn, role, text from t join l using (conv_id) where turn < last
  union all select l.conv_id, 1, last, 'assistant', coalesce(reply, '') from l left join r using (conv_id)),
n as (select *, row_number() over (partition by pair_id, side order by turn, role, text) - 1 as k from s),
size as (select pair_id, least(count(*) filter (side = 0), count(*) filter (side = 1)) as least from n group by 1),
d as (select a.pair_id, min(a.k) as k from n a join n b on a.pair_id = b.pair_id and a.k = b.k and a.side = 0 and b.side = 1
      where a.role <> b.role or a.text <> b.text group by 1),
c as (select pair_id, coalesce(d.k, least) as common from size left join d using (pair_id)),
m as (
  select n.*, common, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) as piece, length(role) + 13 as head, length(text) + 11 as body
  from n join c using (pair_id)),
o as (select *, coalesce(sum(head + body) over (partition by pair_id, side, k >= common order by k rows between unbounded preceding and 1 preceding), 0) as before from m)
select pair_id, common,
  md5(coalesce(string_agg(piece, '' order by k) filter (side = 0 and k < common), '')) as prompt_md5,
  md5(coalesce(string_agg(piece, '' order by k) filter (side = 0 and k >= common), '')) as chosen_md5,
  md5(coalesce(string_agg(piece, '' order by k) filter (side = 1 and k >= common), '')) as rejected_md5,
  coalesce(string_agg((before + head)::bigint || '+' || body, ' ' order by k) filter (side = 0 and k >= common and role = 'assistant'), '') as chosen_mask,
  coalesce(string_agg((before + head)::bigint || '+' || body, ' ' order by k) filter (side = 1 and k >= common and role = 'assistant'), '') as rejected_mask
from o group by pair_id, common
"""
