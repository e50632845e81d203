"""Chat formatting of preference pairs.

A pair is two conversations, chosen and rejected. Their longest common turn prefix is rendered
once as the prompt; what follows on either side is its completion, with a mask of the characters
that count towards the loss: the text and end mark of the assistant's turns. All of it is joins,
aggregates and column functions.

Turns come as rows (pair_id, side, turn, role, text); within a side they are ordered by turn, then
role, then text, nulls first, and equal rows stay side by side. Defined cases: a null role is
rendered as `unknown`, a null text as empty, and null equals null when turns are compared; a
pair whose sides are equal has two empty completions, one of which a side is missing has the
other side as a completion; rows with a null pair_id or a side that is neither are left out; very
long texts are rendered whole; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values of the rendered form.
BEGIN, AFTER_ROLE, END = "<|", "|>\n", "<|end|>\n"
SIDES = ("chosen", "rejected")


def stale_replies(conversations: DataFrame) -> DataFrame:
    """Pairs from plain conversations: the rejected side repeats the reply before its last one.

    Chosen is a conversation as it is up to its last assistant turn. Rejected has the previous
    assistant turn's text in that place instead, so it answers an earlier question; with no
    earlier reply it stops before the last. Conversations without an assistant turn, or with a
    null conv_id, make no pair. Turns are numbered anew in the order of turn, role and text, nulls
    first, so that null and tied turns have a place too, which a stale text does not change.
    """
    ordered = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    read = conversations.where(F.col("conv_id").isNotNull()).select("conv_id", "turn", "role", "text")
    # One pass over the ordered turns: each one's number, the reply before it, and the number of the last reply.
    reply = F.when(F.col("role") == "assistant", F.struct("text"))
    numbered = read.select(
        F.col("conv_id").alias("pair_id"),
        F.row_number().over(ordered).alias("turn"),
        "role",
        "text",
        F.last(reply, ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
        F.col("role").eqNullSafe("assistant").alias("is_reply"),
    )
    whole = Window.partitionBy("pair_id")
    until = numbered.withColumn("last", F.max(F.when(F.col("is_reply"), F.col("turn"))).over(whole)).where("turn <= last")
    is_last = F.col("turn") == F.col("last")
    chosen = F.struct(F.lit("chosen").alias("side"), F.col("text").alias("text"))
    rejected = F.struct(F.lit("rejected").alias("side"), F.when(is_last, F.col("before.text")).otherwise(F.col("text")).alias("text"))
    sides = F.when(is_last & F.col("before").isNull(), F.array(chosen)).otherwise(F.array(chosen, rejected))
    return until.select("pair_id", "turn", "role", F.explode(sides).alias("of")).select("pair_id", "of.side", "turn", "role", "of.text")


def _rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(BEGIN), F.coalesce(role, F.lit("unknown")), F.lit(AFTER_ROLE), F.coalesce(text, F.lit("")), F.lit(END))


def format_pairs(turns: DataFrame) -> DataFrame:
    """One row per pair: pair_id, n_common, prompt, and for either side the completion and its mask.

    A mask is an array of (start, length) in characters of the completion, in order.
    """
    read = turns.where(F.col("pair_id").isNotNull() & F.col("side").isin(*SIDES))
    ordered = Window.partitionBy("pair_id", "side").orderBy("turn", "role", "text")
    placed = read.select("pair_id", "side", F.row_number().over(ordered).alias("place"), "role", "text")
    # The two sides meet turn by turn: two rows at most for each place of a pair.
    turn = F.struct("role", "text")
    by_place = placed.groupBy("pair_id", "place").agg(
        *(F.max(F.when(F.col("side") == side, turn)).alias(side) for side in SIDES)
    )
    one_side = F.col("chosen").isNull() | F.col("rejected").isNull()
    equal = ~one_side & F.col("chosen").eqNullSafe(F.col("rejected"))
    pair = Window.partitionBy("pair_id")
    differs = F.coalesce(F.min(F.when(~equal, F.col("place"))).over(pair), F.max("place").over(pair) + 1) - 1
    marked = by_place.withColumn("n_common", differs)
    in_prompt = F.col("place") <= F.col("n_common")

    def parts(of: Column, wanted: Column) -> Column:
        body = _rendered(of["role"], of["text"])
        trained = F.coalesce(of["role"] == "assistant", F.lit(False))
        lead = F.length(F.lit(BEGIN)) + F.length(F.coalesce(of["role"], F.lit("unknown"))) + F.length(F.lit(AFTER_ROLE))
        part = F.struct(F.col("place").alias("place"), body.alias("body"), trained.alias("trained"), lead.alias("lead"))
        return F.array_sort(F.collect_list(F.when(wanted & of.isNotNull(), part)))

    collected = marked.groupBy("pair_id").agg(
        F.max("n_common").alias("n_common"),
        parts(F.col("chosen"), in_prompt).alias("prompt_parts"),
        *(parts(F.col(side), ~in_prompt).alias(f"{side}_parts") for side in SIDES),
    )

    def text(name: str) -> Column:
        return F.array_join(F.transform(name, lambda p: p["body"]), "")

    def mask(name: str) -> Column:
        none = F.array().cast("array<struct<start:int,length:int>>")
        start = F.struct(F.lit(0).alias("at"), none.alias("spans"))

        def step(acc: Column, p: Column) -> Column:
            size = F.length(p["body"])
            span = F.struct((acc["at"] + p["lead"]).alias("start"), (size - p["lead"]).alias("length"))
            spans = F.when(p["trained"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
            return F.struct((acc["at"] + size).alias("at"), spans.alias("spans"))

        return F.aggregate(name, start, step, lambda acc: acc["spans"])

    return collected.select(
        "pair_id",
        F.col("n_common").cast("long").alias("n_common"),
        text("prompt_parts").alias("prompt"),
        *(c for side in SIDES for c in (text(f"{side}_parts").alias(side), mask(f"{side}_parts").alias(f"{side}_mask"))),
    )
