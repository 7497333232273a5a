"""Preference formatting of chat pairs, in DataFrame functions only.

A pair has a chosen and a rejected conversation. Their longest common prefix of turns
(equal role and text) is rendered once as the prompt, the rest of each as a completion
whose assistant texts are to be learnt and all else is masked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEARN_ROLE = "assistant"


def render(role: Column, text: Column) -> Column:
    """One turn: <|role|>, a line feed, the text, <|end|>, a line feed."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("<|end|>\n"))


def _side(turns: DataFrame, name: str) -> DataFrame:
    t = turns.select("pair_id", F.struct(F.col("turn").isNull().alias("none"), F.col("turn").cast("bigint").alias("turn"),
                                         F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    ordered = F.array_sort(F.collect_list("t"))
    return t.where("pair_id is not null").groupBy("pair_id").agg(
        F.transform(ordered, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias(name))


def _completion(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda x: render(x["role"], x["text"])), "")


def _spans(turns: Column) -> Column:
    """(start, length) in the completion of each assistant text, in characters."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(acc, x):
        head = F.length(x["role"]) + 5  # <| |> and the line feed
        span = F.array(F.struct((acc["at"] + head).alias("start"), F.length(x["text"]).alias("length")))
        spans = F.when(x["role"] == LEARN_ROLE, F.concat(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct((acc["at"] + head + F.length(x["text"]) + 8).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def preference_format(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """(pair_id, n_prompt_turns, prompt, chosen, rejected, chosen_spans, rejected_spans)
    of the pairs that both frames (pair_id, turn, role, text) have.

    Turns go by ``turn`` (null last), then role and text; a null role or text is empty.
    Repeated turns are turns. Equal conversations leave both completions empty; without
    a common turn the prompt is empty. Rows with a null pair_id, and pairs with only one
    side, give no row. Offsets count characters within a completion."""
    both = _side(chosen, "c").join(_side(rejected, "r"), "pair_id")
    equal = F.zip_with("c", "r", lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(equal, F.lit(False))
    both = both.select("pair_id", "c", "r", F.when(first > 0, first - 1).otherwise(F.size("c")).cast("int").alias("n"))
    rest = {s: F.slice(F.col(s), F.col("n") + 1, F.greatest(F.size(s) - F.col("n"), F.lit(0))) for s in "cr"}
    both = both.select("pair_id", F.col("n").alias("n_prompt_turns"), F.slice("c", F.lit(1), F.col("n")).alias("p"),
                       rest["c"].alias("c"), rest["r"].alias("r"))
    return both.select("pair_id", "n_prompt_turns", _completion(F.col("p")).alias("prompt"), _completion(F.col("c")).alias("chosen"),
                       _completion(F.col("r")).alias("rejected"), _spans(F.col("c")).alias("chosen_spans"), _spans(F.col("r")).alias("rejected_spans"))


def neighbour_pairs(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Preference pairs made from (conv_id, turn, role, text): conversations 2p and 2p + 1
    make pair p. Chosen is the even one; rejected is its first half (by turn number,
    under half of its highest plus one) continued by the odd one's turns from there on."""
    c = conversations.where("conv_id is not null").select(
        F.floor(F.col("conv_id") / 2).cast("bigint").alias("pair_id"), (F.pmod("conv_id", F.lit(2)) == 0).alias("even"), "turn", "role", "text")
    even = c.where("even").drop("even")
    half = even.groupBy("pair_id").agg(F.floor((F.max("turn") + 1) / 2).alias("half"))
    odd = c.where("not even").drop("even").join(half, "pair_id").where("turn >= half").drop("half")
    kept = even.join(half, "pair_id").where("turn < half").drop("half")
    return even, kept.union(odd)
