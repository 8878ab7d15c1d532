"""Operator 6: preference pairs as one prompt and two masked completions, in SQL functions only.

The longest common turn prefix of the chosen and the rejected conversation is rendered once as the prompt; what follows is rendered as the
two completions, with the character spans of the assistant's turns, which alone count for a loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"  # fixed values: the common chat markers


def conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, equal numbers by role and text.

    Null roles and texts are empty; markers inside a turn are broken so that they cannot close it. Rows without an id form one conversation.
    """
    def clean(c: str) -> Column:
        return F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("<|"), F.lit("< |"))

    t = turns.select(F.col(conv_id).alias("conv_id"), F.struct(F.col(turn).alias("turn"), clean(role).alias("role"), clean(text).alias("text")).alias("t"))
    grouped = t.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return grouped.select("conv_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))


def common_prefix(a: Column, b: Column) -> Column:
    """Number of leading turns that are equal."""
    shorter = F.least(F.size(a), F.size(b))
    places = F.sequence(F.lit(0), shorter)
    return F.get(F.filter(places, lambda i: (i == shorter) | ~F.get(a, i).eqNullSafe(F.get(b, i))), F.lit(0))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit("\n"), t["text"], F.lit(CLOSE))), "")


def spans(turns: Column, role: str = "assistant") -> Column:
    """Character spans [start, end) of the role's texts with their closing marker in the rendered turns."""
    empty = F.expr("struct(cast(0 as int) as at, cast(array() as array<struct<start:int,end:int>>) as found)")

    def step(state: Column, t: Column) -> Column:
        start = state["at"] + len(OPEN) + F.char_length(t["role"]) + 1
        end = start + F.char_length(t["text"]) + len(CLOSE)
        one = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(t["role"] == role, F.concat(state["found"], one)).otherwise(state["found"]).alias("found"))

    return F.aggregate(turns, empty, step, lambda s: s["found"])


def preference(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected", role: str = "assistant") -> DataFrame:
    """Adds n_prompt_turns, prompt, and per side the completion and its mask; ``usable`` is false where both sides are the same.

    A null conversation counts as one without turns. All columns are computed inside the row; ties and repeated pairs stay rows of their own.
    """
    none = F.expr("cast(array() as array<struct<role:string,text:string>>)")
    df = pairs.withColumns({chosen: F.coalesce(chosen, none), rejected: F.coalesce(rejected, none)})
    df = df.withColumn("n_prompt_turns", common_prefix(F.col(chosen), F.col(rejected)))
    rest = {s: F.slice(F.col(s), F.col("n_prompt_turns") + 1, F.size(s) + 1) for s in (chosen, rejected)}
    return df.withColumns({
        "prompt": render(F.slice(F.col(chosen), F.lit(1), F.col("n_prompt_turns"))),
        "chosen_completion": render(rest[chosen]), "chosen_mask": spans(rest[chosen], role),
        "rejected_completion": render(rest[rejected]), "rejected_mask": spans(rest[rejected], role),
        "usable": (F.size(rest[chosen]) > 0) | (F.size(rest[rejected]) > 0)})


def stale_answers(convs: DataFrame, role: str = "assistant") -> DataFrame:
    """(conv_id, chosen, rejected): the rejected side ends with the first answer of the conversation in place of the last one.

    A conversation with one answer gets an empty one; without any both sides are the same.
    """
    places = F.filter(F.sequence(F.lit(0), F.size("turns")), lambda i: F.get("turns", i)["role"] == role)
    df = convs.withColumn("_a", places)
    first, last = F.get("_a", F.lit(0)), F.try_element_at("_a", F.lit(-1))
    other = F.when(first < last, F.get("turns", first)["text"]).otherwise("")
    swapped = F.transform("turns", lambda t, i: F.struct(t["role"].alias("role"), F.when(i.eqNullSafe(last), other).otherwise(t["text"]).alias("text")))
    return df.select("conv_id", F.col("turns").alias("chosen"), swapped.alias("rejected"))
