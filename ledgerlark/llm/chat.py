"""Preference pairs of conversations: one shared prompt and two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, CLOSE, END = "<|", "|>\n", "\n<|end|>\n"


def conversation_turns(turns: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """One row a conversation: ``conv_id, turns`` (role, text) in the order of turn, role, text.

    A conversation is one training record and so one row. Rows without a conversation id
    belong to none and are left out; a repeated row is a repeated turn; an empty table has no conversation.
    """
    entry = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    whole = turns.filter(F.col(conv_id).isNotNull()).groupBy(F.col(conv_id).alias("conv_id"))
    ordered = whole.agg(F.sort_array(F.collect_list(entry)).alias("t"))
    bare = F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return ordered.select("conv_id", bare.alias("turns"))


def opening(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(CLOSE))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(opening(t), t["text"], F.lit(END))), "")


def trained_spans(turns: Column, trained: str) -> Column:
    """``begin-end`` of the texts of the trained role in the rendered turns, comma-joined."""

    def step(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(opening(turn))
        end = begin + F.length(turn["text"])
        span = F.concat_ws("-", begin.cast("string"), end.cast("string"))
        out = F.when(turn["role"] == trained, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((end + len(END)).alias("at"), out.alias("spans"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))
    return F.aggregate(turns, start, step, lambda s: F.array_join(s["spans"], ","))


def format_preferences(pairs: DataFrame, trained: str = "assistant") -> DataFrame:
    """``pairs`` with ``n_prefix, prompt, chosen_text, rejected_text, chosen_mask, rejected_mask``.

    ``pairs`` has ``chosen`` and ``rejected``, arrays of (role, text). The longest common prefix
    of turns is rendered once as the prompt; what follows in either is its completion, with the
    spans of the trained role's texts, counted in characters from the completion's start: only
    these carry loss. Equal conversations have two empty completions, unrelated ones an empty
    prompt; a null array counts as empty. No row meets another.
    """
    nothing = F.array().cast("array<struct<role:string,text:string>>")
    chosen, rejected = F.coalesce("chosen", nothing), F.coalesce("rejected", nothing)
    differs = F.array_position(F.zip_with(chosen, rejected, lambda a, b: a.eqNullSafe(b)), False)
    shared = F.when(differs > 0, differs - 1).otherwise(F.size(chosen)).cast("int")
    with_prefix = pairs.withColumns({"n_prefix": shared})
    rest = lambda turns: F.slice(turns, F.col("n_prefix") + 1, F.greatest(F.size(turns) - F.col("n_prefix"), F.lit(0)))
    return with_prefix.withColumns({
        "prompt": rendered(F.slice(chosen, F.lit(1), F.col("n_prefix"))),
        "chosen_text": rendered(rest(chosen)),
        "rejected_text": rendered(rest(rejected)),
        "chosen_mask": trained_spans(rest(chosen), trained),
        "rejected_mask": trained_spans(rest(rejected), trained),
    })


def swapped_answers(conversations: DataFrame, trained: str = "assistant") -> DataFrame:
    """Pairs from conversations without preference labels: ``conv_id, other_id, chosen, rejected``.

    Conversations 2k and 2k+1 are partners. Each is chosen once; its rejected form has its last
    trained turn, and what follows it, replaced by the partner's last trained turn. A conversation
    without such a turn, or whose partner has none or is missing, has a null ``other_id`` and nothing
    rejected. An empty table gives no rows.
    """
    at = F.size("turns") - F.array_position(F.reverse(F.transform("turns", lambda t: t["role"])), trained) + 1
    placed = conversations.withColumn("at", at.cast("int"))
    answered = F.col("at") <= F.size("turns")
    # Only the answered look for a partner.
    mine = placed.select("conv_id", F.col("turns").alias("chosen"), "at", F.when(answered, F.col("conv_id")).alias("_own"))
    answer = F.slice("turns", F.col("at"), F.lit(1))
    theirs = placed.filter(answered).select(
        F.col("conv_id").alias("other_id"), F.expr("conv_id ^ 1").alias("_own"), answer.alias("answer")
    )
    swapped = F.concat(F.slice("chosen", F.lit(1), F.col("at") - 1), "answer")
    nothing = F.array().cast(conversations.schema["turns"].dataType)
    rejected = F.when(F.col("other_id").isNull(), nothing).otherwise(swapped)
    return mine.join(theirs, "_own", "left").select("conv_id", "other_id", "chosen", rejected.alias("rejected"))
