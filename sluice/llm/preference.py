"""Preference pairs: one prompt and two masked completions.

The prompt is the longest common prefix of turns of the chosen and the rejected conversation and is
rendered once. The turns after it are the completions; only what an assistant says in them is
trained on, which the spans mark. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.scratch import stored

#: Marks of the chat template around each turn.
OPEN, BETWEEN, CLOSE = "<|", "|>\n", "\n<|end|>\n"


def header(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(turn["role"], F.lit("")), F.lit(BETWEEN))


def rendered(turn: Column) -> Column:
    return F.concat(header(turn), F.coalesce(turn["text"], F.lit("")), F.lit(CLOSE))


def conversations(turns: DataFrame, key: str, name: str) -> DataFrame:
    """One row per conversation with its turns in order; ties of ``turn`` by role and text.

    A conversation becomes one row of the result and is gathered as one; copies of a turn
    (same number, role and text) count as often as they occur.
    """
    turn = F.struct(F.col("turn").alias("turn"), F.col("role").alias("role"), F.col("text").alias("text"))
    return turns.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("pair_id")).agg(
        F.sort_array(F.collect_list(turn)).alias(name)
    )


def _same(a: Column, b: Column) -> Column:
    return a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"])


def _spans(turns: Column) -> Column:
    """(start, length) in characters of the assistant's words and their closing mark."""
    spans = F.aggregate(
        turns,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(rendered(t))).alias("at"),
            F.when(
                F.coalesce(t["role"] == "assistant", F.lit(False)),
                F.concat(acc["spans"], F.array(F.struct(
                    (acc["at"] + F.length(header(t))).alias("start"),
                    (F.length(rendered(t)) - F.length(header(t))).alias("length"),
                ))),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
    )
    return spans["spans"]


def paired(pairs: DataFrame) -> DataFrame:
    """``preference_rows`` of rows that hold both conversations as arrays of turns, ``a`` and ``b``."""
    shorter = F.least(F.size("a"), F.size("b"))
    differs = F.filter(
        F.sequence(F.lit(0), shorter), lambda i: (i == shorter) | ~_same(F.get(F.col("a"), i), F.get(F.col("b"), i))
    )
    pairs = pairs.withColumn("prompt_turns", F.array_min(differs))
    rest = lambda side: F.slice(side, F.col("prompt_turns") + 1, F.size(side))
    pairs = pairs.withColumn("rest_a", rest(F.col("a"))).withColumn("rest_b", rest(F.col("b")))
    text = lambda turns: F.array_join(F.transform(turns, rendered), "")
    return pairs.select(
        "pair_id", "prompt_turns",
        text(F.slice("a", 1, F.col("prompt_turns"))).alias("prompt"),
        text(F.col("rest_a")).alias("chosen"), text(F.col("rest_b")).alias("rejected"),
        _spans(F.col("rest_a")).alias("chosen_spans"), _spans(F.col("rest_b")).alias("rejected_spans"),
    )


def preference_rows(chosen: DataFrame, rejected: DataFrame, key: str = "pair_id") -> DataFrame:
    """pair_id, prompt_turns, prompt, chosen, rejected, chosen_spans and rejected_spans.

    Both inputs have ``key``, turn, role and text. A pair that only one side has gives no row, nor
    does a null key. Turns are equal if role and text are (two nulls are equal); a null text
    renders as empty. If one conversation is a prefix of the other, its completion is empty;
    equal ones have two empty completions. Other columns are not read.
    """
    return paired(conversations(chosen, key, "a").join(conversations(rejected, key, "b"), "pair_id"))


def followers(ids: DataFrame) -> DataFrame:
    """pair_id and other, the next id in order, for the distinct ids in ``pair_id``; the last one's is the first.

    The ids are dealt to ranges and numbered inside them; only the smallest id of each range meets
    that of the next one, so the one task over all ranges sees as many rows as there are partitions.
    """
    dealt = stored(ids.repartitionByRange("pair_id").withColumn("range", F.spark_partition_id()), "pair-order")
    starts = dealt.groupBy("range").agg(F.min("pair_id").alias("start"))
    ranges = starts.select(
        "range", F.coalesce(F.lead("start").over(Window.orderBy("start")), F.min("start").over(Window.partitionBy())).alias("start")
    )
    after = F.lead("pair_id").over(Window.partitionBy("range").orderBy("pair_id"))
    return dealt.withColumn("after", after).join(F.broadcast(ranges), "range").select(
        "pair_id", F.coalesce("after", "start").alias("other")
    )


def pairs_by_order(turns: DataFrame) -> DataFrame:
    """``preference_rows`` of plain conversations: one row for each that an assistant takes part in.

    Each is chosen over a talk that leaves it at its middle answer (of n the one numbered n / 2 from 0, rounded down)
    and goes on as the next such conversation does from its own middle answer; the last one's next is the first, so a lone one
    meets itself and has two empty completions. All turns stay on both sides, and the prompt grows over turns that agree.

    ``turns`` has conv_id, turn, role and text; other columns are not read. Rows with a null conv_id have no
    conversation and give nothing. Ids may have gaps. Turns are in the order of turn, role and text, nulls first; a repeated
    row counts as often as it occurs, and two answers of one turn number are two answers. A null role is nobody's,
    null and empty texts render alike but differ as turns. An empty table gives no rows.
    """
    is_answer = F.col("role") == "assistant"
    ids = turns.where(is_answer & F.col("conv_id").isNotNull()).select(F.col("conv_id").alias("pair_id")).distinct()
    order = stored(followers(ids), "pair-followers")
    answers = F.filter(
        F.sequence(F.lit(0), F.size("a") - 1), lambda i: F.coalesce(F.get(F.col("a"), i)["role"] == "assistant", F.lit(False))
    )
    middle = F.element_at(answers, F.floor(F.size(answers) / 2).cast("int") + 1)
    talks = conversations(turns, "conv_id", "a").join(order, "pair_id").withColumn("middle", middle)
    tails = talks.select(
        F.col("pair_id").alias("other"), F.slice("a", F.col("middle") + 1, F.size("a")).alias("tail")
    )
    return paired(talks.join(tails, "other").withColumn("b", F.concat(F.slice("a", 1, F.col("middle")), "tail")))
