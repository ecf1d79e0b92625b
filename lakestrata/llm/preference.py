"""Preference pairs: shared prompt, and two completions with loss masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.llm.common import running_starts

TRAINED_ROLE = "assistant"


def head_of(role: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"))


def tail_of(text: Column) -> Column:
    return F.concat(F.coalesce(text, F.lit("")), F.lit("<|end|>\n"))


def spans_of(turns: Column) -> Column:
    """`start-end` of the trained parts, in code points of the completion, end exclusive."""
    sizes = F.transform(turns, lambda t: t["head"] + t["tail"])
    placed = F.zip_with(
        turns,
        running_starts(sizes),
        lambda t, at: F.when(t["trained"], F.concat_ws("-", (at + t["head"]).cast("string"), (at + t["head"] + t["tail"]).cast("string"))),
    )
    return F.array_join(placed, ",")  # leaves nulls out


def format_pairs(
    chosen: DataFrame,
    rejected: DataFrame,
    *,
    pair_col: str = "pair_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    trained_role: str = TRAINED_ROLE,
) -> DataFrame:
    """One row per pair: the longest common turn prefix as prompt, the rest as completions.

    Turns are numbered from 0 in the order of `turn_col` on each side and are
    compared by role and text (null equals null).  A turn reads
    `<|role|>\\ntext<|end|>\\n`.  The masks list the spans of a completion that
    carry loss: text and end mark of the trained role's turns.

    Result: pair_id, n_prompt_turns, n_chosen_turns, n_rejected_turns (long),
    prompt, chosen, rejected, chosen_mask, rejected_mask (string).

    Defined cases: null role or text renders as nothing.  A pair with one side
    missing has an empty prompt and an empty other completion; equal sides give
    two empty completions.  Turns with equal numbers are ordered by role and text;
    repeated rows are repeated turns.  Rows without a pair id are left out, an
    empty table gives no rows.  Other columns are not read.
    """

    def side(turns: DataFrame, name: str) -> DataFrame:
        turn = F.struct(
            F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")
        )
        return (
            turns.where(F.col(pair_col).isNotNull())
            .select(F.col(pair_col).alias("pair_id"), turn.alias("t"), F.lit(name == "chosen").alias("is_chosen"))
        )

    both = side(chosen, "chosen").unionByName(side(rejected, "rejected"))

    def sorted_turns(flag: Column) -> Column:
        return F.array_sort(F.collect_list(F.when(flag, F.col("t"))))

    # A pair is one output row, so its turns meet in one row in any case.
    pairs = both.groupBy("pair_id").agg(
        sorted_turns(F.col("is_chosen")).alias("c"), sorted_turns(~F.col("is_chosen")).alias("r")
    )
    shorter = F.least(F.size("c"), F.size("r"))
    same = F.zip_with(
        "c", "r", lambda a, b: a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"])
    )
    first_other = F.array_position(F.slice(same, 1, shorter), F.lit(False))
    prefix = F.when(shorter == 0, 0).when(first_other > 0, first_other - 1).otherwise(shorter).cast("int")
    parts = pairs.withColumn("n", prefix).select(
        "pair_id",
        "n",
        F.slice("c", 1, F.col("n")).alias("p"),
        F.slice("c", F.col("n") + 1, F.greatest(F.size("c") - F.col("n"), F.lit(0))).alias("c"),
        F.slice("r", F.col("n") + 1, F.greatest(F.size("r") - F.col("n"), F.lit(0))).alias("r"),
    )

    def rendered(column: str) -> Column:
        return F.array_join(F.transform(column, lambda t: F.concat(head_of(t["role"]), tail_of(t["text"]))), "")

    def mask(column: str) -> Column:
        sizes = F.transform(
            column,
            lambda t: F.struct(
                F.length(head_of(t["role"])).alias("head"),
                F.length(tail_of(t["text"])).alias("tail"),
                t["role"].eqNullSafe(F.lit(trained_role)).alias("trained"),
            ),
        )
        return spans_of(sizes)

    return parts.select(
        "pair_id",
        F.col("n").cast("bigint").alias("n_prompt_turns"),
        F.size("c").cast("bigint").alias("n_chosen_turns"),
        F.size("r").cast("bigint").alias("n_rejected_turns"),
        rendered("p").alias("prompt"),
        rendered("c").alias("chosen"),
        rendered("r").alias("rejected"),
        mask("c").alias("chosen_mask"),
        mask("r").alias("rejected_mask"),
    )
