"""Preference pairs: shared prompt once, then both completions with their loss masks. DataFrame functions only.

Two tables of turns (pair, turn, role, text) hold the chosen and the rejected conversation of each pair. The prompt is
the longest common prefix: all turns before the first turn number at which the two differ. It is rendered once. What
follows is each side's completion; a segment of it is trained on (mask 1) if its role is ``assistant``. A conversation is
put together in pieces of ``piece`` turns first, so a long one is gathered from few rows.

Repeated equal rows count once. Several turns of one number are put in the order of role and text and are compared as a
whole. A null turn comes last, a null role is rendered as ``user``, a null text as empty. Rows with a null pair belong
to no pair and are left out. A pair with one side only has an empty prompt and an empty other completion; two equal
sides are all prompt. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

LAST = 2**62


def turns(table: DataFrame, pair, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The four columns that the pairs are made of, and the conversation's id."""
    return table.select(
        pair.alias("pair_id"), F.col(conv_col).alias("conv"), F.coalesce(F.col(turn_col).cast("long"), F.lit(LAST)).alias("turn"), F.coalesce(F.col(role_col), F.lit("user")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).where("pair_id is not null")


def rendered(role, text):
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n"))


def preference_pairs(chosen: DataFrame, rejected: DataFrame, piece: int = 64) -> DataFrame:
    """Per pair: ids, ``n_prompt`` turns, ``prompt``, ``chosen``, ``rejected`` and for each completion its mask, ``mask:code points`` of each segment."""
    rows = chosen.withColumn("side", F.lit(0)).unionByName(rejected.withColumn("side", F.lit(1))).dropDuplicates(["pair_id", "side", "conv", "turn", "role", "text"])
    own = lambda side: F.sort_array(F.collect_list(F.when(F.col("side") == side, F.struct("role", "text"))))
    differ = rows.groupBy("pair_id", "turn").agg(own(0).alias("a"), own(1).alias("b")).where("a <> b").groupBy("pair_id").agg(F.min("turn").alias("first"))
    ids = rows.groupBy("pair_id").agg(F.min(F.when(F.col("side") == 0, F.col("conv"))).alias("chosen_id"), F.min(F.when(F.col("side") == 1, F.col("conv"))).alias("rejected_id"))
    placed = rows.join(differ, "pair_id", "left").withColumn("prompt", F.col("first").isNull() | (F.col("turn") < F.col("first"))).where("not (prompt and side = 1)")
    placed = placed.withColumn("kind", F.when(F.col("prompt"), 0).otherwise(F.col("side") + 1)).withColumn("body", rendered(F.col("role"), F.col("text")))
    segment = F.struct("turn", "role", "text", "body", F.concat(F.when(F.col("role") == "assistant", "1:").otherwise("0:"), F.length("body").cast("string")).alias("mask"))
    pieces = placed.groupBy("pair_id", "kind", F.floor(F.col("turn") / piece).alias("piece")).agg(F.sort_array(F.collect_list(segment)).alias("s"))
    pieces = pieces.select("pair_id", "kind", "piece", F.concat_ws("", F.col("s.body")).alias("body"), F.concat_ws(",", F.col("s.mask")).alias("mask"), F.size("s").alias("n"))
    kinds = pieces.groupBy("pair_id", "kind").agg(F.sort_array(F.collect_list(F.struct("piece", "body", "mask"))).alias("p"), F.sum("n").alias("n"))
    kinds = kinds.select("pair_id", "kind", "n", F.concat_ws("", F.col("p.body")).alias("body"), F.concat_ws(",", F.col("p.mask")).alias("mask"))
    of = lambda kind, c: F.coalesce(F.max(F.when(F.col("kind") == kind, F.col(c))), F.lit(0 if c == "n" else ""))
    sides = kinds.groupBy("pair_id").agg(of(0, "n").cast("long").alias("n_prompt"), of(0, "body").alias("prompt"), of(1, "body").alias("chosen"), of(2, "body").alias("rejected"), of(1, "mask").alias("chosen_mask"), of(2, "mask").alias("rejected_mask"))
    return ids.join(sides, "pair_id").select("pair_id", "chosen_id", "rejected_id", "n_prompt", "prompt", "chosen", "rejected", "chosen_mask", "rejected_mask")
