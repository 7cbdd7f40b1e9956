"""Conversations logged as growing snapshots, collapsed to the longest ones and rendered.

A conversation is the sequence of its (turn, role, text). Every turn has a rolling hash of all turns up to it: the
exclusive or of hashes keyed by the turn's number, in two independent 64-bit lanes. A conversation whose last rolling hash is one
that a longer one has on the way is a snapshot of it; an anti-join leaves the others. Of equal conversations the one with
the least id stays. Only hashes are joined, common prefixes are distinct before, and texts are shuffled once, for rendering.

Hashes roll in blocks of ``BLOCK_TURNS`` turn numbers with the blocks' totals carried over, so a conversation with a third of all turns
spreads over many tasks; it meets in one place only as the one text that it becomes.

Defined cases: rows without a conversation or a turn number belong to no place in a conversation and are left out; a null role or text
counts as an empty one; repeated rows count once; several rows of one turn are all part of it, in order of role and text; an empty
table gives no rows; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

BLOCK_TURNS = 1024

# The marks around a rendered turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _turns(rows: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    return rows.filter("conv_id IS NOT NULL AND turn IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
    )


def rolling(rows: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """(conv_id, turn, a, b): the rolling hash of every turn of (conv_id, turn, role, text)."""
    keyed = _turns(rows).select(
        "conv_id", "turn", F.xxhash64("turn", "role", "text").alias("a"), F.xxhash64("text", F.lit("|"), "role", "turn").alias("b"),
    ).distinct()
    turns = keyed.groupBy("conv_id", "turn").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    turns = turns.withColumn("block", F.floor(F.col("turn") / block_turns))
    within = Window.partitionBy("conv_id", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    rolled = turns.select("conv_id", "turn", "block", *[F.bit_xor(c).over(within).alias(c) for c in "ab"])
    totals = turns.groupBy("conv_id", "block").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("conv_id", "block", *[F.coalesce(F.bit_xor(c).over(before), F.lit(0).cast("long")).alias(f"from_{c}") for c in "ab"])
    joined = rolled.join(carried, ["conv_id", "block"])
    return joined.select("conv_id", "turn", *[F.col(c).bitwiseXOR(F.col(f"from_{c}")).alias(c) for c in "ab"])


def maximal(rows: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """(conv_id, copies): conversations that no other one continues, the least id of equal ones."""
    hashes = rolling(rows, block_turns)
    last = hashes.groupBy("conv_id").agg(F.max(F.struct("turn", "a", "b")).alias("end"))
    wholes = last.groupBy("end").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    wholes = wholes.select("conv_id", "copies", "end.turn", "end.a", "end.b")
    # A turn that another follows ends a proper prefix.
    ends = last.select("conv_id", F.col("end.turn").alias("last"))
    passed = hashes.join(ends, "conv_id").filter("turn < last").select("turn", "a", "b").distinct()
    return wholes.join(passed, ["turn", "a", "b"], "left_anti").select("conv_id", "copies")


def rendered(rows: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """(conv_id, copies, n_turns, text): the maximal conversations as one text each."""
    # Texts and the kept ids meet by conversation, as the grouping needs them: one shuffle of texts.
    turns = _turns(rows).join(maximal(rows, block_turns), "conv_id")
    in_order = F.array_sort(F.collect_set(F.struct("turn", "role", "text")))
    whole = turns.groupBy("conv_id").agg(F.first("copies").alias("copies"), in_order.alias("turns"))
    pieces = F.transform("turns", lambda t: F.concat(F.lit(OPEN), t["role"], F.lit("\n"), t["text"], F.lit(CLOSE), F.lit("\n")))
    return whole.select("conv_id", "copies", F.size("turns").alias("n_turns"), F.array_join(pieces, "").alias("text"))
