"""First arrival per key, new-versus-stored rows, lookback and per-source caps."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_arrival(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key: the first by ``order``, ties settled by the row's hash.

    The ``= 1`` filter on the row number lets Spark keep one row per key in
    every map task before the shuffle, so a key with a third of all rows sends
    one row per task instead of all of them.
    """
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    ranked = Window.partitionBy(*keys).orderBy(*order, tie)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def new_rows(batch: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``batch`` whose key is not stored yet.

    Written in two steps so that the large side is only ever probed: the
    stored keys are cut down to those in the batch (a small batch is broadcast
    by its measured size), and the batch then drops that short list.
    """
    wanted = batch.select(*keys)
    present = stored.select(*keys).join(wanted, keys, "left_semi").distinct()
    return batch.join(present, keys, "left_anti")


def numbered(df: DataFrame, name: str = "_row") -> DataFrame:
    """Rows with a number each; it stays the same once they are written."""
    return df.withColumn(name, F.monotonically_increasing_id())


def picked(df: DataFrame, chosen: DataFrame, within: list[str], keep: bool = True, name: str = "_row") -> DataFrame:
    """The rows of ``df`` whose number is in ``chosen`` (``keep=False``: is not), numbers counted within ``within``.

    Only ``chosen`` is shuffled, not the rows. It is told to all tasks as one bit per row, an eighth of a byte.
    """
    at = F.bitmap_bit_position(F.col(name))
    bits = chosen.withColumn("_bucket", F.bitmap_bucket_number(F.col(name))).groupBy(*within, "_bucket")
    bits = bits.agg(F.bitmap_construct_agg(at).alias("_bits"))
    byte = F.expr(f"substring(_bits, CAST(bitmap_bit_position({name}) DIV 8 AS INT) + 1, 1)")
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(at, F.lit(8)).cast("int"))
    joined = df.withColumn("_bucket", F.bitmap_bucket_number(F.col(name))).join(F.broadcast(bits), [*within, "_bucket"], "inner" if keep else "left")
    return joined.filter(bit == 1 if keep else F.coalesce(bit, F.lit(0)) == 0).select(*df.columns)


def lookback(
    df: DataFrame, ts: str, as_of: datetime | str, days: int, keep_unknown: bool = False
) -> DataFrame:
    """Rows created in the ``days`` before ``as_of``; ``keep_unknown`` keeps rows without a time."""
    cutoff = F.lit(as_of).cast("timestamp") - F.make_dt_interval(days=F.lit(days))
    recent = F.col(ts) >= cutoff
    return df.filter(recent | F.col(ts).isNull() if keep_unknown else recent)


def cap_per_group(df: DataFrame, group: str, n: int, order: list[Column]) -> DataFrame:
    """The first ``n`` rows of each group. The filter is pushed below the shuffle as a group limit."""
    ranked = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") <= n).drop("_rank")
