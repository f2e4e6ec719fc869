"""Totals per key attached to each row, and shares of those totals
(WIN-1..4).

Three strategies give the same results:

``"salted"`` (default)
    The rows are exchanged once by (keys, salt): a hot group spreads over
    ``salts`` partitions.  Each partition sums its part of a group, the parts
    (one row per key and salt) are summed per key, and the total goes back to
    the rows where they are.  The input is read once -- both sides start from
    the same exchange -- and nothing runs while the plan is built.
``"join"``
    ``groupBy(keys)`` with partial aggregation, the totals written under the
    shared checkpoint folder and joined back: the input is read twice, the
    first time only its keys and value, and within the broadcast bound the rows
    are not exchanged at all.  For inputs that are cheap to read again, such as
    the batch job's written features.
``"window"``
    ``sum().over(Window.partitionBy(keys))``: one task per key group.  For
    groups that are bounded, as those of the yearly rollup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portolan.functions.columns import fixed_sum, guarded_ratio, partial_sum
from portolan.operators.joins import null_safe_join
from portolan.sources.lake import materialize_counted


# Totals above this many keys are not broadcast (hash table of ~100 MB).
TOTALS_BROADCAST_MAX_ROWS = 2_000_000
# Partitions that a group of rows spreads over at most.
SALTS = 16


def _salted_total(df: DataFrame, value: str, keys: list[str], total_as: str, scale: int | None,
                  salts: int) -> DataFrame:
    every = [F.col(f"`{c}`") for c in df.columns]
    # copies of one row spread too, as far as they come from several partitions
    salt = F.pmod(F.xxhash64(*every, F.spark_partition_id()), F.lit(salts))
    # a struct of the keys is never null, and equal to another with the same nulls
    rows = (df.select(*every, F.struct(*[F.col(f"`{k}`") for k in keys]).alias("__key"), salt.alias("__salt"))
            .repartition("__key", "__salt"))
    sum_parts, finish = partial_sum(value, scale)
    # the hash asks for every column, or pruning would give the sums an exchange
    # (and a read of the input) of their own
    parts = (rows.groupBy("__key", "__salt")
             .agg(sum_parts.alias("__part"), F.max(F.xxhash64(*every)).alias("__every"))
             .filter(F.col("__every").isNotNull()))
    totals = parts.select(F.col("__key").alias("__k"), F.col("__salt").alias("__s"),
                          finish(F.sum("__part").over(Window.partitionBy("__key"))).alias(total_as))
    on = (F.col("__key") == F.col("__k")) & (F.col("__salt") == F.col("__s"))
    # the hash side is the parts of one partition: a row per key and salt
    return rows.join(totals.hint("shuffle_hash"), on, "left").drop("__key", "__salt", "__k", "__s")


def attach_total(df: DataFrame, value: str, keys: list[str], total_as: str,
                 strategy: str = "salted", scale: int | None = None,
                 broadcast_max_rows: int | None = TOTALS_BROADCAST_MAX_ROWS, salts: int = SALTS) -> DataFrame:
    """Append ``total_as`` = sum of ``value`` over rows sharing ``keys``.

    ``scale`` selects exact fixed-point summation (see ``fixed_sum``);
    ``None`` sums doubles.

    With ``strategy="join"`` the totals are written (their row count observed
    during the write) and broadcast within ``broadcast_max_rows``; beyond it, or
    with None, the join is a sort-merge join whose skewed partitions AQE splits.
    """
    if strategy == "window":
        return df.withColumn(total_as, fixed_sum(value, scale, over=Window.partitionBy(*keys)))
    if strategy == "salted":
        return _salted_total(df, value, keys, total_as, scale, salts)
    if strategy != "join":
        raise ValueError(f"unknown strategy {strategy!r}")
    totals, rows = materialize_counted(df.groupBy(*keys).agg(fixed_sum(value, scale).alias(total_as)), "totals")
    if broadcast_max_rows is not None and rows <= broadcast_max_rows:
        totals = F.broadcast(totals)
    return null_safe_join(df, totals, keys, "left")


def share_of_total(df: DataFrame, value: str, keys: list[str], total_as: str,
                   share_as: str, strategy: str = "salted", scale: int | None = None,
                   broadcast_max_rows: int | None = TOTALS_BROADCAST_MAX_ROWS, salts: int = SALTS) -> DataFrame:
    """Total per key plus guarded share ``value / total`` (0 when the total
    is not positive, null when the value is null)."""
    out = attach_total(df, value, keys, total_as, strategy, scale, broadcast_max_rows, salts)
    return out.withColumn(share_as, guarded_ratio(value, total_as))
