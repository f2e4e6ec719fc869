"""Exact quantiles of many columns without a sort (DQ-4).

A quantile is the value at a rank.  ``with_order_key`` turns doubles into longs of
the same order, and the value is found digit by digit, sixteen bits a round: a
histogram of the digit over the values that share the digits found so far, its
running sum, and the digit where the sum reaches the rank.  A round is one
aggregation for all columns and all quantiles; it combines in the tasks, and
shuffles at most 65,536 counts per column and quantile, whatever the input.
Everything is one lazy plan that reads the input once a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portolan.functions.columns import from_order_key, with_order_key

DIGIT = 16
ROUNDS = 64 // DIGIT


def column_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, key) of every value that is neither null nor NaN."""
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns]
    values = df.select(F.inline(F.array(*pairs))).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    # a key that cannot be null: a join on it adds no test for null, which the
    # optimizer would push below the key's steps by computing them once more
    return with_order_key(values, "value", "key").select("column_name", F.coalesce("key", F.lit(0)).alias("key"))


def _digit(rank_round: int):
    shifted = F.shiftright("key", 64 - DIGIT * (rank_round + 1))
    return shifted if rank_round == 0 else shifted.bitwiseAND(F.lit((1 << DIGIT) - 1))


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float]) -> DataFrame:
    """(column_name, probability, value): the least value that at least the
    share ``probability`` of the column's values does not exceed.

    Null and NaN are not values; infinities are.  A column without values has
    no row."""
    keys = column_keys(df, columns)
    first = keys.groupBy("column_name", _digit(0).alias("digit")).agg(F.count(F.lit(1)).alias("n"))
    column = Window.partitionBy("column_name")
    sums = (first.withColumn("all", F.sum("n").over(column))
            .withColumn("upto", F.sum("n").over(column.orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("probability", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
            .withColumn("rank", F.greatest(F.ceil(F.col("probability") * F.col("all")), F.lit(1)).cast("long"))
            .withColumn("prefix", F.lit(0).cast("long")))
    upto = (Window.partitionBy("column_name", "probability").orderBy("digit")
            .rowsBetween(Window.unboundedPreceding, 0))
    for r in range(ROUNDS):
        if r:
            # one row per column and quantile: a proven bound
            own = (keys.withColumn("prefix", F.shiftright("key", 64 - DIGIT * r))
                   .join(F.broadcast(found), ["column_name", "prefix"]))
            sums = (own.groupBy("column_name", "probability", "prefix", "rank", _digit(r).alias("digit"))
                    .agg(F.count(F.lit(1)).alias("n")).withColumn("upto", F.sum("n").over(upto)))
        at = sums.filter((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n")))
        prefix = F.shiftleft("prefix", DIGIT) + F.col("digit")
        found = at.select("column_name", "probability", prefix.alias("prefix"),
                          (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"))
    return found.select("column_name", "probability", from_order_key("prefix").alias("value"))
