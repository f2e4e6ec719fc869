"""Data-quality operators (DQ-1..11, SRC-7, AGG-13).

Each returns a small report DataFrame (no printing, no driver collection),
computed in as few passes as possible: the missing report and the profile
are single aggregations over the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portolan.functions.columns import fixed_mean, fixed_sum, missing
from portolan.operators.quantiles import exact_quantiles


def missing_report(df: DataFrame, columns: list[str] | None = None,
                   total_as: str = "total_rows") -> DataFrame:
    """DQ-1/2: one row; per column the number of missing values (type-aware
    test), plus the total row count -- one pass."""
    cols = columns or df.columns
    aggs = [F.count(F.when(missing(c, df.schema[c].dataType), F.lit(1))).alias(c)
            for c in cols]
    return df.agg(*aggs, F.count(F.lit(1)).alias(total_as))


def numeric_summary(df: DataFrame, columns: list[str], scale: int | None = None,
                    digits: int | None = None) -> DataFrame:
    """DQ-4: count, mean, sample standard deviation, min, exact 25 / 50 / 75 %
    quantiles and max, one row per column.

    Null and NaN are not values.  Quantiles are values of the column (the least
    one that the share does not exceed); a column without values has count 0
    and nulls.  ``digits`` rounds mean and deviation."""
    def of(c: str):
        v = F.col(f"`{c}`").cast("double")
        return F.when(~F.isnan(v), v)

    def shown(c):
        return c if digits is None else F.round(c, digits)

    rows = [F.struct(F.lit(c).alias("column_name"), F.count(of(c)).alias("n"),
                     shown(fixed_mean(of(c), scale)).alias("mean"), shown(F.stddev_samp(of(c))).alias("stddev"),
                     F.min(of(c)).alias("min"), F.max(of(c)).alias("max")) for c in columns]
    base = df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
    at = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).groupBy("column_name").agg(*[
        F.max(F.when(F.col("probability") == p, F.col("value"))).alias(name)
        for name, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))])
    # one row per column on either side
    return base.join(F.broadcast(at), "column_name", "left").select(
        "column_name", "n", "mean", "stddev", "min", "q25", "q50", "q75", "max")


def numeric_stats(df: DataFrame, columns: list[str], scale: int | None = None) -> DataFrame:
    """DQ-4, exact part: per column the non-null count, exact mean (fixed
    point at ``scale``), min and max -- one aggregation pass, then one row
    per column (``stack``)."""
    aggs = []
    for c in columns:
        aggs += [F.count(c).alias(f"{c}__n"), fixed_mean(c, scale).alias(f"{c}__mean"),
                 F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = ", ".join(f"'{c}', `{c}__n`, `{c}__mean`, `{c}__min`, `{c}__max`" for c in columns)
    return wide.selectExpr(f"stack({len(columns)}, {rows}) as (column_name, n, mean, min, max)")


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """DQ-5: distinct values / tuples, ordered."""
    return df.select(*columns).distinct().orderBy(*columns)


def range_check(df: DataFrame, column: str) -> DataFrame:
    """DQ-6: min, max, non-null and null counts of one column."""
    c = F.col(column)
    return df.agg(F.min(c).alias(f"min_{column}"), F.max(c).alias(f"max_{column}"),
                  F.count(c).alias("non_null"),
                  F.count(F.when(c.isNull(), F.lit(1))).alias("nulls"))


def world_reconciliation(yearly: DataFrame, partner: str = "partnerISO",
                         value: str = "annual_value_usd", world: str = "W00",
                         by: str = "year") -> DataFrame:
    """DQ-9: reported world value vs. the sum over real partners, per year,
    in one aggregation (no self-join)."""
    p, v = F.col(partner), F.col(value)
    return (yearly.groupBy(by).agg(
        fixed_sum(F.when(p == world, v)).alias("world_reported"),
        fixed_sum(F.when(p.isNull() | (p != world), v)).alias("partners_total"),
    ).withColumn("difference", F.col("world_reported") - F.col("partners_total"))
        .orderBy(by))


def entity_audit(df: DataFrame, entity_col: str, entity: str, order_col: str = "year") -> DataFrame:
    """DQ-10: the rows of one entity, ordered, each with the entity's row
    count and range of ``order_col``."""
    part = df.filter(F.col(entity_col) == entity)
    stats = part.groupBy(entity_col).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(order_col).alias(f"min_{order_col}"),
        F.max(order_col).alias(f"max_{order_col}"))
    # grouping a one-entity slice yields at most one row: a proven bound
    return part.join(F.broadcast(stats), entity_col).orderBy(order_col)


#: Texts of a row's values are set apart by this in its hash.
_FIELD = "\x1f"


def row_text(df: DataFrame, decimals: int = 6):
    """A row as one text: its values in column order, doubles as plain decimals,
    null as an empty mark.  Equal rows have equal texts on every run."""
    def text(f):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = c.try_cast(T.DecimalType(38, decimals))
        return F.coalesce(c.cast("string"), F.lit("\\N"))
    return F.concat_ws(_FIELD, *[text(f) for f in df.schema.fields])


def profile(df: DataFrame, table: str, samples: int = 5, first_columns: int = 10) -> DataFrame:
    """SRC-7 / AGG-13: a table's profile in long form, (table_name, section,
    item, value), in one pass over the table.

    Sections: ``rows`` and ``columns`` (counts), ``first_columns``, ``schema``
    (a type per column), ``null_share`` (per column, missing values by its type,
    six digits), ``sample`` (``samples`` rows as text, the least by the row's
    hash: the same on every run and however the table is dealt out).  Tasks keep
    their own least rows and counts; both merge."""
    hashed = F.struct(F.md5(row_text(df).cast("binary")).alias("h"), row_text(df).alias("t"))
    fields = df.schema.fields
    counted = df.agg(
        F.count(F.lit(1)).alias("__n"),
        F.array(*[F.count(F.when(missing(F.col(f"`{f.name}`"), f.dataType), F.lit(1))) for f in fields]).alias("__null"))
    # a sort of which every task keeps its first rows only (TakeOrderedAndProject)
    first = (df.select(hashed.alias("__r")).orderBy("__r").limit(samples)
             .agg(F.array_sort(F.collect_list("__r")).alias("__rows")))
    one = counted.join(F.broadcast(first))  # a row each

    def entry(section: str, item, value):
        return F.struct(F.lit(section).alias("section"), item.alias("item"), value.cast("string").alias("value"))

    names = ",".join(df.columns[:first_columns])
    fixed = [entry("rows", F.lit("all"), F.col("__n")), entry("columns", F.lit("all"), F.lit(len(fields))),
             entry("first_columns", F.lit("all"), F.lit(names))]
    fixed += [entry("schema", F.lit(f.name), F.lit(f.dataType.simpleString())) for f in fields]
    fixed += [entry("null_share", F.lit(f.name), F.round(F.try_divide(F.col("__null")[i], F.col("__n")), 6)
                    .try_cast(T.DecimalType(38, 6))) for i, f in enumerate(fields)]
    drawn = F.transform("__rows", lambda r, i: entry("sample", (i + 1).cast("string"), r["t"]))
    return one.select(F.lit(table).alias("table_name"), F.inline(F.concat(F.array(*fixed), drawn)))
