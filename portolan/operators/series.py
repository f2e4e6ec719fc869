"""Chart-ready series (SER-1..4, AGG-9..12, AGG-14, PRJ-14..18).

Every series is one lazy plan returned as a DataFrame -- no per-entity job
loops and no Python-side densification.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.functions.columns import fixed_sum, log_scale, month_label, text_head
from portolan.operators.filters import exclude, members

# Axis points that one row of the dense grid's plan holds at a time, about.
AXIS_SLICE = 1000


def partner_fx_series(monthly_mart: DataFrame, partner: str, currency: str) -> DataFrame:
    """SER-1: one partner's rows in one currency, month label, value and
    the month's mean rate, ordered by time (one point per source row)."""
    return (monthly_mart
            .filter((F.col("partnerISO") == partner) & (F.col("currency") == currency))
            .select(month_label("year", "month").alias("month_label"), "year", "month",
                    "commodity_desc", F.col("primary_value_usd").cast("double").alias("value"),
                    "avg_rate")
            .orderBy("year", "month", "commodity_desc"))


def partner_fx_monthly(monthly_mart: DataFrame, partner: str, currency: str) -> DataFrame:
    """SER-1, summed variant: one point per month."""
    return (monthly_mart
            .filter((F.col("partnerISO") == partner) & (F.col("currency") == currency))
            .groupBy("year", "month").agg(fixed_sum("primary_value_usd").alias("value"),
                                          F.max("avg_rate").alias("avg_rate"))
            .withColumn("month_label", month_label("year", "month"))
            .orderBy("year", "month"))


def country_year_series(yearly_mart: DataFrame, countries: list[str],
                        country_col: str = "country_name") -> DataFrame:
    """SER-2 / FLT-2: GDP per capita and traded value for several countries
    in one plan (membership filter, one ordering)."""
    return (members(yearly_mart, country_col, list(countries))
            .select(country_col, F.col("year").cast("double").alias("year"),
                    F.col("gdp_per_capita").cast("double").alias("gdp_per_capita"),
                    F.col("annual_value_usd").cast("double").alias("import_value"),
                    "commodity_desc")
            .orderBy(country_col, "year", "commodity_desc"))


def commodity_month_values(monthly_mart: DataFrame, world: str = "W00") -> DataFrame:
    """AGG-9 / PRJ-13 / PRJ-14: value per (short commodity, first-of-month
    date), world aggregate excluded."""
    return (exclude(monthly_mart, "partnerISO", world)
            .withColumns({"date": F.make_date("year", "month", F.lit(1)),
                          "commodity": text_head("commodity_desc")})
            .groupBy("commodity", "date").agg(fixed_sum("primary_value_usd").alias("value")))


def month_totals(monthly_mart: DataFrame, world: str = "W00") -> DataFrame:
    """AGG-10: total value per first-of-month date, world excluded."""
    return (exclude(monthly_mart, "partnerISO", world)
            .withColumn("date", F.make_date("year", "month", F.lit(1)))
            .groupBy("date").agg(fixed_sum("primary_value_usd").alias("total_value"))
            .orderBy("date"))


def axis_points(df: DataFrame, axis: str) -> DataFrame:
    """AGG-14: the distinct axis values (nulls excluded), ordered."""
    return df.select(axis).filter(F.col(axis).isNotNull()).distinct().orderBy(axis)


def dense_grid(values: DataFrame, series: str, axis: str, value: str, fill: float = 0.0,
               slice_points: int = AXIS_SLICE) -> DataFrame:
    """SER-3: every series x every axis point that occurs, absent and null cells
    = ``fill``; a cell that occurs more than once holds the sum.

    The axis stays a table: its points are dealt to slices of about
    ``slice_points``; each series meets each slice in one row, with the cells
    it has there as a map, and is expanded to points last.  The joins carry a
    row per series and slice instead of one per cell, and no list grows with
    the axis.  All parts start from one exchange of the summed cells, so the
    input is read once and nothing runs while the plan is built.
    """
    cells = (values.filter(F.col(axis).isNotNull()).groupBy(F.col(series).alias("__s"), F.col(axis).alias("__a"))
             .agg(F.sum(F.col(value).cast("double")).alias("__v")))
    # every part asks for all three columns of the cells, or column pruning would
    # give each part an exchange, and a read of the input, of its own
    whole = F.max(F.struct("__v", "__s", "__a")).alias("__whole")
    points = cells.groupBy("__a").agg(whole).filter(F.col("__whole").isNotNull())
    slices = points.agg(F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(float(slice_points))), F.lit(1))
                        .cast("int").alias("n")).scalar()
    by_slice = (points.select("__a", F.pmod(F.xxhash64("__a"), slices).cast("int").alias("__slice"))
                .groupBy("__slice").agg(F.collect_list("__a").alias("__points")))
    # one task holds at most a slice of a series
    held = (cells.select("__s", F.pmod(F.xxhash64("__a"), slices).cast("int").alias("__slice"),
                         F.struct("__a", "__v").alias("__cell"))
            .groupBy("__s", "__slice").agg(F.map_from_entries(F.collect_list("__cell")).alias("__map")))
    rows = (cells.groupBy("__s").agg(whole).filter(F.col("__whole").isNotNull())
            .select("__s", F.explode(F.sequence(F.lit(0), slices - 1)).alias("__slice")))
    has = held.select(F.col("__s").alias("__h"), F.col("__slice").alias("__hs"), "__map")
    grid = (rows.join(by_slice, "__slice")
            .join(has, F.col("__s").eqNullSafe(F.col("__h")) & (F.col("__slice") == F.col("__hs")), "left"))
    own = F.transform("__points", lambda p: F.struct(
        p.alias(axis), F.coalesce(F.try_element_at(F.col("__map"), p), F.lit(float(fill))).alias(value)))
    return grid.select(F.col("__s").alias(series), F.inline(own))


def partner_totals(monthly_mart: DataFrame, year: int, world: str = "W00") -> DataFrame:
    """SER-4 / AGG-11 / PRJ-16: total per partner for one year, world
    excluded, with ``log10(total + 1)``."""
    return (monthly_mart.filter(F.col("year") == year)
            .groupBy("partnerISO").agg(fixed_sum("primary_value_usd").alias("export"))
            .transform(lambda t: exclude(t, "partnerISO", world))
            .withColumn("log_export", log_scale("export")))


def top_partner(totals: DataFrame) -> DataFrame:
    """AGG-12: arg-max partner and its value; ties go to the greatest
    partner code (deterministic)."""
    best = F.max(F.struct(F.col("export"), F.col("partnerISO")))
    return totals.agg(best.alias("__b")).select(
        F.col("__b.partnerISO").alias("top_partner"), F.col("__b.export").alias("top_export"))


def axis_ticks(totals: DataFrame, n: int = 6, col: str = "log_export") -> DataFrame:
    """PRJ-17: ``n`` evenly spaced ticks over [min, max] of the log scale,
    labelled with the back-transformed value ``$int(10^v - 1)``."""
    bounds = totals.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    step = (F.col("hi") - F.col("lo")) / F.lit(float(n - 1))
    ticks = bounds.select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
    v = F.when(F.col("i") == n - 1, F.col("hi")).otherwise(F.col("lo") + F.col("i") * step)
    return ticks.select(
        "i", F.round(v, 9).alias("tick"),
        F.concat(F.lit("$"), F.format_number(
            (F.pow(F.lit(10.0), v) - F.lit(1.0)).cast("long"), 0)).alias("label"))
