"""Macro indicators: long -> wide pivot, renames, ISO mapping, derived
ratios and year-over-year growth (AGG-4, PRJ-2/5/10/11, WIN-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portolan.operators.features import cast_columns
from portolan.operators.joins import lookup
from portolan.schemas import INDICATOR_NAMES

PIVOT_KEYS = ["country_id", "country_name", "year"]


def pivot_indicators(df: DataFrame, names: list[str], keys: list[str] = PIVOT_KEYS,
                     name_col: str = "indicator_name", value_col: str = "value",
                     agg: str = "max") -> DataFrame:
    """Long -> wide.  The value list is always passed, so the schema is
    fixed (a listed but absent indicator is an all-null column) and no
    value-discovery job runs at definition time.  ``max`` equals ``first``
    on unique keys and is order-independent; ``first`` ignores nulls."""
    if agg == "max":
        a = F.max(value_col)
    elif agg == "first":
        a = F.first(value_col, ignorenulls=True)
    else:
        raise ValueError(agg)
    return df.groupBy(*keys).pivot(name_col, list(names)).agg(a)


def pivot_with_rest(df: DataFrame, names: list[str], keys: list[str] = PIVOT_KEYS,
                    name_col: str = "indicator_name", value_col: str = "value",
                    rest_as: str = "other_indicators") -> DataFrame:
    """AGG-4: long -> wide in one pass, nothing lost: a column per listed name,
    as `pivot_indicators`, and ``rest_as``, a map of the names outside the list
    to their values (null: an unnamed value, under the key ``''``; an empty map
    if there are none).

    Values are reduced per key and name first, so a key's map holds its
    distinct names however many rows it has."""
    per_name = (df.groupBy(*keys, F.coalesce(F.col(name_col), F.lit("")).alias("__name"))
                .agg(F.max(value_col).alias("__value")))
    listed = F.col("__name").isin(list(names))
    columns = [F.max(F.when(F.col("__name") == n, F.col("__value"))).alias(n) for n in names]
    rest = F.map_from_entries(F.array_sort(F.collect_list(F.when(~listed, F.struct("__name", "__value")))))
    return per_name.groupBy(*keys).agg(*columns, rest.alias(rest_as))


def unknown_indicators(df: DataFrame, names: list[str], name_col: str = "indicator_name") -> DataFrame:
    """PRJ-10: the indicator names (null included) that are not in the value
    list, with the number of their rows."""
    known = F.coalesce(F.col(name_col).isin(list(names)), F.lit(False))
    return df.filter(~known).groupBy(name_col).agg(F.count(F.lit(1)).alias("n_rows"))


def rename_report(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """PRJ-10: (source_name, target_name, present): which renames of the map
    apply to ``df`` and which are skipped because the column is absent."""
    rows = [F.struct(F.lit(k).alias("source_name"), F.lit(v).alias("target_name"),
                     F.lit(k in df.columns).alias("present")) for k, v in mapping.items()]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> tuple[DataFrame, list[str]]:
    """PRJ-10: rename by map; absent names are skipped and returned."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    skipped = [k for k in mapping if k not in present]
    return df.withColumnsRenamed(present), skipped


def attach_iso3(df: DataFrame, iso_dim: DataFrame, code_col: str = "country_id",
                out_col: str = "countryISO3") -> DataFrame:
    """PRJ-5: alpha-2 -> alpha-3 by broadcast lookup; unknown -> null."""
    return lookup(df, iso_dim, F.col(code_col), "iso2", [F.col("iso3").alias(out_col)])


def per_capita(df: DataFrame, num: str = "gdp", den: str = "population",
               out: str = "gdp_per_capita", digits: int = 2) -> DataFrame:
    """PRJ-11: ``round(num / den, digits)`` (HALF_UP); null when either side
    is null or the denominator is zero."""
    return df.withColumn(out, F.round(F.try_divide(F.col(num), F.col(den)), digits))


def indicators_typed(wdi_raw: DataFrame) -> DataFrame:
    return cast_columns(cast_columns(wdi_raw, ["value"], "double"), ["year"], "int")


def indicators_wide(wdi_raw: DataFrame, iso_dim: DataFrame, mapping: dict[str, str] = INDICATOR_NAMES,
                    rest_as: str | None = None) -> DataFrame:
    """Wide indicators with alpha-3 code and GDP per capita; ``rest_as`` adds the
    map of indicators outside the mapping (without it `unknown_indicators`
    reports them)."""
    typed = indicators_typed(wdi_raw)
    wide = (pivot_indicators(typed, list(mapping)) if rest_as is None
            else pivot_with_rest(typed, list(mapping), rest_as=rest_as))
    wide, _ = rename_columns(wide, mapping)
    wide = attach_iso3(wide, iso_dim)
    return per_capita(wide)


def growth(df: DataFrame, value: str, entity: str = "country_id", order: str = "year",
           prev_as: str | None = None, growth_as: str | None = None,
           strict_year: bool = False, digits: int = 2) -> DataFrame:
    """WIN-5: previous value per entity and growth in percent,
    ``round((x - prev) / prev * 100, digits)``.

    By default ``prev`` is the previous *row* of the entity; with
    ``strict_year`` it is null unless that row is exactly one year earlier.
    Windows are per entity (a country's years), so each task holds one
    bounded series.
    """
    prev_as = prev_as or f"prev_{value}"
    growth_as = growth_as or f"{value}_growth"
    w = Window.partitionBy(entity).orderBy(order)
    prev = F.lag(value).over(w)
    if strict_year:
        prev = F.when(F.lag(order).over(w) == F.col(order) - 1, prev)
    out = df.withColumn(prev_as, prev)
    g = F.try_divide(F.col(value) - F.col(prev_as), F.col(prev_as)) * F.lit(100.0)
    return out.withColumn(growth_as, F.round(g, digits))
