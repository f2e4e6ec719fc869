"""Driver tables -> domain tables.

The test driver ships TPC-H-like tables; the domain operators expect trade
records, daily FX rates, long-form indicators and two small dimensions.
These functions derive them with plain joins / projections so that every
registered query reads the driver tables and its work grows with them.

Mapping (identical to the oracle CTEs in ``portolan.plans.oracle``):

* ``trade_raw``   lineitem x orders x customer x part, one row per line
* ``iso_dim``     nation (key <> 0): numeric code, alpha-2, alpha-3
* ``currency_dim`` iso_dim: alpha-3 -> currency code (null for some)
* ``fx_raw``      orders: priority digit as currency, order date, rate
* ``wdi_raw``     orders x customer x nation by nation and order year

Scale notes: the only large joins are lineitem x orders (on the order key)
and x part (on the part key).  orders is first reduced to
``(o_orderkey, c_nationkey)`` by its own join with customer, so lineitem is
joined to a two-column table; Catalyst prunes every unused column into the
scans.  Those two small sides are broadcast only while their files are small;
past the bound (any large scale factor) the planner's sort-merge joins take
over and AQE splits skewed partitions.  Without the explicit choice the
planner's size estimate for ``orders x customer`` (product of the inputs)
makes it broadcast *lineitem* instead at small scale factors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.operators.joins import bounded_broadcast
from portolan.sources.tables import Tables

# Fixed values of the adapter (shared with the oracle SQL).
ANNUAL_ORDER_MOD = 50       # orders whose key is divisible -> annual period
NULL_PARTNER_NATION = 24    # this nation's partner code becomes null
NULL_QTY_PART_MOD = 11      # parts divisible -> null quantity
ZERO_WEIGHT_PART_MOD = 13   # parts divisible -> zero weight
WORLD_NATION = 23           # plays the world aggregate (alpha-3 W00)
ISO2_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXY"
RATE_DIVISOR = 100000.0
SERVICES_EXCLUDED_MOD = (5, 1)  # nations with key % 5 == 1 lack the indicator


def trade_raw(t: Tables, lineitem: DataFrame | None = None) -> DataFrame:
    """``lineitem`` may be a streaming DataFrame (stream-static joins)."""
    li = (lineitem if lineitem is not None else t.lineitem).select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate")
    orders = t.orders.select("o_orderkey", "o_custkey")
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    order_nation = (orders.join(customers, "o_custkey")
                    .select(F.col("o_orderkey").alias("l_orderkey"), "c_nationkey"))
    # customer keys are unique: the joined side has no more rows than orders
    order_nation = bounded_broadcast(order_nation)
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand",
                         "p_type", "p_size")
    rows = (li.join(order_nation, "l_orderkey")
            .join(bounded_broadcast(part), "l_partkey"))
    yr, mo = F.year("l_shipdate"), F.month("l_shipdate")
    return rows.select(
        F.when(F.col("l_orderkey") % ANNUAL_ORDER_MOD == 0, yr)
        .otherwise(yr * 100 + mo).cast("string").alias("data_period"),
        F.col("p_brand").alias("hs_code"),
        F.concat(F.col("p_type"), F.lit("; "), F.col("p_brand")).alias("commodity_desc"),
        F.nullif(F.col("c_nationkey"), F.lit(NULL_PARTNER_NATION)).cast("string")
        .alias("partner_code"),
        F.when(F.col("l_partkey") % NULL_QTY_PART_MOD == 0, F.lit(None).cast("double"))
        .otherwise(F.col("l_quantity")).alias("quantity"),
        F.when(F.col("l_partkey") % ZERO_WEIGHT_PART_MOD == 0, F.lit(0.0))
        .otherwise(F.col("l_quantity") * F.col("p_size")).alias("weight"),
        F.col("l_extendedprice").alias("primary_value_usd"),
    )


def _iso2(key) -> F.Column:
    return F.concat(F.substring(F.lit(ISO2_LETTERS), key + 1, 1), F.lit("X"))


def iso_dim(t: Tables) -> DataFrame:
    k = F.col("n_nationkey")
    return t.nation.filter(k != 0).select(
        k.alias("iso_numeric"),
        _iso2(k).alias("iso2"),
        F.when(k == WORLD_NATION, F.lit("W00"))
        .otherwise(F.concat(F.lit("N"), F.lpad(k.cast("string"), 2, "0"))).alias("iso3"),
    )


def currency_dim(t: Tables) -> DataFrame:
    return iso_dim(t).select(
        F.col("iso3").alias("country_iso3"),
        F.nullif((F.col("iso_numeric") % 6).cast("string"), F.lit("0")).alias("currency"),
    )


def fx_raw(t: Tables) -> DataFrame:
    return t.orders.select(
        F.substring("o_orderpriority", 1, 1).alias("currency"),
        F.substring(F.col("o_orderdate").cast("string"), 1, 10).alias("date"),
        (F.col("o_totalprice") / F.lit(RATE_DIVISOR)).alias("rate"),
    )


def wdi_raw(t: Tables) -> DataFrame:
    """Long-form indicators, one aggregation pass then an unpivot."""
    o = t.orders.select("o_custkey", "o_totalprice", "o_orderdate")
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    n = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    base = o.join(c, "o_custkey").join(n, "c_nationkey")
    agg = base.groupBy("c_nationkey", "n_name", F.year("o_orderdate").alias("yr")).agg(
        F.count_distinct("o_custkey").alias("pop"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("gdp"),
        F.count(F.lit(1)).alias("cnt"),
    )
    mod, excluded = SERVICES_EXCLUDED_MOD
    wide = agg.select(
        _iso2(F.col("c_nationkey")).alias("country_id"),
        F.col("n_name").alias("country_name"),
        F.col("yr").cast("string").alias("year"),
        F.col("pop").cast("string").alias("Population, total"),
        F.col("gdp").cast("string").alias("GDP (current US$)"),
        F.when(F.col("c_nationkey") % mod != excluded, (F.col("cnt") % 60).cast("string"))
        .alias("Services, value added (% of GDP)"),
    )
    return (wide.unpivot(["country_id", "country_name", "year"],
                         ["Population, total", "GDP (current US$)",
                          "Services, value added (% of GDP)"],
                         "indicator_name", "value")
            .filter(F.col("value").isNotNull()))
