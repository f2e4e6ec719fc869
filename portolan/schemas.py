"""Domain schemas (explicit StructTypes, no inference)."""

from pyspark.sql import types as T

S, D, I, L = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


TRADE_RAW = _struct(
    ("data_period", S), ("hs_code", S), ("commodity_desc", S),
    ("partner_code", S), ("quantity", D), ("weight", D),
    ("primary_value_usd", D),
)

FX_RAW = _struct(("currency", S), ("date", S), ("rate", D))

WDI_RAW = _struct(
    ("country_id", S), ("country_name", S), ("year", S),
    ("indicator_name", S), ("value", S),
)

WDI_TYPED = _struct(
    ("country_id", S), ("country_name", S), ("year", I),
    ("indicator_name", S), ("value", D),
)

CURRENCY_DIM = _struct(("country_iso3", S), ("currency", S))

ISO_DIM = _struct(("iso_numeric", I), ("iso2", S), ("iso3", S))

SERVING_CELLS = T.StructType([
    T.StructField("row_key", S, False),
    T.StructField("cells", T.MapType(S, S), False),
])

# Indicator names of the long-form input and their short
# column names in the wide table (must match the source data exactly).
INDICATOR_NAMES = {
    "External debt stocks, total (DOD, current US$)": "external_debt",
    "GDP (current US$)": "gdp",
    "Imports of goods and services (current US$)": "import",
    "Industry (including construction), value added (% of GDP)": "industry_in_gdp",
    "Inflation, consumer prices (annual %)": "inflation",
    "Population, total": "population",
    "Services, value added (% of GDP)": "services_in_gdp",
    "Trade (% of GDP)": "trade_in_gdp",
}

# Pseudo-partner codes folded into UNIDENTIFIED, the label for
# unmapped partners, and the world-aggregate partner code.
PARTNER_ALIASES_UNIDENTIFIED = ("X1", "_X", "E19", "F19")
UNIDENTIFIED = "UNIDENTIFIED"
WORLD = "W00"
