"""Parameters of the registered queries (shared by the Spark catalog and
the oracle SQL)."""

# Year range of the registered marts: the driver data spans 1995-2001.
QUERY_YEARS = (1996, 2000)
# Partner / currency pair charted by the FX series.
SERIES_PARTNER, SERIES_CURRENCY = "N07", "1"
# Year of the partner map, its arg-max and axis ticks.
SERIES_YEAR = 1998
# Countries of the multi-country yearly series.
SERIES_COUNTRIES = ("NATION_1", "NATION_7", "NATION_13", "NATION_19")
# Entity of the slice audit.
AUDIT_ENTITY = "NATION_5"
# Number of rows of the top-k report and of the serving peek.
TOP_K, PEEK_K = 10, 5
# Indicators that the queries on unlisted names take as listed.
LISTED_INDICATORS = ("Population, total", "GDP (current US$)")
