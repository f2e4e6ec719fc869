"""portolan: lazy, parameterised PySpark operators for trade, FX and
macro-indicator marts.

Every operator is a function ``f(df, ...params) -> DataFrame`` built only
from DataFrame / SQL built-ins, so Catalyst sees the whole plan (pushdown,
pruning, partial aggregation, broadcast selection) and nothing runs until
an action or a write.  Sub-packages:

``functions``  column expressions (missing test, guarded ratio, period
               parsing, exact fixed-point sums, cell text)
``operators``  DataFrame -> DataFrame operators (quality, features,
               shares, rollups, FX statistics, indicators, views, series,
               serving rows, size-checked lookup joins)
``sources``    readers, the driver-table adapter, dimensions, lake layout
``plans``      compositions: marts, the registered query catalog, oracle SQL
``streaming``  Structured Streaming jobs (landing, weekly / monthly rate
               tables, enriched trade stream, idempotent upsert sink)
"""

from portolan.session import checkpoint_root, get_session

__all__ = ["checkpoint_root", "get_session"]
