"""Left joins that cannot multiply rows, and broadcasts of a proven size.

Nothing here runs a job while a plan is built.

* Uniqueness of a lookup key is part of the plan (``unique_side``): the right
  side is grouped by the key, and a key that occurs twice raises when the query
  runs, at any size.
* A side is hinted ``broadcast`` only if the files (or constant rows) that it is
  read from hold at most ``BROADCAST_INPUT_BYTES`` together.  That is known from
  the file listing and bounds the side: lookups and aggregates have no more rows
  than their inputs.  Beyond it the join is left to the planner: sort-merge,
  with AQE free to broadcast from measured sizes and to split skewed partitions.
* ``join_accounting`` counts the rows behind every join of a chain in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from portolan.functions.columns import as_col

# Compressed parquet of this size is at most some hundred MB as a hash table.
BROADCAST_INPUT_BYTES = 16 << 20


class FanOutError(ValueError):
    """A join changed the number of rows."""


def input_bytes(df: DataFrame) -> int:
    """Bytes of all files and constant rows that ``df`` is read from (no job).
    Sources of unknown size count as too large for any bound."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def is_small(df: DataFrame, max_bytes: int = BROADCAST_INPUT_BYTES) -> bool:
    return not df.isStreaming and input_bytes(df) <= max_bytes


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_INPUT_BYTES) -> DataFrame:
    """``broadcast(df)`` if its inputs are within the bound, else ``df``."""
    return F.broadcast(df) if is_small(df, max_bytes) else df


def unique_side(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """The rows of ``df`` whose keys are not null, one per key; when the query
    runs, a key with several rows raises with ``name`` and the key.

    The test rides on the key column itself, so no optimization can drop it
    while the side is joined."""
    keys = list(keys)
    values = [c for c in df.columns if c not in keys]
    held = F.any_value(F.struct(*[F.col(f"`{c}`") for c in values] or [F.lit(1).alias("__none")])).alias("__held")
    known = df
    for k in keys:
        known = known.filter(F.col(f"`{k}`").isNotNull())
    grouped = known.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("__n"), held)
    shown = F.concat_ws(", ", *[F.col(f"`{k}`").cast("string") for k in keys])
    first = df.schema[keys[0]].dataType
    error = F.raise_error(F.concat(F.lit(f"{name}: key is not unique: "), shown)).cast(first)
    checked = F.when(F.col("__n") == 1, F.col(f"`{keys[0]}`")).otherwise(error).alias(keys[0])
    return grouped.select(checked, *[F.col(f"`{k}`") for k in keys[1:]],
                          *[F.col("__held").getField(c).alias(c) for c in values])


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys (none null) that several rows share, with their number ``n``:
    what ``unique_side`` would raise for, as a report."""
    known = df
    for k in keys:
        known = known.filter(F.col(k).isNotNull())
    return known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def lookup(df: DataFrame, dim: DataFrame, left_key, right_key: str, take: list, *, how: str = "left",
           max_bytes: int = BROADCAST_INPUT_BYTES, require_unique: bool = True) -> DataFrame:
    """Left-join ``dim`` on ``left_key == dim[right_key]`` and append the
    ``take`` columns.  A repeated key of the dimension raises when the query
    runs (a lookup must not fan out).  A null left key never matches."""
    side = dim.select(F.col(right_key).alias("__lk"), *take)
    small = is_small(side, max_bytes)
    if require_unique:
        side = unique_side(side, ["__lk"], f"lookup by {right_key}")
    if small:
        side = F.broadcast(side)
    return df.join(side, as_col(left_key) == F.col("__lk"), how).drop("__lk")


def null_safe_join(df: DataFrame, other: DataFrame, keys: list[str],
                   how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` with ``<=>`` so null keys pair up (a null group
    key is one group, as in a window partition).  Keys appear once."""
    renamed = other.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                           *[c for c in other.columns if c not in keys])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        cond = c if cond is None else cond & c
    out = df.join(renamed, cond, how)
    return out.drop(*[f"__r_{k}" for k in keys])


def key_collisions(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their multiplicity."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


@dataclass(frozen=True)
class Step:
    """A left join of a chain: the right side's rows meet the left ones where
    ``left`` equals ``right``, pairwise.  ``where`` says which rows the stage
    keeps, for a filter behind the join."""

    stage: str
    other: DataFrame | None = None
    left: Sequence[Column | str] = field(default_factory=tuple)
    right: Sequence[str] = field(default_factory=tuple)
    where: Column | None = None


def join_accounting(rows: DataFrame, first_stage: str, steps: Sequence[Step]) -> DataFrame:
    """DQ-11: (stage, row_count) of ``rows`` and behind every left join, in one
    pass over ``rows`` and without joining any value.

    A right side is reduced to its keys and their multiplicity; a left row is
    worth the product of the multiplicities it met (1 where it met none).  A
    fan-out shows as a stage with more rows than the one before it."""
    out, aggregates = rows.withColumn("__worth", F.lit(1).cast("long")), [
        F.count(F.lit(1)).alias(first_stage)]
    for i, step in enumerate(steps):
        worth = "__worth" if i == 0 else f"__worth{i - 1}"
        times = F.lit(1)
        if step.other is not None:
            names = [f"__k{i}_{j}" for j in range(len(step.right))]
            side = step.other.select(*[F.col(r).alias(n) for r, n in zip(step.right, names, strict=True)])
            small = is_small(side)
            side = side.dropna().groupBy(*names).agg(F.count(F.lit(1)).alias(f"__m{i}"))
            on = [as_col(c) == F.col(n) for c, n in zip(step.left, names, strict=True)]
            cond = on[0]
            for c in on[1:]:
                cond = cond & c
            out = out.join(F.broadcast(side) if small else side, cond, "left").drop(*names)
            times = F.coalesce(F.col(f"__m{i}"), F.lit(1))
        out = out.withColumn(f"__worth{i}", F.col(worth) * times)
        kept = F.col(f"__worth{i}") if step.where is None else F.when(step.where, F.col(f"__worth{i}"))
        aggregates.append(F.coalesce(F.sum(kept), F.lit(0)).alias(step.stage))
    stages = [first_stage, *[s.stage for s in steps]]
    pairs = [F.struct(F.lit(s).alias("stage"), F.col(s).alias("row_count")) for s in stages]
    return out.agg(*aggregates).select(F.inline(F.array(*pairs)))


class RowGuard:
    """Row counts around a join, observed while the one run writes its result:
    ``before`` and ``after`` mark the frames, ``check`` raises `FanOutError` if
    the join changed the number of rows."""

    def __init__(self, name: str) -> None:
        self.name = name
        self._seen = {side: Observation(f"{name}-{side}") for side in ("before", "after")}

    def _mark(self, df: DataFrame, side: str) -> DataFrame:
        return df.observe(self._seen[side], F.count(F.lit(1)).alias("rows"))

    def before(self, df: DataFrame) -> DataFrame:
        return self._mark(df, "before")

    def after(self, df: DataFrame) -> DataFrame:
        return self._mark(df, "after")

    def check(self) -> int:
        before, after = (int(self._seen[side].get["rows"]) for side in ("before", "after"))
        if before != after:
            raise FanOutError(f"{self.name}: {before} rows before the joins, {after} behind them")
        return after
