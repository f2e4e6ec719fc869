"""Sharding by minimax contiguous partition over ordered groups of equal texts.

Rows with equal texts form an atomic group.  Groups stand in a fixed order:
the heavy ones first (by size; fewer than ``HEAVY`` per shard can exist), the
rest by the hash of the text.  The smallest capacity for which a greedy pass
fits all groups into the shards is found by binary search, and the cuts are
made under that capacity, each as near to an even share of what is left as
the capacity allows.

Neither the groups nor their running sums ever meet in one place.  The search
works on the sums of hash ranges: taken as atoms they bound the capacity from
above, taken as divisible from below; ranges that a cut may fall into are
split further, until both bounds agree.  Each round brings a few thousand sums
to the driver, whatever the number of groups.

Built of DataFrame operations only.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate
from operator import add

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portolan.llm.store import cut, if_small

#: A group of at least 1/HEAVY of an even share is placed by name.
HEAVY = 64
#: Bits of the hash that the first ranges share, and by which a range is split.
FIRST_BITS, MORE_BITS = 11, 5
#: Rows that are numbered in one window of a shard.
SLOT_ROWS = 20_000


@dataclass(frozen=True)
class Cell:
    """A hash range (or, without bits, one group): sums over its groups."""

    size: int
    groups: int
    last: int       # greatest hash in it
    prefix: int     # hash >> (64 - bits)
    bits: int


class Line:
    """Cells in order, with running sums."""

    def __init__(self, cells: list[Cell]) -> None:
        self.cells = cells
        self.ends = list(accumulate((c.size for c in cells), initial=0))

    def atomic(self, capacity: int, at: int) -> int:
        """Furthest cell boundary that one shard from position ``at`` reaches."""
        return self.ends[bisect_right(self.ends, at + capacity) - 1]

    def divisible(self, capacity: int, at: int) -> int:
        """The same if ranges of several groups could be cut anywhere."""
        k = bisect_right(self.ends, at + capacity) - 1
        if k == len(self.cells) or self.cells[k].groups == 1:
            return max(self.ends[k], at)
        return at + capacity

    def reach(self, step, capacity: int, shards: int) -> list[int]:
        at, out = 0, []
        for _ in range(shards):
            at = step(capacity, at)
            out.append(at)
        return out

    def smallest(self, step, shards: int, low: int) -> int:
        """Smallest feasible capacity of at least ``low``, by binary search."""
        high = max(low, self.ends[-1])
        while low < high:
            mid = (low + high) // 2
            if self.reach(step, mid, shards)[-1] >= self.ends[-1]:
                high = mid
            else:
                low = mid + 1
        return low


def _sums(groups: DataFrame, bits: int) -> list[Cell]:
    prefix = F.shiftright("h", 64 - bits)
    rows = groups.groupBy(prefix.alias("prefix")).agg(
        F.sum("size").alias("size"), F.count(F.lit(1)).alias("groups"), F.max("h").alias("last")).collect()
    return [Cell(r["size"], r["groups"], r["last"], r["prefix"], bits) for r in sorted(rows, key=lambda r: r["prefix"])]


def _search(groups: DataFrame, heavy: list[Cell], cells: list[Cell], shards: int) -> tuple[Line, int]:
    """(line, smallest capacity): splits ranges until the bounds agree."""
    while True:
        line = Line(heavy + cells)
        largest = max((c.size for c in line.cells if c.groups == 1), default=0)
        low = line.smallest(line.divisible, shards, max(largest, -(-line.ends[-1] // shards)))
        high = line.smallest(line.atomic, shards, low)
        if low == high:
            return line, high
        open_cells: set[int] = set()
        for a, b in zip(line.reach(line.atomic, low, shards), line.reach(line.divisible, high, shards), strict=True):
            first = max(bisect_right(line.ends, a) - 1, 0)
            last = min(bisect_left(line.ends, b), len(line.cells) - 1)
            open_cells |= {k for k in range(first, last + 1) if line.cells[k].groups > 1 and line.cells[k].bits < 64}
        if not open_cells:
            return line, high
        # ranges of one width at a time, so that a round is one aggregation
        bits = min(line.cells[k].bits for k in open_cells)
        chosen = {line.cells[k].prefix for k in open_cells if line.cells[k].bits == bits}
        finer = _sums(groups.where(F.shiftright("h", 64 - bits).isin(sorted(chosen))), min(bits + MORE_BITS, 64))
        cells = sorted([c for c in cells if c.bits != bits or c.prefix not in chosen] + finer, key=lambda c: c.last)


def _even_cuts(line: Line, capacity: int, shards: int) -> list[int]:
    """Index of the first cell of each shard but the first: no shard exceeds
    the capacity, and each takes about an even share of what is left."""
    total, ends = line.ends[-1], line.ends
    least = [total]  # least[k]: from here on, k shards are enough
    for _ in range(shards - 1):
        least.append(ends[bisect_left(ends, max(least[-1] - capacity, 0))])
    at, out = 0, []
    for left in range(shards, 1, -1):
        target = at + (total - at) / left
        k = bisect_left(ends, target)
        if k > 0 and target - ends[k - 1] < ends[min(k, len(ends) - 1)] - target:
            k -= 1
        low = bisect_left(ends, max(least[left - 1], at))
        k = max(min(k, bisect_right(ends, at + capacity) - 1), low)
        out.append(k)
        at = ends[k]
    return out


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
          row_bytes: int = 8) -> DataFrame:
    """One row per document: (id, size, text_crc32, law, shard, slot, grown_shard).

    ``size`` is the text's UTF-8 bytes plus ``row_bytes``; a null text counts
    as the empty one and shares its group.  Equal texts go to the same shard.
    The law is ``bytes``: the largest shard is as small as the order of the
    groups allows.  ``slot`` numbers a shard's rows from 0 without gaps, in an
    order fixed by id and text within parts of about SLOT_ROWS different rows.
    Repeated rows are separate rows with slots of their own: they are counted,
    numbered as one with a width, and dealt out again, SLOT_ROWS at a time, so
    no task holds all copies of a row.  Null ids are
    allowed, an empty table gives an empty result; other columns are not read.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = cut(docs.select(F.col(f"`{id_col}`").alias("_id"), (F.octet_length(text) + row_bytes).cast("long").alias("size"),
                           F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h")), "sizes")
    groups = cut(rows.groupBy("h").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")), "groups")
    total, n = groups.agg(F.sum("size"), F.sum("rows")).first()
    total, n = total or 0, n or 0
    bound = max(1, total // (HEAVY * shards))
    # fewer than HEAVY * shards + 1 groups can be that large
    heavy = [Cell(r["size"], 1, r["h"], 0, 64) for r in
             groups.where(F.col("size") > bound).orderBy(F.desc("size"), "h").collect()]
    rest = groups.where(F.col("size") <= bound)
    line, capacity = _search(rest, heavy, _sums(rest, FIRST_BITS), shards)
    starts = _even_cuts(line, capacity, shards)

    named = [[] for _ in range(shards)]
    for k, cell in enumerate(heavy):
        named[bisect_right(starts, k)].append(cell.last)
    # a hash belongs to shard s if it lies above the last hash before s
    lasts = [line.cells[k - 1].last if k > len(heavy) else None for k in starts]
    by_hash = reduce(add, [F.lit(1) if last is None else (F.col("h") > last).cast("int") for last in lasts], F.lit(0))
    place = by_hash
    for s, hashes in enumerate(named):
        if hashes:
            place = F.when(F.col("h").isin(hashes), F.lit(s)).otherwise(place)

    parts = max(1, -(-n // (shards * SLOT_ROWS)))
    # equal rows are one row with a count up to here
    placed = cut(rows.groupBy("_id", "h", "size", "text_crc32").agg(F.count(F.lit(1)).alias("c"))
                 .withColumn("shard", place.cast("int"))
                 .withColumn("part", F.pmod(F.xxhash64("_id", "h"), F.lit(parts)).cast("int")), "placed")
    counts = placed.groupBy("shard", "part").agg(F.sum("c").alias("in_part"))
    offsets = counts.select("shard", "part", (F.sum("in_part").over(
        Window.partitionBy("shard").orderBy("part")) - F.col("in_part")).alias("before"))
    upto = F.sum("c").over(Window.partitionBy("shard", "part").orderBy("_id", "h", "size", "text_crc32")
                           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = (placed.withColumn("first", upto - F.col("c"))
                .join(if_small(offsets, shards * parts), ["shard", "part"])
                .withColumn("first", F.col("before") + F.col("first")))
    few = numbered.where(F.col("c") <= SLOT_ROWS).withColumn("nth", F.explode(F.sequence(F.lit(0), F.col("c") - 1)))
    if n <= SLOT_ROWS:
        out = few
    else:  # the copies of a hot row are dealt out by all tasks; a given number, so that none are merged
        tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        begins = F.sequence(F.lit(0).cast("long"), F.col("c") - 1, F.lit(SLOT_ROWS).cast("long"))
        many = (numbered.where(F.col("c") > SLOT_ROWS).withColumn("begin", F.explode(begins))
                .repartition(tasks, "_id", "h", "begin")
                .withColumn("nth", F.explode(F.sequence("begin", F.least("c", F.col("begin") + SLOT_ROWS) - 1))))
        out = few.unionByName(many.drop("begin"))
    return out.select(F.col("_id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      (F.col("first") + F.col("nth")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
