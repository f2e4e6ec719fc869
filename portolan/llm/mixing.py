"""Mixing sources to target weights by systematic sampling.

Each source gets a share of all words; a source's documents are expected
``target / size`` times each.  Within the source the documents stand in order
of size (then by a hash of their id), the expected copies are added up along
that order, one random offset is added, and a document is taken once for every
integer that the sum crosses at it.  So a document is taken the floor or the
ceiling of its expected copies, without bias, and as sizes grow along the order
the words taken differ from the target by the largest document at most.

Sums are whole numbers of 1e-12 copies (decimals, exact), so no result depends
on the partitioning.  Documents are range-partitioned by (source, size, hash):
a hot source spreads over many ranges; a range's prefix is the sum of the
ranges before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portolan.llm.ranking import ranked, sorted_table
from portolan.llm.store import cut, if_small

#: Expected copies are whole multiples of this share of a copy.
UNITS = 1_000_000_000_000
#: Weights of the sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: A source gives at most this many times its own words.
MOST_COPIES = 3
WORD = r"[^\x20\x09-\x0D]+"
_WIDE = "decimal(38,0)"


def hash60(text):
    """The first 60 bits of a text's sha256 as a long."""
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``sizes`` (source, source_size) with ``target``, the words each source gives.

    Sources share all words by their weights; one that would give more than
    ``most`` times its size gives that, and the excess is shared again by weight
    until none is above.  One row per source; each round is one aggregation.
    """
    order = [F.asc_nulls_last("source")]
    place = ((F.col("_rank") - 1) % len(weights)).cast("int")
    named = cut(ranked(sizes, order, "mix-sources", "_rank").select(
        "source", "source_size", F.element_at(F.array(*map(F.lit, weights)), place + 1).cast("long").alias("weight"),
        (F.col("source_size") * most).alias("most")), "mix-weights")
    first = named.agg(F.sum("source_size").alias("total"), F.sum("weight").alias("w")).first()
    total, held, left = int(first["total"] or 0), 0, int(first["w"] or 0)

    def above(held: int, left: int):
        """Whether a source's share of the rest is above what it can give."""
        return (F.col("weight").cast(_WIDE) * F.lit(total - held).cast(_WIDE)
                > F.col("most").cast(_WIDE) * F.lit(left).cast(_WIDE))

    while left:
        over = above(held, left)
        row = named.agg(F.sum(F.when(over, F.col("most"))).alias("held"),
                        F.sum(F.when(~over, F.col("weight"))).alias("left")).first()
        before, held, left = (held, left), int(row["held"] or 0), int(row["left"] or 0)
        if before == (held, left):
            break
    share = ((F.col("weight") * F.lit(total - held)).cast("double") / F.lit(float(left))) if left else F.lit(0.0)
    capped = above(held, left) if left else F.lit(True)
    return named.select("source", "source_size",
                        F.when(capped, F.col("most").cast("double")).otherwise(share).alias("target"))


def crossings(table: DataFrame, group: str, expected: str, order: list, seed: int, name: str) -> DataFrame:
    """``table`` with ``copies``: the integers that the running sum of ``expected``
    (long, in `UNITS`) plus the group's random offset crosses at the row.

    The sum runs within ``group`` along ``order``; null is a group.  No task
    holds a group: rows are dealt by ranges of (group, order), the sums of whole
    ranges are one row per range and group.
    """
    ranges = sorted_table(table, [F.asc_nulls_last(group), *order], name)
    sums = ranges.groupBy("_part", group).agg(F.sum(F.col(expected).cast("decimal(20,0)")).alias("_sum"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spread = F.coalesce(F.concat(F.lit("="), F.col(group)), F.lit("null"))
    starts = sums.select(
        F.col("_part").alias("_p"), F.col(group).alias("_g"),
        (F.coalesce(F.sum("_sum").over(earlier), F.lit(0))
         + (hash60(F.concat(F.lit(f"{seed}:"), spread)) % UNITS)).cast(_WIDE).alias("_start"))
    along = Window.partitionBy("_part", group).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    local = ranges.withColumn("_upto", F.sum(F.col(expected).cast("decimal(20,0)")).over(along).cast(_WIDE))
    joined = local.join(starts, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
    units = F.lit(UNITS).cast(_WIDE)
    end = F.col("_start") + F.col("_upto")
    begin = end - F.col(expected).cast(_WIDE)
    joined = joined.select(*table.columns, end.cast(_WIDE).alias("_e"), begin.cast(_WIDE).alias("_b"), units.alias("_u"))
    return joined.withColumn("copies", F.expr("(_e div _u) - (_b div _u)")).drop("_e", "_b", "_u")


def mix(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: int = 42,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: id, source, size, source_size, target, copies, taken.

    Size counts the words of the whole text (null: 0); documents without words
    are taken like others and give nothing.  A null source is a source, last in
    order.  Equal rows may take each other's copies; an empty table gives an
    empty result; other columns are not read.
    """
    words = F.regexp_count(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), F.lit(WORD))
    sized = cut(docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"),
        words.cast("long").alias("size")).withColumn("_row", F.monotonically_increasing_id()), "mix-sizes")
    wanted = cut(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "mix-targets")
    side = if_small(wanted.select(F.col("source").alias("_s"), "source_size", "target"), wanted.count())
    expected = F.when(F.col("source_size") > 0,
                      F.floor(F.col("target") / F.col("source_size") * float(UNITS))).otherwise(0).cast("long")
    known = (sized.join(side, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
             .withColumn("expected", expected)
             .withColumn("_hash", hash60(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))))))
    order = [F.asc("size"), F.asc("_hash"), F.asc_nulls_last("id"), F.asc("_row")]
    return (crossings(known, "source", "expected", order, seed, "mix-order")
            .select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
                    "copies", (F.col("size") * F.col("copies")).alias("taken")))


def mixture(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The mixed corpus: each document as often as it is taken, in its own columns.

    Rows meet by id, so ids must be distinct (null counts as one id)."""
    taken = mixed.filter("copies > 0").select(F.col(f"`{id_col}`").alias("_id"), "copies")
    return (docs.join(taken, F.col(f"`{id_col}`").eqNullSafe(F.col("_id")))
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .drop("_id", "copies", "_copy"))
