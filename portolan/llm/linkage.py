"""Links between members of shared buckets, without pairing whole buckets.

``members`` has a bucket ``key`` and a ``node``; ``nodes`` one row per node with
whatever the bound ``may_link`` needs of sides ``a`` and ``b``.  Every member is
first checked against its bucket's least and greatest member, then, where a node
lies in few buckets, against the members of a small chunk of its bucket.  What these links leave in different
components is compared chunk by chunk, and only pairs that pass the bound leave
the comparison for the exact check.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.llm.graph import components
from portolan.llm.store import cut
from portolan.llm.words import mix

#: Pairs of a key and a node that are looked through at a time, about.
PART = 1 << 18
#: Buckets of up to so many members are done by the pairs with their least and
#: greatest member: these are all their pairs.
STARS = 3
#: Members of a bucket that are compared with each other at a time.
CHUNK = 256
#: Members of the small chunks, and how often a bucket is dealt into such.
NEAR, ROUNDS = 64, 2


def _dealt(parts: int):
    """mapInArrow: (keys, node) -> (part, keys, nodes): the pairs of a key and
    its node, a row for each part of the keys' range."""
    def run(batches):
        held, pairs = [], 0
        for batch in batches:
            lists, node = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
            sizes = np.diff(lists.offsets.to_numpy())
            held.append((lists.flatten().to_numpy(zero_copy_only=False), np.repeat(node, sizes)))
            pairs += int(sizes.sum())
            if pairs >= PART:
                yield packed(held)
                held, pairs = [], 0
        if pairs:
            yield packed(held)

    def packed(held):
        key, node = (np.concatenate(x) for x in zip(*held, strict=True))
        part = ((mix(key.view(np.uint64)) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.min_scalar_type(parts))
        order = np.argsort(part, kind="stable")
        ends = np.append(0, np.cumsum(np.bincount(part, minlength=parts))).astype(np.int32)
        full = np.flatnonzero(np.diff(ends))
        ends = pa.array(np.append(ends[full], ends[-1]))
        return pa.RecordBatch.from_arrays(
            [pa.array(full), *(pa.ListArray.from_arrays(ends, pa.array(x[order])) for x in (key, node))],
            names=["part", "keys", "nodes"])

    return run


class _Sharing:
    """Finds the keys with two different nodes or more among pairs that come
    piece by piece; holds one node per key."""

    def __init__(self) -> None:
        self.key = self.node = np.zeros(0, dtype=np.int64)
        self.out = np.zeros(0, dtype=bool)  # of keys whose held node is given out
        self.more, self.waiting = [], 0

    def add(self, key: np.ndarray, node: np.ndarray) -> pa.RecordBatch | None:
        self.more.append((key, node))
        self.waiting += len(key)
        return self.found() if self.waiting >= max(2 * PART, len(self.key)) else None

    def found(self) -> pa.RecordBatch:
        """(key, node) of the shared keys, as far as not given out before."""
        key, node = (np.concatenate(x) for x in zip((self.key, self.node), *self.more, strict=True))
        order = np.argsort(key, kind="stable")  # the held node of a key comes first
        key, node = key[order], node[order]
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, dtype=np.int64)
        first = node[start]
        other = node != np.repeat(first, np.diff(np.append(start, len(key))))
        shared = np.logical_or.reduceat(other, start) if len(key) else other
        out = np.append(self.out, np.zeros(self.waiting, dtype=bool))[order][start]
        new = shared & ~out
        self.key, self.node, self.out, self.more, self.waiting = key[start], first, out | shared, [], 0
        return pa.RecordBatch.from_arrays(
            [pa.array(np.append(self.key[new], key[other])), pa.array(np.append(first[new], node[other]))],
            names=["key", "node"])


def _shared(batches):
    """mapInArrow: (part, keys, nodes), sorted by part -> (key, node)."""
    at, sharing = None, _Sharing()
    for batch in batches:
        keys, nodes = batch.column(1), batch.column(2)
        for i, part in enumerate(batch.column(0).to_pylist()):
            if part != at:
                yield sharing.found()
                at, sharing = part, _Sharing()
            found = sharing.add(*(x[i].values.to_numpy(zero_copy_only=False) for x in (keys, nodes)))
            if found is not None:
                yield found
    yield sharing.found()


def shared_members(buckets: DataFrame, node: str, pairs: int) -> DataFrame:
    """Distinct (key, node) of the buckets with two different nodes or more.
    ``buckets`` has a node, a long, and its ``keys``, an array of longs, without
    nulls; ``pairs`` is about the number of all keys.

    Nearly all buckets have one node.  So their rows are exchanged once, in
    arrays for each part of the keys' range (of about PART pairs, however many
    there are), and a part is looked through on its own."""
    dealt = buckets.select("keys", node).mapInArrow(
        _dealt(pairs // PART + 1), "part long, keys array<long>, nodes array<long>")
    return (dealt.repartition("part").sortWithinPartitions("part").mapInArrow(_shared, "key long, node long")
            .distinct().withColumnRenamed("node", node))


def _bounded(pairs: DataFrame, nodes: DataFrame, may_link: Column) -> DataFrame:
    """(a, b) of the distinct pairs (x, y) that pass the bound."""
    a, b = nodes.alias("a"), nodes.alias("b")
    return (pairs.distinct().join(a, F.col("x") == F.col("a.node")).join(b, F.col("y") == F.col("b.node"))
            .where(may_link).select(F.col("x").alias("a"), F.col("y").alias("b")))


def star_pairs(members: DataFrame, nodes: DataFrame, may_link: Column) -> DataFrame:
    """(a, b): each member of a bucket with its least and greatest member."""
    ends = members.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
    pairs = (members.join(ends, "key").where("node < hi")  # the greatest one meets the least one from there
             .select("node", F.explode(F.array("lo", "hi")).alias("hub")).where("node <> hub").select(F.least("node", "hub").alias("x"), F.greatest("node", "hub").alias("y")))
    return _bounded(pairs, nodes, may_link)


def _open_members(members: DataFrame, nodes: DataFrame, labels: DataFrame | None, few_keys: bool,
                  over: int) -> tuple[DataFrame, Column]:
    """The members, with their node's columns, their component ``comp`` and
    their bucket's size ``c``, of the buckets with several components and more
    than ``over`` members; and the condition that sides a and b meet here.
    With ``few_keys`` (a node lies in a bounded number of buckets) a pair meets
    in its least common bucket only, not once per common bucket."""
    if labels is not None:
        root = labels.select(F.col("node").alias("l_node"), "root")
        members = members.join(root, members["node"] == root["l_node"], "left").select(
            "key", "node", F.coalesce("root", "node").alias("comp"))
    else:
        members = members.withColumn("comp", F.col("node"))
    sizes = (members.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("comp").alias("lo"),
                                        F.max("comp").alias("hi"))
             .where("lo <> hi").where(F.col("c") > over).select("key", "c"))
    dealt = cut(members.join(sizes, "key").join(nodes, "node"), "dealt")
    if not few_keys:
        return dealt, F.lit(True)
    dealt = cut(dealt.join(dealt.groupBy("node").agg(F.collect_set("key").alias("shared")), "node"), "dealt-keys")
    return dealt, F.array_min(F.array_intersect("a.shared", "b.shared")) == F.col("a.key")


def near_pairs(members: DataFrame, nodes: DataFrame, labels: DataFrame, may_link: Column, few_keys: bool = False,
               over: int = 1, salt: int = 0) -> DataFrame:
    """(a, b) in different components of ``labels`` within small chunks of the
    buckets of more than ``over`` members: all such pairs of a bucket of up to
    NEAR members, and a linear number of those of a larger one, which join most
    of a class together before the rest is compared."""
    dealt, meet = _open_members(members, nodes, labels, few_keys, over)
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("node", F.lit(salt)), F.ceil(F.col("c") / NEAR)))
    return (dealt.alias("a").join(
        dealt.alias("b"), (F.col("a.key") == F.col("b.key")) & (F.col("a.part") == F.col("b.part"))
        & (F.col("a.comp") != F.col("b.comp")) & (F.col("a.node") < F.col("b.node")) & may_link & meet)
        .select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct())


def other_pairs(members: DataFrame, nodes: DataFrame, labels: DataFrame | None, may_link: Column,
                few_keys: bool = False, over: int = 1) -> DataFrame:
    """(a, b) within buckets of more than ``over`` members and in different
    components of ``labels`` (node, root); without labels all pairs.  Members
    are dealt into chunks of about CHUNK, and every two chunks of a bucket meet
    in a join group of their own."""
    dealt, meet = _open_members(members, nodes, labels, few_keys, over)
    dealt = (dealt.withColumn("parts", F.ceil(F.col("c") / CHUNK).cast("int"))
             .withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int")))
    # the comparisons, not the rows, are the work: no merging of small partitions
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = (dealt.withColumn("q", F.explode(F.sequence("part", F.col("parts") - 1))).withColumn("p", F.col("part"))
            .repartition(parts, "key", "p", "q"))
    right = dealt.withColumn("p", F.explode(F.sequence(F.lit(0), "part"))).withColumn("q", F.col("part"))
    same = F.col("a.part") == F.col("b.part")
    return (left.alias("a").join(
        right.alias("b"), (F.col("a.key") == F.col("b.key")) & (F.col("a.p") == F.col("b.p"))
        & (F.col("a.q") == F.col("b.q")) & (F.col("a.comp") != F.col("b.comp"))
        & (~same | (F.col("a.node") < F.col("b.node"))) & may_link & meet)
        .select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")).distinct())


def verified(pairs: DataFrame, texts: Callable[[DataFrame, int], DataFrame], check) -> DataFrame:
    """The pairs (a, b) that ``check``, a mapInArrow function over (a, b, text
    of a, text of b), lets through.  ``texts`` gives (node, _text) for a table
    of distinct nodes and their number."""
    kind = pairs.schema["a"].dataType.simpleString()
    pairs = cut(pairs, "candidates")
    ends = cut(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "ends")
    if not (count := ends.count()):
        return pairs
    named = cut(texts(ends, count), "texts")
    left = named.select(F.col("node").alias("a"), F.col("_text").alias("text_a"))
    right = named.select(F.col("node").alias("b"), F.col("_text").alias("text_b"))
    return cut(pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
               .mapInArrow(check, f"a {kind}, b {kind}"), "links")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, root) with the components of ``links`` (a, b) put
    together: only links between components are followed, not those within."""
    if links.isEmpty():
        return labels
    near, far = labels.toDF("a", "root_a"), labels.toDF("b", "root_b")
    between = links.join(near, "a", "left").join(far, "b", "left").select(
        F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    tops = components(between, "a", "b")
    grown = labels.join(tops.toDF("root", "top"), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    alone = tops.join(labels.select("node"), "node", "left_anti").select("node", "root")
    return cut(grown.unionByName(alone), "roots")


def _larger(members: DataFrame, over: int) -> DataFrame:
    """The members of the buckets of more than ``over``."""
    large = members.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > over).select("key")
    return cut(members.join(large.hint("shuffle_hash"), "key", "left_semi"), "large-members")


def linked_components(members: DataFrame, nodes: DataFrame, may_link: Column,
                      check: Callable[[DataFrame], DataFrame], few_keys: bool = False) -> DataFrame:
    """(node, root) of the nodes that have links; ``few_keys`` as in
    `_open_members`.  Small chunks come first only then: a node of many buckets
    would be dealt and compared in each of them once more."""
    roots = components(check(star_pairs(members, nodes, may_link)), "a", "b")
    members, over = _larger(members, STARS), STARS
    for salt in range(ROUNDS if few_keys else 0):
        roots = _merged(roots, check(near_pairs(members, nodes, roots, may_link, few_keys, over, salt)))
        if over < NEAR:  # smaller buckets are done
            members, over = _larger(members, NEAR), NEAR
    return _merged(roots, check(other_pairs(members, nodes, roots, may_link, few_keys, over)))
