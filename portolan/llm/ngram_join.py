"""N-gram Jaccard join by parity sketches.

Every document's set of word shingles is hashed into ``k`` blocks; a block's
word of the sketch is the XOR of the hashes of the shingles that fall into it.
A shingle that only one of two sets has changes exactly one block, so sets
whose symmetric difference is at most ``d`` agree in at least ``k - d`` blocks
(pigeonhole).  ``d`` follows from the threshold and the size band, hence every
pair that reaches the threshold meets in a bucket (band, block, word).  A
second, bit-wise parity sketch (one bit flipped per shingle) bounds the
symmetric difference of candidates from below by its Hamming distance; the
pairs that remain are verified on their whole shingle sets.

Work per bucket is bounded: first every member is paired with the bucket's
least and greatest member only; members that are still in different
components afterwards are compared in blocks of bounded size, and only pairs
that pass the size and Hamming bounds leave the comparison.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.llm.linkage import linked_components, other_pairs, shared_members, verified
from portolan.llm.store import Table, cut, if_small
from portolan.llm.words import mix, shingle_sets, text_chunks, words_of

#: Ratio of a size band's bounds; it exceeds 1/similarity, so partners lie in
#: the same or the next band.
BAND = 1.7
#: A block of few shingles says little, an empty one nothing.  A band has this
#: share of blocks beyond the pigeonhole number, and a document leaves out its
#: smallest blocks, as many as its own size allows (`block_keys`).
SPARE = 0.07
_U = np.uint64


@dataclass(frozen=True)
class Threshold:
    """Jaccard similarity of at least ``num / den``."""

    num: int = 9
    den: int = 10

    def __post_init__(self) -> None:
        if not self.num / self.den > 1 / BAND or self.num > self.den:
            raise ValueError("similarity must lie between 0.6 and 1")

    def largest_partner(self, n: int) -> int:
        return n * self.den // self.num

    def smallest_partner(self, n: int) -> int:
        return -(-n * self.num // self.den)

    def difference(self, total: int) -> int:
        """Largest symmetric difference of linked sets of ``total`` elements together."""
        return total * (self.den - self.num) // (self.den + self.num)


class Bands:
    """Size bands and their numbers of blocks, grown on demand."""

    def __init__(self, threshold: Threshold) -> None:
        self.threshold, self.low, self.blocks, self.diff = threshold, [1], [], []

    def upto(self, n: int) -> None:
        while self.low[-1] <= n:
            start = self.low[-1]
            end = max(start + 1, int(start * BAND))
            top = end - 1
            d = self.threshold.difference(top + self.threshold.largest_partner(top))
            self.low.append(end)
            self.diff.append(d)
            # without a possible difference only equal sets are linked: no blocks
            self.blocks.append(0 if d == 0 else d + 1 + (int(SPARE * d) + 1 if d >= 3 else 0))

    def own_diff(self, sizes: np.ndarray, most: np.ndarray | None = None) -> np.ndarray:
        """Largest symmetric difference between a set of each size and one that
        it is linked with (and that has ``most`` elements at most)."""
        t = self.threshold
        partner = sizes * t.den // t.num
        total = sizes + (partner if most is None else np.minimum(partner, most))
        return total * (t.den - t.num) // (t.den + t.num)

    def of(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(own band, 1 if a partner may lie in the band below) of each size."""
        self.upto(int(sizes.max(initial=1)))
        low = np.asarray(self.low)
        band = np.searchsorted(low, sizes, side="right") - 1
        least = -(-sizes * self.threshold.num // self.threshold.den)
        return band, (band > 0) & (least < low[np.maximum(band, 0)])


def _segments(sizes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(sizes, out=out[1:])
    return out


def block_keys(hashes: np.ndarray, doc: np.ndarray, band: np.ndarray, blocks: np.ndarray,
               diff: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, document) of the blocks that the documents put into buckets.

    ``hashes`` are the documents' sorted sets behind each other; band, blocks
    and diff hold one value per document; diff bounds its difference to every
    partner in the band.

    A document has ``blocks - diff - 1`` blocks to spare.  It keeps those of at
    least as many shingles as its first block beyond the spared smallest ones.
    Of two linked sets, the one with the higher such bound still shares a block
    that it keeps, and equal blocks have equal numbers: the other keeps it too.
    """
    base = _segments(blocks)
    total = int(base[-1])
    if not total:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    use = blocks[doc] > 0
    hashes, doc = hashes[use], doc[use]
    # monotone in the hash, so the elements of a block lie together
    block = base[doc] + (((hashes >> _U(32)) * blocks[doc].astype(np.uint64)) >> _U(32)).astype(np.int64)
    count = np.bincount(block, minlength=total)
    folded = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.bitwise_xor.accumulate(mix(hashes), out=folded[1:])
    cut_at = _segments(count)
    word = folded[cut_at[1:]] ^ folded[cut_at[:-1]]
    owner = np.repeat(np.arange(len(blocks)), blocks)
    index = np.arange(total) - base[owner]
    ascending = count[np.lexsort((count, owner))]
    some = blocks > 0
    least = np.zeros(len(blocks), dtype=np.int64)
    least[some] = ascending[(base[:-1] + blocks - diff - 1)[some]]
    keep = count >= least[owner]
    key = mix(word ^ mix((band[owner].astype(np.uint64) << _U(32)) + index.astype(np.uint64) + _U(1)))
    return key[keep], owner[keep]


def parity_sketches(hashes: np.ndarray, doc: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, word offsets): one parity bit flipped per element, in a power of
    two of at least as many bits as the set has elements (64 at least)."""
    width = 1 << np.ceil(np.log2(np.maximum(sizes, 64))).astype(np.int64)
    base = _segments(width)
    at = base[doc] + (mix(hashes ^ _U(0x5851F42D4C957F2D)) & (width[doc] - 1).astype(np.uint64)).astype(np.int64)
    bits = (np.bincount(at, minlength=int(base[-1])) & 1).astype(np.uint8)
    return np.packbits(bits, bitorder="little").view(np.int64), base // 64


SKETCH_SCHEMA = "n long, f1 long, f2 long, keys array<long>, parity array<long>"


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))


def _sketcher(width: int, threshold: Threshold, lower: bool, passed: int):
    """mapInArrow function: ``passed`` leading columns, then the text."""

    def run(batches):
        bands = Bands(threshold)
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column(passed)):
                sets = list(shingle_sets(words_of(data, offsets, lower), width))
                sizes = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
                hashes = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
                doc = np.repeat(np.arange(len(sets)), sizes)
                ends = _segments(sizes)
                sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
                np.cumsum(mix(hashes ^ _U(0x1F83D9ABFB41BD6B)), out=sums[1:])
                xors = np.zeros(len(hashes) + 1, dtype=np.uint64)
                np.bitwise_xor.accumulate(mix(hashes ^ _U(0x5BE0CD19137E2179)), out=xors[1:])
                band, below = bands.of(sizes)
                blocks, starts = np.asarray(bands.blocks), np.asarray(bands.low)
                some = sizes > 0
                own = block_keys(hashes, doc, band, np.where(some, blocks[band], 0), bands.own_diff(sizes))
                less = np.maximum(band - 1, 0)
                low = block_keys(hashes, doc, less, np.where(some & below, blocks[less], 0),
                                 bands.own_diff(sizes, starts[less + 1] - 1))
                key, owner = np.concatenate([own[0], low[0]]), np.concatenate([own[1], low[1]])
                order = np.argsort(owner, kind="stable")
                parity, at = parity_sketches(hashes, doc, sizes)
                piece = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(c) for c in range(passed)] + [
                        pa.array(sizes),
                        pa.array((sums[ends[1:]] - sums[ends[:-1]]).view(np.int64)),
                        pa.array((xors[ends[1:]] ^ xors[ends[:-1]]).view(np.int64)),
                        _lists(key[order], _segments(np.bincount(owner, minlength=len(sets)))),
                        _lists(parity, at)],
                    names=[*batch.schema.names[:passed], "n", "f1", "f2", "keys", "parity"])

    return run


def _verifier(width: int, threshold: Threshold, lower: bool):
    """mapInArrow function over (a, b, text_a, text_b): keeps linked pairs."""

    def run(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for i, j, data, offsets in text_chunks(batch.column(2)):
                left = list(shingle_sets(words_of(data, offsets, lower), width))
                at = i
                for x, y, other, ends in text_chunks(batch.column(3).slice(i, j - i)):
                    for k, right in enumerate(shingle_sets(words_of(other, ends, lower), width)):
                        mine = left[at - i + k]
                        both = len(np.intersect1d(mine, right, assume_unique=True))
                        keep[at + k] = both * threshold.den >= threshold.num * (len(mine) + len(right) - both)
                    at += y - x
            yield batch.select([0, 1]).filter(pa.array(keep))

    return run


def _hamming(a: Column, b: Column) -> Column:
    """Hamming distance of two parity sketches; the wider one is folded."""
    def fold(x: Column, y: Column) -> Column:
        h = F.size(y)
        return F.when(F.size(x) > h, F.zip_with(
            F.slice(x, F.lit(1), h), F.slice(x, h + 1, h), lambda p, q: p.bitwiseXOR(q))).otherwise(x)
    return F.aggregate(F.zip_with(fold(a, b), fold(b, a), lambda p, q: F.bit_count(p.bitwiseXOR(q))),
                       F.lit(0), lambda s, x: s + x)


#: Columns of the nodes that `may_link` needs.
BOUND = ("node", "n", "parity")


def may_link(threshold: Threshold) -> Column:
    """Size and Hamming bounds of sides a and b."""
    na, nb = F.col("a.n"), F.col("b.n")
    return ((F.least(na, nb) * threshold.den >= F.greatest(na, nb) * threshold.num)
            & (_hamming(F.col("a.parity"), F.col("b.parity")) * (threshold.den + threshold.num)
               <= (na + nb) * (threshold.den - threshold.num)))


@dataclass
class Sketched:
    """Written intermediate tables of one join."""

    rows: DataFrame      # _id, n, f1, f2: one row per document
    nodes: DataFrame     # node, f1, f2, n, parity, th, least: one row per distinct set
    members: DataFrame   # key, node of the buckets with two sets or more
    texts: DataFrame     # _th, _text of all documents


def sketch(docs: DataFrame, id_col: str, text_col: str, width: int, threshold: Threshold,
           lower: bool) -> Sketched:
    base = docs.select(F.col(f"`{id_col}`").alias("_id"), F.xxhash64(f"`{text_col}`").alias("_th"),
                       F.col(f"`{text_col}`").cast("string").alias("_text"))
    id_type = base.schema["_id"].dataType.simpleString()
    sketches = Table(docs.sparkSession, "sketches")
    sketched = sketches.write(base.mapInArrow(_sketcher(width, threshold, lower, 2),
                                              f"_id {id_type}, _th long, {SKETCH_SCHEMA}")).read()
    rows = cut(sketched.select("_id", "n", "f1", "f2"), "rows")
    full = sketched.where("n > 0")
    # one row stands for all copies of a set; its keys alone go into buckets.  Its
    # number is fixed by the table that it is written to
    nodes = cut(
        full.groupBy("f1", "f2", "n").agg(F.min(F.struct("_th", "_id")).alias("r"), F.min("_id").alias("least"),
                                          F.first("parity").alias("parity"))
        .select(F.monotonically_increasing_id().alias("node"), "f1", "f2", "n", "parity", F.col("r._th").alias("th"),
                F.col("r._id").alias("rid"), "least"), "nodes")
    stand_in = nodes.select(F.col("rid").alias("_id"), F.col("th").alias("_th"), "f1")
    # a repeated row (same id and text) would enter twice: harmless, keys are counted by distinct set
    keyed = Table(docs.sparkSession, "keys")
    keyed.write(full.select("_id", "_th", "f1", "keys").join(
        stand_in, (full["_id"].eqNullSafe(stand_in["_id"])) & (full["_th"] == stand_in["_th"])
        & (full["f1"] == stand_in["f1"]), "left_semi").select("f1", "keys"))
    sketches.drop()
    buckets = keyed.read()
    pairs = buckets.agg(F.sum(F.size("keys"))).first()[0] or 0
    members = cut(shared_members(buckets, "f1", pairs).join(nodes.select("f1", "node"), "f1").select("key", "node"),
                  "members")
    keyed.drop()
    return Sketched(rows, nodes.drop("rid"), members, base.select("_th", "_text"))


def _checker(s: Sketched, nodes: DataFrame, width: int, threshold: Threshold, lower: bool):
    """Exact check of pairs of nodes on the whole texts of their stand-ins."""

    def texts(ends: DataFrame, n: int) -> DataFrame:
        ends = ends.join(nodes.select("node", "th"), "node")
        need = ends.select(F.col("th").alias("_th")).distinct()
        found = s.texts.join(if_small(need, n), "_th", "left_semi").groupBy("_th").agg(F.min("_text").alias("_text"))
        return ends.join(found, ends["th"] == found["_th"]).select("node", "_text")

    return lambda pairs: verified(pairs, texts, _verifier(width, threshold, lower))


def _start(docs: DataFrame, id_col: str, text_col: str, width: int, threshold: Threshold,
           lower: bool) -> tuple[Sketched, DataFrame]:
    s = sketch(docs, id_col, text_col, width, threshold, lower)
    nodes = cut(s.nodes.join(s.members.select("node").distinct(), "node", "left_semi"), "bucketed-nodes")
    return s, nodes


def similar_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                  threshold: Threshold = Threshold(), lower: bool = True) -> DataFrame:  # noqa: B008
    """All links between different sets, as (least_a, least_b): the smallest
    ids of the documents that have them.  ``classes`` has the membership of
    copies.  Null ids stand for themselves; empty texts have no links."""
    s, nodes = _start(docs, id_col, text_col, width, threshold, lower)
    check = _checker(s, nodes, width, threshold, lower)
    links = check(other_pairs(s.members, nodes.select(*BOUND), None, may_link(threshold)))
    ids = nodes.select("node", "least")
    return (links.join(ids.select(F.col("node").alias("a"), F.col("least").alias("least_a")), "a")
            .join(ids.select(F.col("node").alias("b"), F.col("least").alias("least_b")), "b")
            .select("least_a", "least_b"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
            threshold: Threshold = Threshold(), lower: bool = True) -> DataFrame:  # noqa: B008
    """One row per document: (id, n_shingles, component_id).

    component_id is the smallest id that links reach from the document, itself
    included.  Null and word-less texts have the empty set, size 0, and are
    linked with nothing.  Copies of a row keep one result row each; a null id
    never is the smallest, so its component_id is null only if no document
    with an id is linked.  Other columns are not read.
    """
    s, nodes = _start(docs, id_col, text_col, width, threshold, lower)
    check = _checker(s, nodes, width, threshold, lower)
    roots = linked_components(s.members, nodes.select(*BOUND), may_link(threshold), check)
    linked = roots.join(nodes.select("node", "least"), "node")
    smallest = linked.groupBy("root").agg(F.min("least").alias("small"))
    linked = linked.join(smallest, "root").select("node", "small")
    whole = s.nodes.select("node", "f1", "f2", "n", "least").join(linked, "node", "left").select(
        "f1", "f2", "n", F.coalesce("small", "least").alias("component_id"))
    return (s.rows.join(whole, ["f1", "f2", "n"], "left")
            .select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("n") == 0, F.col("_id")).otherwise(F.col("component_id")).alias("component_id")))
