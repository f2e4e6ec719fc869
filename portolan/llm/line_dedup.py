"""Fuzzy line deduplication over a corpus.

Every line is a set of character shingles.  Its MinHash signature (one
permutation, a bin per signature place, empty bins filled from the next one)
is cut into bands; lines that share a band meet in a bucket, are verified on
their whole shingle sets, and the links are joined by a distributed
union-find.  Of each component only the first line stays, by document id, then
text, then place in the document.

`BANDS` bands of `ROWS` places find a pair at the threshold with probability
0.995 and a pair of similarity 0.9 practically always.  Equal lines are equal
by their whole text, whatever the bands say.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.llm.linkage import linked_components, shared_members, verified
from portolan.llm.ngram_join import Threshold, may_link, parity_sketches
from portolan.llm.store import cut, if_small, settled
from portolan.llm.words import _POWERS, mix, text_chunks

#: Code points of a shingle; a shorter line is one shingle as a whole.
SHINGLE = 10
#: Lines are linked from this Jaccard similarity on: num / den.
NUM, DEN = 4, 5
BANDS, ROWS = 8, 3
#: Bytes of text, about, whose shingles are handled at a time: what numpy makes of
#: them stays in a core's cache.
PIECE = 1 << 17
#: Columns of a line's bucket keys; null for a line shorter than a shingle.
KEYS = [f"k{b}" for b in range(BANDS)]

_U = np.uint64
_PLACES = BANDS * ROWS
_EMPTY = _U(0xFFFFFFFFFFFFFFFF)


class Lines:
    """The ``\\n``-split lines of a chunk of texts, in code points."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self._data, self._offsets = data, offsets
        self.points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
        behind = np.flatnonzero((data & 0xC0) == 0x80)  # bytes that start no code point
        bounds = offsets - np.searchsorted(behind, offsets)
        breaks = np.flatnonzero(self.points == 10)
        rows = len(offsets) - 1
        self.row = np.sort(np.concatenate([np.arange(rows), np.searchsorted(bounds, breaks, side="right") - 1]))
        self.start = np.sort(np.concatenate([bounds[:-1], breaks + 1]))
        last = np.append(self.row[1:] != self.row[:-1], True) if rows else np.zeros(0, dtype=bool)
        following = np.append(self.start[1:], len(self.points))
        self.end = np.where(last, following, following - 1)
        first = np.searchsorted(self.row, np.arange(rows))
        self.place = np.arange(len(self.row)) - first[self.row] if rows else self.row
        # up to the next line there is only the line and its break, which is white space
        solid = np.append((self.points != 32) & ((self.points - np.uint32(9)) > 4), False)
        self.has_word = (self.end > self.start) & (np.logical_or.reduceat(solid, self.start) if rows else False)
        self.codes = np.zeros(len(self.points) + SHINGLE, dtype=np.uint64)
        np.add(self.points, _U(1), out=self.codes[:len(self.points)])
        self.codes[:len(self.points)] *= _U(0xD6E8FEB86659FD93)

    def hashes(self) -> np.ndarray:
        """Hash of each whole line: 64 bits of a cryptographic one, which no
        structure of the lines can bring to collide."""
        raw = self._data.tobytes()
        lines = (line for a, b in zip(self._offsets[:-1].tolist(), self._offsets[1:].tolist(), strict=True)
                 for line in raw[a:b].split(b"\n"))
        digests = b"".join(blake2b(line, digest_size=8).digest() for line in lines)
        return np.frombuffer(digests, dtype=np.uint64)

    def shingles(self) -> tuple[np.ndarray, np.ndarray]:
        """(hash, line) of every shingle."""
        size = self.end - self.start
        count = np.where(size >= SHINGLE, size - SHINGLE + 1, (size > 0).astype(np.int64))
        line = np.repeat(np.arange(len(size)), count)
        first = np.cumsum(count) - count
        begins = np.zeros(len(self.points) + 1, dtype=np.int8)  # 1 where shingles begin, as a sum
        begins[self.start[count > 0]] += 1
        begins[(self.start + count)[count > 0]] -= 1
        begins = np.cumsum(begins[:-1], dtype=np.int8).view(bool)
        # windows of 2, 4, 8 and 10 codes, each from two shorter ones; such short
        # sums over powers of the base are safe
        codes, step, n = self.codes, _POWERS.get(SHINGLE)[0], len(self.points)
        two = codes[1:] * step[1]
        two += codes[:-1]
        four = two[2:] * step[2]
        four += two[:-2]
        ten = four[4:4 + n] * step[4]
        ten += four[:n]
        ten += two[8:8 + n] * step[8]
        sums = ten[begins]
        short = np.flatnonzero((size > 0) & (size < SHINGLE))
        whole = np.zeros(len(short), dtype=np.uint64)
        for k in range(SHINGLE - 1):  # a short line is summed to its end only
            use = size[short] > k
            whole[use] += step[k] * codes[self.start[short[use]] + k]
        sums[first[short]] = whole
        return mix(sums), line


def band_keys(hashes: np.ndarray, line: np.ndarray, lines: int) -> np.ndarray:
    """Bucket keys (lines x BANDS) of the one-permutation MinHash signatures."""
    # a row per place, so that the steps below go along them
    signature = np.full((_PLACES, lines), _EMPTY, dtype=np.uint64)
    at = hashes >> _U(32)
    at *= _U(_PLACES)
    at >>= _U(32)
    at *= _U(lines)
    at += line.view(np.uint64)
    np.minimum.at(signature.reshape(-1), at.view(np.int64), hashes)
    empty = signature == _EMPTY
    if empty.any():
        for k in [*range(_PLACES - 2, -1, -1), *range(_PLACES - 1, -1, -1)]:
            after = (k + 1) % _PLACES
            bare = np.flatnonzero(empty[k])
            signature[k, bare] = mix(signature[after, bare] + _U(1))
            empty[k] &= empty[after]  # a bin filled from a filled one counts as filled from now on
    keys = np.empty((lines, BANDS), dtype=np.uint64)
    for band in range(BANDS):
        key = np.full(lines, mix(np.array([band + 1], dtype=np.uint64))[0])
        for row in range(ROWS):
            key = mix(key + signature[band * ROWS + row])
        keys[:, band] = key
    return keys


KEY_SCHEMA = ", ".join(f"{k} long" for k in KEYS)


def _signer(batches):
    """mapInArrow: (id, text hash, text) -> one row per line with a word."""
    for batch in batches:
        for i, j, data, offsets in text_chunks(batch.column(2), PIECE):
            lines = Lines(data, offsets)
            hashes, line = lines.shingles()
            keys = band_keys(hashes, line, len(lines.row))
            use = np.flatnonzero(lines.has_word)
            # a shorter line is linked with equal lines only
            banded = (lines.end - lines.start)[use] >= SHINGLE
            row = pa.array(i + lines.row[use])
            bands = [pa.array(keys[use, b].view(np.int64), mask=~banded) for b in range(BANDS)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), batch.column(1).take(row), pa.array(lines.place[use].astype(np.int32)),
                 pa.array(lines.hashes()[use].view(np.int64)), *bands],
                names=["_id", "_th", "place", "line", *KEYS])


def _shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of single lines, one per row, each line's sorted
    and behind those of the one before, and their number per line."""
    hashes, line = Lines(data, offsets).shingles()
    return _distinct(hashes, line, len(offsets) - 1)


def _distinct(hashes: np.ndarray, line: np.ndarray, lines: int) -> tuple[np.ndarray, np.ndarray]:
    _sort_within(hashes, np.bincount(line, minlength=lines))
    keep = np.ones(len(hashes), dtype=bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (line[1:] != line[:-1])
    return hashes[keep], np.bincount(line[keep], minlength=lines)


def _sort_within(values: np.ndarray, sizes: np.ndarray) -> None:
    """Sorts each of the segments of the given sizes in place."""
    ends = np.cumsum(sizes)
    for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
        values[a:b].sort()


def _common(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Size of the intersection of each two sets of the same place."""
    (x, nx), (y, ny) = left, right
    pair = np.arange(len(nx))
    both = np.empty(len(x) + len(y), dtype=np.uint64)
    both[np.arange(len(x)) + np.repeat(np.cumsum(ny) - ny, nx)] = x
    both[np.arange(len(y)) + np.repeat(np.cumsum(nx), ny)] = y
    owner = np.repeat(pair, nx + ny)
    _sort_within(both, nx + ny)
    twice = (both[1:] == both[:-1]) & (owner[1:] == owner[:-1])
    return np.bincount(owner[1:][twice], minlength=len(nx))


def _profiler(batches):
    """mapInArrow: (node, line) -> (node, n, parity): what bounds a pair's similarity."""
    for batch in batches:
        for i, j, data, offsets in text_chunks(batch.column(1), PIECE):
            hashes, sizes = _shingle_sets(data, offsets)
            parity, at = parity_sketches(hashes, np.repeat(np.arange(len(sizes)), sizes), sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.array(sizes),
                 pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(parity))],
                names=["node", "n", "parity"])


def _verifier(batches):
    for batch in batches:
        keep = np.zeros(batch.num_rows, dtype=bool)
        for i, j, data, offsets in text_chunks(batch.column(2), PIECE):
            for x, y, other, ends in text_chunks(batch.column(3).slice(i, j - i), PIECE):
                left = _shingle_sets(data[offsets[x]:offsets[y]], offsets[x:y + 1] - offsets[x])
                right = _shingle_sets(other, ends)
                both = _common(left, right)
                keep[i + x:i + y] = both * DEN >= NUM * (left[1] + right[1] - both)
        yield batch.select([0, 1]).filter(pa.array(keep))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(lines, drops): all lines with a word as (_id, _th, place, line, k0...),
    and (_id, _th, places, n): the places of those that repeat an earlier one."""
    text = F.col(f"`{text_col}`").cast("string")
    base = docs.select(F.col(f"`{id_col}`").alias("_id"), F.xxhash64(text).alias("_th"), text.alias("_text"))
    id_type = base.schema["_id"].dataType.simpleString()
    lines = cut(base.mapInArrow(_signer, f"_id {id_type}, _th long, place int, line long, {KEY_SCHEMA}"), "lines")
    # plain columns, no structs: Spark sums them up by hashing, without a sort.
    # at_th and at_place are of one row, any that has the line.  A line's keys are
    # the same wherever it stands.
    nodes = cut(lines.groupBy(F.col("line").alias("node")).agg(
        F.min("_id").alias("least"), F.max(F.isnull("_id")).alias("nameless"), F.count(F.lit(1)).alias("c"),
        F.first("_th").alias("at_th"), F.first("place").alias("at_place"),
        *[F.max(k).alias(k) for k in KEYS]), "line-nodes")
    # a line goes into its buckets once, however often it stands somewhere
    buckets = nodes.where(f"{KEYS[0]} is not null").select(F.array(*KEYS).alias("keys"), "node")
    members = cut(shared_members(buckets, "node", nodes.count() * BANDS), "line-members")

    # the bucketed lines' texts, from a document where they stand; lines and
    # documents grow together, so no side is broadcast by a hint
    at = (members.select("node").distinct().join(nodes, "node")
          .groupBy(F.col("at_th").alias("_th")).agg(F.collect_list(F.struct("at_place", "node")).alias("at")))
    # the texts are exchanged once, by hash, and one of equal texts is split, once
    whole = base.select("_th", "_text").groupBy("_th").agg(F.min("_text").alias("_text")).join(at, "_th")
    split = whole.select(F.split("_text", "\n").alias("split"), "at").select("split", F.explode("at").alias("at"))
    named = cut(split.select("at.node", F.get("split", "at.at_place").alias("_text")).where("_text is not null"),
                "line-texts")
    bounded = cut(named.mapInArrow(_profiler, "node long, n long, parity array<long>"), "line-parity")

    def check(pairs: DataFrame) -> DataFrame:
        return verified(pairs, lambda ends, n: named.join(if_small(ends, n), "node", "left_semi"), _verifier)

    roots = linked_components(members, bounded, may_link(Threshold(NUM, DEN)), check, few_keys=True)
    classes = cut(roots.join(nodes, "node").groupBy("root").agg(
        F.min("least").alias("class_least"), F.max("nameless").alias("class_nameless")), "line-classes")
    owners = (nodes.join(roots, "node", "left").join(classes, "root", "left")
              .where("c > 1 or class_nameless is not null")
              .select(F.col("node").alias("line"), F.coalesce("root", "node").alias("root"),
                      F.when(~F.coalesce("class_nameless", "nameless"),
                             F.coalesce("class_least", "least")).alias("least")))
    again = cut(lines.drop(*KEYS).join(owners, "line").select(
        "_id", "_th", "place", "root", F.col("_id").eqNullSafe(F.col("least")).alias("tied")), "line-repeats")
    # the first row of a class: least id, then least text hash, then first place
    firsts = again.where("tied").groupBy("root").agg(F.min(F.struct("_th", "place")).alias("first"))
    drops = (again.join(firsts, "root")
             .where(~F.col("tied") | (F.struct("_th", "place") != F.col("first")))
             .select("_id", "_th", "place").distinct()
             .groupBy("_id", "_th").agg(F.collect_list("place").alias("places"), F.count(F.lit(1)).alias("n")))
    return lines, drops


def _cutter(batches):
    """mapInArrow: (..., places, text) -> (..., text, n_lines, n_kept)."""
    for batch in batches:
        places, texts = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
        out, total, kept = [], [], []
        for k in range(batch.num_rows):
            text = texts[k].as_py()
            gone = set(places[k].as_py() or ())
            lines = [] if text is None else text.split("\n")
            worded = sum(1 for x in lines if x.strip(" \t\n\r\x0b\x0c"))
            if gone:
                text = "\n".join(x for i, x in enumerate(lines) if i not in gone)
            out.append(text)
            total.append(worded)
            kept.append(worded - len(gone))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-2], pa.array(out, type=pa.string()), pa.array(total, type=pa.int64()),
             pa.array(kept, type=pa.int64())],
            names=[*batch.schema.names[:-2], "_text", "n_lines", "n_kept"])


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every line that repeats an earlier one, equal or similar,
    taken out of its text, and the counts ``n_lines`` and ``n_kept`` of lines
    with a word before and after.

    Lines without a word stay where they are; a null text stays null, with
    counts 0.  A document may lose all its lines to earlier ones; its row
    stays.  Rows with equal id and equal text count as one document and keep
    the same lines.  Null ids come first in the order.  Columns of the names
    n_lines and n_kept are replaced.
    """
    # the places to drop are all that the result needs of the tables before it
    drops = settled(lambda: repeated_lines(docs, id_col, text_col)[1], docs.sparkSession, "line-drops")
    text = F.col(f"`{text_col}`").cast("string")
    keep = [c for c in docs.columns if c not in (text_col, "n_lines", "n_kept")]
    base = docs.select(*[F.col(f"`{c}`").alias(f"_c{k}") for k, c in enumerate(keep)],
                       F.col(f"`{id_col}`").alias("_id"), F.xxhash64(text).alias("_th"), text.alias("_text"))
    side = drops.select(F.col("_id").alias("d_id"), F.col("_th").alias("d_th"), "places")
    joined = base.join(side, (base["_th"] == side["d_th"]) & base["_id"].eqNullSafe(side["d_id"]),
                       "left").select(*[f"_c{k}" for k in range(len(keep))], "places", "_text")
    schema = joined.drop("places").withColumn("n_lines", F.lit(0).cast("long")).withColumn(
        "n_kept", F.lit(0).cast("long")).schema
    cut_rows = joined.mapInArrow(_cutter, schema)
    named = {c: F.col(f"_c{k}").alias(c) for k, c in enumerate(keep)} | {text_col: F.col("_text").alias(text_col)}
    return cut_rows.select(*[named[c] for c in docs.columns if c in named], "n_lines", "n_kept")
