"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a linked list of byte ranges.  Every adjacent pair that is in
the vocabulary waits in the bucket of its merge rank; a bitmap of 64-bit words
in three levels marks the buckets in use, so the next rank to merge is three
find-first-set steps away, however long the pre-token is.  Entries whose pair
has changed meanwhile are stale and skipped when they come up.  Encoding a
pre-token of n bytes takes O(n log n) steps at most (the logarithm for order
within a bucket), so a text without a single space is no special case.

Vocabulary files are read on the driver from the path given, and sent to the
executors as a broadcast of bounded size (one vocabulary).
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.llm.store import unused
from portolan.llm.words import text_buffers

#: Distinct pre-tokens that a worker remembers, and those that it lets wait
#: before it encodes them: about 150 bytes each.
REMEMBERED, WAITING = 250_000, 60_000
#: Longer pre-tokens are encoded on their own.
SHORT_BYTES = 64
#: Texts of more characters are split into pre-tokens step by step.
STEPWISE_CHARS, STEP = 1_000_000, 50_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Vocabulary of a rank file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


class RankQueue:
    """Bitmaps over the merge ranks in use; a bucket of positions per rank."""

    def __init__(self, size: int) -> None:
        self.low, self.mid, self.top = [0] * (size // 64 + 1), [0] * (size // 4096 + 1), 0
        self.buckets: dict[int, list] = {}

    def add(self, rank: int, entry) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(entry)
            return
        self.buckets[rank] = [entry]
        self.low[rank >> 6] |= 1 << (rank & 63)
        self.mid[rank >> 12] |= 1 << (rank >> 6 & 63)
        self.top |= 1 << (rank >> 12)

    def pop(self) -> tuple[int, list]:
        """Least rank in use and its bucket: find first set, level by level."""
        a = (self.top & -self.top).bit_length() - 1
        word = self.mid[a]
        b = (a << 6) + (word & -word).bit_length() - 1
        word = self.low[b]
        rank = (b << 6) + (word & -word).bit_length() - 1
        self.low[b] = word & word - 1
        if not self.low[b]:
            self.mid[a] &= self.mid[a] - 1
            if not self.mid[a]:
                self.top &= self.top - 1
        return rank, self.buckets.pop(rank)


class Merger:
    """Encodes pre-tokens of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks, self.size = ranks, max(ranks.values(), default=0) + 1
        self.byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], dtype=np.int32)
        self.two = np.full(65536, -1, dtype=np.int32)
        joins = []
        for token, rank in ranks.items():
            if len(token) == 2:
                self.two[token[0] << 8 | token[1]] = rank
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    joins.append((left * self.size + right, rank))
        joins.sort()
        self.join_keys = np.array([k for k, _ in joins] + [np.iinfo(np.int64).max], dtype=np.int64)
        self.join_ranks = np.array([r for _, r in joins] + [-1], dtype=np.int32)

    def _joined(self, left, right) -> np.ndarray:
        """Rank of the token that two tokens make together, or -1."""
        keys = np.asarray(left, dtype=np.int64) * self.size + right
        at = np.searchsorted(self.join_keys, keys)
        return np.where(self.join_keys[at] == keys, self.join_ranks[at], np.int32(-1))

    def one(self, raw: bytes) -> np.ndarray:
        """Ids of one (long) pre-token: entries are single positions, the
        leftmost of a rank first."""
        n, get, queue = len(raw), self.ranks.get, RankQueue(self.size)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [get(raw[i:i + 2], -1) for i in range(n - 1)] + [-1]
        for i in range(n - 1):
            if pair[i] >= 0:
                queue.add(pair[i], i)
        while queue.top:
            rank, bucket = queue.pop()
            heapify(bucket)
            while bucket:
                i = heappop(bucket)
                if pair[i] != rank:
                    continue  # stale: merged away, or its pair has changed
                j = after[i]
                end = after[i] = after[j]
                pair[j] = pair[i] = -1
                if end < n:
                    before[end] = i
                    pair[i] = get(raw[i:after[end]], -1)
                k = before[i]
                if k >= 0:
                    pair[k] = get(raw[k:end], -1)
                lower = False
                for at in (i, k):
                    if at >= 0 and pair[at] == rank:
                        heappush(bucket, at)
                    elif at >= 0 and pair[at] >= 0:
                        queue.add(pair[at], at)
                        lower |= pair[at] < rank
                if lower and bucket:  # a smaller rank goes first; the rest waits
                    for at in bucket:
                        queue.add(rank, at)
                    break
        out, i = [], 0
        while i < n:
            out.append(self.ranks[raw[i:after[i]]])
            i = after[i]
        return np.array(out, dtype=np.int32)

    def many(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each) of many short pre-tokens at once.

        The linked lists lie behind each other in arrays and share one queue,
        whose entries are arrays of positions: all pre-tokens that wait for the
        same rank take that merge in one step, each at its leftmost position.
        """
        size = np.fromiter(map(len, raws), dtype=np.int64, count=len(raws))
        data = np.frombuffer(b"".join(raws), dtype=np.uint8)
        n = len(data)
        if not n:
            return np.zeros(0, dtype=np.int32), size
        word = np.repeat(np.arange(len(raws), dtype=np.int32), size)
        ends = np.cumsum(size)
        after = np.arange(1, n + 1, dtype=np.int32)
        after[ends[size > 0] - 1] = -1
        before = np.arange(-1, n - 1, dtype=np.int32)
        before[(ends - size)[size > 0]] = -1
        token = self.byte[data]
        pair = np.full(n, -1, dtype=np.int32)
        pair[:-1] = np.where(after[:-1] >= 0, self.two[data[:-1].astype(np.int32) << 8 | data[1:]], -1)
        queue = RankQueue(self.size)

        def push(ranks: np.ndarray, at: np.ndarray) -> None:
            ok = ranks >= 0
            if not ok.all():
                ranks, at = ranks[ok], at[ok]
            if len(at) == 0:
                return
            if len(at) == 1:
                queue.add(int(ranks[0]), at)
                return
            order = np.argsort(ranks, kind="stable")
            ranks, at = ranks[order], at[order]
            cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
            heads = ranks[cuts[:-1]].tolist()
            for rank, a, b in zip(heads, cuts[:-1], cuts[1:], strict=True):
                queue.add(rank, at[a:b])

        push(pair, np.arange(n, dtype=np.int32))
        while queue.top:
            rank, bucket = queue.pop()
            at = bucket[0] if len(bucket) == 1 else np.unique(np.concatenate(bucket))
            at = at[pair[at] == rank]  # the others are stale
            if not len(at):
                continue
            if len(at) > 1:
                own = word[at]
                again = own[1:] == own[:-1]
                if again.any():
                    queue.add(rank, at[1:][again])
                    at = np.concatenate([at[:1], at[1:][~again]])
            gone = after[at]
            end = after[gone]
            token[at], after[at] = rank, end
            pair[gone], pair[at], token[gone] = -1, -1, -1
            right = end >= 0
            a, e = at[right], end[right]
            before[e] = a
            left = before[at]
            b = left[left >= 0]
            ranks = self._joined(np.concatenate([np.full(len(a), rank), token[b]]),
                                 np.concatenate([token[e], np.full(len(b), rank)]))
            where = np.concatenate([a, b])
            pair[where] = ranks
            push(ranks, where)
        live = token >= 0
        return token[live], np.bincount(word[live], minlength=len(raws))


class Encoder:
    """Turns texts into codes of their distinct pre-tokens, and those into ids.

    ``codes`` assigns a code to every distinct pre-token met; new ones wait in
    ``fresh`` until `settle` encodes them together.  When more than REMEMBERED
    are known, `settle` is followed by a new start.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex
        self.merger, self.pattern = Merger(ranks), regex.compile(pattern)
        self.reset()

    def reset(self) -> None:
        fresh: list[str] = []

        class Codes(dict):
            def __missing__(self, word: str) -> int:
                code = self[word] = len(self)
                fresh.append(word)
                return code

        self.codes, self.fresh = Codes(), fresh
        self.ids, self.count = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        self.start = np.zeros(0, dtype=np.int64)

    def code(self, text: str) -> array:
        """Codes of a text's pre-tokens.  Long texts are taken step by step, so
        that only a bounded number of match strings is in memory."""
        look = self.codes.__getitem__
        if len(text) <= STEPWISE_CHARS:
            return array("i", map(look, self.pattern.findall(text)))
        out, found = array("i"), self.pattern.finditer(text)
        while step := [m.group() for m in islice(found, STEP)]:
            out.extend(map(look, step))
        return out

    def settle(self) -> None:
        """Encode the pre-tokens that are new since the last call."""
        if not self.fresh:
            return
        raws = [w.encode() for w in self.fresh]
        found = [self.merger.ranks.get(raw, -1) for raw in raws]
        short = [k for k, f in enumerate(found) if f < 0 and len(raws[k]) <= SHORT_BYTES]
        count = np.ones(len(raws), dtype=np.int64)
        ids, sizes = self.merger.many([raws[k] for k in short])
        count[short] = sizes
        long = {k: self.merger.one(raws[k]) for k, f in enumerate(found) if f < 0 and len(raws[k]) > SHORT_BYTES}
        for k, own in long.items():
            count[k] = len(own)
        start = np.cumsum(count) - count
        out = np.empty(int(count.sum()), dtype=np.int32)
        whole = np.array(found) >= 0
        out[start[whole]] = np.array(found)[whole]
        if short:
            first = np.cumsum(sizes) - sizes
            out[np.repeat(start[short] - first, sizes) + np.arange(len(ids))] = ids
        for k, own in long.items():
            out[start[k]:start[k] + len(own)] = own
        self.start = np.concatenate([self.start, start + len(self.ids)])
        self.ids, self.count = np.concatenate([self.ids, out]), np.concatenate([self.count, count])
        self.fresh.clear()

    def expand(self, codes: np.ndarray) -> np.ndarray:
        """Ids of settled codes."""
        count = self.count[codes]
        first = np.cumsum(count) - count
        return self.ids[np.repeat(self.start[codes] - first, count) + np.arange(int(count.sum()))]

    def encode(self, text: str) -> np.ndarray:
        codes = np.frombuffer(self.code(text), dtype=np.int32)
        self.settle()
        return self.expand(codes)


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def digest(ranks: dict[bytes, int]) -> str:
    """Names a vocabulary by its tokens and ranks."""
    h = hashlib.sha256()
    for token, rank in sorted(ranks.items()):
        h.update(b"%d:%d:" % (rank, len(token)) + token)
    return h.hexdigest()


def _encoder(ranks, name: str, pattern: str) -> Encoder:
    """The worker's encoder of the vocabulary ``name``; successive tasks share it, not
    the pre-tokens that it remembers: a worker also serves other stages."""
    key = (name, pattern)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(ranks.value, pattern)
    return _ENCODERS[key]


#: Ids of an Arrow batch at most (a longer text makes a batch of its own).
BATCH_IDS = 2_000_000


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str = "text",
           out_col: str = "ids") -> DataFrame:
    """``docs`` with the text replaced by ``out_col``, the array of its ids.

    Each match of ``pattern`` is encoded separately, without special tokens.
    Null and empty texts give an empty array; an existing column of the name
    ``out_col`` is replaced.  Bytes between matches have no ids.
    """
    shared, name = _broadcast(docs.sparkSession, ranks), digest(ranks)

    def encoded(batches, encoder):
        for batch in batches:
            texts, kept, start, waiting = batch.column(batch.num_columns - 1), batch.columns[:-1], 0, []

            def settled(end: int):
                """Batches of the rows that wait, with their ids."""
                encoder.settle()
                at, held, counts = start, [], []
                for k, codes in enumerate(waiting, start + 1):
                    held.append(encoder.expand(np.frombuffer(codes, dtype=np.int32)))
                    counts.append(len(held[-1]))
                    if k == end or sum(counts) >= BATCH_IDS:
                        lists = pa.ListArray.from_arrays(
                            pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)),
                            pa.array(np.concatenate(held)))
                        yield pa.RecordBatch.from_arrays([c.slice(at, k - at) for c in kept] + [lists],
                                                         names=[*batch.schema.names[:-1], out_col])
                        at, held, counts = k, [], []
                if len(encoder.codes) > REMEMBERED:
                    encoder.reset()

            for k in range(batch.num_rows):
                waiting.append(encoder.code(texts[k].as_py() or ""))
                if len(encoder.fresh) >= WAITING or k + 1 == batch.num_rows:
                    yield from settled(k + 1)
                    start, waiting = k + 1, []

    def run(batches):
        encoder = _encoder(shared, name, pattern)
        try:
            yield from encoded(batches, encoder)
        finally:
            encoder.reset()

    keep = [c for c in docs.columns if c not in (text_col, out_col)]
    text = unused("_text", keep)
    base = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias(text))
    schema = base.drop(text).withColumn(out_col, F.array().cast("array<int>")).schema
    return base.mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids",
           out_col: str = "decoded") -> DataFrame:
    """``encoded`` with ``out_col`` added: the bytes its ids stand for (binary,
    as ids need not end at a code point).  Null gives empty bytes; ids outside
    the vocabulary raise."""
    shared = _broadcast(encoded.sparkSession, ranks)

    def run(batches):
        size = max(shared.value.values(), default=-1) + 1
        tokens = [b""] * size
        known = np.zeros(size, dtype=bool)
        for token, rank in shared.value.items():
            tokens[rank], known[rank] = token, True
        length = np.fromiter(map(len, tokens), dtype=np.int64, count=size)
        base = np.concatenate([[0], np.cumsum(length)])
        flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            if len(ids) and (ids.min() < 0 or ids.max() >= size or not known[ids].all()):
                raise ValueError("decode: an id is not in the vocabulary")
            counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
            out = []
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                own = ids[a:b]
                spans = length[own]
                at = np.cumsum(spans) - spans
                out.append(flat[np.repeat(base[own] - at, spans) + np.arange(int(spans.sum()))].tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, type=pa.binary())], names=[*batch.schema.names, out_col])

    keep = [c for c in encoded.columns if c not in (ids_col, out_col)]
    base_df = encoded.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{ids_col}`").cast("array<int>").alias(ids_col))
    return base_df.mapInArrow(run, base_df.withColumn(out_col, F.lit(b"")).schema)


def _broadcast(spark: SparkSession, ranks: dict[bytes, int]):
    return spark.sparkContext.broadcast(ranks)
