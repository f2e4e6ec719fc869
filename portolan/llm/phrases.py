"""Phrase collocations, counted by HAT-tries in the tasks.

A task keeps runs of words in a shallow trie over word ids whose leaves are
hash containers.  It starts as one container; a container that grows past
`BURST` entries bursts: its first words part into two containers, and a word
that has a container to itself goes on by slices of the second word's id.  When
the trie is full, whole containers, that is subtrees, leave it as sorted runs of
(phrase, count) rows.  Runs meet by prefix partition; the prefix is the whole
path of up to three words, so that neither a hot word nor a hot pair fills one
partition, and a partition adds up what the tasks have counted.

Texts are read twice.  First every position gives one entry, its word and the
next one; counts of single words are sums over the trie.  A phrase occurs at
most as often as its parts, so then only those runs of three words are counted
whose two pairs reach the least count.  A Bloom filter of a fixed size, sent to
the tasks, tells: it knows every such pair, and what it lets through besides is
counted and falls to the least count.  Counts are exact at every size.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from hashlib import blake2b
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portolan.llm.store import cut

#: Entries that a task's trie holds before subtrees leave it (about 120 MB).
CAPACITY = 1_000_000
#: Entries of a hash container before it bursts.
BURST = 4096
#: Distinct words a task numbers before it starts anew.
MOST_WORDS = 1 << 20
#: Bytes of text that are split at a time.
BLOCK = 1 << 20
#: Rows of an Arrow batch of a run.
RUN_ROWS = 100_000
#: Bits of the filter of frequent pairs (8 MB), at every size of the corpus.
FILTER_BITS = 1 << 26
#: Bits set for a pair.
FILTER_HASHES = 2
#: Parts in which a language's phrases are ranked before its first ones are.
RANK_PARTS = 64

_BITS = 20
_LOW = (1 << _BITS) - 1
_SLICE = 4
#: Ends a piece; no word can equal it.
END = b"."
_PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes(0x0A if b in _PIECE_ENDS else 0x20 if b == 9 else b for b in bytes(range(256)).lower())
_GAP = re.compile(rb"[ \n]")
_U = np.uint64
COUNT_SCHEMA = "lang string, words int, phrase string, n long"


def token_blocks(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Words of whole texts by blocks, `END` behind every piece."""
    whole, at = b"\n".join(texts).translate(_TABLE), 0
    while at < len(whole):
        gap = _GAP.search(whole, at + BLOCK)
        end = gap.start() if gap else len(whole)
        yield whole[at:end].replace(b"\n", b" . ").split()
        at = end
    yield [END, END]


class _Ids(dict):
    """Word -> number in order of appearance; `END` is 0."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _word_hash(word: bytes) -> int:
    return int.from_bytes(blake2b(word, digest_size=8).digest(), "little")


class PairFilter:
    """Bloom filter of pairs of words by language: never denies a pair it holds."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words

    @staticmethod
    def places(lang: str, first: np.ndarray, second: np.ndarray, bits: int) -> list[np.ndarray]:
        """Bits of pairs, given their words' hashes."""
        x = first * _U(0x9E3779B97F4A7C15) + (second ^ _U(_word_hash(lang.encode())))
        out = []
        for _ in range(FILTER_HASHES):
            x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
            x ^= x >> _U(29)
            out.append(x & _U(bits - 1))
        return out

    def __contains__(self, pair) -> bool:
        lang, a, b = pair
        return bool(self.holds(lang, np.array([_word_hash(a)], _U), np.array([_word_hash(b)], _U))[0])

    def holds(self, lang: str, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        out = np.ones(len(first), dtype=bool)
        for place in self.places(lang, first, second, 64 * len(self.words)):
            out &= (self.words[place >> _U(6)] >> (place & _U(63)) & _U(1)).astype(bool)
        return out


class _Part:
    """The containers of one language."""

    def __init__(self) -> None:
        self.boxes: list[Counter] = [Counter()]
        self.base = np.zeros(0, dtype=np.int64)  # first word -> its (first) container
        self.fan = np.zeros(0, dtype=np.int64)   # first word -> mask of the second word's id

    def grow(self, size: int) -> None:
        if len(self.base) < size:
            more = np.zeros(2 * size - len(self.base), dtype=np.int64)
            self.base, self.fan = np.concatenate([self.base, more]), np.concatenate([self.fan, more])

    def insert(self, path: np.ndarray, burst: int) -> None:
        if not len(path):
            return
        box = self._box(path)
        order = np.argsort(box, kind="stable")
        keys = path[order].tolist()
        start = np.flatnonzero(np.diff(box[order], prepend=-1)).tolist()
        for k, i, j in zip(box[order[start]].tolist(), start, [*start[1:], len(keys)], strict=True):
            self.boxes[k].update(keys[i:j])
        waiting = [k for k, held in enumerate(self.boxes) if len(held) > burst]
        while waiting:
            k = waiting.pop()
            if len(self.boxes[k]) > burst:
                waiting += [j for j in self._burst(k) if len(self.boxes[j]) > burst]

    def _box(self, path: np.ndarray) -> np.ndarray:
        first = path >> 2 * _BITS
        return self.base[first] + (path >> _BITS & self.fan[first])

    def _burst(self, k: int) -> list[int]:
        """Parts the entries of a container; returns the containers to look at again."""
        words, n = np.unique(np.fromiter(self.boxes[k], np.int64, len(self.boxes[k])) >> 2 * _BITS, return_counts=True)
        if len(words) > 1:
            # a word with more than half goes alone, else the upper half of the words
            away = words[n > n.sum() // 2] if (n > n.sum() // 2).any() else words[len(words) // 2:]
            self.base[away] = new = len(self.boxes)
            self.boxes.append(Counter())
            self._deal([k])
            return [k, new]
        word = int(words[0])
        old = range(int(self.base[word]), int(self.base[word] + self.fan[word]) + 1)
        if self.fan[word] >= _LOW >> _SLICE:
            return []  # one second word each
        self.fan[word] = (self.fan[word] << _SLICE) + (1 << _SLICE) - 1
        self.base[word] = new = len(self.boxes)
        self.boxes += [Counter() for _ in range(int(self.fan[word]) + 1)]
        self._deal(old)
        return list(range(new, len(self.boxes)))

    def _deal(self, boxes) -> None:
        """Puts the entries of containers where their words belong now."""
        for k in boxes:
            held, self.boxes[k] = self.boxes[k], Counter()
            if not held:
                continue
            box = self._box(np.fromiter(held, np.int64, len(held)))
            order = np.argsort(box, kind="stable")
            keys, n = list(held), list(held.values())
            keys, n = [keys[i] for i in order.tolist()], [n[i] for i in order.tolist()]
            start = np.flatnonzero(np.diff(box[order], prepend=-1)).tolist()
            for to, i, j in zip(box[order[start]].tolist(), start, [*start[1:], len(keys)], strict=True):
                dict.update(self.boxes[to], zip(keys[i:j], n[i:j], strict=True))  # a path stands in one container


class Trie:
    """Counts of word runs of one task, by language.

    Without a filter: runs of one and two words and the number of words; with
    one: runs of three words whose pairs it holds.
    """

    def __init__(self, pairs: PairFilter | None = None, capacity: int = CAPACITY, burst: int = BURST,
                 most_words: int = MOST_WORDS) -> None:
        self.pairs, self.capacity, self.burst = pairs, capacity, burst
        self.most_words = min(most_words, _LOW)
        self.clear()

    def clear(self) -> None:
        self.ids = _Ids({END: 0})
        self.parts: dict[str, _Part] = defaultdict(_Part)
        self.hashes = np.zeros(0, dtype=_U)

    def add(self, lang: str, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        """Counts texts; yields the runs that leave the trie meanwhile."""
        carry = np.zeros(0, dtype=np.int64)
        for tokens in token_blocks(texts):
            seq = np.concatenate([carry, np.fromiter(map(self.ids.__getitem__, tokens), np.int64, len(tokens))])
            self._insert(lang, seq)
            carry = seq[-2:]
            if len(self.ids) >= self.most_words:
                names = list(self.ids)
                words = [names[k] for k in carry]
                yield from self.spill(0)
                self.clear()
                carry = np.array([self.ids[w] for w in words], dtype=np.int64)
            elif self.entries() > self.capacity:
                yield from self.spill(self.capacity // 2)

    def entries(self) -> int:
        return sum(sum(map(len, part.boxes)) for part in self.parts.values())

    def _insert(self, lang: str, seq: np.ndarray) -> None:
        part = self.parts[lang]
        part.grow(len(self.ids))
        first, second, third = seq[:-2], seq[1:-1], seq[2:]
        if self.pairs is None:
            at = np.flatnonzero(first > 0)
            part.insert(first[at] << 2 * _BITS | second[at] << _BITS, self.burst)
            return
        if len(self.hashes) < len(self.ids):
            fresh = list(self.ids)[len(self.hashes):]
            self.hashes = np.concatenate([self.hashes, np.fromiter(map(_word_hash, fresh), _U, len(fresh))])
        real = seq > 0
        known = real[:-1] & real[1:]
        at = np.flatnonzero(known)
        known[at] = self.pairs.holds(lang, self.hashes[seq[at]], self.hashes[seq[at + 1]])
        at = np.flatnonzero(known[:-1] & known[1:])
        part.insert(first[at] << 2 * _BITS | second[at] << _BITS | third[at], self.burst)

    def spill(self, keep: int) -> Iterator[pa.RecordBatch]:
        """Takes whole subtrees out, largest first, until ``keep`` entries are
        left; yields them as sorted runs."""
        held = sorted(((len(box), lang, k) for lang, part in self.parts.items()
                       for k, box in enumerate(part.boxes) if box), reverse=True)
        left, gone = sum(h[0] for h in held), defaultdict(list)
        for size, lang, k in held:
            if left <= keep:
                break
            gone[lang].append(k)
            left -= size
        if not gone:
            return
        names = pa.array(list(self.ids), pa.binary())
        order = np.empty(len(names), dtype=np.int64)  # place of a word in byte order, from 1; `END` first
        order[pc.array_sort_indices(names).to_numpy()] = np.arange(1, len(names) + 1)
        order[0] = 0
        for lang, boxes in gone.items():
            part = self.parts[lang]
            out = [part.boxes[k] for k in boxes]
            for k in boxes:
                part.boxes[k] = Counter()
            size = sum(map(len, out))
            path = np.fromiter(chain.from_iterable(out), np.int64, size)
            n = np.fromiter(chain.from_iterable(map(dict.values, out)), np.int64, size)
            del out
            yield from self._run(lang, path, n, names, order)

    def _run(self, lang: str, path: np.ndarray, n: np.ndarray, names: pa.Array, order: np.ndarray):
        word = [path >> (2 * _BITS), path >> _BITS & _LOW, path & _LOW]
        at = np.argsort(order[word[0]] << 2 * (_BITS + 1) | order[word[1]] << (_BITS + 1) | order[word[2]])
        word, n = [w[at] for w in word], n[at]
        if self.pairs is None:
            yield _batch(lang, 0, pa.array([b""], pa.binary()), pa.array([int(n.sum())], pa.int64()))
        for size in (1, 2) if self.pairs is None else (3,):
            whole = np.flatnonzero(word[size - 1] > 0)
            if not len(whole):
                continue
            new = np.zeros(len(whole), dtype=bool)
            new[0] = True
            for w in word[:size]:
                new[1:] |= w[whole[1:]] != w[whole[:-1]]
            start = np.flatnonzero(new)
            sums = np.add.reduceat(n[whole], start)
            for i in range(0, len(start), RUN_ROWS):
                own = whole[start[i:i + RUN_ROWS]]
                phrase = pc.binary_join_element_wise(*[names.take(pa.array(w[own])) for w in word[:size]], b" ")
                yield _batch(lang, size, phrase, pa.array(sums[i:i + RUN_ROWS], pa.int64()))


def _batch(lang: str, words: int, phrase: pa.Array, n: pa.Array) -> pa.RecordBatch:
    rows = len(phrase)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * rows, pa.string()), pa.array(np.full(rows, words, dtype=np.int32)),
         phrase.view(pa.string()), n], names=["lang", "words", "phrase", "n"])


def _counter(pairs, capacity: int, burst: int):
    def run(batches):
        trie = Trie(pairs and PairFilter(pairs.value), capacity, burst)
        for batch in batches:
            by_lang: dict[str, list[bytes]] = defaultdict(list)
            for lang, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by_lang[lang].append(raw)
            for lang, texts in by_lang.items():
                yield from trie.add(lang, texts)
        yield from trie.spill(0)
    return run


def pair_filter(pairs: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """The 64-bit words of a `PairFilter` of (lang, phrase) rows; at most
    ``bits`` / 64 rows reach the driver."""
    def run(batches):
        for batch in batches:
            by_lang: dict[str, list[bytes]] = defaultdict(list)
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by_lang[lang].append(phrase)
            found = []
            for lang, phrases in by_lang.items():
                words = [tuple(map(_word_hash, phrase.split(b" "))) for phrase in phrases]
                first, second = np.array(words, dtype=_U).reshape(-1, 2).T
                found += PairFilter.places(lang, first, second, bits)
            place = np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=_U)
            slot, start = np.unique(place >> _U(6), return_index=True)
            mask = np.bitwise_or.reduceat(_U(1) << (place & _U(63)), start) if len(start) else place
            yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(mask.view(np.int64))],
                                             names=["slot", "mask"])

    rows = pairs.select("lang", F.col("phrase").cast("binary").alias("phrase")).mapInArrow(run, "slot int, mask long")
    out = np.zeros(bits // 64, dtype=np.int64)
    for row in rows.groupBy("slot").agg(F.bit_or("mask").alias("mask")).toLocalIterator():
        out[row["slot"]] = row["mask"]
    return out.view(_U)


def phrase_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 10,
                  capacity: int = CAPACITY, burst: int = BURST, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(lang, words, phrase, n), written: runs of 1 to 3 words within a piece
    that occur ``least`` times or more in a language, and per language one row of
    0 words with the number of its words."""
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("raw"))

    def merged(pairs) -> DataFrame:
        keys = ["lang", "words", "phrase"]
        runs = texts.mapInArrow(_counter(pairs, capacity, burst), COUNT_SCHEMA).repartition(*keys)
        sums = runs.groupBy(*keys).agg(F.sum("n").alias("n"))
        return cut(sums.filter((F.col("n") >= least) | (F.col("words") == 0)), "phrase-counts")

    short = merged(None)
    pairs = docs.sparkSession.sparkContext.broadcast(pair_filter(short.filter("words = 2"), filter_bits))
    return short.unionByName(merged(pairs))


def _head(n: int):
    return F.substring_index("phrase", " ", n)


def scored_cuts(counts: DataFrame) -> DataFrame:
    """(lang, words, phrase, a, l, r, score) of each candidate's lowest-scoring
    cut (ties: the smallest first part).  Exact: products are decimals."""
    def cut_at(k: int, right: int):
        return F.struct(F.lit(k).alias("k"), _head(k).alias("left"), _head(-right).alias("right"))

    cuts = F.when(F.col("words") == 2, F.array(cut_at(1, 1))).otherwise(F.array(cut_at(1, 2), cut_at(2, 1)))
    rows = counts.filter("words >= 2").select("lang", "words", "phrase", F.col("n").alias("a"), F.inline(cuts))
    parts = counts.filter("words in (1, 2)").select("lang", F.col("phrase").alias("part"), "n")
    left = parts.select("lang", F.col("part").alias("left"), F.col("n").alias("l"))
    right = parts.select("lang", F.col("part").alias("right"), F.col("n").alias("r"))
    wide = "decimal(38,0)"
    score = (f"(cast(cast(a as decimal(19,0)) * a * 1000000 as {wide})"
             f" div cast(cast(l as decimal(19,0)) * r as {wide}))")
    best = F.min(F.struct(F.expr(score).alias("score"), "k", "l", "r", "a", "words")).alias("best")
    return (rows.join(left, ["lang", "left"]).join(right, ["lang", "right"])
            .groupBy("lang", "phrase").agg(best).select("lang", "phrase", "best.*").drop("k"))


def covered(counts: DataFrame) -> DataFrame:
    """(lang, phrase, longer): for pairs inside a candidate of three words the
    greatest count of such a candidate."""
    return (counts.filter("words = 3")
            .select("lang", F.explode(F.array(_head(2), _head(-2))).alias("pair"), "n")
            .groupBy("lang", "pair").agg(F.max("n").alias("longer"))
            .withColumnRenamed("pair", "phrase"))


def collocations(docs: DataFrame, *, least: int = 10, inside: int = 50, top: int = 2000, lang_col: str = "lang",
                 text_col: str = "text", capacity: int = CAPACITY, burst: int = BURST) -> DataFrame:
    """Per language the ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    A phrase goes if one word longer candidate around it has at least
    ``inside`` percent of its count.  Null languages are ``und``; null and empty
    texts have no words; repeated rows count each; an empty table gives an
    empty result; other columns are not read.  A language without candidates
    has no row.
    """
    counts = phrase_counts(docs, lang_col, text_col, least, capacity, burst)
    scored = scored_cuts(counts).join(covered(counts), ["lang", "phrase"], "left")
    kept = scored.filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * inside))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language's first rows are among the first of its parts: one task ranks
    # RANK_PARTS x top rows at most
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    in_part = F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))
    ahead = kept.withColumn("_part", part).withColumn("_place", in_part).filter(F.col("_place") <= top)
    first = ahead.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))) \
        .filter(F.col("rank") <= top)
    totals = counts.filter("words = 0").select("lang", "n")
    return first.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
