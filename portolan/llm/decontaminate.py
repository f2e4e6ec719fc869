"""Benchmark decontamination by a BM25 inverted index with block-max WAND.

The test items are the documents of the index; every passage of every training
text is a query.  Weights are BM25's, divided by the score that an item gives
itself, so a passage that holds all of an item scores 1, and one threshold fits
all items.  Postings lie in blocks of items with their greatest weights:
the sum of a block's greatest weights over a passage's terms bounds all scores
of the block, and passages without a block above the threshold are done.  The
others run through WAND with the block bounds, which retrieves every item
above the threshold.  What is retrieved is verified: a leak holds enough of
both the item's question and its answer, by word shingles.

An item's answer is its last sentence, its question what comes before; an item
of one sentence is all question.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.llm.store import cut
from portolan.llm.words import combine, segment_hashes, text_buffers, text_chunks

#: BM25 parameters, and the share of its own score that an item must reach.
K1, B, SCORE = 1.2, 0.75, 0.6
#: Shingles of an item's question and answer that a passage must hold.
SHINGLE, QUESTION, ANSWER = 3, 0.6, 0.5
#: Least terms of a passage.  It is twice the length of its items, rounded up to
#: a power of two: an item's passages do not depend on how long others are.
PASSAGE = 128
#: Items of a block of the index.
BLOCK = 4
#: Terms of the items in one index, repeats included, so at least its postings
#: and shingles (some 60 bytes for each); a larger set is worked off in parts,
#: one pass over the texts each.
INDEX_TERMS = 1 << 20
#: Bounds of passages and blocks that are summed up at a time.
CELLS = 1 << 20

_WORDY = np.zeros(128, dtype=bool)
_WORDY[[*range(48, 58), *range(97, 123)]] = True
#: Scripts that write words without blanks between them: each character of
#: theirs is a term.  Thai and Lao, Myanmar, Khmer, Tai scripts, kana and
#: bopomofo, ideographs.
_UNSPACED = ((0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x1AAF), (0x3005, 0x3007), (0x3021, 0x312F),
             (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA9E0, 0xA9FF),
             (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x16FE0, 0x18D8F), (0x1AFF0, 0x1B16F),
             (0x20000, 0x3FFFF))


@cache
def _kinds() -> np.ndarray:
    """Of each code point: 0 separates, 1 is of a word, 2 is a term by itself.
    Marks belong to their letter."""
    out = np.fromiter((unicodedata.category(chr(i))[0] in "LNM" for i in range(0x110000)), dtype=np.uint8, count=0x110000)
    for a, b in _UNSPACED:
        out[a:b + 1] *= 2
    return out


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of each run of lower-case letters and digits: punctuation
    and symbols of any script separate words, so junk between them does not
    hide a text.  In scripts without blanks each character is a term."""
    if not len(data) or data.max() < 128:
        return segment_hashes(data, offsets, _WORDY[data])
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
    first = np.flatnonzero((data & 0xC0) != 0x80)
    end = np.append(first[1:], len(data))
    kind = _kinds()[points]
    alone = kind == 2
    return segment_hashes(data, offsets, np.repeat(kind > 0, end - first), np.concatenate([first[alone], end[alone]]))


def lowered(column: pa.Array) -> pa.Array:
    """Lower case, in pieces that a 32-bit string array can hold."""
    return pc.utf8_lower(column.fill_null("") if column.null_count else column)


def shingles(terms: np.ndarray) -> np.ndarray:
    return np.unique(combine(terms, min(SHINGLE, len(terms)))) if len(terms) else terms


@dataclass
class Index:
    """Inverted index of items 0..n-1, sorted by term hash."""

    ids: list | pa.Array
    vocabulary: np.ndarray          # sorted term hashes
    start: np.ndarray               # postings of term t: start[t]:start[t+1]
    item: np.ndarray
    weight: np.ndarray
    block_start: np.ndarray         # blocks with term t: block_start[t]:block_start[t+1]
    block: np.ndarray
    block_max: np.ndarray           # greatest weight of the term in the block
    top: np.ndarray                 # greatest weight of term t
    blocks: int
    window: int                     # terms of a passage
    question: list[np.ndarray]
    answer: list[np.ndarray]


@dataclass
class Counts:
    """What the weights take from the whole set of items, whichever part of it
    an index holds."""

    items: int                      # items with a term
    mean: float                     # their mean number of terms
    window: int                     # terms of a passage of the items that an index holds
    term: np.ndarray                # sorted hashes, all terms of the part at least
    df: np.ndarray                  # items that hold each


def term_hashes(text: str) -> np.ndarray:
    return terms_of(*text_buffers(lowered(pa.array([text], type=pa.string()))))[0]


def question_answer(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Terms of an item's question and answer."""
    t = re.sub(r"\s+", " ", text or "").strip()
    ends = [m.end() for m in re.finditer(r"[.!?](?=\s)", t)]
    q, a = term_hashes(t[:ends[-1]] if ends else t), term_hashes(t[ends[-1]:] if ends else "")
    return (q, a) if len(q) else (a, q)


def _item_terms(batches):
    """mapInArrow: (item, text) -> (item, text, n, terms) of the items with a
    term: their number of terms, and the distinct ones."""
    for batch in batches:
        terms = [np.concatenate(question_answer(t)) for t in batch.column(1).to_pylist()]
        sizes = np.fromiter(map(len, terms), dtype=np.int64, count=len(terms))
        sets = [pa.array(np.unique(t).view(np.int64)) for t in terms]
        whole = pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sizes), pa.array(sets, type=pa.list_(pa.int64()))],
            names=["item", "text", "n", "terms"])
        yield whole.filter(pa.array(sizes > 0))


def window_of(terms: int) -> int:
    """Terms of a passage for items of so many terms."""
    return max(PASSAGE, 2 << (terms - 1).bit_length())


def build(items: list[tuple[object, str]], counts: Counts | None = None) -> Index | None:
    """Index of (id, text) items; items without a term are left out.  ``counts``
    are those of all items if these are a part of them."""
    rows = [(i, *question_answer(t)) for i, t in items]
    rows = [(i, q, a) for i, q, a in rows if len(q) + len(a)]
    if not rows:
        return None
    n = len(rows)
    length = np.array([len(q) + len(a) for _, q, a in rows], dtype=np.float64)
    term, owner, tf = [], [], []
    for k, (_, q, a) in enumerate(rows):
        own, count = np.unique(np.concatenate([q, a]), return_counts=True)
        term.append(own)
        owner.append(np.full(len(own), k))
        tf.append(count)
    term, owner, tf = np.concatenate(term), np.concatenate(owner), np.concatenate(tf).astype(np.float64)
    vocabulary, at = np.unique(term, return_inverse=True)
    held = np.bincount(at)
    if counts is None:
        counts = Counts(n, float(length.mean()), window_of(int(length.max())), vocabulary, held)
    df = counts.df[np.searchsorted(counts.term, vocabulary)]
    idf = np.log((counts.items - df + 0.5) / (df + 0.5) + 1.0)
    weight = idf[at] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[owner] / counts.mean))
    weight /= np.bincount(owner, weight)[owner]
    order = np.lexsort((owner, at))
    at, owner, weight = at[order], owner[order], weight[order]
    # postings of a term and block lie together: the pairs that exist, no others
    begins = np.flatnonzero(np.diff(at, prepend=-1) | np.diff(owner // BLOCK, prepend=-1))
    block_start = np.searchsorted(at[begins], np.arange(len(vocabulary) + 1))
    block_max = np.maximum.reduceat(weight, begins)
    return Index([i for i, _, _ in rows], vocabulary, np.concatenate([[0], np.cumsum(held)]), owner, weight,
                 block_start, owner[begins] // BLOCK, block_max, np.maximum.reduceat(block_max, block_start[:-1]),
                 (n - 1) // BLOCK + 1, counts.window,
                 [shingles(q) for _, q, _ in rows], [shingles(a) for _, _, a in rows])


def _slots(index: Index, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of the terms, place in block and block_max) of all their blocks."""
    first = index.block_start[terms]
    count = index.block_start[terms + 1] - first
    which = np.repeat(np.arange(len(terms)), count)
    return which, np.arange(len(which)) + np.repeat(first - (np.cumsum(count) - count), count)


def wand(index: Index, terms: list[int], threshold: float) -> list[tuple[int, float]]:
    """All items that the distinct terms score at or above the threshold."""
    cursors = [[int(index.item[index.start[t]]), int(index.start[t]), t] for t in terms]
    top = index.top
    slack = 1e-9
    _, at = _slots(index, np.asarray(terms, dtype=np.int64))
    live = np.flatnonzero(np.bincount(index.block[at], index.block_max[at]) >= threshold - slack).tolist()
    out = []

    def advance(c: list[int], item: int) -> bool:
        end = int(index.start[c[2] + 1])
        c[1] += int(np.searchsorted(index.item[c[1]:end], item))
        if c[1] >= end:
            return False
        c[0] = int(index.item[c[1]])
        return True

    while cursors:
        cursors.sort()
        bound, pivot = 0.0, -1
        for k, c in enumerate(cursors):
            bound += top[c[2]]
            if bound >= threshold - slack:
                pivot = k
                break
        if pivot < 0:
            break
        item = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
            pivot += 1
        ahead = bisect_left(live, item // BLOCK)
        if ahead == len(live):
            break
        if live[ahead] != item // BLOCK:
            # no item can reach it before the next block whose bound does
            goal = live[ahead] * BLOCK
            cursors = [c for c in cursors if c[0] >= goal or advance(c, goal)]
        elif cursors[0][0] == item:
            here = [c for c in cursors if c[0] == item]
            score = float(sum(index.weight[c[1]] for c in here))
            if score >= threshold - slack:
                out.append((item, score))
            cursors = [c for c in cursors if c[0] != item or advance(c, item + 1)]
        else:
            cursors = [c for c in cursors if c[0] >= item or advance(c, item)]
    return out


def passages(row: np.ndarray, rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) term of passages of ``size`` terms that overlap by half, so
    that any run of half the size lies within one."""
    first = np.searchsorted(row, np.arange(rows))
    end = np.append(first[1:], len(row)) if rows else first
    half = size // 2
    count = np.where(end > first, np.maximum(-(-(end - first) // half) - 1, 1), 0)
    owner = np.repeat(np.arange(rows), count)
    nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    a = first[owner] + nth * half
    return a, np.minimum(a + size, end[owner])


def candidates(index: Index, terms: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Passages a:b in which some block's bound reaches the threshold."""
    at = np.searchsorted(index.vocabulary, terms)
    at = np.minimum(at, len(index.vocabulary) - 1)
    known = np.flatnonzero(index.vocabulary[at] == terms)
    code = at[known]
    lo, hi = np.searchsorted(known, a), np.searchsorted(known, b)
    total = int((hi - lo).sum())
    passage = np.repeat(np.arange(len(a)), hi - lo)
    pos = np.arange(total) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)
    # a cheaper bound first: the greatest weights over all blocks, with repeats
    rough = np.bincount(passage, index.top[code[pos]], minlength=len(a)) >= SCORE - 1e-9
    passage, pos = passage[rough[passage]], pos[rough[passage]]
    pairs = np.unique(passage * np.int64(len(index.vocabulary)) + code[pos])
    passage, own = pairs // len(index.vocabulary), pairs % len(index.vocabulary)
    live, first = np.unique(passage, return_index=True)
    if not len(live):
        return live
    # some passages at a time: their pairs of term and block, and a row of blocks each
    ends = np.append(first[1:], len(own))
    count = np.append(0, np.cumsum(index.block_start[own + 1] - index.block_start[own]))
    group = np.cumsum(count[ends] - count[first] + index.blocks) // CELLS
    edges = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(live))
    reached = np.zeros(len(live), dtype=bool)
    for i, j in zip(edges[:-1], edges[1:], strict=True):
        mine = slice(first[i], ends[j - 1])
        which, at = _slots(index, own[mine])
        nth = np.searchsorted(live[i:j], passage[mine])
        bounds = np.bincount(nth[which] * index.blocks + index.block[at], index.block_max[at],
                             minlength=(j - i) * index.blocks).reshape(j - i, -1)
        reached[i:j] = (bounds >= SCORE - 1e-9).any(axis=1)
    return live[reached]


def _share(part: np.ndarray, held: np.ndarray) -> float:
    return len(np.intersect1d(part, held, assume_unique=True)) / len(part) if len(part) else 1.0


def _found(index: Index, terms: np.ndarray, row: np.ndarray, rows: int) -> dict[tuple[int, int], tuple]:
    """(row, item number) -> (score, question, answer) of the leaks in a chunk."""
    a, b = passages(row, rows, index.window)
    found: dict[tuple[int, int], tuple[float, float, float]] = {}
    for p in candidates(index, terms, a, b).tolist():
        own = terms[a[p]:b[p]]
        at = np.searchsorted(index.vocabulary, own)
        at = np.minimum(at, len(index.vocabulary) - 1)
        hits = wand(index, np.unique(at[index.vocabulary[at] == own]).tolist(), SCORE)
        if not hits:
            continue
        held = np.unique(np.concatenate([combine(own, w) for w in range(1, SHINGLE + 1)]))
        for item, score in hits:
            q, s = _share(index.question[item], held), _share(index.answer[item], held)
            if q >= QUESTION and s >= ANSWER:
                key = (int(row[a[p]]), item)
                found[key] = max(found.get(key, (0.0, 0.0, 0.0)), (score, q, s))
    return found


def _searcher(shared):
    """mapInArrow: (id, text) -> (id, item, score, question, answer), by the
    indexes of one part, one per length of passage."""

    def run(batches):
        for batch in batches:
            for i, j, data, offsets in text_chunks(lowered(batch.column(1))):
                terms, row = terms_of(data, offsets)
                for index in shared.value:
                    if found := _found(index, terms, row, j - i):
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(pa.array([i + r for r, _ in found])),
                             index.ids.take(pa.array([k for _, k in found])),
                             *[pa.array([v[c] for v in found.values()], type=pa.float64()) for c in range(3)]],
                            names=["id", "item", "score", "question", "answer"])
    return run


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, item_id, score, question, answer) of the texts that hold test
    items: the best passage's score, and the shares of question and answer
    shingles in it.

    Null and empty texts and items have no passages and are never found; items
    with a null id count under id null; ids of both are of any type; repeated
    documents give a row each, repeated items are separate items.  No items: no
    rows.  Other columns are not read.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    tests = items.select(F.col(f"`{item_id_col}`").alias("item"),
                         F.col(f"`{item_text_col}`").cast("string").alias("text"))
    id_type, item_type = base.schema["id"].dataType.simpleString(), tests.schema["item"].dataType.simpleString()
    schema = f"id {id_type}, item {item_type}, score double, question double, answer double"
    # one count over all items, so that a part's weights and passages are those of the whole set
    tests = cut(tests.mapInArrow(_item_terms, f"item {item_type}, text string, n long, terms array<long>")
                .withColumn("nth", F.monotonically_increasing_id()), "items")
    n, total = tests.agg(F.count(F.lit(1)), F.sum("n")).first()
    df = cut(tests.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")), "item-terms")
    parts = -(-(total or 0) // INDEX_TERMS)
    out = spark.createDataFrame([], schema)
    for part in range(parts):
        # each part is about INDEX_TERMS: a bounded broadcast
        mine = tests.where(F.pmod(F.xxhash64("nth"), F.lit(parts)) == part)
        own = mine.select(F.explode("terms").alias("term")).distinct()
        known = df.join(own, "term", "left_semi").toArrow() if parts > 1 else df.toArrow()
        term = known.column("term").to_numpy().view(np.uint64)
        order = np.argsort(term)
        own_items = mine.select("item", "text", "n").orderBy("nth").toArrow()
        texts, windows = own_items.column("text").to_pylist(), [window_of(k) for k in own_items.column("n").to_pylist()]
        indexes = []
        for window in sorted(set(windows)):
            counts = Counts(n, total / n, window, term[order], known.column("df").to_numpy()[order])
            index = build([(k, t) for k, (t, w) in enumerate(zip(texts, windows, strict=True)) if w == window], counts)
            index.ids = own_items.column("item").take(pa.array(index.ids)).combine_chunks()
            indexes.append(index)
        if indexes:
            out = out.unionByName(base.mapInArrow(_searcher(spark.sparkContext.broadcast(indexes)), schema))
    return out.withColumnsRenamed({"id": id_col, "item": "item_id"})
