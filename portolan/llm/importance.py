"""Target-distribution importance resampling over hashed word runs.

A 256-byte table lower-cases A to Z and blanks every byte that separates words
in the UTF-8 text; ``bytes.split`` yields the words.  A run of words is hashed
by chaining ``zlib.crc32``: the hash of a run is the seed for the run that is
one word longer, so each run costs one call.  Counters add up the buckets in
each task, and Spark adds the tasks' counters, at most one row a bucket and
task.

The gain of a bucket is the logarithm of how much likelier it is in the target
than in the corpus; a document's weight is the sum of its runs' gains.  Weights
plus Gumbel noise, drawn from the document's id, rank the documents: the
highest are a draw without replacement in proportion to the weights'
exponentials.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.llm.ranking import ranked
from portolan.llm.store import cut

BUCKETS = 10_000
#: Words in a run at most.
LONGEST = 3
#: Bytes of a text whose words are held at a time.
BLOCK = 1 << 20

_WORD_BYTES = frozenset([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
#: Lower-cases A to Z, keeps digits, letters and bytes of other scripts, blanks the rest.
CLEAN = bytes(b if b in _WORD_BYTES else 0x20 for b in bytes(range(256)).lower())


def run_hashes(raw: bytes, longest: int = LONGEST) -> Iterator[tuple[int, list[int]]]:
    """(words, crc32 of every run of 1 to ``longest`` words) of a whole text, by
    blocks; a run that crosses blocks belongs to the block where it ends."""
    clean, carry, at = raw.translate(CLEAN), [], 0
    while at < len(clean):
        end = clean.find(b" ", at + BLOCK)
        end = len(clean) if end < 0 else end
        words = clean[at:end].split()
        at = end
        sequence = carry + words
        follow = [b" " + w for w in sequence]
        chain = list(map(crc32, sequence))
        hashes = chain[len(carry):]
        for n in range(1, longest):
            chain = list(map(crc32, follow[n:], chain))
            hashes += chain[max(len(carry) - n, 0):]
        carry = sequence[len(sequence) - (longest - 1):] if len(sequence) >= longest else sequence
        yield len(words), hashes


def _buckets(hashes: list[int], buckets: int) -> np.ndarray:
    return np.array(hashes, dtype=np.uint32) % np.uint32(buckets)


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS,
                  longest: int = LONGEST) -> DataFrame:
    """(bucket, n): runs of all texts by bucket; buckets without a run are absent."""
    def run(batches):
        total: Counter[int] = Counter()
        for batch in batches:
            for raw in batch.column(0):
                for _, hashes in run_hashes(raw.as_py() or b"", longest):
                    total.update(_buckets(hashes, buckets).tolist())
        yield pa.RecordBatch.from_arrays([pa.array(list(total.keys()), pa.int32()),
                                          pa.array(list(total.values()), pa.int64())], names=["bucket", "n"])

    raw = texts.select(F.col(f"`{text_col}`").cast("string").cast("binary").alias("raw"))
    return raw.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln) of the smoothed frequency in the target over that in the
    corpus, per bucket.  Two tables of at most ``buckets`` rows reach the driver."""
    def dense(counts: DataFrame) -> list[int]:
        out = [0] * buckets
        for row in counts.collect():
            out[row["bucket"]] = row["n"]
        return out

    s, t = dense(corpus), dense(target)
    all_s, all_t = float(sum(s) + buckets), float(sum(t) + buckets)
    return np.array([math.floor(1000 * math.log(float(b + 1) * all_s / (float(a + 1) * all_t)))
                     for a, b in zip(s, t, strict=True)], dtype=np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
          longest: int = LONGEST) -> DataFrame:
    """Per row: id, n_words, n_features (runs) and weight, the sum of their gains."""
    def run(batches):
        for batch in batches:
            out = []
            for raw in batch.column(1):
                words = features = weight = 0
                for n, hashes in run_hashes(raw.as_py() or b"", longest):
                    words, features = words + n, features + len(hashes)
                    weight += int(gain[_buckets(hashes, len(gain))].sum())
                out.append((words, features, weight))
            cols = [pa.array([row[k] for row in out], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols],
                                             names=["id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("raw"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long")


def noise(id_col: str, seed: int):
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of the id's sha256; a
    null id counts as the empty string."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, *, percent: int = 5, least_words: int = 20, seed: int = 42,
             buckets: int = BUCKETS, longest: int = LONGEST, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_features, weight, score, rank.

    ``rank`` is 1, 2, 3... for the drawn rows, floor(percent/100) of those with
    ``least_words`` words, by score, then id (null last); null for all others.
    Null and empty texts have no words, weight 0 and no rank; repeated rows are
    rows of their own, equal ones may take each other's rank; an empty table
    gives an empty result; other columns are not read.
    """
    raw_target = bucket_counts(target, text_col, buckets, longest)
    gain = gains(bucket_counts(docs, text_col, buckets, longest), raw_target, buckets)
    scored = cut(weigh(docs, gain, id_col, text_col, longest)
                 .withColumn("score", F.col("weight") + noise("id", seed))
                 .withColumn("_row", F.monotonically_increasing_id()), "importance-scores")
    able = scored.filter(F.col("n_words") >= least_words)
    wanted = able.count() * percent // 100
    # the written row number splits a hot group of equal rows between ranges
    order = ranked(able, [F.desc("score"), F.asc_nulls_last("id"), F.asc("_row")], "importance-order", "rank")
    drawn = order.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    rest = scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).drop("_row").withColumnRenamed("id", id_col)


def drawn_documents(docs: DataFrame, result: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id has a rank in ``result``, in their own columns."""
    ids = result.filter(F.col("rank").isNotNull()).select(F.col(f"`{id_col}`").alias("_drawn")).distinct()
    return docs.join(ids, F.col(f"`{id_col}`").eqNullSafe(F.col("_drawn")), "left_semi")
