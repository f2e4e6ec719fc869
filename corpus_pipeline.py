"""Corpus pipeline: the stages that turn raw documents into token ids.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's documents.  All but the
last return the columns of ``documents``.

Stages decide for each row, not for each id: null ids and one id with several
texts are documents like others.  Rows with equal id and equal text have the
same lines and the same leaks, and one of them stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.llm import bpe, decontaminate, line_dedup, ngram_join, quality_gam
from portolan.llm.queries import QUALITY_CUT, quality_model, table, vocabulary
from portolan.llm.store import cut, settled

#: SQL cannot express a trained classifier or the tokenizer's merges.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    scored = quality_gam.score(docs.withColumn("_whole", F.col("text")), quality_model(spark, sf_dir))
    return scored.where(F.col("score") >= QUALITY_CUT).withColumnRenamed("_whole", "text").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every line once, where it stands first; a document whose lines all stand
    in earlier documents goes, one that had no line with a word stays."""
    done = line_dedup.dedup_lines(docs)
    return done.where("n_kept > 0 or n_lines = 0").withColumn(
        "n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def _meeting(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """``docs`` joined with (l_id, l_th): their id, null or not, and text hash."""
    return docs.join(keys, docs["doc_id"].eqNullSafe(keys["l_id"]) & (F.xxhash64(docs["text"]) == keys["l_th"]), how)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that shares four fifths of its five-word shingles:
    the one with the smallest id, null ids last, then the least text hash.  Rows
    without a word are in no group.  Of rows with equal id and equal text one
    stays, the least by its other columns."""
    # a struct is never null, and its least one is the row that stays
    keyed = docs.withColumn("_key", F.struct(F.isnull("doc_id").alias("none"), "doc_id", F.xxhash64("text").alias("th")))

    def marks() -> DataFrame:
        found = ngram_join.classes(keyed, id_col="_key", width=5, threshold=ngram_join.Threshold(4, 5))
        return (found.withColumn("copy", ~F.col("component_id").eqNullSafe(F.col("_key")))
                .groupBy("_key", "copy").agg(F.count(F.lit(1)).alias("n")).where("copy or n > 1")
                .select(F.col("_key.doc_id").alias("l_id"), F.col("_key.th").alias("l_th"), "copy"))

    # the join's own tables go once the rows to drop are written
    marked = settled(marks, spark, "classes")
    again = _meeting(docs, marked.where("not copy"), "left_semi")
    once = again.groupBy("doc_id", F.xxhash64("text")).agg(F.min(F.struct(*docs.columns)).alias("r")).select("r.*")
    return _meeting(docs, marked, "left_anti").unionByName(once).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item in them, by id and text: another text
    of the same id stays, and null ids are no exception."""
    keyed = docs.withColumn("_key", F.struct("doc_id", F.xxhash64("text").alias("th")))

    def found() -> DataFrame:
        return decontaminate.leaks(keyed, table(spark, sf_dir, "benchmark"), id_col="_key").select(
            F.col("_key.doc_id").alias("l_id"), F.col("_key.th").alias("l_th")).distinct()

    return _meeting(docs, settled(found, spark, "leaks"), "left_anti").select(*docs.columns)


def to_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    ranks, pattern = vocabulary()
    return bpe.encode(docs, ranks, pattern)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("byte-level BPE", to_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each one's result is written
    under the shared folder before the next one starts."""
    out = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        out = cut(stage(spark, out, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, out, sf_dir)
