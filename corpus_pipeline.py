"""Training-corpus pipeline: language, exact copies, near copies, source mix, pieces.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each
stage's result as Parquet and hands the reread table to the next.  All but the last
return the columns of ``documents``; the last returns one row per document of the mix
with its pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.bayes_join import bayes_join
from tessera.llm.common import Scratch, documents, word_count
from tessera.llm.cube_mix import cube_mix
from tessera.llm.lang_gru import UND, has_letter, identify, train_on
from tessera.llm.radix_dedup import radix_dedup
from tessera.llm.sp_nbest import sp_encode

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the network knows; texts without a letter (or null) go.

    Without a labelled text to learn from there is no network, and every text with a letter stays.
    """
    model, langs = train_on(docs)
    if model is None:
        return docs.where(has_letter(F.col("text"))).select(*docs.columns)
    return identify(docs, model, langs).where(F.col("lang_pred") != UND).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts."""
    return radix_dedup(docs).where("kept").select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    kept = bayes_join(docs).where("kept").select(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_h"))
    return docs.join(kept.hint("merge"), same, "left_semi").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The source mix: each document as often as the mix takes it."""
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("_h"))
    taken = (cube_mix(rows).where("copies > 0")
             .groupBy(F.col("doc_id").alias("_id"), "_h").agg(F.max("copies").alias("_copies")))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_h"))
    return (docs.join(taken.hint("merge"), same)
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*docs.columns))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document (best path), scores of the N best, exact round trip."""
    return sp_encode(docs, carry=False).select(
        "doc_id", "lang", "source", "n_pieces", "score", "ids",
        F.transform("others", lambda o: o["score"]).alias("other_scores"), "round_trip")


STAGES = [("language", language), ("exact_dedup", exact), ("near_dedup", near), ("mix", mix), ("pieces", pieces)]

#: A trained network, MinHash candidates and drawn samples are not SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = documents(spark, sf_dir)
    before = None
    for _, stage in STAGES:
        docs = scratch.put(stage(spark, docs, sf_dir))
        if before is not None:
            scratch.drop(before)
        before = docs
    return docs
