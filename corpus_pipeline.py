"""A corpus pipeline: toxic documents go, then documents of no language, near duplicates and benchmark
leaks; what is left is packed into training sequences.

Every stage takes (spark, docs, sf_dir) and reads all that the stage before kept. All but the last return
the columns of ``docs``, whatever other columns it has. Rows with null ids are treated like others; null
and letterless texts leave at the second stage; empty tables pass through as empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import decontaminate, langid, near_dedup, packing, toxicity
from tidemark.llm.common import crc_bucket
from tidemark.sources.sinks import materialize

#: A language must get this mean probability; two languages in equal parts still pass. Of more than four
#: languages each may get less: 1.4 times an even share.
LEAST_LANGUAGE_SCORE = 0.35


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go. It learns from four fifths of the labels, as op8 does."""
    known = crc_bucket("doc_id", 5) != 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs.where(known), labels.where(known))
    scored = toxicity.predict(docs, model, keep=tuple(docs.columns), names=("_tm_score", "_tm_toxic"))
    return scored.where("_tm_toxic = 0").select(*_columns(docs))


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or of no language with some certainty, go."""
    model = langid.train(docs.where(crc_bucket("doc_id", 4) != 2))
    if model is None:  # nothing to learn from: only the letters count
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = langid.predict(docs, model, keep=tuple(docs.columns), names=("_tm_lang", "_tm_score"))
    least = min(LEAST_LANGUAGE_SCORE, 1.4 / len(model.languages))
    return found.where((F.col("_tm_lang") != langid.UNDETERMINED) & (F.col("_tm_score") >= least)) \
        .select(*_columns(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id."""
    return near_dedup.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    benchmark = decontaminate.Benchmark(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    names = ("_tm_words", "_tm_hit", "_tm_items", "_tm_digest", "_tm_contaminated")
    found = decontaminate.contamination(docs, benchmark, keep=tuple(docs.columns), names=names)
    return found.where("NOT _tm_contaminated").select(*_columns(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1,024 tokens; the rows of op7."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("language", keep_language), ("near duplicates", drop_near_duplicates),
          ("decontamination", drop_benchmark_leaks), ("packing", pack)]

#: Trained models, minhash groups and sequences have no SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each one's result written to the shared folder for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
