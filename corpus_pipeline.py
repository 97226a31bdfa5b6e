"""The corpus pipeline: toxic documents go, one of each near-duplicate group stays, repeated passages and
benchmark leaks go, and what is left is mixed to target weights.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; the runner writes it as Parquet and hands it,
read again, to the next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.llm.common import fresh_dir, table, unused
from lettermill.llm.mixing import mix_documents
from lettermill.llm.passages import remove_passages
from lettermill.llm.simhash import keep_one
from lettermill.llm.toxicity import drop_toxic
from lettermill.llm.winnow import drop_contaminated


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays."""
    return keep_one(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of passages go, with the white space of the texts they are cut from; ``n_chars`` follows.

    A text without one stays as it is, a document of which nothing is left goes.
    """
    words, removed, kept = unused(docs.columns, "n_words", "n_removed", "kept_text")
    done = remove_passages(docs, results=(words, removed, kept))
    cut = F.col(removed) > 0
    return done.filter(~(cut & (F.col(removed) == F.col(words)))).select(
        *[F.when(cut, F.col(kept)).otherwise(F.col("text")).alias("text") if c == "text"
          else F.when(cut, F.length(kept).cast("bigint")).otherwise(F.col("n_chars")).alias("n_chars") if c == "n_chars"
          else F.col(f"`{c}`") for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document; those of which it takes nothing are left out, unless they are empty."""
    return mix_documents(docs).filter("taken > 0 OR size = 0")


STAGES = [("toxicity", toxicity), ("simhash", simhash), ("passages", passages), ("decontaminate", decontaminate), ("mix", mix)]
ORACLE_SQL = None  # the toxicity model is fitted, and the links of fingerprints are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, place = table(spark, sf_dir, "documents"), fresh_dir(spark, "corpus-pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{name}")
        docs = spark.read.parquet(f"{place}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
