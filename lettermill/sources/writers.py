"""Sinks. Each is one write action."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.operators.gate import REQUEST_KEY, gate
from lettermill.operators.prep import key_hash
from lettermill.operators.records import to_sft
from lettermill.sources.local import local_path, write_files
from lettermill.sources.readers import XML_NULL
from lettermill.sources.store import KeyedStore

SMALL_ORIGIN = "guideline"
LETTER_END = "\n"  # after the text of a letter file
RESPONSE_SCHEMA = "index string, model_index bigint, variant bigint, response string, kind string"


def write_sft(records: DataFrame, path: str, small: bool = False) -> None:
    """Records as JSON lines; the small set holds the guideline records only."""
    kept = records.filter(F.col("origin") == SMALL_ORIGIN) if small else records
    to_sft(kept).select("instruction", "output").write.mode("error").json(path)


def write_qa(qa: DataFrame, path: str) -> None:
    """Questions and answers as CSV, white space at their ends kept."""
    (qa.write.mode("error").option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def response_store(spark: SparkSession, path: str, buckets: int = 64) -> KeyedStore:
    return KeyedStore(spark, path, RESPONSE_SCHEMA, REQUEST_KEY, buckets)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    return response_store(spark, path).current()


def append_responses(responses: DataFrame, path: str, phrases: Mapping[str, Sequence[str]], batch: str | None = None) -> bool:
    """Append the good responses whose key has no good stored one, once per key, as one commit.

    Bad responses are not stored and so stay pending. Of good responses with one key in a batch the first in
    text order is stored. ``batch`` names the commit (without one the time does): sent again, it changes nothing.
    """
    fresh = gate(responses, phrases, "response", "kind")
    store = response_store(responses.sparkSession, path)
    return store.append(batch or _now(), fresh, lambda stored: gate(stored, phrases, "response", "kind"))


KNOWN_SCHEMA = "index string, value string, kind string"


def known_store(spark: SparkSession, path: str, buckets: int = 64) -> KeyedStore:
    return KeyedStore(spark, path, KNOWN_SCHEMA, ("index", "kind"), buckets)


def append_known(known: DataFrame, path: str, batch: str | None = None) -> bool:
    """Append extracted facts (index, kind, value), once per key, as one commit."""
    return known_store(known.sparkSession, path).append(batch or _now(), known)


def _now() -> str:
    return f"{time.time_ns():020d}"


def write_letters(letters: DataFrame, path: str) -> None:
    """Letters as a table laid out by type, so that a reader of one type scans no other."""
    letters.write.mode("error").partitionBy("letter_type").parquet(path)


def write_letter_files(letters: DataFrame, path: str, files: int = 64) -> None:
    """(path, raw_text) as one text file per letter, in a folder named after it, by ``files`` tasks.

    Workers write them themselves where the folder is on a disk that they see (``local.write_files``), Spark's writer
    elsewhere, which suits a small corpus only.
    """
    spread = letters.select("path", "raw_text").repartition(files, "path")
    local = local_path(letters.sparkSession, path)
    if local:
        write_files(spread, local, LETTER_END)
    else:
        spread.write.mode("error").option("lineSep", LETTER_END).partitionBy("path").text(path)


def write_articles(articles: DataFrame, path: str, row_tag: str = "article", root_tag: str = "articles") -> None:
    """Rows as XML elements; null and '' are told apart."""
    (articles.write.mode("error").format("xml").option("rowTag", row_tag).option("rootTag", root_tag)
     .option("nullValue", XML_NULL).save(path))


def write_chunks(chunks: DataFrame, path: str, key: str, buckets: int) -> None:
    """Chunks (with or without vectors) laid out by a hash bucket of the key, one file per bucket."""
    bucketed = chunks.withColumn("bucket", F.pmod(key_hash(F.col(key), 0), F.lit(buckets)))
    bucketed.repartition("bucket").write.mode("error").partitionBy("bucket").parquet(path)
