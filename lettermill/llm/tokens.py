"""Token counts kept as rollups: signed deltas per batch, added up by source, language and tokenizer version.

A store is a folder: ``ledger/batch=<id>`` holds what each batch said of its documents, ``rollup/batch=<id>`` the
batch's sums, and a batch is committed once its rollup is there. Totals are the sums of the rollups. A batch that
is sent again is left out, one that broke off before its commit is written anew.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lettermill.llm.common import fresh_dir, table, unused

TOKENIZER_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# The public pre-tokenization pattern of this vocabulary.
TOKENIZER_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
LEDGER = "doc_id bigint, tokenizer string, source string, lang string, deleted boolean, n_tokens bigint, n_chars bigint, batch string"
ROLLUP = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint, n_chars bigint, batch string"
KEYS = ("source", "lang", "tokenizer")


def byte_pair_counter(path: str = TOKENIZER_FILE) -> Callable[[], Callable[[str], int]]:
    """A maker of counters; each task loads the vocabulary file for itself, so it must be on every machine."""
    def make() -> Callable[[str], int]:
        import base64

        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}
        encoding = tiktoken.Encoding("byte-pairs", pat_str=TOKENIZER_PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda text: len(encoding.encode_ordinary(text))

    return make


def count_tokens(documents: DataFrame, counter: Callable[[], Callable[[str], int]], text: str = "text") -> DataFrame:
    """``documents`` with ``n_tokens`` in place of the text; null and empty texts have 0."""
    kept = [c for c in documents.columns if c not in (text, "n_tokens")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            counts = pa.array([count(t.as_py()) if t.is_valid and t.as_py() else 0 for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)) for c in kept], counts], [*kept, "n_tokens"])

    return documents.mapInArrow(run, documents.select(*kept, F.lit(0).cast("bigint").alias("n_tokens")).schema)


class TokenRollup:
    """The rollup store under ``path``, a folder in shared storage."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _exists(self, part: str) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}")
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def _batches(self) -> list[str]:
        """Committed batches, by name; names sort in the order of commits. One name per batch."""
        if not self._exists("rollup"):
            return []
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/rollup")
        found = place.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(place)
        names = [status.getPath().getName().removeprefix("batch=") for status in found if status.isDirectory()]
        return sorted(n for n in names if self._exists(f"rollup/batch={n}/_SUCCESS"))

    def _read(self, part: str, schema: str) -> DataFrame:
        """The committed batches' rows, in one scan; a batch that broke off is not read."""
        done = self._batches()
        if not done:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{part}").filter(F.col("batch").isin(done))

    def current(self, only: DataFrame | None = None) -> DataFrame:
        """The last word on each document and tokenizer version, or on those in ``only`` (doc_id, tokenizer)."""
        last = Window.partitionBy("doc_id", "tokenizer").orderBy(F.desc("batch"))
        ledger = self._read("ledger", LEDGER)
        if only is not None:
            # What the batch does not speak of is not ranked.
            asked = only.select(F.col("doc_id").alias("_d"), F.col("tokenizer").alias("_t"))
            ledger = ledger.join(asked, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("tokenizer").eqNullSafe(F.col("_t")), "left_semi")
        return ledger.withColumn("_nth", F.row_number().over(last)).filter("_nth = 1").drop("_nth", "batch")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Take in a batch of changes (doc_id, tokenizer, source, lang, deleted, n_tokens, n_chars) in one go.

        A change replaces what was known of its document and tokenizer version: that is taken away, the new is
        added, a deletion only takes away. Of changes with one key the one with most tokens counts, then the
        first by source and language; null is a doc_id like any other. Returns False, and does nothing, if the
        batch is committed.
        Batches must be named in rising order.
        """
        done = self._batches()
        if batch in done:
            return False
        if done and batch < done[-1]:
            raise ValueError(f"batch {batch!r} comes after {done[-1]!r}")
        named = ["doc_id", "tokenizer", "source", "lang", "deleted", "n_tokens", "n_chars"]
        only = Window.partitionBy("doc_id", "tokenizer").orderBy("deleted", F.desc("n_tokens"), "source", "lang", F.desc("n_chars"))
        own = changes.select(*named).withColumn("_nth", F.row_number().over(only)).filter("_nth = 1").drop("_nth")
        own.write.mode("overwrite").parquet(f"{self.path}/ledger/batch={batch}")
        new = self.spark.read.schema(LEDGER.rsplit(",", 1)[0]).parquet(f"{self.path}/ledger/batch={batch}")
        signed = new.filter("NOT deleted").select(*KEYS, F.lit(1).alias("sign"), "n_tokens", "n_chars")
        if done:
            gone = self.current(new).filter("NOT deleted")
            signed = signed.unionByName(gone.select(*KEYS, F.lit(-1).alias("sign"), "n_tokens", "n_chars"))
        sums = signed.groupBy(*KEYS).agg(F.sum("sign").cast("bigint").alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).alias("n_tokens"),
                                         F.sum(F.col("sign") * F.col("n_chars")).alias("n_chars"))
        sums.write.mode("overwrite").parquet(f"{self.path}/rollup/batch={batch}")
        return True

    def totals(self) -> DataFrame:
        """Documents, tokens and characters by source, language and tokenizer version; empty groups are left out."""
        summed = self._read("rollup", ROLLUP).groupBy(*KEYS).agg(*[F.sum(c).cast("bigint").alias(c) for c in ("n_docs", "n_tokens", "n_chars")])
        return summed.filter("n_docs <> 0 OR n_tokens <> 0 OR n_chars <> 0")


def changes_of(documents: DataFrame, tokenizer: str, n_tokens: str = "n_tokens", deleted: bool = False) -> DataFrame:
    """Changes that say of every document how many tokens it has under a tokenizer version."""
    return documents.select("doc_id", F.lit(tokenizer).alias("tokenizer"), "source", "lang", F.lit(deleted).alias("deleted"),
                            F.col(n_tokens).cast("bigint").alias("n_tokens"), F.coalesce("n_chars", F.lit(0)).cast("bigint").alias("n_chars"))


def keyed(documents: DataFrame) -> DataFrame:
    """``documents`` (doc_id, text, source, lang, ...) where rows without a doc_id have one of their own: a negative hash
    of their content and of a number among rows of the same content, the same whenever they are read."""
    content = [x for c in ("text", "source", "lang") for x in (F.col(c).isNull(), F.col(c))]
    one, two = unused(documents.columns, "row_one", "row_two")
    told = documents.filter("doc_id IS NULL").withColumns({one: F.xxhash64(*content), two: F.xxhash64(F.lit(1), *content)})
    nth = F.row_number().over(Window.partitionBy(one, two).orderBy(one))
    own = F.xxhash64(one, two, nth).bitwiseOR(F.lit(-1 << 63))
    return documents.filter("doc_id IS NOT NULL").unionByName(told.withColumn("doc_id", own).drop(one, two))


def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in with an estimate, are revised to counted tokens, and those without a token leave; the
    middle batch is sent twice. The totals are those of the counted documents, with or without a doc_id."""
    documents = keyed(table(spark, sf_dir, "documents"))
    sized = documents.select("doc_id", "text", "source", "lang", F.length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_chars"))
    store = TokenRollup(spark, fresh_dir(spark, "token-rollup"))
    estimate = F.ceil(F.col("n_chars") / 4)
    store.commit("1-load", changes_of(sized.drop("text").withColumn("n_tokens", estimate), "byte-pairs-50k"))
    counted = changes_of(count_tokens(sized, byte_pair_counter()), "byte-pairs-50k")
    store.commit("2-count", counted)
    store.commit("2-count", counted)
    store.commit("3-empty", store.current().filter("n_tokens = 0").withColumn("deleted", F.lit(True)))
    return store.totals()
