"""Training-set preparation: instruct format, splits, truncation, chunking."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.functions.text import tokens, truncate_tokens
from lettermill.rules import RESPONSE_MARKER

# The record format a trained model expects.
INTRO = "Below is an instruction that describes a task. Write a response that appropriately completes the request."
INSTRUCTION_KEY = "### Instruction:"
INPUT_KEY = "Input:"
# End of fixed values.


def instruct_prompt(instruction: Column, context: Column | None = None) -> Column:
    """Intro, instruction, the input where there is one, and the marker the response follows."""
    head = F.concat(F.lit(f"{INTRO}\n\n{INSTRUCTION_KEY}\n"), instruction)
    tail = F.lit(f"\n\n{RESPONSE_MARKER}")
    if context is None:
        return F.concat(head, tail)
    given = F.coalesce(context, F.lit("")) != ""
    return F.when(given, F.concat(head, F.lit(f"\n\n{INPUT_KEY}\n"), context, tail)).otherwise(F.concat(head, tail))


def to_instruct(df: DataFrame, instruction: str = "instruction", response: str = "response",
                context: str | None = None) -> DataFrame:
    """Add ``text``: the filled prompt and the response."""
    prompt = instruct_prompt(F.col(instruction), F.col(context) if context else None)
    return df.withColumn("text", F.concat(F.lit("{ 'prompt': "), prompt, F.lit(", 'response': "), F.col(response), F.lit(" }")))


def key_hash(key: Column, seed: int) -> Column:
    """A number below 2**32 from key and seed, the same in every run and engine."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def split_fraction(df: DataFrame, key: str, fraction: float = 0.05, seed: int = 68) -> DataFrame:
    """Add ``split``: about ``fraction`` of the rows are "eval". Row by row, no shuffle."""
    share = F.pmod(key_hash(F.col(key), seed), F.lit(10_000))
    return df.withColumn("split", F.when(share < round(fraction * 10_000), "eval").otherwise("train"))


def split_exact(df: DataFrame, key: str, n: int = 1000, seed: int = 68) -> DataFrame:
    """Add ``split``: exactly ``n`` rows (or all, if fewer) are "eval"; ``key`` is unique.

    The rows with the smallest hashes are taken: those up to the n-th (hash, key), which is found first
    and then compared with row by row, so the rows themselves are not shuffled. Hashes are counted in
    65,536 ranges; a running sum over these counts (a fixed number of rows) tells in which range the
    n-th falls, and only the keys of that range are ranked.
    """
    if n <= 0:
        return df.withColumn("split", F.lit("train"))
    hashed = df.select(F.col(key).alias("_key"), key_hash(F.col(key), seed).alias("_hash"))
    hashed = hashed.withColumn("_range", F.shiftright("_hash", 16))
    upto = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = hashed.groupBy("_range").agg(F.count("*").alias("_n")).withColumn("_upto", F.sum("_n").over(upto))
    edge = (counted.filter((F.col("_upto") >= n) & (F.col("_upto") - F.col("_n") < n))
            .select("_range", (F.lit(n) - F.col("_upto") + F.col("_n")).alias("_need")))
    ranked = hashed.join(F.broadcast(edge), "_range").withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_range").orderBy("_hash", "_key")))
    last = ranked.filter(F.col("_rank") == F.col("_need")).select(F.struct("_hash", "_key")).scalar()
    taken = F.coalesce(F.struct(key_hash(F.col(key), seed).alias("_hash"), F.col(key).alias("_key")) <= last, F.lit(True))
    return df.withColumn("split", F.when(taken, "eval").otherwise("train"))


def truncate_rows(df: DataFrame, text: str = "text", limit: int = 512) -> DataFrame:
    return df.withColumn(text, truncate_tokens(F.col(text), limit))


def apply_tokenizer(df: DataFrame, encode, text: str = "text", limit: int = 512) -> DataFrame:
    """Add ``token_ids``: ``encode`` is the user's function from a string to a list of ids.

    The hook for a tokenizer that is not a Spark expression: Arrow batches, one Python worker per task.
    """
    @F.pandas_udf("array<int>")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda value: None if value is None else list(encode(value))[:limit])

    return df.withColumn("token_ids", encoded(F.col(text)))


def chunk(df: DataFrame, key: str, text: str = "text", size: int = 512, overlap: int = 20) -> DataFrame:
    """(key, chunk_no, n_tokens, text): windows of ``size`` tokens, each starting ``overlap`` before the last end."""
    step = size - overlap
    words = df.select(F.col(key), tokens(F.col(text)).alias("_words")).filter(F.size("_words") > 0)
    starts = F.sequence(F.lit(0), F.size("_words") - 1, F.lit(step))
    pieces = F.transform(starts, lambda s: F.slice("_words", s + 1, size))
    return (words.select(key, F.posexplode(pieces).alias("chunk_no", "_piece"))
            .select(key, F.col("chunk_no").cast("bigint").alias("chunk_no"), F.size("_piece").cast("bigint").alias("n_tokens"),
                    F.array_join("_piece", " ").alias("text")))


def chunk_sentences(df: DataFrame, key: str, text: str = "text", size: int = 512, overlap: int = 20) -> DataFrame:
    """Like ``chunk``, but cut between sentences: a chunk takes whole sentences while they fit, and opens
    with the last sentences of the chunk before, as far as they make up at most ``overlap`` tokens and leave
    room. A sentence longer than ``size`` is cut into pieces of that size.

    Sentence lengths are folded into chunk bounds; all of it is built-in functions.
    """
    sentences = F.split(F.col(text), r"(?<=[.!?])\s+")

    def cut(sentence: Column) -> Column:
        return F.transform(F.array(tokens(sentence)), lambda words: F.transform(
            F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(words) - 1), F.lit(size)), lambda at: F.slice(words, at + 1, size)))[0]

    units = df.select(key, F.filter(F.flatten(F.transform(sentences, cut)), lambda w: F.size(w) > 0).alias("_units"))
    counted = units.withColumn("_counts", F.transform("_units", lambda w: F.size(w)))
    span = "struct<first:int,n:int>"
    state = F.struct(F.array().cast(f"array<{span}>").alias("done"), F.lit(0).alias("first"), F.lit(0).alias("filled"), F.lit(0).alias("at"))

    def tail(at: Column, count: Column) -> Column:
        """(first, filled) of the sentences before ``at`` that open the next chunk."""
        # At most ``overlap`` sentences of a token or more can be carried over.
        back = F.reverse(F.slice("_counts", F.greatest(F.lit(1), at - overlap + 1), F.least(at, F.lit(overlap))))

        def add(carried: Column, n: Column) -> Column:
            fits = carried["open"] & (carried["filled"] + n <= overlap) & (carried["filled"] + n + count <= size)
            return F.when(fits, F.struct((carried["first"] - 1).alias("first"), (carried["filled"] + n).alias("filled"), F.lit(True).alias("open"))
                          ).otherwise(F.struct(carried["first"].alias("first"), carried["filled"].alias("filled"), F.lit(False).alias("open")))

        return F.aggregate(back, F.struct(at.alias("first"), F.lit(0).alias("filled"), F.lit(True).alias("open")), add)

    def step(s: Column, count: Column) -> Column:
        closed = F.transform(F.array(tail(s["at"], count)), lambda t: F.struct(
            F.concat(s["done"], F.array(F.struct(s["first"].alias("first"), (s["at"] - s["first"]).alias("n")))).alias("done"),
            t["first"].alias("first"), (t["filled"] + count).alias("filled"), (s["at"] + 1).alias("at")))[0]
        return F.when(s["filled"] + count > size, closed).otherwise(F.struct(
            s["done"].alias("done"), s["first"].alias("first"), (s["filled"] + count).alias("filled"), (s["at"] + 1).alias("at")))

    def finish(s: Column) -> Column:
        last = F.array(F.struct(s["first"].alias("first"), (s["at"] - s["first"]).alias("n")))
        return F.when(s["at"] > 0, F.concat(s["done"], last)).otherwise(s["done"])

    spans = counted.withColumn("_spans", F.aggregate("_counts", state, step, finish))
    placed = spans.select(key, "_units", F.posexplode_outer("_spans").alias("chunk_no", "_span")).filter("_span IS NOT NULL")
    piece = F.flatten(F.slice("_units", F.col("_span.first") + 1, F.col("_span.n")))
    return placed.select(key, F.col("chunk_no").cast("bigint").alias("chunk_no"), F.size(piece).cast("bigint").alias("n_tokens"),
                         F.array_join(piece, " ").alias("text"))
