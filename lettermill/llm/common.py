"""What several of the operators share: tables, shared storage, words, names, components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.sources.scratch import fresh_dir, shared_dir

# The pattern of words of letters and digits; the same text works in Java, RE2 and Python.
LETTER_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Bytes: A-Z to a-z, every other ASCII character that is no letter or digit to a space.
LETTER_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def letter_words(text: str | None) -> list[bytes]:
    """The ``LETTER_WORDS`` of a text with A-Z lowered, as UTF-8."""
    return text.encode().translate(LETTER_TABLE).split() if text else []


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read from there: its lineage ends here."""
    spark, place = df.sparkSession, shared_dir(df.sparkSession)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(place)
    return df.checkpoint(eager=True)


def unused(columns: list[str], *names: str) -> list[str]:
    """``names``, each with as many underscores in front as it takes to be in ``columns`` in no letter case."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, as it is given to mapInArrow, after which the worker gives back what the task held: workers are kept for the
    tasks and stages that follow, and what each has kept adds up."""
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def give_back() -> None:
    """Free cycles, and hand the pages of freed memory to the system where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def row_hashes(df: DataFrame) -> tuple[Column, Column]:
    """Two hashes of the whole row, nulls marked: rows alike in both are copies. Columns that Spark cannot hash (maps,
    variants) go in as JSON."""
    whole = []
    for f in df.schema.fields:
        own = F.col(f"`{f.name}`")
        plain = not any(kind in f.dataType.simpleString() for kind in ("map<", "variant"))
        whole += [own.isNull(), own if plain else F.to_json(F.struct(own.alias("c")))]
    return F.xxhash64(*whole), F.xxhash64(F.lit(1), *whole)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); ``component`` is the smallest node reachable.

    Contraction: in each round every node moves to the neighbour (or itself) that comes first in an order
    drawn anew by hash, and the edges are rewritten to the nodes moved to. Chains, stars and dense groups
    all shrink by a constant factor, so the rounds grow with the logarithm of the largest group. Each
    round's edges and moves are checkpointed. No row collects a node's neighbours. Loops, nulls in
    either end and repeated edges are allowed; an edge with a null end is dropped.
    """
    pairs = edges.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    current = checkpointed(pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    moves: list[DataFrame] = []
    for step in range(max_rounds):
        if current.isEmpty():
            break
        both = current.select("a", "b").unionAll(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(step), c).alias("h"), c.alias("n"))
        move = both.groupBy("a").agg(F.min(rank(F.col("b"))).alias("first"))
        move = checkpointed(move.select(F.col("a").alias("node"), F.least(F.col("first"), rank(F.col("a")))["n"].alias("to")))
        moves.append(move)
        ends_a = move.select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        ends_b = move.select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        moved = current.join(ends_a, "a").join(ends_b, "b").filter("to_a <> to_b")
        current = checkpointed(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct())
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    rooted = nodes.select("node", F.col("node").alias("root"))
    for move in moves:
        step_to = move.select(F.col("node").alias("root"), "to")
        rooted = rooted.join(step_to, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("node").alias("component"))
    return rooted.join(smallest, "root").select("node", "component")
