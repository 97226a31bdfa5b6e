"""Packing rows into sequences of a bounded size: next-fit over one order of all rows, in built-in functions.

All rows stand on one line of tokens, in hash order. A sequence that begins at a row ends before the row that covers
the token ``limit`` further on, so that row's place is known for every row from places alone, by one sorted pass. The
sequences are the chain of these successors from the first row. To follow the chain without walking it, the line is cut
into cells of ``limit`` tokens: a chain enters each cell exactly once, whatever row it comes from, so where it enters
cell c + 2**k is a function of where it enters cell c, and is made of two functions for 2**(k-1). A function for
2**k is only needed at every 2**k-th cell, so all of them together are twice as large as the table.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.operators.prep import key_hash
from lettermill.sources.scratch import fresh_dir

RANGE_ROWS = 1 << 16  # rows of one range of the order, about
CELLS = 1024  # cells in which sequences are numbered together


def running_total(df: DataFrame, group: str, order: list[Column], value: Column, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over all rows before, in the order of ``group``, then ``order``.

    Groups are summed first, so only one row per group is ordered in one place.
    """
    before = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    sums = df.groupBy(group).agg(F.sum(value).alias("_sum"))
    sums = sums.select(group, F.coalesce(F.sum("_sum").over(before), zero).alias("_first"))
    own = df.withColumn("_own", F.coalesce(F.sum(value).over(inside), zero))
    return own.join(sums, group).withColumn(name, F.col("_first") + F.col("_own")).drop("_first", "_own")


class _Steps:
    """Tables of the steps, each written once and read by those after it."""

    def __init__(self, spark) -> None:
        self.spark, self.place, self.n = spark, fresh_dir(spark, "packing"), 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        df.write.parquet(f"{self.place}/{self.n}")
        return self.spark.read.schema(df.schema).parquet(f"{self.place}/{self.n}")


def successors(rows: DataFrame, limit: int, total: int) -> DataFrame:
    """(a, b): for the row that begins at token a, the beginning b of the row that covers token a + limit.

    ``rows`` (place, n) have n > 0. Every cell gets the rows that begin in it, the one that reaches into it and the tokens
    asked for, sorted by place: what covers a token is the last row that began. Rows without a successor are left out.
    """
    cell = lambda c: F.expr(f"({c}) div {limit}")
    begins = rows.select(cell("place").alias("cell"), "place", F.lit(0).alias("asks"), F.col("place").alias("row"))
    reaches = rows.filter(cell("place + n - 1") > cell("place")).select((cell("place") + 1).alias("cell"), "place", F.lit(0).alias("asks"), F.col("place").alias("row"))
    asked = rows.filter(F.col("place") + limit < total).select(
        (cell("place") + 1).alias("cell"), (F.col("place") + limit).alias("place"), F.lit(1).alias("asks"), F.col("place").alias("row"))
    order = Window.partitionBy("cell").orderBy("place", "asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    covering = F.last(F.when(F.col("asks") == 0, F.col("row")), ignorenulls=True).over(order)
    return begins.unionByName(reaches).unionByName(asked).withColumn("b", covering).filter("asks = 1").select(F.col("row").alias("a"), "b")


def chain(next_row: DataFrame, limit: int, cells: int, steps: _Steps) -> DataFrame:
    """(row): the rows of the chain of ``next_row`` (a, b) from the one at 0."""
    cell = lambda c: F.expr(f"{c} div {limit}")
    onward = next_row.select(F.col("a").alias("b"), F.col("b").alias("c"))
    within = cell("b") == cell("a")
    # Where a chain enters the next cell: a cell holds two rows of a chain at most.
    entered = steps.keep(next_row.filter(~within).unionByName(next_row.filter(within).join(onward, "b").select("a", F.col("c").alias("b"))))
    levels = [entered]
    for k in range(1, ceil(log2(cells)) if cells > 1 else 0):
        place = cell("a") % (1 << k)
        first = levels[-1].filter(place == 0)
        second = levels[-1].filter(place == 1 << (k - 1)).select(F.col("a").alias("b"), F.col("b").alias("c"))
        levels.append(steps.keep(first.join(second, "b").select("a", F.col("c").alias("b"))))
    found = steps.keep(next_row.sparkSession.range(1).select(F.col("id").alias("row")))
    for level in reversed(levels):
        found = steps.keep(found.unionByName(found.join(level, F.col("row") == F.col("a")).select(F.col("b").alias("row"))))
    return found.unionByName(found.join(next_row.filter(within), F.col("row") == F.col("a")).select(F.col("b").alias("row")))


def pack(df: DataFrame, key: str, n_tokens: str, limit: int = 8192) -> DataFrame:
    """(key, n_tokens, bin, position): rows packed, in hash order, into sequences of at most ``limit`` tokens.

    A sequence is closed when the next row does not fit. Sequences are numbered from 0 in that order, ``position`` is
    where a row begins in its own. Null and negative counts are 0; a row longer than ``limit`` counts as ``limit``, and
    its text must be cut by whoever writes it. Keys are unique; rows that share one are ordered by their size. Only keys
    and counts travel. Rows without tokens stay in the sequence that is open where they stand.
    """
    steps = _Steps(df.sparkSession)
    size = F.least(F.greatest(F.coalesce(F.col(n_tokens).cast("bigint"), F.lit(0)), F.lit(0)), F.lit(limit)).cast("bigint")
    sized = steps.keep(df.select(F.col(key).alias("key"), size.alias("n"), F.coalesce(key_hash(F.col(key), 0), F.lit(0)).alias("hash")))
    n_rows, total = (int(x or 0) for x in sized.agg(F.count("*"), F.sum("n")).first())
    bits = max(0, ceil(log2(max(1, n_rows / RANGE_ROWS))))
    ranged = sized.withColumn("range", F.shiftright("hash", 32 - bits) if bits else F.lit(0))
    rows = steps.keep(running_total(ranged, "range", [F.col("hash"), F.col("key"), F.col("n")], F.col("n"), "place").select("key", "n", "place"))
    if not total:
        zero = F.lit(0).cast("bigint")
        return rows.select(F.col("key").alias(key), F.col("n").alias("n_tokens"), zero.alias("bin"), zero.alias("position"))
    next_row = steps.keep(successors(rows.filter("n > 0").select("place", "n"), limit, total))
    begins = chain(next_row, limit, ceil(total / limit), steps).withColumn("cell", F.expr(f"row div {limit}"))
    numbered = running_total(begins.withColumn("group", F.expr(f"cell div {CELLS}")), "group", [F.col("row")], F.lit(1), "bin").select("cell", "row", "bin")
    # A row's sequence begins in its own cell or the one before: four at most to choose from.
    near = numbered.unionByName(numbered.withColumn("cell", F.col("cell") + 1)).groupBy("cell").agg(F.collect_list(F.struct("row", "bin")).alias("begins"))
    joined = rows.withColumn("cell", F.expr(f"place div {limit}")).join(near, "cell")
    # The row that begins a sequence is the last at its place: those without tokens there stand before it.
    own = F.array_max(F.filter("begins", lambda b: (b["row"] < F.col("place")) | ((b["row"] == F.col("place")) & ((F.col("n") > 0) | (F.col("place") == 0)))))
    return joined.withColumn("own", own).select(
        F.col("key").alias(key), F.col("n").alias("n_tokens"), F.col("own.bin").cast("bigint").alias("bin"), (F.col("place") - F.col("own.row")).alias("position"))
