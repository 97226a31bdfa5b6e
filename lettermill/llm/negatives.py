"""Hard negatives by exact integer scores: products in a residue number system, windowed selection.

Components are whole numbers. A block of anchors meets a block of rows as matrices of residues modulo a few small
primes; the primes are so small that every sum of their float32 products is below 2 ** 24, and so exact in any order
of adding. Chinese remaindering then gives back the signed scores, as the primes' product is above twice the largest
score that the vectors' norms allow.

Every anchor meets every row, a block of each at a time: first for its positives, whose scores open the windows, then
for the negatives inside them. A task holds one block of anchors and what is best so far, and streams its rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lettermill.llm.common import fresh_dir, table

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # hundredths of the positive's score
SCALE = 256
EXACT = 1 << 24  # whole numbers up to here are exact in float32
DIMS = 1024  # dimensions multiplied at a time
NORM_LIMIT = float(1 << 55)  # scores and a hundred times as much fit a bigint
ANCHOR_CELLS = 1 << 20  # components of a block of anchors
ROW_CELLS = 1 << 23  # components of a block of rows, which are streamed
LEAST_ROWS = 1024
TILE = (512, 2048)  # anchors and rows multiplied at a time
_NONE = np.iinfo(np.int64).min


def primes_for(dims: int, bound: int) -> list[int]:
    """The largest odd primes whose centred residues multiply exactly over ``dims`` dimensions, as many as it takes for
    their product to be above twice ``bound``."""
    found: list[int] = []
    product = 1
    p = 2 * int(((EXACT - 1) / max(1, min(dims, DIMS))) ** 0.5) + 1
    while product <= 2 * bound:
        if p < 3:
            raise ValueError(f"no primes for scores up to {bound}")
        if all(p % d for d in range(3, int(p ** 0.5) + 1, 2)):
            found.append(p)
            product *= p
        p -= 2
    return found or [3]


def residues(x: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """Per prime the components modulo it, between -(p - 1) / 2 and (p - 1) / 2."""
    return [((x + p // 2) % p - p // 2).astype(np.float32) for p in primes]


def scores(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products of the rows of a and b, given by their residues."""
    value, product = None, 1
    for x, y, p in zip(a, b, primes):
        own = np.zeros((len(x), len(y)), np.int64)
        for at in range(0, x.shape[1], DIMS):
            own += (x[:, at:at + DIMS] @ y[:, at:at + DIMS].T).astype(np.int64)
        if value is None:
            value = (own + p // 2) % p - p // 2
        else:
            # The next digit in the mixed radix of the primes, centred like the residues.
            digit = (own - value) % p * pow(product, -1, p)
            value += ((digit + p // 2) % p - p // 2) * product
        product *= p
    return value


@dataclass
class Best:
    """The first ``k`` rows of every place so far: higher scores first, then smaller ids, those without one last."""

    places: int
    k: int
    parts: list[np.ndarray] = field(default_factory=lambda: [np.empty(0, np.int64)] * 4)

    def __post_init__(self) -> None:
        self.least = np.full(self.places, _NONE)  # the score a row needs to come in, once there are k

    def offer(self, first: int, score: np.ndarray, allowed: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        """Scores (places from ``first`` on, rows); only those ``allowed`` count."""
        pick = allowed & (score >= self.least[first:first + len(score)][:, None])
        if score.shape[1] > self.k and np.count_nonzero(pick) > 4 * self.k * len(score):
            at = score.shape[1] - self.k
            pick &= score >= np.partition(np.where(pick, score, _NONE), at, axis=1)[:, at][:, None]
        i, j = np.nonzero(pick)
        if not len(i):
            return
        new = [i + first, -score[i, j], unnamed[j].astype(np.int64), ids[j]]
        held = [np.concatenate([a, b]) for a, b in zip(self.parts, new)]
        order = np.lexsort(held[::-1])
        place = held[0][order]
        begins = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        nth = np.arange(len(place)) - np.repeat(begins, np.diff(np.append(begins, len(place))))
        self.parts = [x[order[nth < self.k]] for x in held]
        last = order[nth == self.k - 1]
        self.least[held[0][last]] = -held[1][last]


def whole_vectors(vectors: DataFrame, key: str, label: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(id, label, dim, vec): floor(scale * x) of every component, rows that take part only, each once.

    A row takes no part if its label or vector is null, a component is null, NaN or infinite, or its inner product with
    itself does not stay below 2 ** 55 (then its scores may not fit).
    """
    v = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    sound = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    norm = F.aggregate(vector, F.lit(0.0), lambda s, x: s + F.pow(F.floor(x.cast("double") * F.lit(float(scale))).cast("double"), F.lit(2.0)))
    rows = vectors.filter(F.col(label).isNotNull() & F.col(vector).isNotNull() & sound & (norm < NORM_LIMIT))
    return rows.select(F.col(key).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), F.size(vector).alias("dim"),
                       v.cast("array<int>").alias("vec")).distinct()


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.int64).reshape(len(column), dim)


def _best_rows(rows: DataFrame, anchors: DataFrame, blocks: tuple[int, int], bound: int, k: int, windowed: bool) -> DataFrame:
    """(anchor, slot, score, id): the first ``k`` rows of every anchor and slot in each block of rows.

    Without windows an anchor has the slot 0, of the rows of its label; with them a slot for each of its ``windows``
    (low, high), of the rows of other labels. Blocks are dealt by hash, so none is larger for what its rows hold.
    """
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    deal = lambda n: F.pmod(F.xxhash64("no"), F.lit(n)).cast("int")
    windows = F.col("windows") if windowed else F.array().cast("array<struct<low:bigint,high:bigint>>")
    asked = anchors.select(deal(blocks[0]).alias("a"), each(blocks[1]).alias("r"), "dim", F.lit(0).alias("kind"), "no", "id", "label", "vec", windows.alias("windows"))
    met = rows.select(each(blocks[0]).alias("a"), deal(blocks[1]).alias("r"), "dim", F.lit(1).alias("kind"), "no", "id", "label", "vec",
                      F.lit(None).cast("array<struct<low:bigint,high:bigint>>").alias("windows"))
    dealt = asked.unionByName(met).repartition("a", "r").sortWithinPartitions("a", "r", "dim", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, block = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([batch.column(c).to_numpy() for c in range(4)])
            starts = np.flatnonzero(np.concatenate([[True], np.any(keys[1:] != keys[:-1], axis=1)]))
            for begin, end in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)]):
                part = batch.slice(begin, end - begin)
                if tuple(keys[begin][:3]) != group:
                    if block:
                        yield from block.rows()
                    group, block = tuple(keys[begin][:3]), _Block(int(keys[begin][2]), bound, k, windowed)
                if keys[begin][3] == 0:
                    block.take(part)
                else:
                    block.meet(part)
        if block:
            yield from block.rows()

    return dealt.mapInArrow(run, "anchor bigint, slot int, score bigint, id bigint")


class _Block:
    """A block of anchors of one dimension and the best rows they have met."""

    def __init__(self, dim: int, bound: int, k: int, windowed: bool) -> None:
        self.dim, self.k, self.windowed, self.primes = dim, k, windowed, primes_for(dim, bound)
        self.taken: list[pa.RecordBatch] = []
        self.best: list[Best] | None = None

    def take(self, anchors: pa.RecordBatch) -> None:
        self.taken.append(anchors)

    def _ready(self) -> None:
        whole = pa.Table.from_batches(self.taken).combine_chunks().to_batches()[0]
        self.no, self.label = whole.column(4).to_numpy(), whole.column(6).to_numpy()
        self.id, self.unnamed = whole.column(5).fill_null(0).to_numpy(), whole.column(5).is_null().to_numpy(zero_copy_only=False)
        self.x = residues(_matrix(whole.column(7), self.dim), self.primes)
        slots = 1
        if self.windowed:
            lists = whole.column(8)
            n = lists.value_lengths().to_numpy()
            slots = int(n.max(initial=0))
            # Windows an anchor does not have hold no score.
            self.low, self.high = np.full((slots, len(n)), 1, np.int64), np.zeros((slots, len(n)), np.int64)
            whose, nth = np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            flat = lists.flatten()
            self.low[nth, whose], self.high[nth, whose] = flat.field("low").to_numpy(), flat.field("high").to_numpy()
        self.best = [Best(len(self.no), self.k) for _ in range(slots)]

    def meet(self, rows: pa.RecordBatch) -> None:
        if not self.taken:
            return
        if self.best is None:
            self._ready()
        y = residues(_matrix(rows.column(7), self.dim), self.primes)
        ids, unnamed = rows.column(5).fill_null(0).to_numpy(), rows.column(5).is_null().to_numpy(zero_copy_only=False)
        label = rows.column(6).to_numpy()
        for b in range(0, len(ids), TILE[1]):
            tile = slice(b, b + TILE[1])
            for a in range(0, len(self.no), TILE[0]):
                own = slice(a, a + TILE[0])
                score = scores([x[own] for x in self.x], [x[tile] for x in y], self.primes)
                same = self.label[own][:, None] == label[tile][None]
                if not self.windowed:
                    itself = (self.id[own][:, None] == ids[tile][None]) & ~self.unnamed[own][:, None] & ~unnamed[tile][None]
                    self.best[0].offer(a, score, same & ~itself, ids[tile], unnamed[tile])
                    continue
                for slot, best in enumerate(self.best):
                    inside = ~same & (score >= self.low[slot, own][:, None]) & (score <= self.high[slot, own][:, None])
                    best.offer(a, score, inside, ids[tile], unnamed[tile])

    def rows(self) -> Iterator[pa.RecordBatch]:
        for slot, best in enumerate(self.best or []):
            place, minus, unnamed, name = best.parts
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.no[place], pa.int64()), pa.array(np.full(len(place), slot, np.int32)), pa.array(-minus, pa.int64()),
                 pa.array(name, pa.int64(), mask=unnamed.astype(bool))], ["anchor", "slot", "score", "id"])


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, key: str = "vec_id", label: str = "label", vector: str = "embedding",
                   positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score: the hard negatives of every anchor.

    Anchors are the rows for which ``is_anchor``, a condition on ``id`` and ``label``, holds. An anchor's positives are its
    first rows of the same label and another key; for each the first rows of other labels are taken with low * positive
    <= 100 * negative <= high * positive. First is the higher score, then the smaller key, null last. Which rows take no
    part says ``whole_vectors``; rows equal in key, label and whole components are one, rows that share only the key
    are rows of their own (but not positives of one another), a null key is no anchor's unless ``is_anchor`` says so
    and differs from every key. Vectors of different lengths never meet. Keys and labels are whole numbers; other
    columns are ignored. With 0 <= low < high <= 100, whole numbers, a positive below zero opens no window.
    """
    spark = vectors.sparkSession
    place = fresh_dir(spark, "whole-vectors")
    whole_vectors(vectors, key, label, vector, scale).withColumn("no", F.monotonically_increasing_id()).write.parquet(f"{place}/rows")
    rows = spark.read.parquet(f"{place}/rows")
    anchors = rows.filter(is_anchor)
    norm = F.aggregate("vec", F.lit(0).cast("bigint"), lambda s, x: s + x.cast("bigint") * x.cast("bigint"))
    marked = F.coalesce(is_anchor, F.lit(False))
    n, cells, n_anchors, anchor_cells, bound = rows.agg(
        F.count("*"), F.sum("dim"), F.count_if(marked), F.sum(F.when(marked, F.col("dim"))), F.max(norm)).first()
    a_blocks = max(1, ceil((anchor_cells or 0) / ANCHOR_CELLS))
    # Rows are cut finer than memory asks where that gives every core a block.
    r_blocks = max(1, ceil((cells or 0) / ROW_CELLS), min(ceil(spark.sparkContext.defaultParallelism / a_blocks), ceil(n / LEAST_ROWS)))
    blocks, bound = (a_blocks, r_blocks), int(bound or 0)

    _first(_best_rows(rows, anchors, blocks, bound, positives, False), positives).write.parquet(f"{place}/positives")
    first = spark.read.parquet(f"{place}/positives").filter("score >= 0")
    opened = first.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct(  # at most ``positives`` of them
        "nth", F.expr(f"({low} * score + 99) div 100").alias("low"), F.expr(f"{high} * score div 100").alias("high")))).alias("w"))
    windows = F.transform("w", lambda w: F.struct(w["low"].alias("low"), w["high"].alias("high")))
    asking = anchors.join(opened.select(F.col("anchor").alias("no"), windows.alias("windows")), "no")
    chosen = _first(_best_rows(rows, asking, blocks, bound, negatives, True), negatives)
    named = (first.select("anchor", (F.col("nth") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
             .join(anchors.select(F.col("no").alias("anchor"), F.col("id").alias("anchor_id")), "anchor"))
    return chosen.join(named, ["anchor", "slot"]).select(
        "anchor_id", "positive_id", F.col("nth").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.select("vec_id", "embedding", label.alias("label")), F.col("id") % 100 == 0)


OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id AS id, b.label, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS n FROM s WHERE label = anchor_label AND id <> anchor_id)
  WHERE n <= 5),
ranked AS (
  SELECT p.anchor_id, positive_id, id, positive_score, score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS n
  FROM p JOIN s ON p.anchor_id = s.anchor_id
  WHERE label <> anchor_label AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(n AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score FROM ranked WHERE n <= 10
"""
