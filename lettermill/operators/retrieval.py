"""Exact vector search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lettermill.sources.scratch import fresh_dir

PIVOTS = 256  # lists the vectors are laid out in, by the nearest of so many of them
CELL_ROWS = 20_000  # vectors of a list that are compared in one go
SLACK = 1e-9  # for rounding in the bounds


def _unit(column: pa.Array) -> list[np.ndarray | None]:
    """Unit vectors; null for those that are null or zero, or hold a null, a NaN or an infinity."""
    out: list[np.ndarray | None] = []
    for value in column.to_pylist():
        v = np.array([np.nan if x is None else x for x in value or ()], float)
        most = np.abs(v).max(initial=0.0)
        v = v / most if most and np.isfinite(most) else None
        out.append(None if v is None or not np.isfinite(v).all() else v / np.linalg.norm(v))
    return out


def _angles(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ pivots.T, -1.0, 1.0))


def topk(queries: DataFrame, vectors: DataFrame, k: int, query_id: str = "query_id", vector_id: str = "vec_id", embedding: str = "embedding",
         digits: int = 6, exclude_self: bool = False, pivots: int = PIVOTS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(query_id, vec_id, similarity, rank): the ``k`` most cosine-similar vectors of each query.

    Exact. Similarity is rounded to ``digits`` before ranking; ties go to the smaller vector id. With
    ``exclude_self`` a query is not answered by the vector of its own id. A vector that is null or zero, or holds a null, a
    NaN or an infinity, has no similarity and is left out, on either side, as is a row without an id; vectors of
    different lengths never meet. Ids are whole numbers.

    Vectors are laid out in lists, by the nearest of ``pivots`` of them, drawn by a hash of their id. A list's vectors are
    within its radius of the pivot, so no vector of it is nearer to a query than the query's distance to the pivot less
    that radius. A query first asks the nearest lists that hold ``k`` vectors or more, whose k-th best similarity is the
    least an answer needs, and then only the lists whose bound reaches it. Lists are cut into blocks of about
    ``cell_rows``; a task holds one and streams the queries past it. What reaches the driver is a row per list.
    """
    spark, place = vectors.sparkSession, fresh_dir(vectors.sparkSession, "lists")
    drawn = (vectors.select(F.col(embedding).cast("array<double>").alias("v"), F.col(vector_id).alias("id"))
             .filter(F.col("v").isNotNull() & F.exists("v", lambda x: x != 0)).orderBy(F.xxhash64("id"), "id").limit(pivots).select("v").toArrow())
    found = [v for v in _unit(drawn.column(0).combine_chunks() if drawn.num_rows else pa.array([], pa.list_(pa.float64()))) if v is not None]
    by_length = {n: np.stack([v for v in found if len(v) == n]) for n in sorted({len(v) for v in found})}
    offsets, n_lists = {}, 0
    for n, own in by_length.items():
        offsets[n], n_lists = n_lists, n_lists + len(own)

    def place_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, list, angle, unit) of the vectors; one of a length that no pivot has makes the list of its length."""
        for batch in batches:
            rows = []
            for i, v in zip(batch.column(0).to_pylist(), _unit(batch.column(1))):
                if v is None:
                    continue
                if len(v) in by_length:
                    angles = _angles(v[None], by_length[len(v)])[0]
                    rows.append((i, offsets[len(v)] + int(angles.argmin()), float(angles.min()), v))
                else:
                    rows.append((i, -len(v), np.pi, v))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.float64(), pa.list_(pa.float64())))],
                                                 ["id", "list", "angle", "unit"])

    laid = vectors.select(F.col(vector_id).cast("bigint").alias("id"), F.col(embedding).cast("array<double>").alias("v")).filter("id IS NOT NULL")
    laid.mapInArrow(place_rows, "id bigint, list int, angle double, unit array<double>").write.parquet(f"{place}/vectors")
    rows = spark.read.parquet(f"{place}/vectors")
    lists = {r["list"]: (r["n"], r["radius"]) for r in rows.groupBy("list").agg(F.count("*").alias("n"), F.max("angle").alias("radius")).collect()}

    def asks(batches: Iterator[pa.RecordBatch], first: bool) -> Iterator[pa.RecordBatch]:
        """(query, unit, list, block) for every block a query has to ask: in the first turn until ``k`` vectors are met, in
        the second where the bound of a list reaches what the first turn found."""
        for batch in batches:
            out = []
            least = batch.column(2).to_pylist()
            for i, v, reach in zip(batch.column(0).to_pylist(), _unit(batch.column(1)), least):
                if v is None:
                    continue
                own = {}
                if len(v) in by_length:
                    for at, angle in enumerate(_angles(v[None], by_length[len(v)])[0].tolist()):
                        if offsets[len(v)] + at in lists:
                            own[offsets[len(v)] + at] = max(0.0, angle - lists[offsets[len(v)] + at][1])
                elif -len(v) in lists:
                    own[-len(v)] = 0.0
                held, turn_one = 0, set()
                for at in sorted(own, key=lambda a: (own[a], a)):
                    if held >= k + exclude_self:
                        break
                    turn_one.add(at)
                    held += lists[at][0]
                for at, angle in own.items():
                    # Half a digit more than the bound, as similarities are compared rounded.
                    if (at in turn_one) if first else (at not in turn_one and (reach is None or np.cos(angle) + SLACK + 10.0 ** -digits >= reach)):
                        out += [(i, v, at, b) for b in range(-(-lists[at][0] // cell_rows))]
            for begin in range(0, len(out), 10_000):
                part = out[begin:begin + 10_000]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), (pa.int64(), pa.list_(pa.float64()), pa.int32(), pa.int32()))],
                                                 ["id", "unit", "list", "block"])

    sizes = F.create_map(*[F.lit(x) for at, (n, _) in lists.items() for x in (at, -(-n // cell_rows))]) if lists else None

    def compared(asked: DataFrame) -> DataFrame:
        own = rows.select("list", F.pmod(F.xxhash64("id"), sizes[F.col("list")]).cast("int").alias("block"), F.lit(0).alias("kind"), "id", "unit")
        met = own.unionByName(asked.select("list", "block", F.lit(1).alias("kind"), "id", "unit"))
        return (met.repartition("list", "block").sortWithinPartitions("list", "block", "kind")
                .mapInArrow(lambda batches: _best(batches, k, digits, exclude_self), "query_id bigint, vec_id bigint, similarity double"))

    window = Window.partitionBy("query_id").orderBy(F.desc("similarity"), F.asc_nulls_last("vec_id"))
    ranked = lambda df: df.withColumn("rank", F.row_number().over(window).cast("bigint")).filter(F.col("rank") <= k)
    none = spark.createDataFrame([], "query_id bigint, vec_id bigint, similarity double, rank bigint")
    if not lists:
        return none
    told = queries.select(F.col(query_id).cast("bigint").alias("id"), F.col(embedding).cast("array<double>").alias("v")).filter("id IS NOT NULL")
    turn = "id bigint, unit array<double>, list int, block int"
    first = told.withColumn("reach", F.lit(None).cast("double")).mapInArrow(lambda b: asks(b, True), turn)
    ranked(compared(first)).write.parquet(f"{place}/first")
    near = spark.read.schema(none.schema).parquet(f"{place}/first")
    reach = near.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("similarity").alias("reach"))
    second = told.join(reach, "id", "left").select("id", "v", "reach").mapInArrow(lambda b: asks(b, False), turn)
    return ranked(near.drop("rank").unionByName(compared(second)))


def _best(batches: Iterator[pa.RecordBatch], k: int, digits: int, exclude_self: bool) -> Iterator[pa.RecordBatch]:
    """The ``k`` best of a block's vectors for each query that asks it; a block's vectors come before its queries."""
    group, ids, held = None, np.empty(0, np.int64), []
    matrix = np.empty((0, 0))
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.column_stack([batch.column(c).to_numpy() for c in range(3)])
        cuts = np.flatnonzero(np.concatenate([[True], np.any(keys[1:] != keys[:-1], axis=1)])).tolist()
        for begin, end in zip(cuts, [*cuts[1:], len(keys)]):
            part, at = batch.slice(begin, end - begin), tuple(keys[begin][:2])
            if at != group:
                group, held, matrix = at, [], np.empty((0, 0))
            if keys[begin][2] == 0:
                held.append(part)
                continue
            if held:
                whole = pa.Table.from_batches(held).combine_chunks()
                ids, held = whole.column(3).to_numpy(), []
                matrix = np.stack(whole.column(4).to_pylist()).astype(float)
            if not len(matrix):
                continue
            for first in range(0, part.num_rows, 256):
                asked = part.slice(first, 256)
                names = asked.column(3).to_numpy()
                similarity = np.round(np.stack(asked.column(4).to_pylist()).astype(float) @ matrix.T, digits) + 0.0
                if exclude_self:
                    similarity[names[:, None] == ids[None, :]] = -np.inf
                kth = np.full((len(names), 1), -np.inf)
                if similarity.shape[1] > k:
                    # All that reach the k-th value, so that ties are settled by id below.
                    kth = np.partition(similarity, similarity.shape[1] - k, axis=1)[:, -k][:, None]
                row, col = np.nonzero((similarity >= kth) & np.isfinite(similarity))
                order = np.lexsort((ids[col], -similarity[row, col], row))
                row, col = row[order], col[order]
                starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.empty(0, np.int64)
                nth = np.arange(len(row)) - np.repeat(starts, np.diff(np.append(starts, len(row))))
                row, col = row[nth < k], col[nth < k]
                yield pa.RecordBatch.from_pydict({"query_id": names[row], "vec_id": ids[col], "similarity": similarity[row, col]})


def build_index_table(chunks: DataFrame, vectors: DataFrame, key: list[str]) -> DataFrame:
    """Chunks with their vectors, ready to search; both sides are unique in the key."""
    return chunks.join(vectors, key)
