"""Embedding near-duplicates by product quantisation: coarse inverted lists, residual subspace codes,
asymmetric distances from look-up tables, exact cosine for what is left.

The quantiser is fitted on a bounded sample; every vector is indexed and every vector asks.

* Probes: two vectors within ``r`` of one another in different lists stand on either side of the border between
  the lists' centroids, and their distances from it add up to at most r. So one of them is within r / 2 of it,
  whatever the dimension: each asks the lists whose border is that near, and no link is missed, though some are
  found from one side only. The list's ball bounds the probes exactly too.
* Codes: the distance to a code differs from the distance to its vector by at most the code's own error,
  which is kept with the code, so no link is lost to the codes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.llm.common import checkpointed, connected_components, table

COSINE = 0.9
SAMPLE_ROWS = 20_000
MAX_LISTS = 1024
LIST_ROWS = 128
PARTS = 8
CODES = 64
BLOCK_ROWS = 4096
SLACK = 1e-5  # for rounding in the bounds; the last test is exact


@dataclass
class Quantiser:
    """Centroids of the lists (lists, dim) and codebooks of the residuals (parts, codes, dim / parts)."""

    centroids: np.ndarray
    books: np.ndarray

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """List of each vector, and its distance to every centroid."""
        d = np.sqrt(np.maximum(0, (x ** 2).sum(1)[:, None] + (self.centroids ** 2).sum(1)[None] - 2 * x @ self.centroids.T))
        return d.argmin(1), d

    def encode(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (rows, parts) of the residuals, and how far each vector is from what its code stands for."""
        residual = x - self.centroids[lists]
        codes, error = np.empty((len(x), len(self.books)), np.uint8), np.zeros(len(x))
        for p, (book, part) in enumerate(zip(self.books, np.split(residual, len(self.books), axis=1))):
            d = (part ** 2).sum(1)[:, None] + (book ** 2).sum(1)[None] - 2 * part @ book.T
            codes[:, p] = d.argmin(1)
            error += ((part - book[codes[:, p]]) ** 2).sum(1)
        return codes, np.sqrt(error)

    def tables(self, q: np.ndarray, at: int) -> np.ndarray:
        """(parts, codes, queries): squared distances of every code of every part to every query, relative to the list's
        centroid. In single precision, of which ``SLACK`` is many times the error."""
        parts, _, width = self.books.shape
        residual = (q - self.centroids[at]).T.reshape(parts, width, len(q)).astype(np.float32)
        books = self.books.astype(np.float32)
        out = np.matmul(-2 * books, residual)
        out += (books ** 2).sum(2)[:, :, None]
        out += (residual ** 2).sum(1)[:, None, :]
        return out

    def within(self, q: np.ndarray, at: int, codes: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, row of the list at ``at``) whose code is within the row's reach of the query."""
        look_up = self.tables(q, at)
        distance = look_up[0][codes[:, 0]]
        for p in range(1, codes.shape[1]):
            distance += look_up[p][codes[:, p]]
        row, query = np.nonzero(distance <= (reach ** 2 + SLACK).astype(np.float32)[:, None])
        return query, row


def _k_means(x: np.ndarray, k: int, rounds: int = 8, seed: int = 11) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.permutation(len(x))[:k]]
    for _ in range(rounds):
        near = ((centres ** 2).sum(1)[None] - 2 * x @ centres.T).argmin(1)
        n = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def fit(sample: np.ndarray, rows: int, parts: int = PARTS, codes: int = CODES) -> Quantiser:
    """A quantiser for about ``rows`` unit vectors from a sample of them."""
    dim = sample.shape[1]
    parts = next(p for p in range(min(parts, dim), 0, -1) if dim % p == 0)
    lists = max(1, min(MAX_LISTS, ceil(rows / LIST_ROWS), len(sample)))
    centroids = _k_means(sample, lists)
    near = ((centroids ** 2).sum(1)[None] - 2 * sample @ centroids.T).argmin(1)
    residual = sample - centroids[near]
    books = [_k_means(part, min(codes, len(part))) for part in np.split(residual, parts, axis=1)]
    return Quantiser(centroids, np.stack(books))


def unit_classes(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """(class rows, members): equal vectors are one class, (class, vec, copies, first), with its smallest key.

    Classes are named by numbers of their own, as a class may have no key but null; they are checkpointed, so that
    the numbers stay.

    Vectors that are null or zero, or hold a null, a NaN or an infinity, are in no class; vectors of unequal
    lengths never meet. Members are all rows with their class, null for those in none.
    """
    v = F.col(vector).cast("array<double>")
    fit_to_compare = (v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
                      & F.exists(v, lambda x: x != 0))
    rows = vectors.select(F.col(key).alias("key"), F.when(fit_to_compare, v).alias("vec"))
    classes = rows.filter("vec IS NOT NULL").groupBy("vec").agg(F.min("key").alias("first"), F.count("*").alias("copies"))
    classes = checkpointed(classes.withColumn("class", F.monotonically_increasing_id()))
    named = classes.select(F.col("vec").alias("_vec"), "class", "copies")
    return classes, rows.join(named, rows["vec"] == named["_vec"], "left").select("key", "class", "copies")


def _vector(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def links(classes: DataFrame, cosine: float = COSINE, block_rows: int = BLOCK_ROWS, spread: float | None = None) -> DataFrame:
    """(kind, a, b, n) over classes of one dimension: per class the copies of the classes linked to it (kind 0), and
    links (a, b) that connect what is connected (kind 1).

    A vector is indexed in its own list, and asks in every list that its bounds leave. A list of more than
    ``block_rows`` rows is dealt into blocks, and so are those that ask in it, so a task holds one block of
    each. A pair whose ends ask each other's lists is found twice and counted for the asker each time; one found from
    one side only is counted for both ends there, so each index row brings the lists it asks. Only spanning links
    come out, not all pairs.
    """
    spark = classes.sparkSession
    n = classes.count()
    if not n:
        return spark.createDataFrame([], "kind int, a bigint, b bigint, n bigint")
    sample_rows = classes.orderBy(F.xxhash64("class")).limit(SAMPLE_ROWS).select("vec").toPandas()["vec"]
    sample = np.stack([np.asarray(v, float) for v in sample_rows])
    sample /= np.linalg.norm(sample / np.abs(sample).max(1, keepdims=True), axis=1, keepdims=True) * np.abs(sample).max(1, keepdims=True)
    quantiser, dim = fit(sample, n), sample.shape[1]
    radius = sqrt(2 - 2 * cosine) + SLACK
    beyond = radius / 2 if spread is None else radius * min(0.5, spread / sqrt(dim))

    def unit(x: np.ndarray) -> np.ndarray:
        x = x / np.abs(x).max(1, keepdims=True)
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    # Ball of each list: the farthest of its vectors. As many rows as lists, at most MAX_LISTS.
    def balls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        far, size = np.zeros(len(quantiser.centroids)), np.zeros(len(quantiser.centroids), np.int64)
        for batch in batches:
            if batch.num_rows:
                lists, d = quantiser.nearest(unit(_vector(batch.column(0), dim)))
                np.maximum.at(far, lists, d[np.arange(len(lists)), lists])
                size += np.bincount(lists, minlength=len(size))
        yield pa.RecordBatch.from_pydict({"list": np.arange(len(far), dtype=np.int32), "far": far, "size": size})

    rows = classes.select("vec").mapInArrow(balls, "list int, far double, size bigint").groupBy("list").agg(F.max("far"), F.sum("size")).collect()
    far, size = np.zeros(len(quantiser.centroids)), np.zeros(len(quantiser.centroids), np.int64)
    for at, d, m in rows:
        far[at], size[at] = d, m
    blocks = np.maximum(1, -(-size // block_rows)).astype(np.int64)
    between = np.sqrt(np.maximum(0, (quantiser.centroids ** 2).sum(1)[:, None] + (quantiser.centroids ** 2).sum(1)[None]
                                 - 2 * quantiser.centroids @ quantiser.centroids.T))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector once as an index row, and as a query once per block of every list it has to ask in."""
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit(_vector(batch.column(1), dim))
            ids, copies = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            own, d = quantiser.nearest(x)
            mine = d[np.arange(len(x)), own]
            border = (d ** 2 - mine[:, None] ** 2) <= 2 * beyond * between[own] + SLACK
            asks = border & (d <= radius + far[None] + SLACK) & (size > 0)[None]
            told = np.packbits(asks, axis=1, bitorder="little")
            i, at = np.nonzero(asks)
            asked = blocks[at]
            i, at = np.repeat(i, asked), np.repeat(at, asked)
            block = np.concatenate([np.arange(b) for b in asked]) if len(asked) else np.empty(0, np.int64)
            place = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
            # Queries are dealt into blocks like the rows of their own list, so that neither side grows.
            query = (at, block, place[i] % np.maximum(1, blocks[at]), i, np.ones(len(i), np.int64))
            # An index block is sent to every block of queries that may ask it.
            spread = np.repeat(np.arange(len(x)), blocks[own])
            turn = np.concatenate([np.arange(b) for b in blocks[own]])
            index = (own[spread], place[spread] % blocks[own][spread], turn, spread, np.zeros(len(spread), np.int64))
            for start in range(0, len(index[0]) + len(query[0]), 20_000):
                both = [np.concatenate([a, b])[start:start + 20_000] for a, b in zip(index, query)]
                who = both[3]
                flat = pa.array(x[who].reshape(-1))
                vectors = pa.ListArray.from_arrays(pa.array(np.arange(0, len(who) * dim + 1, dim), pa.int32()), flat)
                # Only index rows tell what they ask; a query's are empty.
                ends = np.concatenate([[0], np.cumsum(np.where(both[4] == 0, told.shape[1], 0))]).astype(np.int32)
                lists = pa.Array.from_buffers(pa.binary(), len(who), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(told[who[both[4] == 0]].tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(both[0], pa.int32()), pa.array(both[1], pa.int32()), pa.array(both[2], pa.int32()), pa.array(both[4], pa.int32()),
                     pa.array(ids[who], pa.int64()), pa.array(copies[who], pa.int64()), vectors,
                     pa.array(own[who], pa.int32()), lists],
                    ["list", "block", "turn", "kind", "id", "copies", "unit", "own", "asks"])

    dealt = (classes.select("class", "vec", "copies")
             .mapInArrow(deal, "list int, block int, turn int, kind int, id bigint, copies bigint, unit array<double>, own int, asks binary"))
    met = dealt.repartition("list", "block", "turn").sortWithinPartitions("list", "block", "turn", "kind")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lettermill.llm.simhash import _roots

        group, held, ids, copies, told, codes, error = None, [], None, None, None, None, None
        counts: list[tuple[np.ndarray, np.ndarray]] = []
        spanning: list[tuple[np.ndarray, np.ndarray]] = []

        def index(at: int) -> None:
            nonlocal held, ids, copies, told, codes, error
            x, ids, copies, told = (np.concatenate([h[k] for h in held]) for k in range(4))
            codes, error = quantiser.encode(x, np.full(len(x), at))
            held = [(x, ids, copies, told)]

        def ask(at: int, q: np.ndarray, who: np.ndarray, m: np.ndarray, own: np.ndarray) -> None:
            x = held[0][0]
            for a in range(0, len(q), 256):
                part, name, of, home = q[a:a + 256], who[a:a + 256], m[a:a + 256], own[a:a + 256]
                # Not farther than the radius, but for the code's own error.
                i, j = quantiser.within(part, at, codes, radius + error + SLACK)
                if not len(i):
                    continue
                near = np.concatenate([np.einsum("ij,ij->i", part[i[s:s + 100_000]], x[j[s:s + 100_000]]) for s in range(0, len(i), 100_000)])
                keep = (near >= cosine) & (name[i] != ids[j])
                i, j = i[keep], j[keep]
                if not len(i):
                    continue
                counts.append((name, np.bincount(i, copies[j], len(part)).astype(np.int64)))
                # Those found that do not ask in the asker's own list will not find it: the link is theirs too.
                alone = (told[j, home[i] >> 3] >> (home[i] & 7) & 1) == 0
                if alone.any():
                    there, back = np.unique(j[alone], return_inverse=True)
                    counts.append((ids[there], np.bincount(back, of[i[alone]]).astype(np.int64)))
                nodes, place = np.unique(np.concatenate([name[i], ids[j]]), return_inverse=True)
                root = _roots(len(nodes), place[:len(i)], place[len(i):])
                moved = root != np.arange(len(nodes))
                spanning.append((nodes[moved], nodes[root[moved]]))

        def out() -> Iterator[pa.RecordBatch]:
            if counts:
                a, m = (np.concatenate([c[k] for c in counts]) for k in (0, 1))
                a, m = a[m > 0], m[m > 0]
                b, c = (np.concatenate([s[k] for s in spanning]) for k in (0, 1))
                counts.clear()
                spanning.clear()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([0, 1], [len(a), len(b)]), pa.int32()), pa.array(np.concatenate([a, b]), pa.int64()),
                     pa.array(np.concatenate([np.zeros(len(a), np.int64), c]), pa.int64()),
                     pa.array(np.concatenate([m, np.zeros(len(b), np.int64)]), pa.int64())], ["kind", "a", "b", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([batch.column(c).to_numpy() for c in range(4)])
            new = np.concatenate([[0], np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1, [len(keys)]])
            for a, b in zip(new[:-1].tolist(), new[1:].tolist()):
                at, kind = tuple(keys[a][:3]), keys[a][3]
                part = batch.slice(a, b - a)
                x, who, m = _vector(part.column(6), dim), part.column(4).to_numpy(), part.column(5).to_numpy()
                if at != group:
                    group, held, codes = at, [], None
                if kind == 0:
                    held.append((x, who, m, np.frombuffer(b"".join(part.column(8).to_pylist()), np.uint8).reshape(len(x), -1)))
                elif held:
                    if codes is None:
                        index(int(at[0]))
                    ask(int(at[0]), x, who, m, part.column(7).to_numpy())
            yield from out()

    return met.mapInArrow(compare, "kind int, a bigint, b bigint, n bigint")


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE,
                 spread: float | None = None) -> DataFrame:
    """key, n_links, component_id and kept of every row: links are other rows at ``cosine`` or more.

    Links below ``cosine`` are never made; those at or above it are all found. Only a caller that gives a ``spread``
    narrows the lists asked to borders within spread * r / sqrt(dim), and then links can be missed. ``component_id`` is the smallest key reachable by links, the row itself included. Equal vectors are
    compared once, as a class. What ``unit_classes`` puts in no class links with nothing, and vectors of
    different lengths do not link; each length is a round of its own. Keys are whole numbers; a row with a
    null key links like others but names a component only with null; rows of one key are rows like any others.
    """
    classes, members = unit_classes(vectors, key, vector)
    lengths = [r[0] for r in classes.select(F.size("vec")).distinct().collect()]
    found = None
    for length in lengths:
        own = checkpointed(links(classes.filter(F.size("vec") == length), cosine, spread=spread))
        found = own if found is None else found.unionByName(own)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "kind int, a bigint, b bigint, n bigint")
    counted = found.filter("kind = 0").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("linked"))
    components = connected_components(found.filter("kind = 1").select("a", "b"))
    placed = (classes.select("class", "first").join(counted, "class", "left").join(components.withColumnRenamed("node", "class"), "class", "left")
              .withColumn("component", F.coalesce("component", "class")))
    smallest = placed.groupBy("component").agg(F.min("first").alias("smallest"))
    facts = placed.join(smallest, "component").select(
        F.col("class").alias("_class"), F.coalesce("linked", F.lit(0).cast("bigint")).alias("linked"), F.col("smallest").alias("component"))
    whole = members.join(facts, members["class"] == facts["_class"], "left")
    component = F.coalesce("component", "key")
    return whole.select(
        F.col("key").alias(key), F.coalesce(F.col("copies") - 1 + F.col("linked"), F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"), (F.col("key") == component).alias("kept"))


def op3_quantised(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP3_SQL = r"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
sound AS (SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
component AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v LEFT JOIN counted USING (vec_id) JOIN component USING (vec_id)
"""
