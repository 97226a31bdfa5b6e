"""SimHash near-duplicates: candidates that share blocks, pivot distance tables, verified distances.

Fingerprints of at most ``MAX_DISTANCE`` differing bits agree on two of six blocks of bits, so those are the
keys under which they meet. Every distinct fingerprint carries a table of its Hamming distances to reference
fingerprints, worked out once: by the triangle inequality two fingerprints are never closer than the largest
difference of their coordinates, so most pairs are discarded without being compared. Survivors are verified.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.llm.common import checkpointed, connected_components, row_hashes, table, tidy, unused

BITS = 64
MAX_DISTANCE = 4
SHINGLE = 4
SEED = 42
BLOCK_ROWS = 2048
PIVOTS = 32


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bit i is set if it is set in over half the hashes of the text's shingles; no words: 0.

    Words stand between ASCII white space, A-Z lowered; a text of fewer words than a shingle is one shingle.
    """
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate([[0], ends[:n - 1]]).tolist()
    stops = (ends[min(shingle, len(words)) - 1:] - 1).tolist()
    hashes = np.fromiter((xxh64_intdigest(line[a:b], seed) for a, b in zip(starts, stops)), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 65536):  # a long text is counted piece by piece
        part = hashes[at:at + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (ones * 2 > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(documents: DataFrame, text: str = "text", key: str = "doc_id", also: Sequence[str] = ()) -> DataFrame:
    """(key, fp, *also): the fingerprint of every row's whole text as a signed 64-bit number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64()), *batch.columns[2:]], ["key", "fp", *also])

    kinds = "".join(f", {c} {documents.schema[c].dataType.simpleString()}" for c in also)
    kind = documents.schema[key].dataType.simpleString()
    return documents.select(key, text, *also).mapInArrow(tidy(run), f"key {kind}, fp bigint{kinds}")


def pivots(count: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints far from one another: rows of a Hadamard matrix, as bits; those of most changes first."""
    rows = np.array([[1]], np.int8)
    while len(rows) < BITS:
        rows = np.block([[rows, rows], [rows, -rows]])
    rows = rows[np.argsort(-np.abs(np.diff(rows, axis=1)).sum(axis=1), kind="stable")]
    bits = (rows[:count] < 0).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).reshape(-1)


def pivot_table(values: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Hamming distance of every value to every reference."""
    return np.bitwise_count(values[:, None] ^ references[None, :]).astype(np.int8)


def with_distances(distinct: DataFrame) -> DataFrame:
    """(fp, coordinates): the fingerprints with their distances to all references, a byte each."""
    references = pivots()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table_of = pivot_table(batch.column(0).to_numpy().view(np.uint64), references)
            ends = np.arange(0, table_of.size + 1, len(references), dtype=np.int32)
            cells = pa.Array.from_buffers(pa.binary(), len(table_of), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(table_of.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0), cells], ["fp", "coordinates"])

    return distinct.select("fp").mapInArrow(tidy(run), "fp bigint, coordinates binary")


def close_pairs(a: np.ndarray, b: np.ndarray, table_a: np.ndarray, table_b: np.ndarray, distance: int = MAX_DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) where a[i] and b[j] differ in at most ``distance`` bits.

    The coordinates are compared reference after reference, and a pair is gone with the first difference
    over ``distance``; only the pairs left by all are verified on the fingerprints.
    """
    i, j = np.nonzero(np.abs(table_a[:, None, 0] - table_b[None, :, 0]) <= distance)
    for r in range(1, table_a.shape[1]):
        if not len(i):
            break
        keep = np.abs(table_a[i, r] - table_b[j, r]) <= distance
        i, j = i[keep], j[keep]
    keep = np.bitwise_count(a[i] ^ b[j]) <= distance
    return i[keep], j[keep]


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest place reachable from each place over the links (i, j)."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if np.array_equal(root, before):
            return root


def _links(group: np.ndarray, coordinates: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span a group: each fingerprint to the smallest place it reaches here."""
    group, first = np.unique(group, return_index=True)
    coordinates = coordinates[first]
    every_i, every_j = [], []
    for a in range(0, len(group), half):
        for b in range(a, len(group), half):
            i, j = close_pairs(group[a:a + half], group[b:b + half], coordinates[a:a + half], coordinates[b:b + half])
            i, j = i + a, j + b
            every_i.append(i[i < j])
            every_j.append(j[i < j])
    i, j = np.concatenate(every_i), np.concatenate(every_j)
    if not len(i):
        return group[:0], group[:0]
    root = _roots(len(group), i, j)
    moved = root != np.arange(len(group))
    return group[moved], group[root[moved]]


BLOCKS = [(BITS * k // 6, BITS * (k + 1) // 6) for k in range(6)]


def block_keys(fp) -> "F.Column":
    """The keys of a fingerprint: for each two of six blocks of bits, their bits and which two they are."""
    part = [F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in BLOCKS]
    pairs = list(combinations(range(6), 2))
    return F.array(*[
        F.lit(n << 22).cast("bigint").bitwiseOR(F.shiftleft(part[x], 11)).bitwiseOR(part[y]) for n, (x, y) in enumerate(pairs)])


def link_edges(distinct: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b): links that connect what is connected among the distinct fingerprints ``fp``.

    Every fingerprint goes to 15 keys. A key with more than ``block_rows`` fingerprints is dealt into blocks
    of about that many, and every two blocks of a key meet in a group of their own, so no task holds more
    than two blocks whatever the key. Of a group only spanning links come out, at most one per
    fingerprint, not all pairs.
    """
    known = with_distances(distinct)
    keyed = distinct.select("fp", F.explode(block_keys(F.col("fp"))).alias("k"))
    counts = keyed.groupBy("k").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / block_rows).cast("int")
    met = known.select("fp", "coordinates", F.explode(block_keys(F.col("fp"))).alias("k")).join(counts, "k").withColumn("m", blocks)
    own = F.pmod(F.xxhash64("fp"), F.col("m")).cast("int")
    # The groups block x belongs to: (x, y) for every y, told as the smaller and the larger of the two.
    dealt = met.withColumn("x", own).select(
        "fp", "k", "coordinates", F.explode(F.transform(F.sequence(F.lit(0), F.col("m") - 1), lambda y: F.struct(
            F.least("x", y).alias("lo"), F.greatest("x", y).alias("hi")))).alias("g"))
    grouped = (dealt.select("fp", "k", "g.lo", "g.hi", "coordinates").repartition("k", "lo", "hi").sortWithinPartitions("k", "lo", "hi"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_cells = np.empty((0, 4), np.int64), np.empty((0, PIVOTS), np.int8)

        def out(rows: np.ndarray, cells: np.ndarray) -> Iterator[pa.RecordBatch]:
            new = np.flatnonzero(np.any(rows[1:, 1:] != rows[:-1, 1:], axis=1)) + 1
            bounds = np.concatenate([[0], new, [len(rows)]])
            size = np.diff(bounds)
            values = rows[:, 0].copy().view(np.uint64)
            # Groups of two are the most frequent by far: all at once.
            two = bounds[:-1][size == 2]
            keep = np.abs(cells[two] - cells[two + 1]).max(axis=1, initial=0) <= MAX_DISTANCE
            keep[keep] = np.bitwise_count(values[two[keep]] ^ values[two[keep] + 1]) <= MAX_DISTANCE
            pair = values[two[keep]], values[two[keep] + 1]
            a, b = [np.maximum(*pair)], [np.minimum(*pair)]
            for at in np.flatnonzero(size > 2):
                x, y = _links(values[bounds[at]:bounds[at + 1]], cells[bounds[at]:bounds[at + 1]], 512)
                a.append(x)
                b.append(y)
            a, b = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
            if len(a):
                yield pa.RecordBatch.from_pydict({"a": a, "b": b})

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(4)])
            cells = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.int8).reshape(-1, PIVOTS)
            rows, cells = np.concatenate([held, rows]), np.concatenate([held_cells, cells])
            last = rows[-1, 1:]
            whole = len(rows) - int(np.argmax(np.any(rows[::-1, 1:] != last, axis=1)) or len(rows))
            held, held_cells = rows[whole:], cells[whole:]
            if whole:
                yield from out(rows[:whole], cells[:whole])
        if len(held):
            yield from out(held, held_cells)

    return grouped.mapInArrow(tidy(run), "a bigint, b bigint")


def _placed(marked: DataFrame) -> DataFrame:
    """(fp, component, component_id) of every fingerprint of ``marked`` (key, fp): a name of its component, never null,
    and the smallest key in it."""
    classes = marked.groupBy("fp").agg(F.min("key").alias("first"))
    edges = checkpointed(link_edges(classes.select("fp")).distinct())
    components = connected_components(edges)
    joined = classes.join(components, classes["fp"] == components["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))
    smallest = joined.groupBy("component").agg(F.min("first").alias("component_id"))
    return joined.join(smallest, "component").select("fp", "component", "component_id")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, fingerprint and component_id of every row of ``documents`` (doc_id, text).

    Fingerprints link at up to 4 differing bits; ``component_id`` is the smallest doc_id reachable. Documents
    of one fingerprint are one class, so copies are never compared with one another. Null and blank texts
    have fingerprint 0 and are linked like any other. A null doc_id gets a class like the others but is
    never a component's id unless all are null. Repeated rows come out as often as they come in.
    """
    marked = checkpointed(fingerprints(documents))
    return marked.join(_placed(marked).select("fp", "component_id"), "fp").select(
        F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(documents: DataFrame) -> DataFrame:
    """Of every component one row: the one with the smallest doc_id; the columns stay, whatever their names.

    Where that doc_id has several rows in the component, the first by a hash of the row stays. A row without a
    doc_id stays only if its component has no row with one, and then the first by that hash. Rows of one doc_id in
    several components are chosen in each for themselves.
    """
    one, two = unused(documents.columns, "row_one", "row_two")
    told = documents.withColumns(dict(zip((one, two), row_hashes(documents))))
    marked = checkpointed(fingerprints(told, also=[one, two]))
    first = F.min(F.struct(F.col("key").isNull().alias("without"), "key", one, two)).alias("kept")
    kept = marked.join(_placed(marked), "fp").groupBy("component").agg(first).select(f"kept.{one}", f"kept.{two}")
    return told.join(kept, [one, two], "left_semi").dropDuplicates([one, two]).drop(one, two)


def op8_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
