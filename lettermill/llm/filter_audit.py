"""What filters do to one another: counters per part and mask of failed filters, kept by a stream that retracts.

All files come in as available-now micro-batches. A document's mask says which of the filters it fails; all but one
depend on its text alone. The last, a smaller id with the same text, depends on every other document, also on those yet
to come: the state keeps of every text the rows with its smallest id so far. When a smaller one arrives, their masks are
taken back from the counters and counted anew as failing. Deltas are written per micro-batch under its number, so a batch
that is run again replaces what it wrote.

Texts are keyed by a hash, many to a key, and the number of keys grows with the table: a call of the state function
handles a few thousand texts at once, and no key holds more. Copies within a batch of rows are settled where they
are read, so a text that a third of all rows share sends a row per batch to its key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lettermill.llm.common import fresh_dir, table

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT = 50  # percent of the words
MAX_CAPITALS = 2  # percent of the code points
MARKS = b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COPY = 16  # the bit of the last filter
BATCHES = 4
TEXTS_PER_KEY = 4096
COUNTERS = "part string, mask int, n bigint, good bigint, toxic bigint"


def mask_of(text: bytes, code_points: int) -> int:
    """The bits of the filters A to D that a text fails."""
    words = text.split()  # of bytes: at ASCII white space
    n = len(words)
    return ((n < MIN_WORDS) + 2 * (100 * len(set(words)) < MIN_DISTINCT * n)
            + 4 * (100 * (len(text) - len(text.translate(None, CAPITALS))) > MAX_CAPITALS * code_points)
            + 8 * (len(text.translate(None, MARKS)) < len(text)))


FACTS = "digest binary, doc_id bigint, mask int, part string, n bigint"


def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, doc_id, mask, part, n) of rows (doc_id, text in bytes, code points, part).

    ``digest`` is null where the batch itself holds a smaller id with the text: such a row is a copy for certain. Rows
    without an id are counted together.
    """
    for batch in batches:
        found: dict[bytes, int] = {}
        ids, parts = batch.column(0).to_pylist(), batch.column(3).to_pylist()
        digests, masks, least = [], [], {}
        for i, text, size in zip(ids, batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            text = text or b""
            digest = hashlib.sha256(text).digest()[:16]
            if digest not in found:
                found[digest] = mask_of(text, size or 0)
            digests.append(digest)
            masks.append(found[digest])
            if i is not None and i < least.get(digest, i + 1):
                least[digest] = i
        rows, unnamed = [], {}
        for i, digest, mask, part in zip(ids, digests, masks, parts):
            open_digest = digest if i == least.get(digest) else None
            if i is not None:
                rows.append((open_digest, i, mask, part, 1))
            else:
                key = (open_digest, None, mask, part)
                unnamed[key] = unnamed.get(key, 0) + 1
        rows += [(*key, n) for key, n in unnamed.items()]
        if rows:
            types = [pa.binary(), pa.int64(), pa.int32(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["digest", "doc_id", "mask", "part", "n"])


HELD = ["digest", "doc_id", "unnamed", "mask", "part", "good", "toxic", "n"]
_HELD = pa.schema([("digest", pa.binary()), ("doc_id", pa.int64()), ("unnamed", pa.bool_()), ("mask", pa.int32()), ("part", pa.string()),
                   ("good", pa.bool_()), ("toxic", pa.bool_()), ("n", pa.int64())])


def _pack(rows: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _HELD, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(pa.Table.from_pandas(rows[HELD], _HELD, preserve_index=False))
    return sink.getvalue().to_pybytes()


def _unpack(value: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(value).read_all().to_pandas()


def settle(held: pd.DataFrame | None, new: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """(what is held now, signed counter rows), given what was held and the rows that arrive."""
    sums = ["part", "mask", "n", "good", "toxic"]
    copies = new[new["digest"].isna()]
    copies = copies.assign(mask=copies["mask"] | COPY)
    arrived = new[new["digest"].notna()]
    both = pd.concat([arrived] if held is None else [held, arrived], ignore_index=True)
    was = np.arange(len(both)) < (0 if held is None else len(held))
    order = np.lexsort((both["doc_id"], both["unnamed"], both["digest"]))
    first = both.iloc[order].drop_duplicates("digest").set_index("digest")
    least = first.loc[both["digest"]]
    kept = (both["unnamed"].to_numpy() == least["unnamed"].to_numpy()) & (both["doc_id"].to_numpy() == least["doc_id"].to_numpy())
    back = both[was & ~kept]
    deltas = pd.concat([
        copies[sums], both[~was & kept][sums], both[~kept].assign(mask=both["mask"][~kept] | COPY)[sums], back.assign(n=-back["n"])[sums]])
    deltas = deltas.assign(good=deltas["n"] * deltas["good"].astype("int64"), toxic=deltas["n"] * deltas["toxic"].astype("int64"))
    now = both[kept].groupby([c for c in HELD if c != "n"], as_index=False, sort=False)["n"].sum()
    return now, deltas.groupby(["part", "mask"], as_index=False)[["n", "good", "toxic"]].sum()


def _state(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    held = _unpack(state.get[0]) if state.exists else None
    now, deltas = settle(held, pd.concat(list(frames), ignore_index=True))
    if len(now):
        state.update((_pack(now),))
    yield deltas


def marked(labels: DataFrame) -> DataFrame:
    """(marked_id, good, toxic) of the labelled ids that are either, each once."""
    flag = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    return (labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("marked_id"))
            .agg(flag("quality").alias("good"), flag("toxic").alias("toxic")).filter("good OR toxic"))


def count_masks(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES, texts_per_key: int = TEXTS_PER_KEY) -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and failed filters, from the files under ``path`` as a stream.

    ``path`` holds Parquet files with doc_id, text and source. Null texts are empty, null sources the part ''. Ids are
    compared as numbers; a row without one comes after all others, and rows that share the smallest id of a text
    are no copies of each other. A labelled document is good or toxic if any of its labels is 1. The files come in
    about ``batches`` micro-batches; the checkpoint and the deltas are in the shared folder.
    """
    place = fresh_dir(spark, "filter-audit")
    given = spark.read.parquet(path)
    keys = max(1, ceil(given.count() / texts_per_key))
    marked(labels).write.parquet(f"{place}/marked")
    spark.createDataFrame([], COUNTERS).write.parquet(f"{place}/deltas/batch=-1")
    files = max(1, ceil(len(given.inputFiles()) / batches))
    # Written as a pattern of one path, which may be a folder or a single file; as it is, it would have to be a folder.
    pattern = f"{path.rstrip('/')[:-1]}[{path.rstrip('/')[-1]}]"
    stream = spark.readStream.schema(given.schema).option("maxFilesPerTrigger", files).parquet(pattern)
    rows = stream.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"),
                         F.length("text").alias("size"), F.coalesce("source", F.lit("")).alias("part")).mapInArrow(facts, FACTS)
    known = spark.read.parquet(f"{place}/marked")
    # Rows without an id find no label, and are spread by their text on the way.
    found = F.col("doc_id").isNotNull() & (F.coalesce("doc_id", F.xxhash64("digest")) == F.col("marked_id"))
    no = F.lit(False)
    judged = rows.join(known, found, "left").select(
        F.pmod(F.coalesce(F.xxhash64("digest"), F.xxhash64("doc_id")), F.lit(keys)).alias("key"), "digest", F.coalesce("doc_id", F.lit(0)).alias("doc_id"),
        F.col("doc_id").isNull().alias("unnamed"), "mask", "part", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"), "n")
    deltas = judged.groupBy("key").applyInPandasWithState(_state, COUNTERS, "held binary", "update", GroupStateTimeout.NoTimeout)

    def keep(batch: DataFrame, number: int) -> None:
        summed = batch.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
        summed.write.mode("overwrite").parquet(f"{place}/deltas/batch={number}")

    query = (deltas.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{place}/checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    total = spark.read.schema(COUNTERS).parquet(f"{place}/deltas").groupBy("part", "mask")
    return total.agg(*[F.sum(c).cast("bigint").alias(c) for c in ("n", "good", "toxic")]).filter("n <> 0")


def _steps() -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all orders and steps: the orders, and matrices (step, mask) of who is kept, removed, redundant; the filter's
    bits alone; the steps (step, step) with the same filter."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    masks = np.arange(1 << len(FILTERS))
    bits = np.array([[1 << FILTERS.index(c) for c in o] for o in orders])
    before = np.cumsum(bits, axis=1) - bits
    fails, earlier = ((masks & b.reshape(-1, 1)) > 0 for b in (bits, before))
    alone = masks == bits.reshape(-1, 1)
    return orders, ~fails & ~earlier, fails & ~earlier, fails & earlier, alone, bits.reshape(-1, 1) == bits.reshape(1, -1)


AUDIT = ("part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, "
         "toxic_lost bigint, shapley bigint")


def interactions(counters: DataFrame) -> DataFrame:
    """Per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    Every part of ``counters`` has a row for each of the 600 steps. A part's counters are one row of at most 32 masks.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders, kept, removed, redundant, alone, same = _steps()
        matrices = [m.astype(np.int64) for m in (kept, removed, redundant, alone)]
        names, numbers = np.repeat(orders, len(FILTERS)), np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(orders))
        for batch in batches:
            for part, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n, good, toxic = np.zeros((3, 1 << len(FILTERS)), np.int64)
                for cell in cells:
                    n[cell["mask"]], good[cell["mask"]], toxic[cell["mask"]] = cell["n"], cell["good"], cell["toxic"]
                counts = [m @ n for m in matrices]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(names), pa.string()), pa.array(names.tolist()), pa.array(numbers), *map(pa.array, counts),
                     pa.array(matrices[1] @ good), pa.array(matrices[1] @ toxic), pa.array(same.astype(np.int64) @ counts[1])],
                    [c.split(" ")[0] for c in AUDIT.split(", ")])

    cells = counters.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    return cells.mapInArrow(run, AUDIT)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions(count_masks(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels")))


OP13_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
firsts AS (SELECT t, min(doc_id) AS first_id FROM texts GROUP BY t),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN coalesce(doc_id > first_id, first_id IS NOT NULL) THEN 16 ELSE 0 END AS mask
  FROM texts JOIN firsts USING (t) LEFT JOIN marks USING (doc_id)),
cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS b),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.b + b.b + c.b + d.b + e.b = 31 AND len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS before
  FROM (SELECT filter_order, bits, unnest(range(1, 6)) AS step FROM orders)),
counted AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & bit = 0 AND mask & before = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells CROSS JOIN steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""
