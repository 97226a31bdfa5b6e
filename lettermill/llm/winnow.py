"""Benchmark decontamination by winnowing, in built-in Spark functions only.

Of every window of k-gram hashes the smallest is kept, on both sides. A span shared by a document and a
benchmark item that is as long as the window and one k-gram less holds the same hashes on both sides, so
both keep the same one: every such span is found. Hits of fingerprints are then extended to the windows of
words round them and compared as text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill.llm.common import LOWER, UPPER, fresh_dir, table, unused

WINDOW = 10
GRAM = 5
# The word pattern of both letter cases, as the letters that belong to words: A-Z are lowered only where words are compared.
WORDS = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
MAX_BROADCAST = 128 << 20  # bytes of fingerprints, and of window texts, that every executor may hold


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORDS), F.lit(0))


def lowered(words: Column) -> Column:
    """Words joined by a space, A-Z lowered and no other letter."""
    return F.translate(F.array_join(words, " "), UPPER, LOWER)


def _each(size: Column, value: Callable[[Column], Column], kind: str) -> Column:
    """``value`` of every place from 0 up to ``size``, nothing if that is not positive."""
    return F.when(size > 0, F.transform(F.sequence(F.lit(0), size - 1), value)).otherwise(F.array().cast(f"array<{kind}>"))


def fingerprints(df: DataFrame, words: str, lengths: list[int], gram: int = GRAM) -> DataFrame:
    """``df`` with ``marks``: array of (length, p, fp), the kept k-gram hashes of its words for spans of each length.

    k is ``gram``, or the length if that is less. A k-gram is kept for a length if it has the smallest hash of any
    window of ``length - k + 1`` k-grams; of equal ones all are kept. The hashes are of words in lower case, all
    letters: no pair of words equal after A-Z alone is lowered is told apart. Words are hashed once for all lengths. The
    steps are separate projections, so that each array is worked out once; for the same reason the arrays are
    exploded with ``explode_outer``, of which no filter is inferred that would be pushed down through them.
    """
    kinds = sorted({min(gram, n) for n in lengths})
    wide = {n: n - min(gram, n) + 1 for n in lengths if n > gram}

    def gram_of(k: int) -> Column:
        return _each(F.size("_h") - (k - 1), lambda i: F.xxhash64(*[F.get("_h", i + j) for j in range(k)]), "bigint")

    def least_of(width: int) -> Column:
        return _each(F.size(f"_g{gram}") - (width - 1), lambda i: F.least(*[F.get(f"_g{gram}", i + j) for j in range(width)]), "bigint")

    hashed = df.withColumn("_h", F.transform(words, lambda w: F.xxhash64(F.lower(w))))
    grams = hashed.withColumns({f"_g{k}": gram_of(k) for k in kinds}).drop("_h")
    least = grams.withColumns({f"_m{n}": least_of(w) for n, w in wide.items()})

    def marks(n: int) -> Column:
        mark = lambda g, p: F.struct(F.lit(n).alias("length"), p.alias("p"), g.alias("fp"))
        if n not in wide:
            return F.transform(f"_g{min(gram, n)}", mark)
        kept = lambda g, p: F.coalesce(g == F.greatest(*[F.get(f"_m{n}", p - j) for j in range(wide[n])]), F.lit(False))
        return F.filter(F.transform(f"_g{gram}", lambda g, p: F.when(kept(g, p), mark(g, p))), lambda x: x.isNotNull())

    return least.withColumn("marks", F.concat(*[marks(n) for n in lengths])).drop(*[f"_g{k}" for k in kinds], *[f"_m{n}" for n in wide])


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, words, n) of the items that have words, and ``length``: that of their windows."""
    cut = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of(F.col("text")).alias("words"))
    return cut.withColumn("n", F.size("words")).filter("n > 0").withColumn("length", F.least("n", F.lit(window)))


def _small(df: DataFrame, size: Column, max_broadcast: int) -> DataFrame:
    """``df`` with a broadcast hint if its rows have at most ``max_broadcast`` bytes together; they are counted."""
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= max_broadcast else df


def marked_words(documents: DataFrame, keys: list[str], items: DataFrame, lengths: list[int], path: str, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """(keys, n, length, begin, near) written to ``path``: every document with its number of words, in a row with length 0,
    and the words round each fingerprint that an item of the length has too.

    ``documents`` has the keys and ``words``, ``items`` is ``item_windows``. The items' fingerprints are broadcast up to
    ``max_broadcast`` bytes; beyond that the join is a shuffle of fingerprints with the few words round them, in which
    the rows of length 0 are spread by their keys.
    """
    test = None
    for length in lengths:
        own = fingerprints(items.filter(F.col("length") == length).select("words"), "words", [length]).select(F.explode_outer("marks").alias("m"))
        test = own if test is None else test.unionByName(own)
    test = test.filter("m IS NOT NULL").select("m.length", "m.fp").distinct().withColumn("hit", F.lit(True))
    whole = F.struct(F.lit(0).alias("length"), F.lit(0).alias("p"), F.xxhash64(*keys).alias("fp"))
    marked = fingerprints(documents.select(*keys, "words"), "words", lengths)
    marked = marked.select(*keys, "words", F.explode_outer(F.concat(F.array(whole), "marks")).alias("m")).select(*keys, "words", "m.length", "m.p", "m.fp")
    begin = F.greatest(F.lit(0), F.col("p") - (F.col("length") - F.least("length", F.lit(GRAM))))
    none = F.array().cast("array<string>")
    near = F.when(F.col("length") > 0, F.slice("words", begin + 1, F.col("p") + F.col("length") - begin)).otherwise(none)
    known = _small(test, F.lit(16), max_broadcast)
    # Where nothing is shuffled, the words are looked at only where a fingerprint hits.
    cut = [*keys, F.when(F.col("length") == 0, F.size("words")).alias("n"), "length", begin.alias("begin"), near.alias("near")]
    if known is test:
        found = marked.select(*cut, "fp").join(known, ["length", "fp"], "left").filter("hit OR length = 0").drop("fp", "hit")
    else:
        found = marked.join(known, ["length", "fp"], "left").filter("hit OR length = 0").select(*cut)
    found.write.parquet(path)
    return documents.sparkSession.read.parquet(path)


def occurrences(near: DataFrame, keys: list[str], items: DataFrame, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """(keys, start, length, item): where windows of the items stand in documents, given the words round their hits.

    The windows' texts are broadcast up to ``max_broadcast`` bytes, beyond that the join is a shuffle.
    """
    windows = (items.select("item", "length", F.explode_outer(_each(F.col("n") - (F.col("length") - 1), lambda i: lowered(F.slice("words", i + 1, F.col("length"))), "string")).alias("window"))
               .filter("window IS NOT NULL").distinct())
    hits = near.filter("length > 0")
    starts = hits.select(*keys, "length", "begin", "near", F.explode_outer(_each(F.size("near") - (F.col("length") - 1), lambda i: i, "int")).alias("at")).filter("at IS NOT NULL")
    texts = starts.select(*keys, "length", (F.col("begin") + F.col("at")).alias("start"), lowered(F.slice("near", F.col("at") + 1, F.col("length"))).alias("window"))
    found = texts.join(_small(windows, F.octet_length("window") + F.octet_length("item") + 32, max_broadcast), ["length", "window"])
    return found.select(*keys, "start", "length", "item").distinct()


def _covered(spans: Column) -> Column:
    """Number of words in the union of spans (start, length), sorted by start."""
    state = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("upto"))

    def add(at: Column, span: Column) -> Column:
        end = (span["start"] + span["length"]).cast("bigint")
        return F.struct((at["n"] + F.greatest(F.lit(0).cast("bigint"), end - F.greatest(at["upto"], span["start"].cast("bigint")))).alias("n"),
                        F.greatest(at["upto"], end).alias("upto"))

    return F.aggregate(spans, state, add, lambda at: at["n"])


def _identity() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")), F.lit(1))


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and text_hash of every row of ``documents``.

    An item of fewer words than ``window`` is one window of its own length, an item without words none. Null
    and empty texts have no words. A null item_id counts as the empty id. Rows are told apart by doc_id and
    text, so repeated rows get the same answer each. Other columns are ignored. The texts are read once. The hits of
    one document are gathered in one row; its windows are bounded by its words.
    """
    keys = ["doc_id", "text_hash"]
    items = item_windows(benchmark, window)
    lengths = sorted(r[0] for r in items.select("length").distinct().collect())  # at most ``window`` numbers
    docs = documents.select("doc_id", _identity().alias("text_hash"), words_of(F.col("text")).alias("words"))
    no_ids = F.array().cast("array<string>")
    if not lengths:
        counted = docs.select(*keys, F.size("words").cast("bigint").alias("n_words"), F.lit(0).cast("bigint").alias("n_hit"), no_ids.alias("items"))
    else:
        near = marked_words(docs, keys, items, lengths, fresh_dir(documents.sparkSession, "marked-words"), max_broadcast)
        per_doc = (occurrences(near, keys, items, max_broadcast).groupBy(*keys)
                   .agg(F.array_sort(F.collect_set(F.struct("start", "length"))).alias("spans"), F.array_sort(F.collect_set("item")).alias("items")))
        hit = per_doc.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_t"), _covered(F.col("spans")).alias("n_hit"), "items")
        counted = near.filter("length = 0").join(hit, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_t")), "left").select(
            *keys, F.col("n").cast("bigint").alias("n_words"), F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"), F.coalesce("items", no_ids).alias("items"))
    return counted.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                          F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "text_hash")


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any word inside a benchmark window; the columns stay, whatever their names."""
    id_name, hash_name = unused(documents.columns, "bad_id", "bad_text")
    bad = contamination(documents.select("doc_id", "text"), benchmark).filter("contaminated").select(F.col("doc_id").alias(id_name), F.col("text_hash").alias(hash_name))
    return documents.join(bad, F.col("doc_id").eqNullSafe(F.col(id_name)) & (_identity() == F.col(hash_name)), "left_anti")


def op4_winnow(spark, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


OP4_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
items AS (
  SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(words), 10) AS size, array_to_string(words[i + 1:i + least(len(words), 10)], ' ') AS w
  FROM (SELECT item, words, unnest(range(0, len(words) - least(len(words), 10) + 1)) AS i FROM items WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
starts AS (
  SELECT doc_id, size, i, array_to_string(words[i + 1:i + size], ' ') AS w
  FROM (SELECT doc_id, words, size, unnest(range(0, len(words) - size + 1)) AS i FROM doc_words CROSS JOIN sizes WHERE len(words) >= size)),
hits AS (SELECT doc_id, i, windows.size, item FROM starts JOIN windows ON starts.size = windows.size AND starts.w = windows.w),
covered AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
