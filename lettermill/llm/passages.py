"""Substring dedup: recurring passages confirmed, Aho-Corasick automata per shard, every occurrence located.

1. Every document keeps a few phrases by winnowing: any ``WINDOW`` words hold a kept phrase of ``GRAM`` words,
   and equal words keep equal phrases. Counting their hashes confirms which recur.
2. Documents are dealt into shards of a bounded size. A shard gets the hashes of its own recurring phrases,
   compiles an automaton of their texts and streams its documents through it, so every document is read by
   one automaton, and an automaton is never larger than what its shard holds.
3. Windows round the places found are compared over the whole corpus by their hashes; all but the first
   occurrence are covered, and the covered words go.

Words and phrases are compared by 64-bit hashes where a false hit only means a needless candidate; windows,
which decide, by 96 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.llm.common import table, tidy, unused

WINDOW = 20
GRAM = 10
HEAD = 4  # words of a phrase that its shard's automaton looks for
SHARD_BYTES = 6 << 20
PIECE = 1 << 20
RESULTS = ("n_words", "n_removed", "kept_text")
_ODD = np.uint64(0x9E3779B97F4A7C15)
_FIRST, _SECOND = 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    return np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, base, np.uint64))])


_BASE = 0x100000001B3
_POWERS = _powers(_BASE, PIECE + 1)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), PIECE + 1)


def one_line(text: str | None) -> bytes:
    """The words between ASCII white space, joined by one space."""
    return b" ".join(text.encode().split()) if text else b""


def word_hashes(line: bytes) -> np.ndarray:
    """A 64-bit hash per word of a text of words and single spaces, worked out on the bytes at once."""
    out, at = [], 0
    while at < len(line):
        end = len(line)
        if end - at > PIECE:
            end = line.rfind(b" ", at, at + PIECE)
            if end < 0:  # one word longer than a piece
                end = line.find(b" ", at)
                end = len(line) if end < 0 else end
        part = np.frombuffer(line, np.uint8, end - at, at)
        if len(part) > PIECE:
            import xxhash

            out.append(np.array([xxhash.xxh64_intdigest(part.tobytes())], np.uint64))
        else:
            spaces = np.flatnonzero(part == 32)
            starts, stops = np.concatenate([[0], spaces + 1]), np.concatenate([spaces, [len(part)]])
            sums = np.concatenate([[np.uint64(0)], np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _POWERS[:len(part)])])
            out.append(_mix((sums[stops] - sums[starts]) * _INVERSE[starts] + (stops - starts).astype(np.uint64)))
        at = end + 1
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def gram_hashes(words: np.ndarray, n: int, base: np.uint64 = _ODD) -> np.ndarray:
    """A hash of every n consecutive words."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = out * base + words[k:k + len(out)]
    return _mix(out)


def _running(of, values: np.ndarray, width: int) -> np.ndarray:
    """``of`` (minimum or maximum) over every ``width`` consecutive values, by doubling the stretch."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = of(values[:-step], values[step:])
        have += step
    return values


def kept_places(grams: np.ndarray, width: int) -> np.ndarray:
    """Places whose hash is the smallest of any ``width`` consecutive ones; of equal ones, all."""
    if len(grams) < width:
        return np.empty(0, np.int64)
    rim = np.zeros(width - 1, np.uint64)
    least = np.concatenate([rim, _running(np.minimum, grams, width), rim])
    return np.flatnonzero(grams == _running(np.maximum, least, width))


class _WindowHashes:
    """Hashes of any windows of a text, from running sums: the cost is that of the text, not of the windows."""

    def __init__(self, base: int) -> None:
        self.base, self.powers, self.inverse = base, _powers(base, 1 << 12), _powers(pow(base, -1, 1 << 64), 1 << 12)

    def at(self, words: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
        while len(self.powers) < len(words):
            self.powers = _powers(self.base, 4 * len(self.powers))
            self.inverse = _powers(pow(self.base, -1, 1 << 64), len(self.powers))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(words * self.powers[:len(words)])])
        return _mix((sums[starts + n] - sums[starts]) * self.inverse[starts])


def packed(df: DataFrame) -> DataFrame:
    """``df`` with ``text`` compressed, for a shuffle of whole texts; null stays null."""
    names, at = df.columns, df.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = pa.array([None if t is None else pack.compress(t.encode()) for t in batch.column(at).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([texts if i == at else c for i, c in enumerate(batch.columns)], names)

    return df.mapInArrow(tidy(run), df.withColumn("text", F.col("text").cast("binary")).schema)


def _unpack(value: bytes | None) -> str | None:
    import zstandard

    return None if value is None else zstandard.ZstdDecompressor().decompress(value).decode()


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")), F.lit(7))


def recurring_phrases(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """(shard, h): the kept phrases of each shard's documents that stand at two places or more anywhere.

    Counted in one shuffle by phrase. A phrase that a batch of documents holds twice is known to recur, so the
    batch sends it once to be counted and its shards apart from it: a phrase in a third of all documents
    costs one row per batch where it is counted, not one per document.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards, hashes, often = [], [], []
            for shard, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                grams = gram_hashes(word_hashes(one_line(text.as_py())), gram)
                own, n = np.unique(grams[kept_places(grams, window - gram + 1)], return_counts=True)
                hashes.append(own)
                often.append(n)
                shards.append(np.full(len(own), shard, np.int32))
            if not hashes:
                continue
            h, n, shard = np.concatenate(hashes), np.concatenate(often), np.concatenate(shards)
            names, place = np.unique(h, return_inverse=True)
            known = np.bincount(place, n, len(names))[place] > 1
            one, once = ~known, names[np.bincount(place, n, len(names)) > 1]
            again_h, again_shard = h[known], shard[known]
            order = np.lexsort((again_h, again_shard))
            again_h, again_shard = again_h[order], again_shard[order]
            new = np.concatenate([[True], (again_h[1:] != again_h[:-1]) | (again_shard[1:] != again_shard[:-1])])[:len(order)]
            again_h, again_shard = again_h[new], again_shard[new]
            yield pa.RecordBatch.from_pydict({
                "h": np.concatenate([h[one], once, again_h]).view(np.int64),
                "shard": np.concatenate([shard[one], np.full(len(once), -1, np.int32), again_shard]),
                "salt": np.concatenate([np.zeros(one.sum() + len(once), np.int32), again_shard + 1]).astype(np.int32),
                "n": np.repeat(np.array([1, 2], np.int32), [int(one.sum()), len(once) + len(again_h)])})

    sent = rows.select("shard", "text").mapInArrow(tidy(run), "h bigint, shard int, salt int, n int")
    total = F.sum("n").over(Window.partitionBy("h", "salt"))
    return sent.withColumn("_total", total).filter("_total > 1 AND shard >= 0").select("shard", "h")


class _Shard:
    """Documents of one shard in order, and the hashes of its recurring phrases."""

    def __init__(self) -> None:
        self.hashes: list[np.ndarray] = []
        self.documents: list[tuple[int | None, int, bytes]] = []
        self.words: list[np.ndarray] = []

    def add(self, doc_id: int | None, text_hash: int, line: bytes) -> None:
        self.documents.append((doc_id, text_hash, line))
        self.words.append(word_hashes(line))

    def recurs(self, grams: np.ndarray) -> np.ndarray:
        """Whether these are recurring phrases of the shard."""
        return self.wanted[np.minimum(np.searchsorted(self.wanted, grams), len(self.wanted) - 1)] == grams

    def automaton(self, window: int, gram: int):
        """Compiled from the heads of the phrases of these documents that recur anywhere; None if none do.

        A head is the phrase's first ``HEAD`` words. What follows a head is compared by the phrase's hash.
        """
        import ahocorasick

        self.wanted = np.sort(np.concatenate(self.hashes)) if self.hashes else np.empty(0, np.uint64)
        if not len(self.wanted):
            return None
        found, known, head = ahocorasick.Automaton(ahocorasick.STORE_LENGTH), set(), min(HEAD, gram)
        for (_, _, line), hashes in zip(self.documents, self.words):
            grams = gram_hashes(hashes, gram)
            places = kept_places(grams, window - gram + 1)
            places = places[self.recurs(grams[places])]
            if len(places):
                words = None
                for p, h in zip(places.tolist(), grams[places].tolist()):
                    if h not in known:
                        known.add(h)
                        words = words or line.split(b" ")
                        found.add_word(f" {b' '.join(words[p:p + head]).decode()} ")
        if not known:
            return None
        found.make_automaton()
        return found

    def locate(self, window: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
        """Per document with recurring phrases: its place here, the candidate starts and their two hashes.

        A window is a candidate if a recurring phrase stands in it and the one of its phrases with the smallest hash
        recurs: equal windows have the same one.
        """
        automaton = self.automaton(window, gram)
        if automaton is None:
            return
        first_hash, second_hash, head = _WindowHashes(_FIRST), _WindowHashes(_SECOND), min(HEAD, gram)
        for place, (_, _, line) in enumerate(self.documents):
            words = self.words[place]
            n = len(words) - window + 1
            if n <= 0:
                continue
            padded = f" {line.decode()} "
            ends = np.fromiter(map(itemgetter(0), automaton.iter(padded)), np.int64)
            if not len(ends):
                continue
            raw = np.frombuffer(line, np.uint8)
            spaces = np.flatnonzero(raw == 32) + 1
            if len(padded) != len(line) + 2:  # the automaton counts in characters
                spaces -= np.cumsum((raw & 0xC0) == 0x80)[spaces - 1]
            spaces = np.concatenate([[0], spaces, [len(padded) - 1]])
            grams = gram_hashes(words, gram)
            first = np.unique(np.searchsorted(spaces, ends) - head)
            first = first[first < len(grams)]
            first = first[self.recurs(grams[first])]
            edge = np.zeros(n + 1, np.int64)
            np.add.at(edge, np.maximum(first - (window - gram), 0), 1)
            np.add.at(edge, np.minimum(first + 1, n), -1)
            starts = np.flatnonzero(np.cumsum(edge[:n]) > 0)
            starts = starts[self.recurs(_running(np.minimum, grams, window - gram + 1)[starts])]
            yield place, starts, first_hash.at(words, starts, window), second_hash.at(words, starts, window)

    def rows(self, window: int, gram: int) -> Iterator[dict]:
        """The first occurrence here of every candidate window, and the word ranges of the later ones."""
        found = list(self.locate(window, gram))
        if not found:
            return
        place = np.concatenate([np.full(len(s), p, np.int32) for p, s, _, _ in found])
        start, one, two = (np.concatenate([f[i] for f in found]) for i in (1, 2, 3))
        found.clear()  # the arrays stand in those put together
        two = two >> np.uint64(32)
        order = np.lexsort((start, place, two, one))
        place, start, one, two = place[order], start[order], one[order], two[order]
        later = np.concatenate([[False], (one[1:] == one[:-1]) & (two[1:] == two[:-1])])
        unnamed = np.array([d[0] is None for d in self.documents])
        ids = np.array([d[0] or 0 for d in self.documents], np.int64)
        hashes = np.array([d[1] for d in self.documents], np.int64)
        first = np.flatnonzero(~later)
        first = first[np.lexsort((start[first], place[first]))]  # rows of a document together compress well
        for at in range(0, len(first), 200_000):
            chosen = first[at:at + 200_000]
            yield {"one": one[chosen].view(np.int64), "two": two[chosen].astype(np.uint32).view(np.int32), "doc_id": pa.array(ids[place[chosen]], mask=unnamed[place[chosen]]),
                   "text_hash": hashes[place[chosen]], "start": start[chosen].astype(np.int32), "stop": pa.nulls(len(chosen), pa.int32())}
        again = np.flatnonzero(later)
        if len(again):
            again = again[np.lexsort((start[again], place[again]))]
            p, s = place[again], start[again]
            # Windows that overlap or touch are one range of words.
            new = np.concatenate([[True], (p[1:] != p[:-1]) | (s[1:] > s[:-1] + window)])
            begin = np.flatnonzero(new)
            end = np.concatenate([begin[1:], [len(s)]]) - 1
            yield {"one": hashes[p[begin]], "two": pa.nulls(len(begin), pa.int32()), "doc_id": pa.array(ids[p[begin]], mask=unnamed[p[begin]]),
                   "text_hash": hashes[p[begin]], "start": s[begin].astype(np.int32), "stop": (s[end] + window).astype(np.int32)}


def later_windows(documents: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, text_hash, start, stop): words covered by windows that also start earlier; ``stop`` is null for a
    single window.

    Earlier is a smaller doc_id (null last), then a smaller hash of the text, then an earlier start. Rows equal
    in doc_id and text are one document. Inside a shard later windows are settled on the spot, so a window
    sends one row per shard at most into the comparison of all, however often it occurs.
    """
    total = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, ceil(total / shard_bytes))
    shard = F.pmod(F.xxhash64("doc_id", _text_hash()), F.lit(shards)).cast("int")
    dealt = documents.select("doc_id", _text_hash().alias("text_hash"), shard.alias("shard"), "text")
    lines = packed(dealt).select("shard", F.lit(1).alias("kind"), F.lit(None).cast("bigint").alias("h"), "doc_id", "text_hash", "text")
    marks = recurring_phrases(dealt, window, gram).select(
        "shard", F.lit(0).alias("kind"), "h", *[F.lit(None).cast(t).alias(c) for c, t in (("doc_id", "bigint"), ("text_hash", "bigint"), ("text", "binary"))])
    sorted_rows = (marks.unionByName(lines).repartition("shard")
                   .sortWithinPartitions("shard", "kind", F.asc_nulls_last("doc_id"), "text_hash"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, _Shard()
        for batch in batches:
            numbers, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            at = 0
            while at < len(numbers):
                if numbers[at] != current:
                    yield from map(pa.RecordBatch.from_pydict, held.rows(window, gram))
                    current, held = numbers[at], _Shard()
                stop = at + int(np.argmin(np.concatenate([(numbers[at:] == current) & (kinds[at:] == kinds[at]), [False]])))
                if kinds[at] == 0:
                    held.hashes.append(batch.column(2).slice(at, stop - at).to_numpy().view(np.uint64))
                else:
                    for i in range(at, stop):
                        row = (batch.column(3)[i].as_py(), batch.column(4)[i].as_py())
                        if not held.documents or held.documents[-1][:2] != row:
                            held.add(*row, one_line(_unpack(batch.column(5)[i].as_py())))
                at = stop
        yield from map(pa.RecordBatch.from_pydict, held.rows(window, gram))

    found = sorted_rows.mapInArrow(tidy(run), "one bigint, two int, doc_id bigint, text_hash bigint, start int, stop int")
    order = Window.partitionBy("one", "two").orderBy(F.asc_nulls_last("doc_id"), "text_hash", "start")
    return (found.withColumn("_nth", F.row_number().over(order)).filter("two IS NULL OR _nth > 1")
            .select("doc_id", "text_hash", "start", "stop"))


def remove_passages(documents: DataFrame, window: int = WINDOW, gram: int = GRAM, results: tuple[str, str, str] = RESULTS) -> DataFrame:
    """``documents`` with n_words, n_removed and kept_text: the words left, joined by one space.

    These columns have the names ``results``, and replace columns of the same names; all others stay. A word goes if a
    window of ``window`` words that also starts earlier covers it; windows are judged on the texts as they come. Null
    and blank texts have no words; texts of fewer words than a window stay whole. ``doc_id`` must be a whole number
    or null.
    """
    documents = documents.drop(*results)
    doc, text_hash, starts, ranges = unused([*documents.columns, *results], "doc", "text_hash", "starts", "ranges")
    # Null ids get a number of their own, so that both sides are dealt by the same two columns.
    key = F.coalesce("doc_id", F.lit(-(1 << 63))).alias(doc)
    later = later_windows(documents.select("doc_id", "text"), window, gram).select(key, F.col("text_hash").alias(text_hash), "start", "stop")
    single = F.col("stop").isNull()
    found = later.groupBy(doc, text_hash).agg(  # lists of one document, as long as it at most
        F.collect_list(F.when(single, F.col("start"))).alias(starts),
        F.collect_list(F.when(~single, F.struct("start", "stop"))).alias(ranges))
    keyed = packed(documents.select("*", key, _text_hash().alias(text_hash)))
    joined = keyed.join(found, [doc, text_hash], "left").select(*[f"`{c}`" for c in documents.columns], starts, ranges)
    names, at = documents.columns, documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, texts, whole = [], [], [], []
            for text, starts, ranges in zip(batch.column(at), *batch.columns[-2:]):
                whole.append(_unpack(text.as_py()))
                line = one_line(whole[-1])
                n, gone = (line.count(b" ") + 1 if line else 0), 0
                if starts.is_valid:
                    edge = np.zeros(n + 1, np.int64)
                    single = starts.values.to_numpy(zero_copy_only=False)
                    np.add.at(edge, single, 1)
                    np.add.at(edge, single + window, -1)
                    for r in ranges.as_py():
                        edge[r["start"]] += 1
                        edge[r["stop"]] -= 1
                    keep = np.cumsum(edge[:n]) == 0
                    gone = int(n - keep.sum())
                    words = line.split(b" ")
                    line = b" ".join([words[i] for i in np.flatnonzero(keep)])
                counts.append(n)
                removed.append(gone)
                texts.append(line.decode())
            columns = [pa.array(whole, pa.string()) if i == at else batch.column(i) for i in range(batch.num_columns - 2)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())],
                                             [*names, *results])

    new = [F.lit(None).cast(t).alias(c) for c, t in zip(results, ("bigint", "bigint", "string"))]
    return joined.mapInArrow(tidy(run), documents.select("*", *new).schema)


def op7_passages(spark, sf_dir: str) -> DataFrame:
    done = remove_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (SELECT doc_id, i, md5(array_to_string(words[i + 1:i + 20], ' ')) AS w
  FROM (SELECT doc_id, words, unnest(range(0, len(words) - 19)) AS i FROM docs WHERE len(words) >= 20)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS nth FROM starts) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS place FROM later),
each_word AS (SELECT doc_id, place, words[place + 1] AS word FROM (SELECT doc_id, words, unnest(range(0, len(words))) AS place FROM docs)),
kept AS (SELECT e.doc_id, count(g.place) AS n_removed, string_agg(CASE WHEN g.place IS NULL THEN e.word END, ' ' ORDER BY e.place) AS line
  FROM each_word e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.place = g.place GROUP BY e.doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(line, '')) AS kept_sha256
FROM docs d LEFT JOIN kept USING (doc_id)
"""
