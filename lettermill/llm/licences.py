"""Licence scans: fuzzy search for short notices, seeds first, then verified with bounded errors.

A notice of which at most k characters are wrong, cut into k+1 pieces, still holds one piece as it is
(pigeonhole). The pieces of all notices are one automaton; only where a piece is found is the text round it
checked with a bounded-error pattern, which also reports where the notice stands and how many errors it has.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.llm.common import letter_words, table


@dataclass(frozen=True)
class Notice:
    """A notice in lower-case words, its label, how many character errors it may have, and a word that may have none."""

    label: str
    words: str
    max_errors: int = 2
    sure: str | None = None


# Fixed by the contract of the query: phrase and label.
BASE_PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

NOTICES = (
    Notice("mit", "released under the mit license", 3),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 6),
    Notice("apache-2", "licensed under the apache license version 2", 4),
    Notice("gpl", "licensed under the gnu general public license", 4),
    Notice("gpl", "under the terms of the gnu general public license", 4),
    Notice("lgpl", "gnu lesser general public license", 3),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted", 7),
    Notice("mpl-2", "mozilla public license version 2", 3),
    Notice("cc-by-nc", "licensed under cc by nc", 2),
    Notice("cc-by-sa", "creative commons attribution sharealike", 3),
    Notice("reserved", "all rights reserved", 1),
    # The base phrases after any lead-in. What tells them from other licences (MPL, version 1.1, CC BY-ND) must stand.
    Notice("mit", "under the mit license", 2, "mit"),
    Notice("apache-2", "apache license version 2", 2, "2"),
    Notice("cc-by-nc", "cc by nc", 1, "nc"),
)

SCAN_SCHEMA = (
    "struct<n_words: bigint, base: array<struct<label: string, word: bigint>>, "
    "fuzzy: array<struct<label: string, first_word: bigint, last_word: bigint, errors: bigint>>, score: double>"
)
SCAN_TYPE = pa.struct([
    ("n_words", pa.int64()), ("base", pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))),
    ("fuzzy", pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("errors", pa.int64())]))),
    ("score", pa.float64())])


def pieces(notice: Notice) -> list[tuple[int, str]]:
    """The notice cut into one piece more than it may have errors: (offset, piece)."""
    n = notice.max_errors + 1
    if len(notice.words) < 2 * n:
        raise ValueError(f"notice too short for {notice.max_errors} errors: {notice.words!r}")
    cuts = [len(notice.words) * i // n for i in range(n + 1)]
    return [(a, notice.words[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    """Compiled once per task from the notices and phrases."""

    def __init__(self, notices: Sequence[Notice], phrases: Sequence[tuple[str, str]]) -> None:
        import ahocorasick
        import regex

        self.notices, self.phrases = list(notices), [(f" {p} ", label) for p, label in phrases]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, notice in enumerate(self.notices):
            for offset, piece in pieces(notice):
                seeds.setdefault(piece, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.automaton.add_word(piece, (len(piece), uses))
        if seeds:
            self.automaton.make_automaton()
        self.any_seed = bool(seeds)
        # The library puts no error before the first letter, so letters too many there are counted by patterns of their own.
        patterns = [[regex.compile(rf"(?b)(?<![^ ]).{{{ahead}}}(?:{regex.escape(n.words, special_only=True)}){{e<={n.max_errors - ahead}}}(?![^ ])")
                     for ahead in range(n.max_errors + 1)] for n in self.notices]

        @lru_cache(maxsize=4096)
        def verify(i: int, window: str) -> tuple[int, int, int] | None:
            """Start, end and errors of the best match in the window; one text seen again costs nothing."""
            best = None
            for ahead, pattern in enumerate(patterns[i]):
                if best and best[2] <= ahead:
                    break
                found = pattern.search(window)
                if found and (best is None or ahead + sum(found.fuzzy_counts) < best[2]):
                    best = (*found.span(), ahead + sum(found.fuzzy_counts))
            return best

        self.verify = verify

    def fuzzy(self, line: str) -> list[tuple[str, int, int, int]]:
        """(label, first word, last word, errors) of every notice found in a text of words and single spaces."""
        windows: dict[int, list[list[int]]] = {}
        for end, (length, uses) in self.automaton.iter(line) if self.any_seed else ():
            for i, offset in uses:
                notice = self.notices[i]
                begin = end + 1 - length - offset
                low, high = begin - notice.max_errors, begin + len(notice.words) + notice.max_errors
                windows.setdefault(i, []).append([max(0, low), min(len(line), high)])
        found: dict[tuple[str, int, int], int] = {}
        for i, spans in windows.items():
            for low, high in dict.fromkeys(map(tuple, spans)):
                # Whole words at both ends, so that the pattern's word edges are those of the text.
                low = line.rfind(" ", 0, low) + 1
                high = line.find(" ", high)
                best = self.verify(i, line[low:] if high < 0 else line[low:high])
                sure = self.notices[i].sure
                if best and (sure is None or sure in line[low + best[0]:low + best[1]].split(" ")):
                    a, b, errors = low + best[0], low + best[1], best[2]
                    while a < b and line[a] == " ":
                        a += 1
                    while b > a and line[b - 1] == " ":
                        b -= 1
                    key = (self.notices[i].label, a, b)
                    found[key] = min(found.get(key, errors), errors)
        out = []
        at, words = 0, 0
        for (label, a, b), errors in sorted(found.items(), key=lambda x: x[0][1]):
            words += line.count(" ", at, a)
            at = a
            out.append((label, words, words + line.count(" ", a, b), errors))
        return out

    def base(self, padded: str) -> list[tuple[str, int]]:
        """(label, start word) of every place of every phrase in a text padded by a space on both sides."""
        out = []
        for phrase, label in self.phrases:
            at, last, words = padded.find(phrase), 0, 0
            while at >= 0:
                words += padded.count(" ", last, at)
                last = at
                out.append((label, words))
                at = padded.find(phrase, at + 1)
        return out

    def scan(self, text: str | None) -> dict:
        words = letter_words(text)
        if not words:
            return {"n_words": 0, "base": [], "fuzzy": [], "score": 0.0}
        line = b" ".join(words).decode()
        base, fuzzy = self.base(f" {line} "), self.fuzzy(line)
        score = 1.0 if base else max((1 - e / (1 + b - a) / 8 for _, a, b, e in fuzzy), default=0.0)
        return {"n_words": len(words), "base": [{"label": lab, "word": w} for lab, w in base],
                "fuzzy": [{"label": lab, "first_word": a, "last_word": b, "errors": e} for lab, a, b, e in fuzzy],
                "score": max(0.0, min(1.0, score))}


def scan_licences(documents: DataFrame, text: str = "text", notices: Sequence[Notice] = NOTICES,
                  phrases: Sequence[tuple[str, str]] = BASE_PHRASES) -> DataFrame:
    """``documents`` with ``scan`` (in place of the text and of a column of that name): word count, exact phrase places, fuzzy spans (words from 0) and a score.

    The score is 1 where a phrase stands exactly, else it falls with the errors per word of the best fuzzy
    match, 0 where there is none. Null and empty texts have no words and score 0. Whole texts are
    searched, whatever their length. Narrow work: one pass, no shuffle.
    """
    kept = [c for c in documents.columns if c not in (text, "scan")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices, phrases)
        for batch in batches:
            scanned = pa.array([scanner.scan(t.as_py()) for t in batch.column(batch.schema.get_field_index(text))], SCAN_TYPE)
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)) for c in kept], scanned], [*kept, "scan"])

    schema = documents.select(*kept, F.lit(None).cast(SCAN_SCHEMA).alias("scan")).schema
    return documents.mapInArrow(run, schema)


def scan_digest(scanned: DataFrame) -> DataFrame:
    """One row per document: counts, first and last exact place, labels and score."""
    base, fuzzy = F.col("scan.base"), F.col("scan.fuzzy")
    labels = lambda spans: F.transform(spans, lambda s: s["label"])
    places = F.transform(base, lambda s: s["word"])
    joined = lambda names: F.array_join(F.array_sort(F.array_distinct(names)), ",")
    return scanned.select(
        "doc_id", F.col("scan.n_words").alias("n_words"), F.size(base).cast("bigint").alias("n_base"),
        F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        joined(labels(base)).alias("base_labels"), joined(F.concat(labels(base), labels(fuzzy))).alias("labels"),
        F.col("scan.score").alias("score"), F.size(fuzzy).cast("bigint").alias("n_fuzzy"))


def op6_licences(spark, sf_dir: str) -> DataFrame:
    return scan_digest(scan_licences(table(spark, sf_dir, "documents").select("doc_id", "text")))


# The columns of the query that SQL can state; the labels of the fuzzy search and the score are beyond it.
OP6_BASE_SQL = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(0, len(w))) AS i FROM docs),
found AS (
  SELECT doc_id, i, 'mit' AS label FROM starts WHERE w[i + 1:i + 4] = ['under', 'the', 'mit', 'license']
  UNION ALL SELECT doc_id, i, 'apache-2' FROM starts WHERE w[i + 1:i + 4] = ['apache', 'license', 'version', '2']
  UNION ALL SELECT doc_id, i, 'cc-by-nc' FROM starts WHERE w[i + 1:i + 3] = ['cc', 'by', 'nc'])
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, count(i) AS n_base, min(i) AS first_word, max(i) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS base_labels
FROM docs d LEFT JOIN found USING (doc_id) GROUP BY d.doc_id, d.w
"""
