"""Toxicity: a lexicon learned from labels, searched with Levenshtein automata over its trie, and scores of the
words round each hit that tell quotation from abuse.

The lexicon and the weights are fitted on a bounded sample of the labelled training rows; every text is then
scored whole, in one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from math import ceil, exp, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill.llm.common import LETTER_WORDS, LOWER, UPPER, fresh_dir, letter_words, table, tidy, unused

SAMPLE_ROWS = 30_000  # labelled rows the lexicon and the weights are fitted on, drawn by a hash of doc_id
PREFIXES = range(3, 9)
SURE = 0.8  # share of toxic documents among those that hold a term
CONTEXT = 6  # words on either side of a hit
QUOTES = "\"“”„«»"
CUES = frozenset("said says wrote writes quoted quote called calls reported dit dijo sagte schrieb zitat cita".split())
_FOLDS = str.maketrans(UPPER, LOWER)
_SPLIT = re.compile(LETTER_WORDS)


def allowed(length: int) -> int:
    """How many edits a term of that many characters may have."""
    return 0 if length < 5 else 1 if length < 9 else 2


class Lexicon:
    """A trie of terms; an open term stands for all words that begin with it.

    The Levenshtein automata of all terms run together over the trie: a state holds the trie's nodes that are
    within reach, each with its fewest edits. States and steps are worked out when a word first needs them and
    then kept, so a word costs one look-up per letter, and most words end after a few letters in the state
    that reaches nothing.
    """

    def __init__(self, terms: Mapping[str, float], exempt: Sequence[str] = ()) -> None:
        self.terms, self.exempt = dict(terms), frozenset(exempt)
        self.below: list[dict[str, int]] = [{}]
        self.limit = [0]  # most edits that a term below the node may have
        self.entries: list[list[tuple[bool, float, int]]] = [[]]
        for term, weight in self.terms.items():
            letters, node = term.rstrip("*"), 0
            edits = allowed(len(letters))
            self.limit[0] = max(self.limit[0], edits)
            for letter in letters:
                if letter not in self.below[node]:
                    self.below[node][letter] = len(self.below)
                    self.below.append({})
                    self.limit.append(0)
                    self.entries.append([])
                node = self.below[node][letter]
                self.limit[node] = max(self.limit[node], edits)
            self.entries[node].append((term.endswith("*"), weight, edits))
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, tuple[float, int] | None] = {}
        self.states: dict[tuple, tuple] = {}
        self.start = self._state({0: 0})

    def _state(self, reached: dict[int, int]) -> tuple:
        """(nodes, steps, best closed, best open) of the state: nodes reached by leaving out letters of a term are added."""
        stack = list(reached.items())
        while stack:
            node, edits = stack.pop()
            for child in self.below[node].values():
                if edits + 1 <= self.limit[child] and edits + 1 < reached.get(child, 9):
                    reached[child] = edits + 1
                    stack.append((child, edits + 1))
        key = tuple(sorted(reached.items()))
        if key not in self.states:
            best = {True: None, False: None}
            for node, edits in key:
                for is_open, weight, most in self.entries[node]:
                    if edits <= most and (best[is_open] is None or (edits, -weight) < best[is_open]):
                        best[is_open] = (edits, -weight)
            self.states[key] = (key, {}, best[False], best[True])
        return self.states[key]

    def _step(self, state: tuple, letter: str) -> tuple:
        reached: dict[int, int] = {}
        for node, edits in state[0]:
            for own, child in self.below[node].items():
                cost = edits + (own != letter)
                if cost <= self.limit[child] and cost < reached.get(child, 9):
                    reached[child] = cost
            if edits + 1 <= self.limit[node] and edits + 1 < reached.get(node, 9):
                reached[node] = edits + 1  # a letter too many in the word
        return self._state(reached)

    def look(self, word: str) -> tuple[float, int] | None:
        """(weight, edits) of the best term within its limit, else None; fewest edits, then most weight."""
        state, best = self.start, self.start[3]
        for letter in word:
            to = state[1].get(letter)
            if to is None:
                to = state[1][letter] = self._step(state, letter)
            state = to
            if state[3] is not None and (best is None or state[3] < best):
                best = state[3]
            if not state[0]:
                break
        if state[2] is not None and (best is None or state[2] < best):
            best = state[2]
        if best is None or (best[0] > 0 and word in self.exempt):
            return None
        return -best[1], best[0]

    def hit(self, word: bytes) -> tuple[float, int] | None:
        """``look``, remembered for the words of a task; words and states are forgotten when they are many."""
        try:
            return self.known[word]
        except KeyError:
            if len(self.known) > 200_000 or len(self.states) > 200_000:
                self.forget()
            found = self.known[word] = self.look(word.decode())
            return found


FEATURES = ("exact", "exact_hits", "near", "near_hits", "quoted_hits", "cued_hits", "others_near", "density")


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """What a text's hits say; all 0 where there is none.

    Weights count where the hit is not quoted. A hit is quoted if an odd number of quotation marks stands
    before it in its line and another follows in it; it is cued if a word of reporting stands up to
    ``CONTEXT`` words before it.
    """
    words = letter_words(text)
    hits = {w: h for w in set(words) if (h := lexicon.hit(w)) is not None}
    if not hits:
        return [0.0] * len(FEATURES)
    folded = text.translate(_FOLDS)
    spans = [(m[0], m.start()) for m in _SPLIT.finditer(folded)]
    quotes = any(q in text for q in QUOTES)
    exact = near = 0.0
    n_exact = n_near = n_quoted = n_cued = others = 0
    places = [i for i, (w, _) in enumerate(spans) if w.encode() in hits]
    for nth, i in enumerate(places):
        word, at = spans[i]
        weight, edits = hits[word.encode()]
        quoted = False
        if quotes:
            begin, end = folded.rfind("\n", 0, at) + 1, folded.find("\n", at)
            before = sum(folded.count(q, begin, at) for q in QUOTES)
            quoted = before % 2 == 1 and any(folded.find(q, at, end if end >= 0 else len(folded)) >= 0 for q in QUOTES)
        cued = any(spans[j][0] in CUES for j in range(max(0, i - CONTEXT), i))
        n_quoted += quoted
        n_cued += cued
        others += sum(1 for j in (nth - 1, nth + 1) if 0 <= j < len(places) and abs(places[j] - i) <= CONTEXT)
        if edits == 0:
            n_exact += 1
            exact = exact if quoted else max(exact, weight)
        else:
            n_near += 1
            near = near if quoted else max(near, weight / (1 + edits))
    return [exact, log1p(n_exact), near, log1p(n_near), log1p(n_quoted), log1p(n_cued), log1p(others), 10 * len(places) / len(words)]


def _marks(words: set[bytes]) -> set[str]:
    """The words of a document as closed terms, and their beginnings as open ones."""
    out = set()
    for word in words:
        letters = word.decode()
        out.add(letters)
        out.update(letters[:k] + "*" for k in PREFIXES if k < len(letters))
    return out


def _tail(t: int, n: int, share: float) -> float:
    """Logarithm of the chance that of n documents t or more are toxic, if each is with that share: the whole tail."""
    k = np.arange(t, n + 1)
    if not len(k):
        return -np.inf
    # Sums of logarithms: log C(n, k) for all k at once.
    factorial = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, n + 1)))])
    logs = factorial[n] - factorial[k] - factorial[n - k] + k * log(share) + (n - k) * log(1 - share)
    most = logs.max()
    return float(most + log(np.exp(logs - most).sum()))


def least_count(toxic: int, clean: int, tests: int) -> int:
    """Toxic documents a mark needs to stand out beyond chance even if no clean one holds it."""
    share, limit = toxic / (toxic + clean), log(0.05 / max(1, tests))
    return max(2, ceil(limit / log(share) - 1e-9))


def choose_terms(counts: Mapping[str, tuple[int, int]], toxic: int, clean: int, tests: int) -> dict[str, float]:
    """Terms and weights from (toxic, clean) documents per mark.

    A term must be sure (``SURE``) and stand out beyond chance, given how many marks were tried. The weight is
    the smoothed logarithm of the odds. Of a beginning and its continuations the one is taken that tells most
    (toxic documents times weight), the longest of equals; what neither begins nor continues it stays to be
    taken. A stem so covers words that the sample lacks.
    """
    share = toxic / (toxic + clean)
    limit = log(0.05 / max(1, tests))
    good = {m: (t, c) for m, (t, c) in counts.items() if t >= 2 and t / (t + c) >= SURE and _tail(t, t + c, share) <= limit}
    longer: dict[str, list[str]] = {}
    for m in good:
        letters = m.rstrip("*")
        for k in range(1, len(letters) + (not m.endswith("*"))):
            longer.setdefault(letters[:k] + "*", []).append(m)
    weight = {m: min(8.0, log((t + 0.5) / (toxic + 1)) - log((c + 0.5) / (clean + 1))) for m, (t, c) in good.items()}
    chosen: dict[str, float] = {}
    covered: set[str] = set()
    for m in sorted(good, key=lambda x: (len(x.rstrip("*")), not x.endswith("*"), x)):
        if m in covered:
            continue
        under = [x for x in (longer.get(m, []) if m.endswith("*") else []) if x not in covered]
        term = max([m, *under], key=lambda x: (good[x][0] * weight[x], len(x.rstrip("*")), x))
        chosen[term] = weight[term]
        letters = term.rstrip("*")
        covered.update([term, *longer.get(term, []), *(letters[:k] + "*" for k in range(1, len(letters) + 1))])
    return chosen


@dataclass
class Model:
    """Lexicon and weights; ``base`` is the score of a text without hits if nothing could be fitted."""

    terms: dict[str, float] = field(default_factory=dict)
    exempt: list[str] = field(default_factory=list)
    weights: list[float] | None = None
    base: float = 0.0

    def scorer(self):
        lexicon = Lexicon(self.terms, self.exempt)

        def score(text: str | None) -> float:
            if self.weights is None:
                return self.base
            x = sum(w * f for w, f in zip(self.weights, [1.0, *features(text, lexicon)]))
            return 1 / (1 + exp(-max(-30.0, min(30.0, x))))

        return score


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 50) -> list[float]:
    """Weights of a logistic regression with a bias, by damped Newton steps; features are scaled inside."""
    scale = np.maximum(x.std(0), 1e-9)
    z = np.column_stack([np.ones(len(x)), x / scale])
    w = np.zeros(z.shape[1])
    ridge = np.diag([1e-6, *[penalty] * x.shape[1]])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge + 1e-9 * np.eye(len(w)), z.T @ (y - p) - ridge @ w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return [float(w[0]), *(w[1:] / scale).tolist()]


def held_out(key: Column) -> Column:
    """Whether a row is kept from training: crc32 of its id as text leaves 0 when divided by 5."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _sample(documents: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled training documents; a document labelled twice counts as toxic if
    one label says so."""
    known = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # At most ``rows`` pairs of numbers.
    return documents.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))


def _counted(sample: DataFrame, marks_of) -> DataFrame:
    """(mark, toxic, clean): in how many documents of either label each mark stands, summed per batch first.

    ``marks_of`` is called once per task and returns the function from a text to its marks.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = marks_of()
        for batch in batches:
            counts = (Counter(), Counter())
            for text, toxic in zip(batch.column(0), batch.column(1)):
                counts[toxic.as_py() > 0].update(marks(text.as_py()))
            names = list(counts[0].keys() | counts[1].keys())
            for at in range(0, len(names), 100_000):
                part = names[at:at + 100_000]
                yield pa.RecordBatch.from_pydict({"mark": pa.array(part, pa.string()), "toxic": pa.array([counts[1][m] for m in part], pa.int64()),
                                                  "clean": pa.array([counts[0][m] for m in part], pa.int64())})

    return (sample.mapInArrow(tidy(run), "mark string, toxic bigint, clean bigint").groupBy("mark")
            .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def fit(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from the labelled training rows among ``documents``; only their texts and labels are used.

    The rows are at most ``sample_rows``; their texts are staged, so ``documents`` is read once. All marks of theirs that
    pass the test become terms, and all their doubtful words are exempt: the sample alone bounds how many they are.

    Without toxic or without clean rows there is nothing to tell apart: all texts get the share of toxic rows.
    """
    place = fresh_dir(documents.sparkSession, "toxicity-sample")
    _sample(documents, labels, sample_rows).write.parquet(place)
    sample = documents.sparkSession.read.parquet(place)
    total = sample.agg(F.count_if(F.col("toxic") > 0), F.count_if(F.col("toxic") <= 0)).first()
    toxic, clean = int(total[0]), int(total[1])
    if not toxic or not clean:
        return Model(base=1.0 if toxic else 0.0)
    marked = _counted(sample, lambda: lambda text: _marks(set(letter_words(text))))
    # Marks that could be sure. Those in too few documents to stand out, whoever they are, stay out of the driver's way.
    likely = marked.filter((F.col("toxic") >= 2) & (F.col("toxic") >= SURE * (F.col("toxic") + F.col("clean"))))
    tests = toxic * len(PREFIXES) * 100
    fewest = least_count(toxic, clean, tests)
    rows = likely.filter(F.col("toxic") >= fewest).collect()
    terms = choose_terms({r["mark"]: (r["toxic"], r["clean"]) for r in rows}, toxic, clean, tests)

    def near():
        lexicon = Lexicon(terms)
        return lambda text: {w.decode() for w in set(letter_words(text)) if (h := lexicon.hit(w)) and h[1] > 0}

    # Words within reach of a term that stand in clean documents as a matter of course are not misspellings.
    doubtful = _counted(sample, near).filter((F.col("clean") >= 2) & (F.col("clean") * toxic >= F.col("toxic") * clean * F.lit(0.2)))
    exempt = [r["mark"] for r in doubtful.select("mark").collect()]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(terms, exempt)
        for batch in batches:
            values = [features(t.as_py(), lexicon) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.list_(pa.float64())), batch.column(1)], ["f", "toxic"])

    # At most sample_rows rows of eight numbers.
    measured = sample.mapInArrow(tidy(measure), "f array<double>, toxic int").collect()
    x, y = np.array([r["f"] for r in measured]), np.array([r["toxic"] > 0 for r in measured], float)
    return Model(terms, exempt, fit_logistic(x, y))


def score_texts(documents: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``documents`` with ``out`` from 0 to 1, in place of a column of that name; null and empty texts get the score
    of a text without hits."""
    documents = documents.drop(out)
    names, at = documents.columns, documents.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            scores = pa.array([score(t.as_py()) for t in batch.column(at)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*names, out])

    return documents.mapInArrow(tidy(run), documents.withColumn(out, F.lit(0.0)).schema)


def drop_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents scored under 0.5; the columns stay, whatever their names."""
    score, = unused(documents.columns, "toxicity")
    return score_texts(documents, fit(documents, labels), out=score).filter(F.col(score) < 0.5).drop(score)


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_texts(documents, fit(documents, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
