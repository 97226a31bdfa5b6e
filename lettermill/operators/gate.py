"""Gates: phrase checks, null checks, skip-what-is-done joins."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill.operators.contain import phrases_in
from lettermill.rules import TYPE_ALIASES


def keep_contains(df: DataFrame, column: str, word: str) -> DataFrame:
    """Rows whose column holds the word, as written; null rows go."""
    return df.filter(F.contains(F.col(column), F.lit(word)))


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def path_endswith(df: DataFrame, suffix: str, path: str = "path") -> DataFrame:
    return df.filter(F.endswith(F.col(path), F.lit(suffix)))


def _phrases_by_type(phrases: Mapping[str, Sequence[str]]) -> dict[str, list[str]]:
    merged: dict[str, list[str]] = {}
    for name, listed in phrases.items():
        own = merged.setdefault(TYPE_ALIASES.get(name, name), [])
        for phrase in listed:
            if phrase.strip() and phrase.lower() not in own:
                own.append(phrase.lower())
    return merged


def _by_type(letter_type: Column, phrases: Mapping[str, Sequence[str]], otherwise: Column,
             value: Callable[[list[str]], Column]) -> Column:
    result = None
    for name, listed in _phrases_by_type(phrases).items():
        if listed:
            own = value(listed)
            result = F.when(letter_type == name, own) if result is None else result.when(letter_type == name, own)
    return otherwise if result is None else F.coalesce(result, otherwise)


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once per row."""
    return F.transform(F.array(value), lambda bound: use(bound))[0]


def phrase_hits(haystack: Column, letter_type: Column, phrases: Mapping[str, Sequence[str]]) -> Column:
    """The lowercased phrases of the letter's type that occur in ``haystack``, in list order."""
    def hits(listed: list[str]) -> Column:
        wanted = F.array(*[F.lit(p) for p in listed])
        return _bind(haystack, lambda h: F.filter(wanted, lambda p: F.contains(h, p)))

    return _by_type(letter_type, phrases, F.array().cast("array<string>"), hits)


def banned_hits(df: DataFrame, phrases: Mapping[str, Sequence[str]], text: str = "text",
                letter_type: str = "letter_type", fold_case: bool = True) -> DataFrame:
    """Add ``hits`` and ``is_bad``; letters of a type without phrases pass.

    ``fold_case=False`` looks the lowercased phrases up in the text as written.
    """
    haystack = F.lower(F.col(text)) if fold_case else F.col(text)
    return (df.withColumn("hits", phrase_hits(haystack, F.col(letter_type), phrases))
            .withColumn("is_bad", F.size("hits") > 0))


def is_bad(text: Column, letter_type: Column, phrases: Mapping[str, Sequence[str]],
           fold_case: bool = True) -> Column:
    """Whether any banned phrase of the letter's type occurs; stops at the first one found."""
    haystack = F.lower(text) if fold_case else text

    def any_of(listed: list[str]) -> Column:
        return _bind(haystack, lambda h: reduce(or_, [F.contains(h, F.lit(p)) for p in listed]))

    return _by_type(letter_type, phrases, F.lit(False), any_of)


def gate(df: DataFrame, phrases: Mapping[str, Sequence[str]], text: str = "text",
         letter_type: str = "letter_type", fold_case: bool = True) -> DataFrame:
    """Drop bad letters. Line feeds are removed first, so a phrase may run across lines."""
    one_line = F.replace(F.col(text), F.lit("\n"), F.lit(""))
    return df.filter(~is_bad(one_line, F.col(letter_type), phrases, fold_case))


def split_good_bad(df: DataFrame, phrases: Mapping[str, Sequence[str]], text: str = "response",
                   letter_type: str = "kind", fold_case: bool = True) -> tuple[DataFrame, DataFrame]:
    """Responses fit to store, and those to ask for again (with their hits)."""
    checked = banned_hits(df, phrases, text, letter_type, fold_case)
    return checked.filter(~F.col("is_bad")).drop("hits", "is_bad"), checked.filter("is_bad")


def match_phrases(df: DataFrame, rules: DataFrame, key: Sequence[str], text: str = "text", letter_type: str = "letter_type") -> DataFrame:
    """(letter_type, key, phrase) for every phrase of a text's type found in it, any case.

    ``rules`` is a table (letter_type, phrase) of any size, ``key`` names a text. Phrases are looked up by their rarest run of
    characters (``contain.phrases_in``); blank ones occur nowhere.
    """
    listed = rules.select(F.col(letter_type), F.lower("phrase").alias("phrase")).filter(F.btrim("phrase") != "")
    folded = df.select(letter_type, *key, F.lower(text).alias("_folded"))
    return phrases_in(folded, key, "_folded", listed, "phrase", letter_type)


def drop_prompt_if(df: DataFrame, kind: str, condition: Column, prompts: str = "prompts") -> DataFrame:
    """Remove one kind from the prompt map where the condition holds."""
    kept = F.map_filter(F.col(prompts), lambda k, _: k != kind)
    return df.withColumn(prompts, F.when(condition, kept).otherwise(F.col(prompts)))


def good_answers(store: DataFrame, phrases: Mapping[str, Sequence[str]], fold_case: bool = True) -> DataFrame:
    """Stored responses that pass the gate of their kind."""
    return gate(store, phrases, "response", "kind", fold_case)


REQUEST_KEY = ("index", "kind", "model_index", "variant")


def pending(requests: DataFrame, store: DataFrame, phrases: Mapping[str, Sequence[str]],
            key: Sequence[str] = REQUEST_KEY, fold_case: bool = True) -> DataFrame:
    """Requests without a good stored answer: never asked, or answered badly."""
    done_keys = good_answers(store, phrases, fold_case).select(*key)
    return requests.join(done_keys, list(key), "left_anti")


def done(requests: DataFrame, store: DataFrame, phrases: Mapping[str, Sequence[str]],
         key: Sequence[str] = REQUEST_KEY, fold_case: bool = True) -> DataFrame:
    """Requests with their good stored answer (a store holds one answer per key)."""
    answers = good_answers(store, phrases, fold_case).select(*key, "response")
    return requests.join(answers, list(key))
