"""Extraction: cascades over case findings, file names, recommendations, code lookup."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill.rules import HUMAN_BIAS, LETTER_TYPES, MODEL_TAGS, PRODUCER_TAGS, TYPE_ALIASES, ExtractRule


def category_fallback(category: Column, sub_category: Column, other: str = "Other") -> Column:
    """Category and sub-category run together; null for the catch-all category."""
    sub = F.when(sub_category == other, "").otherwise(F.coalesce(sub_category, F.lit("")))
    return F.when(F.coalesce(category, F.lit("")) != other, F.concat(F.coalesce(category, F.lit("")), sub))


def cascade(text: Column, rules: Sequence[ExtractRule], fallback: Column | None = None,
            min_length: int = 3) -> Column:
    """The first capture, in rule order, of at least ``min_length`` characters; else ``fallback``.

    Each pattern is tried once per row, and only if those before it failed.
    """
    captures = []
    for rule in rules:
        found = F.array(F.regexp_extract(text, "(?iu)" + rule.pattern, rule.group))
        captures.append(F.get(F.filter(found, lambda capture: F.length(capture) >= min_length), F.lit(0)))
    if fallback is not None:
        captures.append(fallback)
    return F.coalesce(*captures)


def extract_cascade(df: DataFrame, text: str, out: str, rules: Sequence[ExtractRule],
                    category: str, sub_category: str) -> DataFrame:
    fallback = category_fallback(F.col(category), F.col(sub_category))
    return df.withColumn(out, cascade(F.col(text), rules, fallback))


def enrich(df: DataFrame, treatment_rules: Sequence[ExtractRule], diagnosis_rules: Sequence[ExtractRule]) -> DataFrame:
    """Decisions with ``treatment_extracted`` and ``diagnosis_extracted``.

    The two are laid out as an array of one struct and inlined: projections above are not merged into it, so
    the cascades run once per row however often their results are used.
    """
    findings = F.col("Findings")
    found = F.struct(
        cascade(findings, treatment_rules, category_fallback(F.col("TreatmentCategory"), F.col("TreatmentSubCategory"))).alias("treatment_extracted"),
        cascade(findings, diagnosis_rules, category_fallback(F.col("DiagnosisCategory"), F.col("DiagnosisSubCategory"))).alias("diagnosis_extracted"))
    return df.select("*", F.inline(F.array(found)))


def decode_name(df: DataFrame, path: str = "path", types: Sequence[str] = LETTER_TYPES,
                tags: Sequence[str] = PRODUCER_TAGS) -> DataFrame:
    """Add ``case_id``, ``producer`` and ``letter_type`` read from the file name.

    A name that does not decode leaves all three null. Longer type names are tried first, so that one
    type name may end in another.
    """
    longest_first = sorted(types, key=len, reverse=True)
    pattern = rf".*/(.*?)({'|'.join(tags)}|)_*({'|'.join(map(re.escape, longest_first))})\d*.txt"
    column = F.col(path)
    kind = F.nullif(F.regexp_extract(column, pattern, 3), F.lit(""))
    renamed = kind
    for name, canonical in TYPE_ALIASES.items():
        renamed = F.when(kind == name, canonical).otherwise(renamed)
    return df.withColumns({
        "case_id": F.when(kind.isNotNull(), F.regexp_extract(column, pattern, 1)),
        "producer": F.when(kind.isNotNull(), F.regexp_extract(column, pattern, 2)),
        "letter_type": renamed,
    })


def producer_bias(tag: Column, mode: str = "intended") -> Column:
    """How far a producer is preferred: people most, then the model number before the dash, else 0."""
    number = F.lit(0).cast("bigint")
    if mode != "reference":
        number = F.coalesce(F.regexp_extract(tag, r"(\d+)-", 1).try_cast("bigint"), number)
    from_model = F.lit(False)
    for marker in MODEL_TAGS:
        from_model = from_model | F.contains(tag, F.lit(marker))
    return F.when(tag.isNotNull(), F.when(from_model, number).otherwise(F.lit(HUMAN_BIAS).cast("bigint")))


def extract_recommendations(pages: DataFrame, text: str = "text", verb: str = "recommends*") -> DataFrame:
    """One row per distinct recommendation of a page: ``pos`` (first place on the page), ``recommendation``."""
    found = F.regexp_extract_all(F.col(text), F.lit(rf"(?iu){verb} ([^.]+)\."), F.lit(1))
    keep = [c for c in pages.columns if c != text]
    return pages.select(*keep, F.posexplode(F.array_distinct(found)).alias("pos", "recommendation"))


def lookup_codes(df: DataFrame, dimension: DataFrame, code: str, dim_code: str) -> DataFrame:
    """Left join to a dimension with one row per code.

    No broadcast hint: a dimension under the session's broadcast limit is broadcast by its measured
    size, a larger one is joined by a shuffle that AQE splits where one code is hot.
    """
    return df.join(dimension, df[code] == dimension[dim_code], "left")
