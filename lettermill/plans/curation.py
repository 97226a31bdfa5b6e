"""From raw letter files to scored letters and training records."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lettermill.functions.jsonish import tolerant_json
from lettermill.functions.text import parse_record
from lettermill.operators.extract import decode_name
from lettermill.operators.gate import gate
from lettermill.operators.records import RecordSet, case_records
from lettermill.operators.select import score_letters
from lettermill.rules import LETTER_TYPES, RewriteSet, rewrite_by_type


def clean_letters(raw: DataFrame, phrases: Mapping[str, Sequence[str]], rewrites: RewriteSet,
                  types: Sequence[str] = LETTER_TYPES, watch: Callable[[str, DataFrame], DataFrame] = lambda name, df: df) -> DataFrame:
    """(path, case_id, producer, letter_type, text) of the letters that decode and pass the gate.

    ``watch`` is handed every step by name and returns it, with what it observes.

    The gate sees the raw text; what is kept is the parsed and rewritten text. Narrow work only: a scan
    and one projection, with the type filter of a later step evaluated before any rewriting.
    """
    decoded = watch("decoded", decode_name(watch("read", raw), "path", types).filter("case_id IS NOT NULL"))
    gated = watch("gated", gate(decoded, phrases, "raw_text", "letter_type"))
    parsed = parse_record(F.col("raw_text"))
    text = F.when(F.col("letter_type") == "json", tolerant_json(parsed)).otherwise(
        rewrite_by_type(parsed, F.col("letter_type"), rewrites))
    return watch("cleaned", gated.select("path", "case_id", "producer", "letter_type", text.alias("text")))


def staged(df: DataFrame, path: str) -> DataFrame:
    """``df`` written once under a path in shared storage, laid out by letter type, and read from there.

    Whoever reads one type scans no other, and nothing before it is worked out again, also not when an
    executor is lost.
    """
    df.write.mode("error").partitionBy("letter_type").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_with_counts(raw: DataFrame, phrases: Mapping[str, Sequence[str]], rewrites: RewriteSet, path: str,
                       text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(cleaned letters staged under ``path``, (step, n, n_empty)): how many rows each step let through, of these how many
    without text. The numbers come out of the run that writes the letters; nothing is read or counted again."""
    seen: dict[str, Observation] = {}

    def watch(name: str, df: DataFrame) -> DataFrame:
        seen[name] = Observation(name)
        shown = text if text in df.columns else "raw_text"
        return df.observe(seen[name], F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(F.col(shown), F.lit("")) == "").alias("n_empty"))

    letters = staged(clean_letters(raw, phrases, rewrites, watch=watch), path)
    rows = [(name, counts["n"], counts["n_empty"]) for name, counts in ((name, o.get) for name, o in seen.items())]
    return letters, raw.sparkSession.createDataFrame(rows, "step string, n bigint, n_empty bigint")


def scored_letters(raw: DataFrame, phrases: Mapping[str, Sequence[str]], rewrites: RewriteSet, stage: str,
                   status: DataFrame | None = None, **scoring) -> DataFrame:
    """Cleaned letters with ``base_score``. Scoring reads the letters several times, and so do the choices made by
    score, so both are staged under ``stage``."""
    cleaned = staged(clean_letters(raw, phrases, rewrites), f"{stage}/cleaned")
    return staged(score_letters(cleaned, status, **scoring), f"{stage}/scored")


def curate(raw: DataFrame, phrases: Mapping[str, Sequence[str]], rewrites: RewriteSet, records: RecordSet,
           stage: str, status: DataFrame | None = None, **scoring) -> DataFrame:
    """Raw letters to records; ``stage`` is a path in shared storage."""
    return case_records(scored_letters(raw, phrases, rewrites, stage, status, **scoring), records)
