"""Training records from cases, drugs and guideline pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill.functions.text import dedup_key, drug_qa, normalise_page, truncate_chars, wrap_prompt
from lettermill.operators.extract import extract_recommendations
from lettermill.operators.gate import path_endswith
from lettermill.operators.select import best_per_rejection, case_wide, choose_best, dedup_first
from lettermill.rules import MAX_ANSWER_CHARS, RECOMMENDATION_SEPARATOR, fill_template
from lettermill.sources.scratch import fresh_dir

RECORD_COLUMNS = ("case_id", "kind", "source_path", "system", "instruction", "result")
WIDE_TYPES = ("appeal", "diagnosis", "medically_necessary", "patient_history", "studies", "treatment")


@dataclass(frozen=True)
class RecordTemplate:
    """Texts of one kind of record; slots are case columns and the clauses."""

    system: str
    instruction: str


@dataclass(frozen=True)
class RecordSet:
    """Templates by kind of record, and the clauses that stand for the case's own text or for nothing.

    Clauses are ``treatment_clause``, ``history_clause`` and ``diagnosis_clause``, each with ``{value}``.
    """

    kinds: Mapping[str, RecordTemplate]
    clauses: Mapping[str, str]


def _clause(records: RecordSet, name: str, value: str) -> Column:
    return F.when(F.col(value).isNotNull(), fill_template(records.clauses[name], value=F.col(value))).otherwise("")


def case_records(scored: DataFrame, records: RecordSet) -> DataFrame:
    """All records of all cases, from letters with ``base_score`` (see ``select.score_letters``).

    Per case a "why" and a "studies" record, where the case has the texts for them. Per rejection an
    appeal, a reason, a treatment and a diagnosis record, likewise; treatment and reason are chosen
    anew against each rejection.

    The best texts of a case are one row; rejections join it by case. A hot case is split there by AQE:
    nothing after that join asks for rows of a case together. All record kinds of a case, and of a rejection, are laid
    out in one array and exploded, so the letters are read once for all of them; the best texts are staged.
    """
    place = fresh_dir(scored.sparkSession, "best-texts")
    case_wide(choose_best(scored.filter(F.col("letter_type").isin(*WIDE_TYPES))), WIDE_TYPES).write.parquet(place)
    wide = scored.sparkSession.read.parquet(place)
    cased = wide.withColumns({"history_clause": _clause(records, "history_clause", "patient_history"),
                              "diagnosis_clause": _clause(records, "diagnosis_clause", "diagnosis"),
                              "source_path": F.lit("")})
    own = {c: F.col(c) for c in ("history_clause", "diagnosis", "treatment")}

    def once(kind: str, result: str) -> Column:
        """A case's record of a kind, null where a text for it is missing."""
        template = records.kinds[kind]
        there = F.col(result).isNotNull() & F.col("treatment").isNotNull() & F.col("diagnosis").isNotNull()
        return F.when(there, F.struct(F.lit(kind).alias("kind"), F.lit(template.system).alias("system"),
                                      fill_template(template.instruction, **own).alias("instruction"), F.col(result).alias("result")))

    per_case = cased.select("case_id", "source_path", F.explode(F.array_compact(F.array(once("why", "medically_necessary"), once("studies", "studies")))).alias("r"))
    of_cases = per_case.select("case_id", "r.kind", "source_path", "r.system", "r.instruction", "r.result")

    chosen = best_per_rejection(scored, ("treatment", "reason_for_denial"))
    per_rejection = chosen.groupBy("rejection_path").agg(
        F.max(F.when(F.col("letter_type") == "treatment", F.col("option_text"))).alias("_treatment"),
        F.max(F.when(F.col("letter_type") == "reason_for_denial", F.col("option_text"))).alias("_reason"))
    rejections = (scored.filter("letter_type = 'rejection'")
                  .select("case_id", F.col("path").alias("rejection_path"), F.col("text").alias("rejection")))
    facts = cased.select("case_id", F.col("appeal").alias("_appeal"), F.col("diagnosis").alias("_diagnosis"),
                         "history_clause", "diagnosis_clause")
    joined = (rejections.join(per_rejection, "rejection_path", "left").join(facts, "case_id", "left")
              .withColumn("treatment_clause", _clause(records, "treatment_clause", "_treatment")))
    clauses = ("rejection", "treatment_clause", "history_clause", "diagnosis_clause")
    slots = {c: F.col(c) for c in clauses}
    kinds = []
    for kind in ("appeal", "reason", "treatment", "diagnosis"):
        template = records.kinds[kind]
        kinds.append(F.when(F.col(f"_{kind}").isNotNull(), F.struct(
            F.lit(kind).alias("kind"), F.lit(template.system).alias("system"),
            fill_template(template.instruction, **slots).alias("instruction"),
            F.col(f"_{kind}").alias("result"))))
    per_kind = joined.select("case_id", F.col("rejection_path").alias("source_path"), F.explode(F.array_compact(F.array(*kinds))).alias("r"))
    of_rejections = per_kind.select("case_id", "r.kind", "source_path", "r.system", "r.instruction", "r.result")
    return of_cases.unionByName(of_rejections)


def drug_records(qa: DataFrame, system: str) -> DataFrame:
    """Records from a (drug, question, answer) table."""
    return qa.select(F.lit(system).alias("system"), F.col("question").alias("instruction"),
                     F.col("answer").alias("result"))


def drug_questions(drugs: DataFrame, question: str, answer: str) -> DataFrame:
    """(drug, question, answer) for the drugs that name a primary site."""
    asked, answered = drug_qa(question, answer, name=F.col("name"), alternate=F.col("name"),
                              primary_site=F.col("primary_site"), category=F.col("category"), remarks=F.col("remarks"))
    return drugs.na.drop(subset=["primary_site"]).select(
        F.col("name").alias("drug"), asked.alias("question"), answered.alias("answer"))


def recommendations(pages: DataFrame) -> DataFrame:
    """Distinct recommendations over all guideline pages: each kept where it is first seen."""
    prepared = pages.withColumn("text", normalise_page(F.col("text")))
    return dedup_first(extract_recommendations(prepared), dedup_key(F.col("recommendation")),
                       ["pdf", "page_no", "pos"])


def concat_per(df: DataFrame, key: str, value: str, order: Sequence[str], separator: str, block_rows: int = 1000) -> DataFrame:
    """(key, joined): the values of a key in order, joined whole.

    ``order[0]`` must be a whole number: its values are cut into ranges of ``block_rows``, each joined by a task
    of its own, so that a hot key is spread; the pieces of a key then meet in the one row they become.
    """
    blocked = df.withColumn("_block", F.floor(F.col(order[0]) / block_rows))
    ordered = F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("_value"))))
    pieces = blocked.groupBy(key, "_block").agg(F.array_join(F.transform(ordered, lambda s: s["_value"]), separator).alias("_piece"))
    joined = F.array_sort(F.collect_list(F.struct("_block", "_piece")))
    return pieces.groupBy(key).agg(F.array_join(F.transform(joined, lambda s: s["_piece"]), separator).alias("joined"))


def guideline_records(pages: DataFrame, template: RecordTemplate) -> DataFrame:
    """One record per guideline document, whole; a document without recommendations has an empty result."""
    documents = path_endswith(pages, ".pdf", "pdf")
    per_pdf = concat_per(recommendations(documents), "pdf", "recommendation", ["page_no", "pos"],
                         RECOMMENDATION_SEPARATOR)
    return (documents.select("pdf").distinct().join(per_pdf, "pdf", "left")
            .select("pdf", F.lit(template.system).alias("system"),
                    fill_template(template.instruction, pdf=F.col("pdf")).alias("instruction"),
                    F.coalesce("joined", F.lit("")).alias("result")))


def all_records(**streams: DataFrame) -> DataFrame:
    """The record streams one after another, each named in ``origin``."""
    merged = None
    for origin, df in streams.items():
        part = df.select(F.lit(origin).alias("origin"), "system", "instruction", "result")
        merged = part if merged is None else merged.unionByName(part)
    return merged


def to_sft(records: DataFrame, limit: int = MAX_ANSWER_CHARS) -> DataFrame:
    """Two-field records: wrapped instruction and output cut to ``limit`` characters."""
    keep = [c for c in records.columns if c not in ("system", "instruction", "result", "context")]
    context = F.col("context") if "context" in records.columns else None
    return records.select(
        *keep, wrap_prompt(F.col("system"), F.col("instruction"), context).alias("instruction"),
        truncate_chars(F.col("result"), limit).alias("output"))


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def counts(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row: ``total`` and a count per named condition, in one pass."""
    return df.agg(F.count("*").alias("total"), *[F.count_if(c).alias(n) for n, c in conditions.items()])
