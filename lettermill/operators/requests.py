"""Building model requests: prompt maps, expansion, chaining of answers, chat payloads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill.functions.text import chat_wrap, is_unknown, mentions_study, optional_clause, trim_newlines
from lettermill.operators.gate import drop_prompt_if
from lettermill.rules import PROMPT_ORDER, fill_template

DROPPABLE_KIND = "studies"


@dataclass(frozen=True)
class PromptSet:
    """Texts by kind, one per variant, and the clauses for what was extracted.

    Slots are ``{findings}``, ``{grounds}``, ``{treatment_clause}``, ``{diagnosis_clause}``; in a clause ``{value}``.
    ``#kind#`` stands for the answer given earlier for that kind.
    """

    kinds: Mapping[str, Sequence[str]]
    treatment_clause: str
    diagnosis_clause: str


def build_prompts(decisions: DataFrame, templates: PromptSet, use_known: bool = False, study_mode: str = "intended", instruct: bool = False) -> DataFrame:
    """``index``, ``prompts`` (kind to variants), ``known`` (kind to value already extracted) of enriched decisions.

    The studies prompt goes where no study is mentioned: in the findings, or with
    ``study_mode='reference'`` (literal test) in the grounds. ``use_known`` moves the kinds whose value
    is already known from ``prompts`` to ``known``; without it ``known`` is empty.
    """
    slots = {
        "findings": trim_newlines(F.col("Findings")), "grounds": F.col("Type"),
        "treatment_clause": optional_clause(F.col("treatment_extracted"), templates.treatment_clause),
        "diagnosis_clause": optional_clause(F.col("diagnosis_extracted"), templates.diagnosis_clause),
    }
    wrap = chat_wrap if instruct else (lambda text: text)
    entries: list[Column] = []
    for kind, texts in templates.kinds.items():
        entries += [F.lit(kind), F.array(*[wrap(fill_template(text, **slots)) for text in texts])]
    studied = mentions_study(F.col("Type" if study_mode == "reference" else "Findings"), mode=study_mode)

    facts = {"treatment": "treatment_extracted", "diagnosis": "diagnosis_extracted", "reason_for_denial": "Type"}
    none = F.create_map().cast("map<string,string>")
    known = none
    if use_known:
        known = F.map_filter(F.create_map(*[c for kind, column in facts.items() for c in (F.lit(kind), F.col(column))]),
                             lambda _, value: ~is_unknown(value))
    built = decisions.select(F.col("ReferenceID").alias("index"), F.create_map(*entries).alias("prompts"),
                             known.alias("known"), studied.alias("_studied"))
    built = drop_prompt_if(built, DROPPABLE_KIND, ~F.col("_studied")).drop("_studied")
    if use_known:
        built = built.withColumn("prompts", F.map_filter("prompts", lambda kind, _: ~F.map_contains_key("known", kind)))
    return built


def explode_known(prompts: DataFrame) -> DataFrame:
    """(index, kind, value) of what is known without asking."""
    return prompts.select("index", F.explode("known").alias("kind", "value"))


def explode_prompts(prompts: DataFrame) -> DataFrame:
    """(index, kind, variant, prompt); ``variant`` counts from 0."""
    kinds = prompts.select("index", F.explode("prompts").alias("kind", "texts"))
    return kinds.select("index", "kind", F.posexplode("texts").alias("variant", "prompt"))


def _order_of(kind: Column, order: Sequence[str]) -> Column:
    return F.element_at(F.create_map(*[F.lit(v) for i, k in enumerate(order) for v in (k, i)]), kind)


def expand_requests(prompts: DataFrame, models: Sequence[tuple[str, int]], order: Sequence[str] = PROMPT_ORDER) -> DataFrame:
    """One row per request: every prompt of an ordered kind, for every model.

    The model list is a literal array that is exploded in place; nothing is joined or shuffled. Kinds
    outside ``order`` are not requested. Model index 0 gets no tag.
    """
    listed = F.array(*[F.struct(F.lit(name).alias("model"), F.lit(index).cast("bigint").alias("model_index"))
                       for name, index in models])
    rows = explode_prompts(prompts).withColumn("ord", _order_of(F.col("kind"), order)).filter("ord IS NOT NULL")
    rows = rows.withColumn("_m", F.explode(listed))
    tag = F.when(F.col("_m.model_index") == 0, "").otherwise(F.concat(F.col("_m.model_index").cast("string"), F.lit("-")))
    return rows.select("index", "kind", F.col("ord").cast("bigint").alias("ord"), F.col("variant").cast("bigint").alias("variant"),
                       "_m.model", "_m.model_index", tag.alias("model_tag"),
                       F.concat("index", F.lit("MAGIC"), tag, F.col("variant").cast("string"), "kind", F.lit(".txt")).alias("target"),
                       "prompt")


def substitute(requests: DataFrame, answers: DataFrame, order: Sequence[str] = PROMPT_ORDER) -> DataFrame:
    """Requests with ``#kind#`` marks replaced by the answers given to earlier kinds of the same case and model.

    ``answers`` is (index, model_index, kind, variant, response); the last variant of a kind counts.
    Marks without an answer stay. A later kind's request needs the answers of the rounds before it, so
    this is called once per round with the answers stored so far.
    """
    earlier = answers.withColumn("_ord", _order_of(F.col("kind"), order)).filter("_ord IS NOT NULL AND response IS NOT NULL")
    last = earlier.groupBy("index", "model_index", "kind", "_ord").agg(F.max_by("response", "variant").alias("response"))
    # At most one entry per ordered kind.
    packed = last.groupBy("index", "model_index").agg(
        F.sort_array(F.collect_list(F.struct("_ord", "kind", "response"))).alias("_answers"))
    joined = requests.join(packed, ["index", "model_index"], "left")
    usable = F.filter(F.coalesce("_answers", F.array().cast("array<struct<_ord:int,kind:string,response:string>>")),
                      lambda a: a["_ord"] < F.col("ord"))
    filled = F.aggregate(usable, F.col("prompt"),
                         lambda text, a: F.replace(text, F.concat(F.lit("#"), a["kind"], F.lit("#")), a["response"]))
    return (joined.withColumn("prompt", F.when(F.contains("prompt", F.lit("#")), filled).otherwise(F.col("prompt")))
            .select(*requests.columns))


def chat_messages(prompt: Column, previous: Column | None = None, error: Column | None = None,
                  feedback_template: str = "{error}") -> Column:
    """The chat turns: the prompt and, where there was an earlier answer, that answer and the feedback."""
    def turn(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    first = F.array(turn("user", prompt))
    if previous is None:
        return first
    feedback = fill_template(feedback_template, error=error if error is not None else F.lit(""))
    return F.when(previous.isNotNull(), F.concat(first, F.array(
        turn("assistant", previous), turn("user", feedback)))).otherwise(first)


def chat_payload(model: Column, messages: Column) -> Column:
    return F.to_json(F.struct(model.alias("model"), messages.alias("messages")))


def feedback_text(links_template: str, words_template: str, bad_urls: Column | None = None, hits: Column | None = None) -> Column:
    """What was wrong with an answer: links that do not work, phrases it must not use; a template has ``{listed}``."""
    parts = [fill_template(template, listed=F.array_join(listed, ", "))
             for template, listed in ((links_template, bad_urls), (words_template, hits)) if listed is not None]
    return F.concat_ws(" ", *parts)


def short_prompt(decisions: DataFrame, with_diagnosis: str, without: str) -> DataFrame:
    """(index, prompt): a sentence to complete, from treatment and the finest diagnosis category at hand."""
    diagnosis = F.coalesce(F.nullif(F.col("DiagnosisSubCategory"), F.lit("")), F.col("DiagnosisCategory"))
    treatment = F.col("treatment_extracted")
    prompt = F.when(diagnosis.isNotNull(), fill_template(with_diagnosis, treatment=treatment, diagnosis=diagnosis)).otherwise(
        fill_template(without, treatment=treatment))
    return decisions.filter(treatment.isNotNull()).select(F.col("ReferenceID").alias("index"), prompt.alias("prompt"))


def eval_prompts(letters: DataFrame, template: str, suffix: str = "_rejection.txt", text: str = "text", path: str = "path") -> DataFrame:
    """Evaluation prompts from rejection letters written by people, told by the file name; ``{letter}`` is the text."""
    return letters.filter(F.endswith(F.col(path), F.lit(suffix))).select(path, fill_template(template, letter=F.col(text)).alias("prompt"))


def attach_results(ids: DataFrame, results: DataFrame, key: Sequence[str]) -> DataFrame:
    return ids.join(results, list(key))


def wrap_letter(completions: DataFrame, template: str, path: Column, reason: str = "answer") -> DataFrame:
    """(path, text): letters round completed sentences; ``{reason}`` is the completion, null ones give no letter."""
    return completions.filter(F.col(reason).isNotNull()).select(path.alias("path"), fill_template(template, reason=F.col(reason)).alias("text"))


def validate_jobs(df: DataFrame, job: str = "job") -> DataFrame:
    """Add ``prompt`` and ``error``, one of them null, from a job's JSON text."""
    parsed = F.try_parse_json(F.col(job))
    asked = F.try_variant_get(parsed, "$.input", "variant")
    prompt = F.try_variant_get(parsed, "$.input.prompt", "variant")
    text = F.when(F.schema_of_variant(prompt) == "STRING", F.try_variant_get(parsed, "$.input.prompt", "string"))
    # The error texts.
    error = (F.when(asked.isNull(), F.concat(F.lit("No input in "), F.col(job)))
             .when(prompt.isNull(), F.concat(F.lit("No prompt in "), F.col(job)))
             .when(F.coalesce(text, F.lit("")) == "", F.lit("Prompt must not be none")))
    return df.withColumns({"prompt": F.when(error.isNull(), text), "error": error})
