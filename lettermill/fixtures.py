"""Fixture views over the driver's tables, and the rules, templates and phrases used on them.

The SQL of a view runs as it is in Spark and in DuckDB. Rules are made of words that the tables hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lettermill.operators.records import RecordSet, RecordTemplate
from lettermill.operators.requests import PromptSet
from lettermill.rules import ExtractRule, RewriteRule, RewriteSet

TABLES = ("customer", "orders", "part", "lineitem", "events", "documents", "embeddings", "pages", "conversations")

VIEWS = {
    "fx_imr": """
SELECT concat('EI', lpad(CAST(o_orderkey AS STRING), 8, '0')) AS ReferenceID,
  CASE WHEN o_orderkey % 3 = 0 THEN 'Upheld Decision of Health Plan'
       WHEN o_orderkey % 31 = 0 THEN NULL
       ELSE 'Overturned Decision of Health Plan' END AS Determination,
  CASE WHEN p_size % 7 = 0 THEN 'Other' ELSE p_type END AS TreatmentCategory,
  CASE WHEN p_size % 5 = 0 THEN 'Other' ELSE p_brand END AS TreatmentSubCategory,
  CASE WHEN c_custkey % 11 = 0 THEN 'Other' ELSE c_mktsegment END AS DiagnosisCategory,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'Other' ELSE o_orderpriority END AS DiagnosisSubCategory,
  CASE o_orderkey % 2 WHEN 0 THEN 'Medical Necessity' ELSE 'Experimental study by trial' END AS Type,
  CASE o_orderkey % 7
    WHEN 0 THEN concat('The patient requested coverage for ', p_name, '. A second sentence.')
    WHEN 1 THEN concat('At issue is whether ', p_name, ' was medically necessary for care.')
    WHEN 2 THEN concat('We find the requested medication ', p_name, ' is likely to be of benefit.')
    WHEN 3 THEN concat('The Health Plan determined the ', p_name, ' was not needed.')
    WHEN 4 THEN concat('A person was admitted to the hospital for ', c_mktsegment, ' injury. Their physicians recommended ', p_name, '. End')
    WHEN 5 THEN 'He wishes to undergo surgery now.'
    ELSE 'No pattern here' END AS Findings
FROM orders JOIN customer ON o_custkey = c_custkey
JOIN part ON p_partkey = 1 + (o_orderkey % 199)
""",
    "fx_letters": """
SELECT d.doc_id,
  concat('letters/C', CAST(CAST(floor(d.doc_id / 36) AS BIGINT) AS STRING),
    CASE CAST(floor(d.doc_id / 12) AS BIGINT) % 4
      WHEN 0 THEN '_' WHEN 1 THEN 'MAGIC0' WHEN 2 THEN 'MAGIC60-1' ELSE 'EXTRACTED' END,
    CASE d.doc_id % 12 WHEN 0 THEN 'appeal' WHEN 1 THEN 'denial' WHEN 2 THEN 'rejection'
      WHEN 3 THEN 'medically_necessary' WHEN 4 THEN 'treatment' WHEN 5 THEN 'diagnosis'
      WHEN 6 THEN 'reason_for_denial' WHEN 7 THEN 'studies' WHEN 8 THEN 'patient_history'
      WHEN 9 THEN 'patient_history_questions' WHEN 10 THEN 'json' ELSE 'notes' END,
    '.txt') AS path,
  concat(CASE WHEN d.doc_id % 9 = 0 THEN '<PARAGRAPH> ' ELSE '' END, d.text,
    CASE WHEN d.doc_id % 5 = 0 THEN concat(' See ', p.url, '.') ELSE '' END,
    CASE WHEN d.doc_id % 8 = 0 THEN ' ### Response: short answer' ELSE '' END) AS raw_text
FROM documents d JOIN pages p ON p.page_id = d.doc_id % 50
""",
    "fx_url_status": """
SELECT lower(url) AS url, max(CASE WHEN page_id % 3 = 0 THEN 0 ELSE 1 END) AS ok
FROM pages GROUP BY lower(url)
""",
    "fx_guideline_pages": """
SELECT concat('src/', source, '.pdf') AS pdf, doc_id AS page_no,
  replace(text, ' the ', ' recommends the ') AS text
FROM documents WHERE lang = 'en'
""",
    "fx_drugs": """
SELECT p_partkey AS drug_id, p_name AS name,
  CASE WHEN p_size % 6 = 0 THEN NULL ELSE p_brand END AS primary_site, p_type AS category,
  CASE WHEN p_size % 4 = 0 THEN NULL ELSE concat('size ', CAST(p_size AS STRING)) END AS remarks
FROM part
""",
    "fx_completions": """
SELECT u.conv_id, a.turn AS attempt, u.text AS prompt,
  CASE (a.conv_id + a.turn) % 6
    WHEN 0 THEN concat(u.text, a.text)
    WHEN 1 THEN concat('<s>[INST]', u.text, '[/INST]', a.text)
    WHEN 2 THEN concat('x[OUT]', a.text)
    WHEN 3 THEN concat('x[ASN]', a.text, '[ASN]tail')
    WHEN 4 THEN concat('<s>[INST]', u.text, '[/INST][/INST]', a.text)
    ELSE concat('The reviewer determined that the requested ', a.text) END AS raw
FROM conversations u JOIN conversations a
  ON u.conv_id = a.conv_id AND a.turn = u.turn + 1 AND u.role = 'user' AND a.role = 'assistant'
""",
}

TREATMENT_RULES = (
    ExtractRule(r"requested coverage for ([^.]+)\."),
    ExtractRule(r"at issue is whether (.+?) was medically necessary"),
    ExtractRule(r"requested medication (.+?) is likely"),
    ExtractRule(r"health plan determined the (.+?) was not"),
    ExtractRule(r"recommended ([^.]+)\."),
    ExtractRule(r"he wishes (to)\b"),
    ExtractRule(r"undergo ([^.]+)\."),
)
DIAGNOSIS_RULES = (ExtractRule(r"seeking (.+?) for ([^.]+)", 2), ExtractRule(r"admitted to the hospital for ([^.]+)\."))

PHRASES = {"appeal": ["erest", "Thinthe"], "denial": ["ndand"], "treatment": ["enqueç", "tionin"], "diagnosis": ["erst ", "of\nof"]}
FLAT_PHRASES = {"appeal": ["erest", "Thinthe"], "denial": ["ndand"], "treatment": ["enqueç", "tionin"], "diagnosis": ["erst "]}
REWRITES = RewriteSet(
    general=(RewriteRule("eriner", "eri"), RewriteRule("The and attion", "An action")),
    by_type={"denial": (RewriteRule("thanedble", "that's $1"),), "appeal": (RewriteRule(r"er(n|s)ter", r"ea\1", True),)})

PROMPTS = PromptSet(
    kinds={
        "denial": ("Findings: {findings} Grounds: {grounds}.{treatment_clause} Draft the letter of refusal.",
                   "{findings}{treatment_clause}{diagnosis_clause} Draft a brief refusal."),
        "appeal": ("Findings: {findings} Grounds: {grounds}.{treatment_clause} Draft an appeal.",
                   "{findings}{treatment_clause}{diagnosis_clause} Draft an appeal in the first person."),
        "medically_necessary": ("{findings} With #diagnosis# and #treatment# in mind: why is it needed?",),
        "studies": ("List the studies in: {findings}",),
        "patient_history": ("{findings}{treatment_clause}{diagnosis_clause} Which earlier facts count?",),
        "patient_history_questions": ("{findings} Given #patient_history#, what should be asked?",),
        "reason_for_denial": ("{findings} Grounds: {grounds}. Name the reason.",),
        "treatment": ("{findings}{treatment_clause} Name the treatment.",),
        "cpt_codes": ("{findings} Procedure codes?",),
        "diagnosis": ("{findings}{diagnosis_clause} Name the diagnosis.",),
        "icd10": ("{findings} Diagnosis codes?",),
    },
    treatment_clause=" Treatment, perhaps: {value}.", diagnosis_clause=" Diagnosis, perhaps: {value}.")
MODELS = (("first-model", 0), ("second-model", 3))

RECORDS = RecordSet(
    kinds={
        "why": RecordTemplate("You explain.", "{history_clause}Why {treatment} for {diagnosis}?"),
        "studies": RecordTemplate("You cite.", "Studies on {treatment} for {diagnosis}?"),
        "appeal": RecordTemplate("You appeal.", "Denial: {rejection}{treatment_clause}{history_clause}{diagnosis_clause} Appeal it."),
        "reason": RecordTemplate("You explain.", "Denial: {rejection} Reason?"),
        "treatment": RecordTemplate("You explain.", "Denial: {rejection} Treatment?"),
        "diagnosis": RecordTemplate("You explain.", "Denial: {rejection} Diagnosis?"),
    },
    clauses={"treatment_clause": " T: {value}", "history_clause": " H: {value}", "diagnosis_clause": " D: {value}"})
GUIDELINE = RecordTemplate("You advise.", "What does {pdf} advise?")
DRUG_QUESTION = "What is known of {name}?"
DRUG_ANSWER = "{alternate}: {primary_site}; {category}; {remarks}"
DRUG_SYSTEM = "You know drugs."
LETTER = "To whom it may concern: {reason} Yours"
WEIGHTS = {"the": 3, "that": 2, "qu": -5, "erest": -100}


def tables(spark: SparkSession, sf_dir: str) -> None:
    """The driver's tables as temporary views under their own names."""
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view, or a table of the driver, over the given data."""
    tables(spark, sf_dir)
    return spark.sql(VIEWS[name]) if name in VIEWS else spark.table(name)


def with_views(sql: str, *names: str) -> str:
    """``sql`` with fixture views in front of it as common table expressions."""
    parts = ", ".join(f"{name} AS ({VIEWS[name]})" for name in names)
    head, _, rest = sql.strip().partition(" ")
    if head.upper() == "WITH":
        return f"WITH {parts}, {rest}"
    return f"WITH {parts} {sql}"
