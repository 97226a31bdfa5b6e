"""The registered queries of the library's own operators, each with the SQL it must agree with."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill import fixtures as fx
from lettermill.fixtures import view, with_views
from lettermill.functions import jsonish, text as T
from lettermill.operators import chain, extract, gate, generate, packing, prep, records, requests, retrieval, select, urls
from lettermill.operators.rewriting import rewrite_in_rounds
from lettermill.plans.curation import clean_letters, curate, scored_letters, staged, staged_with_counts
from lettermill.rules import LETTER_TYPES, PROMPT_ORDER, URL_STRICT, RewriteRule, RewriteSet
from lettermill.sources import readers, writers
from lettermill.sources.scratch import fresh_dir
from lettermill.sources.store import KeyedStore

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def entry(name: str, sql: str | None = None, *views: str):
    """Register the decorated function as ``name``; ``sql`` may use the fixture views named."""
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = with_views(sql, *views) if views else sql
        return function

    return register


def _long(column) -> F.Column:
    return column.cast("bigint")


def _size(column) -> F.Column:
    return F.size(column).cast("bigint")


# --- A: scans and sinks -------------------------------------------------------------------------

_IMR_COLUMNS = "Determination, TreatmentCategory, TreatmentSubCategory, DiagnosisCategory, DiagnosisSubCategory, Type, Findings, ReferenceID"


@entry("a1_read_decisions", f"SELECT {_IMR_COLUMNS} FROM fx_imr", "fx_imr")
def _(spark, d):
    path = fresh_dir(spark, "decisions")
    view(spark, d, "fx_imr").write.option("header", True).option("escape", '"').csv(path)
    return readers.read_decisions(spark, path)


@entry("a3_read_letters", "SELECT path, raw_text FROM fx_letters", "fx_letters")
def _(spark, d):
    path = fresh_dir(spark, "letters")
    view(spark, d, "fx_letters").select("path", "raw_text").write.parquet(path)
    return readers.read_letters(spark, path, format="parquet")


@entry("a2_repair_utf8", "SELECT doc_id, concat(substr(text, 1, 7), chr(65533), substr(text, 8)) AS text FROM documents")
def _(spark, d):
    cut = lambda *at: F.substring("text", *at).cast("binary")
    bad = [F.unhex(F.lit(h)) for h in ("FF", "E282", "C0AF", "EDA080", "F4908080", "80")]
    end = F.length(F.coalesce("text", F.lit("")))
    # Bytes that are no UTF-8 before, inside and after the text, between them a replacement character that belongs there.
    raw = F.concat(bad[0], cut(F.lit(1), F.lit(7)), bad[1], F.lit("\ufffd").cast("binary"), bad[2], cut(F.lit(8), end), *bad[3:])
    return readers.repair_utf8(view(spark, d, "documents").select("doc_id", raw.alias("text")), "text")


@entry("a3_letter_files", "SELECT path, raw_text FROM fx_letters", "fx_letters")
def _(spark, d):
    path = fresh_dir(spark, "letter-files")
    writers.write_letter_files(view(spark, d, "fx_letters"), path)
    files = readers.read_letters(spark, path, suffix="part-*")
    return files.withColumn("raw_text", F.substring("raw_text", F.lit(1), F.length("raw_text") - 1))


@entry("a4_merge_corpora", "SELECT path, CASE WHEN contains(raw_text, 'See http') THEN concat('second: ', raw_text) ELSE raw_text END AS raw_text FROM fx_letters", "fx_letters")
def _(spark, d):
    letters = view(spark, d, "fx_letters").select("path", "raw_text")
    second = letters.filter(F.contains("raw_text", F.lit("See http"))).withColumn("raw_text", F.concat(F.lit("second: "), "raw_text"))
    return select.merge_corpora([(letters, 0), (second, 1)])


@entry("a5_read_pages", "SELECT pdf, page_no, text FROM fx_guideline_pages", "fx_guideline_pages")
def _(spark, d):
    return readers.read_pages(view(spark, d, "fx_guideline_pages"))


@entry("a6_read_drugs", "SELECT name, primary_site, category, remarks FROM fx_drugs", "fx_drugs")
def _(spark, d):
    path = fresh_dir(spark, "drugs")
    named = {new: old for old, new in readers.DRUG_COLUMNS.items()}
    drugs = view(spark, d, "fx_drugs").drop("drug_id").withColumnsRenamed(named)
    drugs.write.option("header", True).option("escape", '"').csv(path)
    return readers.read_drugs(spark, path)


_WRAP = "concat('[INST] ', CASE WHEN {s} = '' THEN '' ELSE concat('<<SYS>>', {s}, '<</SYS>>') END, {i}, ' ', '[/INST]')"
_DRUG_Q = "concat('What is known of ', name, '?')"
_DRUG_A = "concat(name, ': ', primary_site, '; ', category, '; ', coalesce(remarks, ''))"


def _drug_records(spark, d):
    asked = records.drug_questions(view(spark, d, "fx_drugs"), fx.DRUG_QUESTION, fx.DRUG_ANSWER)
    return records.drug_records(asked, fx.DRUG_SYSTEM)


@entry("a9_articles", "SELECT conv_id, turn, role, CASE WHEN turn % 5 = 0 THEN '' WHEN turn % 7 = 0 THEN NULL ELSE concat(' <b>&', text, chr(10)) END AS text FROM conversations")
def _(spark, d):
    path = fresh_dir(spark, "articles")
    text = F.when(F.col("turn") % 5 == 0, "").when(F.col("turn") % 7 != 0, F.concat(F.lit(" <b>&"), "text", F.lit("\n")))
    writers.write_articles(view(spark, d, "conversations").withColumn("text", text), path)
    return readers.read_articles(spark, path, "conv_id bigint, turn bigint, role string, text string")


@entry("a10_write_sft", f"SELECT {_WRAP.format(s="'You know drugs.'", i=_DRUG_Q)} AS instruction, {_DRUG_A} AS output FROM fx_drugs WHERE primary_site IS NOT NULL", "fx_drugs")
def _(spark, d):
    path = fresh_dir(spark, "sft")
    writers.write_sft(records.all_records(drug=_drug_records(spark, d)), path)
    return readers.read_sft(spark, path)


@entry("a11_write_qa", f"SELECT name AS drug, {_DRUG_Q} AS question, {_DRUG_A} AS answer FROM fx_drugs WHERE primary_site IS NOT NULL", "fx_drugs")
def _(spark, d):
    path = fresh_dir(spark, "qa")
    writers.write_qa(records.drug_questions(view(spark, d, "fx_drugs"), fx.DRUG_QUESTION, fx.DRUG_ANSWER), path)
    return readers.read_qa(spark, path)


_STORE_PHRASES = {"appeal": ["queux", "thinti"]}
_STORED = "CAST(conv_id AS STRING) AS index, 'appeal' AS kind, CAST(0 AS BIGINT) AS model_index, attempt AS variant, raw AS response"
_BAD_RAW = "(contains(lower(replace(raw, chr(10), '')), 'queux') OR contains(lower(replace(raw, chr(10), '')), 'thinti'))"


def _responses(spark, d):
    view(spark, d, "fx_completions").createOrReplaceTempView("completions")
    return spark.sql(f"SELECT {_STORED} FROM completions")


@entry("a12_response_store", f"SELECT {_STORED} FROM fx_completions WHERE NOT {_BAD_RAW}", "fx_completions")
def _(spark, d):
    path, responses = fresh_dir(spark, "responses"), _responses(spark, d)
    writers.append_responses(responses.unionByName(responses), path, _STORE_PHRASES)
    writers.append_responses(responses, path, _STORE_PHRASES)
    return writers.read_responses(spark, path).select("index", "kind", "model_index", "variant", "response")


_ANSWER = """CASE WHEN contains(raw, 'The reviewer determined that the requested') THEN ''
  WHEN starts_with(raw, prompt) THEN substr(raw, length(prompt) + 1)
  WHEN contains(raw, '[ASN]') THEN split_part(raw, '[ASN]', 2) WHEN contains(raw, '[OUT]') THEN split_part(raw, '[OUT]', 2)
  WHEN contains(raw, '[/INST][/INST]') THEN split_part(raw, '[/INST][/INST]', 2)
  WHEN contains(raw, '[/INST]') THEN split_part(raw, '[/INST]', 2) ELSE raw END"""


@entry("a12_store_commits", "SELECT CAST(conv_id AS STRING) AS index, min(raw) AS response FROM fx_completions GROUP BY conv_id", "fx_completions")
def _(spark, d):
    store = KeyedStore(spark, fresh_dir(spark, "store"), "index string, response string", ["index"])
    rows = view(spark, d, "fx_completions").select(F.col("conv_id").cast("string").alias("index"), F.col("raw").alias("response"), "conv_id")
    part = lambda n: rows.filter(F.col("conv_id") % 3 == n)
    store.append("1", part(0))
    # Rows of a batch that broke off before its commit.
    rows.select("response", F.lit("lost").alias("index")).write.parquet(f"{store.path}/data/batch=2/bucket=0")
    store.append("2", part(1).unionByName(part(0).withColumn("response", F.lit(""))))
    store.compact("3")
    store.append("2", part(2))
    store.append("4", rows)
    return store.current()


@entry("a13_letters", f"SELECT concat('letters/', CAST(conv_id AS STRING), '_', CAST(attempt AS STRING), '.txt') AS path, concat('To whom it may concern: ', {_ANSWER}, ' Yours') AS text FROM fx_completions", "fx_completions")
def _(spark, d):
    answered = view(spark, d, "fx_completions").withColumn("answer", T.clean_completion(F.col("prompt"), F.col("raw")))
    path = F.concat(F.lit("letters/"), F.col("conv_id").cast("string"), F.lit("_"), F.col("attempt").cast("string"), F.lit(".txt"))
    return requests.wrap_letter(answered, fx.LETTER, path)


_CHUNKS = r"""
  SELECT doc_id, CAST(i // 492 AS BIGINT) AS chunk_no, CAST(len(t[i + 1:i + 512]) AS BIGINT) AS n_tokens, array_to_string(t[i + 1:i + 512], ' ') AS text
  FROM (SELECT doc_id, t, unnest(range(0, len(t), 492)) AS i FROM (SELECT doc_id, regexp_extract_all(text, '\S+') AS t FROM documents) WHERE len(t) > 0)"""


@entry("a14_write_chunks", _CHUNKS)
def _(spark, d):
    path = fresh_dir(spark, "chunks")
    writers.write_chunks(prep.chunk(view(spark, d, "documents"), "doc_id"), path, "doc_id", 16)
    return spark.read.parquet(path).drop("bucket")


@entry("a15_read_sft", "SELECT concat('[INST] ', a.text, ' ', '[/INST]') AS instruction, b.text AS output FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user' AND b.role = 'assistant'")
def _(spark, d):
    path = fresh_dir(spark, "sft")
    writers.write_sft(records.all_records(chat=_pairs(spark, d).select(F.lit("").alias("system"), F.col("ask").alias("instruction"), F.col("reply").alias("result"))), path)
    return readers.read_sft(spark, path)


def _pairs(spark, d):
    view(spark, d, "conversations")
    return spark.sql("""SELECT a.conv_id, a.turn, a.text AS ask, b.text AS reply FROM conversations a JOIN conversations b
        ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user' AND b.role = 'assistant'""")


# --- B: filters and predicates ------------------------------------------------------------------


@entry("b1_keep_contains", "SELECT ReferenceID, Determination FROM fx_imr WHERE contains(Determination, 'Overturned')", "fx_imr")
def _(spark, d):
    return gate.keep_contains(view(spark, d, "fx_imr"), "Determination", "Overturned").select("ReferenceID", "Determination")


@entry("b2_require", "SELECT * FROM fx_drugs WHERE primary_site IS NOT NULL AND remarks IS NOT NULL", "fx_drugs")
def _(spark, d):
    return gate.require(view(spark, d, "fx_drugs"), ["primary_site", "remarks"])


# Letters decoded, gated, parsed and rewritten; what SQL can take over from one step to the next.
_TAGS = "MAGIC[0-9]*-*[0-9]*|FARTS[0-9]*|farts[0-9]|EXTRACTED"
_TYPES = "|".join(sorted(LETTER_TYPES, key=len, reverse=True))
_NAME = f"'.*/(.*?)({_TAGS}|)_*({_TYPES})\\d*.txt'"
_DECODED = f"""decoded AS (SELECT doc_id, path, raw_text, CASE WHEN kind <> '' THEN regexp_extract(path, {_NAME}, 1) END AS case_id,
    CASE WHEN kind <> '' THEN regexp_extract(path, {_NAME}, 2) END AS producer,
    CASE kind WHEN '' THEN NULL WHEN 'denial' THEN 'rejection' ELSE kind END AS letter_type
  FROM (SELECT *, regexp_extract(path, {_NAME}, 3) AS kind FROM fx_letters))"""


def _hit(source: str, phrases=None) -> str:
    """SQL: the list of phrases of a row's type that its text holds."""
    listed = phrases or fx.PHRASES
    cases = " ".join(
        f"WHEN '{'rejection' if name == 'denial' else name}' THEN list_filter([{', '.join(_quoted(p.lower()) for p in own)}], lambda p: contains({source}, p))"
        for name, own in listed.items())
    return f"CASE letter_type {cases} ELSE [] END"


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def _letters(spark, d):
    return extract.decode_name(view(spark, d, "fx_letters"))


@entry("b3_banned_hits", f"WITH {_DECODED} SELECT doc_id, array_to_string(coalesce(hits, []), '|') AS hits, coalesce(len(hits), 0) > 0 AS is_bad FROM (SELECT *, {_hit('lower(raw_text)')} AS hits FROM decoded)", "fx_letters")
def _(spark, d):
    return gate.banned_hits(_letters(spark, d), fx.PHRASES, "raw_text").select("doc_id", F.array_join("hits", "|").alias("hits"), "is_bad")


_GATED = f"{_DECODED}, gated AS (SELECT * FROM decoded WHERE coalesce(len({_hit('lower(replace(raw_text, chr(10), %s))' % repr(''))}), 0) = 0)"


@entry("b4_gate", f"WITH {_GATED} SELECT doc_id, path FROM gated", "fx_letters")
def _(spark, d):
    return gate.gate(_letters(spark, d), fx.PHRASES, "raw_text").select("doc_id", "path")


@entry("b5_path_endswith", "SELECT path FROM fx_letters WHERE ends_with(path, '_rejection.txt')", "fx_letters")
def _(spark, d):
    return gate.path_endswith(view(spark, d, "fx_letters"), "_rejection.txt").select("path")


_BAD_RESPONSE = "(contains(lower(raw), 'queux') OR contains(lower(raw), 'thinti'))"


@entry("b6_split_good_bad", f"SELECT CAST(conv_id AS STRING) AS index, attempt AS variant, CASE WHEN {_BAD_RESPONSE} THEN 'bad' ELSE 'good' END AS part FROM fx_completions", "fx_completions")
def _(spark, d):
    good, bad = gate.split_good_bad(_responses(spark, d), _STORE_PHRASES)
    part = lambda df, name: df.select("index", "variant", F.lit(name).alias("part"))
    return part(good, "good").unionByName(part(bad, "bad"))


@entry("b7_is_unknown", "SELECT ReferenceID, TreatmentCategory IS NULL OR lower(TreatmentCategory) IN ('other', '') OR contains(lower(TreatmentCategory), 'unkown') AS treatment, Determination IS NULL OR lower(Determination) IN ('other', '') OR contains(lower(Determination), 'unkown') AS determination FROM fx_imr", "fx_imr")
def _(spark, d):
    return view(spark, d, "fx_imr").select("ReferenceID", T.is_unknown(F.col("TreatmentCategory")).alias("treatment"), T.is_unknown(F.col("Determination")).alias("determination"))


@entry("b8_mentions_study", "SELECT ReferenceID, contains(lower(Type), 'study by') OR contains(lower(Type), 'journal') OR contains(lower(Type), 'article') AS named, false AS literal FROM fx_imr", "fx_imr")
def _(spark, d):
    return view(spark, d, "fx_imr").select("ReferenceID", T.mentions_study(F.col("Type")).alias("named"), T.mentions_study(F.col("Type"), mode="reference").alias("literal"))


_JOB = """CASE CAST(event_id % 5 AS INT) WHEN 0 THEN props WHEN 1 THEN '{"input": {}}' WHEN 2 THEN concat('{"input": {"prompt": "', event_type, '"}}')
  WHEN 3 THEN '{"input": {"prompt": ""}}' ELSE concat('{"input": {"prompt": ', CAST(event_id AS STRING), '}}') END"""


@entry("b9_validate_jobs", f"""SELECT event_id, CASE WHEN event_id % 5 = 2 THEN event_type END AS prompt,
  CASE CAST(event_id % 5 AS INT) WHEN 0 THEN concat('No input in ', props) WHEN 1 THEN concat('No prompt in ', job) WHEN 2 THEN NULL ELSE 'Prompt must not be none' END AS error
  FROM (SELECT *, {_JOB} AS job FROM events)""")
def _(spark, d):
    view(spark, d, "events")
    return requests.validate_jobs(spark.sql(f"SELECT event_id, {_JOB} AS job FROM events")).drop("job")


@entry("b11_drop_sentences", r"""SELECT doc_id, coalesce(array_to_string(list_filter(string_split(text, '. '), lambda s: NOT (contains(s, 'the ') OR contains(s, 'que') OR contains(s, 'ung'))), '. '), '') AS text FROM documents""")
def _(spark, d):
    return view(spark, d, "documents").select("doc_id", T.drop_sentences(F.col("text"), ["the ", "que", "ung"]).alias("text"))


@entry("b12_not_null", "SELECT ReferenceID FROM fx_imr WHERE Determination IS NOT NULL", "fx_imr")
def _(spark, d):
    return gate.not_null(view(spark, d, "fx_imr"), "Determination").select("ReferenceID")


@entry("b13_optional_clause", "SELECT ReferenceID, CASE WHEN lower(DiagnosisSubCategory) <> 'other' THEN concat(' (', DiagnosisSubCategory, ')') ELSE '' END AS clause FROM fx_imr", "fx_imr")
def _(spark, d):
    return view(spark, d, "fx_imr").select("ReferenceID", T.optional_clause(F.col("DiagnosisSubCategory"), " ({value})").alias("clause"))


_STORE_ROWS = "SELECT * FROM fx_completions WHERE contains(raw, '[INST]') OR contains(raw, '[OUT]')"
_GOOD_ROWS = f"SELECT * FROM ({_STORE_ROWS}) WHERE NOT {_BAD_RAW}"


def _asked_and_stored(spark, d):
    answers = _responses(spark, d)
    return answers.drop("response"), answers.filter("contains(response, '[INST]') OR contains(response, '[OUT]')")


@entry("b15_pending", f"SELECT CAST(conv_id AS STRING) AS index, attempt AS variant FROM fx_completions EXCEPT ALL SELECT CAST(conv_id AS STRING), attempt FROM ({_GOOD_ROWS})", "fx_completions")
def _(spark, d):
    asked, stored = _asked_and_stored(spark, d)
    return gate.pending(asked, stored, _STORE_PHRASES).select("index", "variant")


@entry("f4b_done", f"SELECT CAST(conv_id AS STRING) AS index, attempt AS variant, raw AS response FROM ({_GOOD_ROWS})", "fx_completions")
def _(spark, d):
    asked, stored = _asked_and_stored(spark, d)
    return gate.done(asked, stored, _STORE_PHRASES).select("index", "variant", "response")


# --- C: extraction ------------------------------------------------------------------------------


def _cascade_sql(rules, category: str, sub: str) -> str:
    tried = " ".join(f"WHEN length(regexp_extract(Findings, '(?i){r.pattern}', {r.group})) >= 3 THEN regexp_extract(Findings, '(?i){r.pattern}', {r.group})" for r in rules)
    return (f"CASE {tried} ELSE CASE WHEN coalesce({category}, '') <> 'Other' THEN concat(coalesce({category}, ''), "
            f"CASE WHEN {sub} = 'Other' THEN '' ELSE coalesce({sub}, '') END) END END")


_TREATMENT = _cascade_sql(fx.TREATMENT_RULES, "TreatmentCategory", "TreatmentSubCategory")
_DIAGNOSIS = _cascade_sql(fx.DIAGNOSIS_RULES, "DiagnosisCategory", "DiagnosisSubCategory")
_ENRICHED = f"enriched AS (SELECT *, {_TREATMENT} AS treatment, {_DIAGNOSIS} AS diagnosis FROM fx_imr)"


def _enriched(spark, d):
    return extract.enrich(view(spark, d, "fx_imr"), fx.TREATMENT_RULES, fx.DIAGNOSIS_RULES)


@entry("c1_treatment_cascade", f"SELECT ReferenceID, {_TREATMENT} AS treatment FROM fx_imr", "fx_imr")
def _(spark, d):
    return extract.extract_cascade(view(spark, d, "fx_imr"), "Findings", "treatment", fx.TREATMENT_RULES, "TreatmentCategory", "TreatmentSubCategory").select("ReferenceID", "treatment")


@entry("c2_diagnosis_cascade", f"SELECT ReferenceID, {_DIAGNOSIS} AS diagnosis FROM fx_imr", "fx_imr")
def _(spark, d):
    return extract.extract_cascade(view(spark, d, "fx_imr"), "Findings", "diagnosis", fx.DIAGNOSIS_RULES, "DiagnosisCategory", "DiagnosisSubCategory").select("ReferenceID", "diagnosis")


@entry("c3_enrich", f"WITH {_ENRICHED} SELECT ReferenceID, Type, treatment AS treatment_extracted, diagnosis AS diagnosis_extracted FROM enriched", "fx_imr")
def _(spark, d):
    return _enriched(spark, d).select("ReferenceID", "Type", "treatment_extracted", "diagnosis_extracted")


@entry("c4_decode_name", f"WITH {_DECODED} SELECT path, case_id, producer, letter_type FROM decoded", "fx_letters")
def _(spark, d):
    return _letters(spark, d).select("path", "case_id", "producer", "letter_type")


_BIAS = "CASE WHEN producer IS NULL THEN NULL WHEN contains(producer, 'MAGIC') OR contains(producer, 'EXTRACTED') THEN coalesce(TRY_CAST(regexp_extract(producer, '(\\d+)-', 1) AS BIGINT), 0) ELSE 1000000 END"


@entry("c5_producer_bias", f"WITH {_DECODED} SELECT path, CAST({_BIAS} AS BIGINT) AS bias FROM decoded", "fx_letters")
def _(spark, d):
    return _letters(spark, d).select("path", extract.producer_bias(F.col("producer")).alias("bias"))


@entry("c6_extract_urls", rf"""
  SELECT doc_id, mode, unnest(found) AS url FROM (
    SELECT doc_id, 'score' AS mode, regexp_extract_all(lower(raw_text), 'https?://\S+') AS found FROM fx_letters
    UNION ALL SELECT doc_id, 'loose', regexp_extract_all(raw_text, 'https?://\S+') FROM fx_letters
    UNION ALL SELECT doc_id, 'strict', regexp_extract_all(raw_text, '{URL_STRICT}') FROM fx_letters)""", "fx_letters")
def _(spark, d):
    letters, out = view(spark, d, "fx_letters"), None
    for mode in ("score", "loose", "strict"):
        found = urls.extract_urls(letters, ["doc_id"], "raw_text", mode).select("doc_id", F.lit(mode).alias("mode"), "url")
        out = found if out is None else out.unionByName(found)
    return out


_NORMAL = "translate(replace(replace(text, '-' || chr(10), ''), chr(10), ''), '“”', '\"\"')"
_FOUND = rf"""found AS (SELECT pdf, page_no, CAST(i - 1 AS INT) AS pos, recommendation FROM (
    SELECT pdf, page_no, unnest(r) AS recommendation, generate_subscripts(r, 1) AS i FROM (
      SELECT pdf, page_no, list_filter(a, lambda x, i: list_position(a, x) = i) AS q, list_filter(a, lambda x, i: list_position(a, x) = i) AS r FROM (
        SELECT pdf, page_no, regexp_extract_all({_NORMAL}, '(?i)recommends* ([^.]+)\.', 1) AS a FROM fx_guideline_pages))))"""


@entry("c7_recommendations", f"WITH {_FOUND} SELECT pdf, page_no, pos, recommendation FROM found", "fx_guideline_pages")
def _(spark, d):
    pages = view(spark, d, "fx_guideline_pages").withColumn("text", T.normalise_page(F.col("text")))
    return extract.extract_recommendations(pages)


_PLAIN = r"regexp_replace(raw_text, '<\s*/?\s*(PARAGRAPH|FREETEXT)\s*>', '', 'g')"
_PARSED = f"CASE WHEN contains({_PLAIN}, '### Response:') THEN split_part({_PLAIN}, '### Response:', 2) ELSE {_PLAIN} END"


@entry("c8_parse_record", f"SELECT doc_id, {_PARSED} AS text FROM fx_letters", "fx_letters")
def _(spark, d):
    return view(spark, d, "fx_letters").select("doc_id", T.parse_record(F.col("raw_text")).alias("text"))


@entry("c9_clean_completion", f"SELECT conv_id, attempt, nullif(answer, '') AS result, CASE WHEN answer = '' THEN concat('Could not generate for ', prompt) END AS error FROM (SELECT *, {_ANSWER} AS answer FROM fx_completions)", "fx_completions")
def _(spark, d):
    return view(spark, d, "fx_completions").select("conv_id", "attempt", F.inline(F.array(T.cleaned_or_error(F.col("prompt"), F.col("raw")))))


@entry("c10_response_content", "SELECT conv_id, turn, text AS content FROM conversations")
def _(spark, d):
    content = F.struct(F.array(F.struct(F.struct(F.col("text").alias("content")).alias("message"))).alias("choices"))
    return view(spark, d, "conversations").select("conv_id", "turn", T.response_content(F.to_json(content)).alias("content"))


_URLS = r"""urls AS (SELECT doc_id, path, unnest(u) AS url, generate_subscripts(u, 1) AS occurrence FROM (SELECT doc_id, path, regexp_extract_all({text}, 'https?://\S+') AS u FROM {source})),
  valid AS (SELECT doc_id, path, occurrence, urls.url, max(coalesce(s.ok, 0)) = 1 AS ok FROM (SELECT *, unnest(range(0, length(url) - length(rtrim(url, '.:;,?>')) + 1)) AS cut FROM urls) urls
    LEFT JOIN fx_url_status s ON s.url = lower(left(urls.url, length(urls.url) - cut)) GROUP BY ALL)"""


@entry("c11_url_ok", f"WITH {_URLS.format(text='raw_text', source='fx_letters')} SELECT DISTINCT url, ok FROM valid", "fx_letters", "fx_url_status")
def _(spark, d):
    return urls.url_ok(urls.extract_urls(view(spark, d, "fx_letters"), ["doc_id"], "raw_text"), view(spark, d, "fx_url_status"))


@entry("c12_bad_urls", f"WITH {_URLS.format(text='raw_text', source='fx_letters')} SELECT doc_id, string_agg(url, ' ' ORDER BY occurrence) AS bad_urls FROM valid WHERE NOT ok GROUP BY doc_id", "fx_letters", "fx_url_status")
def _(spark, d):
    found = urls.bad_urls(view(spark, d, "fx_letters"), view(spark, d, "fx_url_status"), ["doc_id"], "raw_text")
    return found.select("doc_id", F.array_join("bad_urls", " ").alias("bad_urls"))


@entry("c13_lookup_codes", "SELECT l_orderkey, l_linenumber, p_name, p_type FROM lineitem LEFT JOIN part ON l_partkey = p_partkey")
def _(spark, d):
    return extract.lookup_codes(view(spark, d, "lineitem"), view(spark, d, "part"), "l_partkey", "p_partkey").select("l_orderkey", "l_linenumber", "p_name", "p_type")


# --- D: scalar functions ------------------------------------------------------------------------


@entry("d1_strip_control", r"SELECT doc_id, regexp_replace(text, '[\x{0000}-\x{0009}\x{000B}-\x{001F}\x{007F}-\x{009F}\p{Cf}\p{Co}]', '', 'g') AS text FROM documents")
def _(spark, d):
    return view(spark, d, "documents").select("doc_id", T.strip_control(F.col("text")).alias("text"))


def _rewritten_sql(value: str, passes: int = 3) -> str:
    """The rewrite rules of the fixtures as often as the tables need them to settle."""
    for _ in range(passes):
        value = f"regexp_replace(regexp_replace({value}, 'eriner', 'eri', 'gi'), 'The and attion', 'An action', 'gi')"
        value = (f"CASE letter_type WHEN 'rejection' THEN regexp_replace({value}, 'thanedble', 'that''s $1', 'gi') "
                 f"WHEN 'appeal' THEN regexp_replace({value}, 'er(n|s)ter', 'ea\\1', 'gi') ELSE {value} END")
    return value


_CLEANED = rf"""{_GATED}, parsed AS (SELECT doc_id, path, case_id, producer, letter_type, {_PARSED} AS t FROM gated WHERE case_id IS NOT NULL),
  once AS (SELECT * REPLACE ({_rewritten_sql('t', 1)} AS t) FROM parsed), twice AS (SELECT * REPLACE ({_rewritten_sql('t', 1)} AS t) FROM once),
  cleaned AS (SELECT path, case_id, producer, letter_type, CASE WHEN letter_type = 'json' THEN NULL ELSE {_rewritten_sql('t', 1)} END AS text FROM twice)"""


@entry("d2_rewrite", f"WITH {_CLEANED} SELECT path, case_id, letter_type, text FROM cleaned", "fx_letters")
def _(spark, d):
    return clean_letters(view(spark, d, "fx_letters"), fx.PHRASES, fx.REWRITES).select("path", "case_id", "letter_type", "text")


# Texts with "queux" never settle under these rules; the others need a pass for every few letters of a run.
_STUBBORN = RewriteSet(
    general=(RewriteRule("beux", "ceux"), RewriteRule("queux", "beux"), RewriteRule("ceux", "queux"), RewriteRule("qqq", "qq")),
    by_type={"denial": (RewriteRule("erst", "er"),)})


@entry("d2_rounds", f"""WITH {_DECODED}, long AS (SELECT path, letter_type, concat('k', repeat('q', CAST(1 + doc_id % 97 AS INTEGER)), ' ', raw_text) AS t, doc_id FROM decoded WHERE case_id IS NOT NULL),
  told AS (SELECT *, regexp_matches(t, '(?i)(qu|b|c)eux') AS cyclic FROM long)
  SELECT path, letter_type, NOT cyclic AS converged, CASE WHEN NOT cyclic THEN CASE letter_type
    WHEN 'rejection' THEN regexp_replace(regexp_replace(t, 'q{{3,}}', 'qq', 'gi'), 'er(st)+', 'er', 'gi') ELSE regexp_replace(t, 'q{{3,}}', 'qq', 'gi') END END AS text FROM told""", "fx_letters")
def _(spark, d):
    run = F.concat(F.lit("k"), F.repeat(F.lit("q"), (F.lit(1) + F.col("doc_id") % 97).cast("int")), F.lit(" "), "raw_text")
    letters = _letters(spark, d).filter("case_id IS NOT NULL").select("path", "letter_type", run.alias("text"))
    done = rewrite_in_rounds(letters, "text", "letter_type", _STUBBORN, fresh_dir(spark, "rounds"))
    return done.withColumn("text", F.when(F.col("converged"), F.col("text")))


@entry("d3_negate", r"SELECT doc_id, regexp_replace(text, '(?i)(the|of)\s*and\s*(in|to|the)', '\1 not and \2', 'g') AS text FROM documents")
def _(spark, d):
    return view(spark, d, "documents").select("doc_id", T.negate(F.col("text"), ["the", "of"], "and", ["in", "to", "the"]).alias("text"))


_DENIED = "CASE WHEN regexp_matches(raw_text, '(?i)(refus|deni)') THEN raw_text ELSE concat(raw_text, '. Your request is denied.') END"


@entry("d4_repair_rejection", rf"SELECT doc_id, regexp_replace(concat('Dear [MEMBER]; ', {_DENIED}, '.'), '(?i)(the|of)\s*and\s*(in|to)', '\1 not and \2', 'g') AS text FROM fx_letters", "fx_letters")
def _(spark, d):
    repaired = T.repair_rejection(F.col("raw_text"), ["refus", "deni"], verbs=["the", "of"], adverb="and", adjectives=["in", "to"])
    return view(spark, d, "fx_letters").select("doc_id", repaired.alias("text"))


@entry("d5_normalise_page", f"SELECT pdf, page_no, {_NORMAL} AS text FROM fx_guideline_pages", "fx_guideline_pages")
def _(spark, d):
    return view(spark, d, "fx_guideline_pages").select("pdf", "page_no", T.normalise_page(F.col("text")).alias("text"))


_KEY = "replace(replace(lower({0}), 'the', ''), ' ', '')"


@entry("d6_dedup_key", f"SELECT doc_id, {_KEY.format('text')} AS key FROM documents")
def _(spark, d):
    return view(spark, d, "documents").select("doc_id", T.dedup_key(F.col("text")).alias("key"))


_BROKEN = """CASE CAST(event_id % 5 AS INT) WHEN 0 THEN props WHEN 1 THEN concat(props, ',') WHEN 2 THEN replace(props, '"', '')
  WHEN 3 THEN substr(props, 1, length(props) - 1) ELSE concat('not ', props) END"""


@entry("d7_repair_json", "SELECT event_id, props AS repaired FROM events")
def _(spark, d):
    view(spark, d, "events")
    bare = F.regexp_replace("props", '"(\\w+)":', "$1:")
    return spark.table("events").select("event_id", jsonish.repair_json_text(bare).alias("repaired"))


@entry("d8_tolerant_json", "SELECT event_id, CASE WHEN event_id % 5 < 4 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events")
def _(spark, d):
    view(spark, d, "events")
    broken = spark.sql(f"SELECT event_id, {_BROKEN} AS props FROM events")
    return broken.select("event_id", _long(F.get_json_object(jsonish.tolerant_json(F.col("props")), "$.k")).alias("k"))


@entry("d9_truncate_chars", "SELECT doc_id, substr(text, 1, 20480) AS text FROM documents")
def _(spark, d):
    return view(spark, d, "documents").select("doc_id", T.truncate_chars(F.col("text")).alias("text"))


@entry("d10_trim_newlines", "SELECT doc_id, trim(concat(chr(10), text, chr(10), chr(10)), chr(10)) AS text FROM documents")
def _(spark, d):
    framed = F.concat(F.lit("\n"), "text", F.lit("\n\n"))
    return view(spark, d, "documents").select("doc_id", T.trim_newlines(framed).alias("text"))


@entry("d11_text_builtins", "SELECT doc_id, lower(text) AS folded, contains(lower(text), 'the') AS holds, length(text) AS chars, replace(text, ',', ';') AS replaced FROM documents")
def _(spark, d):
    return view(spark, d, "documents").select("doc_id", F.lower("text").alias("folded"), F.contains(F.lower("text"), F.lit("the")).alias("holds"),
                                              _long(F.length("text")).alias("chars"), F.replace("text", F.lit(","), F.lit(";")).alias("replaced"))


@entry("d12_wrap_prompt", "SELECT conv_id, turn, concat('[INST] ', CASE WHEN role = 'system' THEN concat('<<SYS>>', role, '<</SYS>>') ELSE '' END, text, ' ', role, '[/INST]') AS prompt FROM conversations")
def _(spark, d):
    system = F.when(F.col("role") == "system", F.col("role"))
    return view(spark, d, "conversations").select("conv_id", "turn", T.wrap_prompt(system, F.col("text"), F.col("role")).alias("prompt"))


@entry("d13_drug_qa", f"SELECT drug_id, {_DRUG_Q} AS question, concat(name, ': ', coalesce(primary_site, ''), '; ', category, '; ', coalesce(remarks, '')) AS answer FROM fx_drugs", "fx_drugs")
def _(spark, d):
    c = F.col
    asked, answered = T.drug_qa(fx.DRUG_QUESTION, fx.DRUG_ANSWER, name=c("name"), alternate=c("name"), primary_site=c("primary_site"), category=c("category"), remarks=c("remarks"))
    return view(spark, d, "fx_drugs").select("drug_id", asked.alias("question"), answered.alias("answer"))


@entry("d14_json_record", "SELECT conv_id, turn, role AS a, text AS b FROM conversations")
def _(spark, d):
    rows = view(spark, d, "conversations").select("conv_id", "turn", T.json_record(a=F.col("role"), b=F.col("text")).alias("j"))
    return rows.select("conv_id", "turn", F.from_json("j", "a string, b string").alias("j")).select("conv_id", "turn", "j.a", "j.b")


@entry("d15_length_score", "SELECT doc_id, length(text) / 100.0::DOUBLE AS score FROM documents")
def _(spark, d):
    return view(spark, d, "documents").select("doc_id", T.length_score(F.col("text")).alias("score"))


# --- E: prompts and requests --------------------------------------------------------------------


def _slot_sql(template: str, **slots: str) -> str:
    """SQL text that fills ``{slot}`` marks."""
    parts = [slots[p[1:-1]] if p[:1] == "{" else _quoted(p) for p in re.split(r"(\{\w+\})", template) if p]
    return f"concat({', '.join(parts)}, '')"


_SLOTS = {
    "findings": "trim(coalesce(Findings, ''), chr(10))", "grounds": "Type",
    "treatment_clause": f"CASE WHEN lower(treatment) <> 'other' THEN {_slot_sql(fx.PROMPTS.treatment_clause, value='treatment')} ELSE '' END",
    "diagnosis_clause": f"CASE WHEN lower(diagnosis) <> 'other' THEN {_slot_sql(fx.PROMPTS.diagnosis_clause, value='diagnosis')} ELSE '' END",
}
_STUDIED = "(contains(lower(coalesce(Findings, '')), 'journal') OR contains(lower(coalesce(Findings, '')), 'article') OR contains(lower(coalesce(Findings, '')), 'study by'))"
_PROMPTED = f"{_ENRICHED}, prompted AS (" + " UNION ALL ".join(
    f"SELECT ReferenceID AS index, '{kind}' AS kind, CAST({i} AS INT) AS variant, {_slot_sql(text, **_SLOTS)} AS prompt FROM enriched"
    + (f" WHERE {_STUDIED}" if kind == "studies" else "") for kind, texts in fx.PROMPTS.kinds.items() for i, text in enumerate(texts)) + ")"


def _prompts(spark, d, **options):
    return requests.build_prompts(_enriched(spark, d), fx.PROMPTS, **options)


@entry("e1_build_prompts", f"WITH {_PROMPTED} SELECT index, kind, variant, prompt FROM prompted", "fx_imr")
def _(spark, d):
    return requests.explode_prompts(_prompts(spark, d))


@entry("e2_explode_known", f"""WITH {_ENRICHED}, facts AS (SELECT ReferenceID AS index, 'treatment' AS kind, treatment AS value FROM enriched
    UNION ALL SELECT ReferenceID, 'diagnosis', diagnosis FROM enriched UNION ALL SELECT ReferenceID, 'reason_for_denial', Type FROM enriched)
  SELECT * FROM facts WHERE value IS NOT NULL AND lower(value) NOT IN ('other', '') AND NOT contains(lower(value), 'unkown')""", "fx_imr")
def _(spark, d):
    return requests.explode_known(_prompts(spark, d, use_known=True))


_ORDERED = "CASE kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(PROMPT_ORDER)) + " END"
_MODEL_ROWS = ", ".join(f"('{name}', {i})" for name, i in fx.MODELS)
_TAGGED = "CASE WHEN model_index = 0 THEN '' ELSE concat(CAST(model_index AS STRING), '-') END"


@entry("e3_expand_requests", f"""WITH {_PROMPTED}, models(model, model_index) AS (VALUES {_MODEL_ROWS})
  SELECT index, kind, CAST({_ORDERED} AS BIGINT) AS ord, CAST(variant AS BIGINT) AS variant, model, CAST(model_index AS BIGINT) AS model_index, {_TAGGED} AS model_tag,
    concat(index, 'MAGIC', {_TAGGED}, CAST(variant AS STRING), kind, '.txt') AS target, prompt
  FROM prompted CROSS JOIN models WHERE {_ORDERED} IS NOT NULL""", "fx_imr")
def _(spark, d):
    return requests.expand_requests(_prompts(spark, d), fx.MODELS)


_ASKED = """asked AS (SELECT CAST(conv_id AS STRING) AS index, 'appeal' AS kind, CAST(4 AS BIGINT) AS ord, CAST(turn AS BIGINT) AS variant, CAST(0 AS BIGINT) AS model_index,
    concat('#treatment# then #diagnosis# and #studies#: ', text) AS prompt FROM conversations WHERE role = 'user'),
  answers AS (SELECT CAST(conv_id AS STRING) AS index, CAST(0 AS BIGINT) AS model_index, CASE WHEN turn % 4 < 2 THEN 'treatment' WHEN turn % 8 < 4 THEN 'diagnosis' ELSE 'studies' END AS kind,
    CAST(turn AS BIGINT) AS variant, text AS response FROM conversations WHERE role = 'assistant')"""


@entry("e4_substitute", f"""WITH {_ASKED}, last AS (SELECT index, kind, arg_max(response, variant) AS response FROM answers WHERE kind IN ('treatment', 'diagnosis') GROUP BY ALL)
  SELECT index, variant, replace(CASE WHEN t.response IS NOT NULL THEN replace(prompt, '#treatment#', t.response) ELSE prompt END, '#diagnosis#', coalesce(g.response, '#diagnosis#')) AS prompt
  FROM asked LEFT JOIN (SELECT * FROM last WHERE kind = 'treatment') t USING (index) LEFT JOIN (SELECT * FROM last WHERE kind = 'diagnosis') g USING (index)""")
def _(spark, d):
    view(spark, d, "conversations")
    asked, answers = (spark.sql(f"WITH {_ASKED} SELECT * FROM {name}") for name in ("asked", "answers"))
    return requests.substitute(asked, answers).select("index", "variant", "prompt")


_ROUND = """{name} AS (SELECT CAST(conv_id AS STRING) AS index, '{name}' AS kind, CAST(turn AS BIGINT) AS variant, {prompt} AS prompt, concat(CAST(turn AS STRING), ':', substr({prompt}, 1, 40)) AS response
    FROM conversations {joins} WHERE role = '{role}'),
  last_{name} AS (SELECT index AS {name}_index, max_by(response, variant) AS {name}_response FROM {name} GROUP BY index)"""
_CHAINED = ", ".join(_ROUND.format(name=name, prompt=prompt, role=role, joins=" ".join(f"LEFT JOIN last_{k} ON {k}_index = CAST(conv_id AS STRING)" for k in joins)) for name, role, prompt, joins in (
    ("treatment", "assistant", "text", ()),
    ("diagnosis", "user", "concat(coalesce(treatment_response, '#treatment#'), ' so? ', text)", ("treatment",)),
    ("studies", "system", "concat('#unknown# ', coalesce(diagnosis_response, '#diagnosis#'), text)", ("diagnosis",)),
    ("appeal", "user", "concat(coalesce(studies_response, '#studies#'), ' ', coalesce(treatment_response, '#treatment#'))", ("studies", "treatment"))))


@entry("e4_chain", f"WITH {_CHAINED} " + " UNION ALL ".join(f"SELECT index, kind, variant, prompt, response FROM {k}" for k in ("treatment", "diagnosis", "studies", "appeal")))
def _(spark, d):
    turns = view(spark, d, "conversations")
    prompts = {"appeal": ("user", F.lit("#studies# #treatment#")), "studies": ("system", F.concat(F.lit("#unknown# #diagnosis#"), "text")),
               "treatment": ("assistant", F.col("text")), "diagnosis": ("user", F.concat(F.lit("#treatment# so? "), "text"))}
    asked = [turns.filter(F.col("role") == role).select(F.col("conv_id").cast("string").alias("index"), F.lit(kind).alias("kind"), "turn", prompt.alias("prompt"))
             for kind, (role, prompt) in prompts.items()]
    rows = reduce(DataFrame.unionByName, asked).select("index", "kind", F.lit(0).cast("bigint").alias("model_index"), F.col("turn").alias("variant"), "prompt")

    def answer(round_: DataFrame) -> DataFrame:
        return round_.withColumn("response", F.concat(F.col("variant").cast("string"), F.lit(":"), F.substring("prompt", 1, 40)))

    return chain.answer_in_rounds(rows, answer, fresh_dir(spark, "rounds")).drop("model_index")


@entry("e5_chat_payload", """SELECT conv_id, turn, 1 AS place, 'user' AS role, text AS content FROM conversations
  UNION ALL SELECT conv_id, turn, 2, 'assistant', role FROM conversations WHERE role <> 'system'
  UNION ALL SELECT conv_id, turn, 3, 'user', concat('Again: ', role) FROM conversations WHERE role <> 'system'""")
def _(spark, d):
    previous = F.when(F.col("role") != "system", F.col("role"))
    messages = requests.chat_messages(F.col("text"), previous, F.col("role"), "Again: {error}")
    rows = view(spark, d, "conversations").select("conv_id", "turn", requests.chat_payload(F.lit("first-model"), messages).alias("payload"))
    parsed = rows.withColumn("p", F.from_json("payload", "model string, messages array<struct<role: string, content: string>>"))
    return parsed.select("conv_id", "turn", F.posexplode("p.messages").alias("at", "m")).select(
        "conv_id", "turn", (F.col("at") + 1).alias("place"), "m.role", "m.content")


_SHORT = ("{treatment} is needed for {diagnosis} since", "{treatment} is needed since")


@entry("e6_short_prompt", f"""WITH {_ENRICHED} SELECT ReferenceID AS index, CASE WHEN coalesce(nullif(DiagnosisSubCategory, ''), DiagnosisCategory) IS NOT NULL
    THEN concat(treatment, ' is needed for ', coalesce(nullif(DiagnosisSubCategory, ''), DiagnosisCategory), ' since') ELSE concat(treatment, ' is needed since') END AS prompt
  FROM enriched WHERE treatment IS NOT NULL""", "fx_imr")
def _(spark, d):
    return requests.short_prompt(_enriched(spark, d), *_SHORT)


@entry("e7_eval_prompts", "SELECT path, concat('Denied: ', raw_text, ' Appeal it.') AS prompt FROM fx_letters WHERE ends_with(path, '_rejection.txt')", "fx_letters")
def _(spark, d):
    return requests.eval_prompts(view(spark, d, "fx_letters"), "Denied: {letter} Appeal it.", text="raw_text")


_TRIED = f"tried AS (SELECT conv_id, attempt, prompt, {_ANSWER} AS answer, row_number() OVER (PARTITION BY conv_id ORDER BY attempt) AS nth FROM fx_completions)"


@entry("e8_first_good", f"""WITH {_TRIED} SELECT conv_id, arg_min(CASE WHEN good THEN answer END, CASE WHEN good THEN nth END) AS result,
    CASE WHEN NOT bool_or(good) THEN concat('Could not generate for ', arg_min(prompt, nth)) END AS error
  FROM (SELECT *, answer <> '' AND NOT contains(answer, 'que') AS good FROM tried WHERE nth <= 3) GROUP BY conv_id""", "fx_completions")
def _(spark, d):
    tried = view(spark, d, "fx_completions").withColumn("answer", T.clean_completion(F.col("prompt"), F.col("raw")))
    return select.first_good(tried, ["conv_id"], good=~F.contains("answer", F.lit("que")))


# --- F, G, H: joins, aggregates, choices --------------------------------------------------------


@entry("f7_match_phrases", f"WITH {_DECODED} SELECT letter_type, path, unnest({_hit('lower(raw_text)')}) AS phrase FROM decoded", "fx_letters")
def _(spark, d):
    rows = [("rejection" if kind == "denial" else kind, phrase) for kind, own in fx.PHRASES.items() for phrase in own]
    rules = spark.createDataFrame(rows, "letter_type string, phrase string")
    return gate.match_phrases(_letters(spark, d), rules, ["path"], "raw_text")


# Ten phrases of one to six words out of every document: many, of all shapes, common and rare.
_PICKED = r"""phrases AS (SELECT DISTINCT lang, {join} AS phrase FROM (
    SELECT lang, words, (doc_id * 7 + k * 131) % {n} AS place, 1 + (doc_id + k) % 6 AS n
    FROM (SELECT doc_id, lang, {words} AS words FROM documents) {each} WHERE {n} > 0) picked)"""


@entry("f7_phrase_index", "WITH " + _PICKED.format(
    join="array_to_string(words[CAST(place + 1 AS BIGINT):CAST(place + n AS BIGINT)], ' ')", n="len(words)", words=r"regexp_extract_all(lower(text), '\S+')", each="CROSS JOIN range(10) r(k)")
    + """ SELECT d.lang, phrase, count(*) AS n_texts, min(doc_id) AS first_doc FROM documents d JOIN phrases p ON d.lang = p.lang AND contains(lower(d.text), phrase) GROUP BY d.lang, phrase""")
def _(spark, d):
    documents = view(spark, d, "documents")
    picked = spark.sql("WITH " + _PICKED.format(
        join="array_join(slice(words, CAST(place + 1 AS INT), CAST(n AS INT)), ' ')", n="size(words)", words=r"regexp_extract_all(lower(text), r'\S+', 0)",
        each="LATERAL VIEW explode(sequence(0, 9)) r AS k") + " SELECT * FROM phrases")
    found = gate.match_phrases(documents, picked, ["doc_id"], letter_type="lang")
    return found.groupBy("lang", "phrase").agg(F.count("*").alias("n_texts"), F.min("doc_id").alias("first_doc"))


@entry("f8_attach_results", f"SELECT conv_id, attempt, {_ANSWER} AS answer FROM fx_completions", "fx_completions")
def _(spark, d):
    done = view(spark, d, "fx_completions")
    answers = done.select("conv_id", "attempt", T.clean_completion(F.col("prompt"), F.col("raw")).alias("answer"))
    return requests.attach_results(done.select("conv_id", "attempt"), answers, ["conv_id", "attempt"])


@entry("g1_group_letters", f"WITH {_DECODED} SELECT case_id, letter_type, count(*) AS n_letters, min(path) AS first_path, max(path) AS last_path FROM decoded WHERE case_id IS NOT NULL GROUP BY case_id, letter_type", "fx_letters")
def _(spark, d):
    return select.group_letters(_letters(spark, d).filter("case_id IS NOT NULL"))


_LINK_POINTS = "CASE WHEN ok THEN 200 + length(url) + CASE WHEN contains(url, '.gov') THEN 100 ELSE 0 END ELSE -100 END"
_LINKED = f"{_URLS.format(text='lower(text)', source='(SELECT NULL AS doc_id, path, text FROM cleaned)')}, linked AS (SELECT path, CAST(sum({_LINK_POINTS}) AS BIGINT) AS url_score FROM valid GROUP BY path)"


@entry("g6_url_score", f"WITH {_CLEANED}, {_LINKED} SELECT path, url_score FROM linked", "fx_letters", "fx_url_status")
def _(spark, d):
    cleaned = staged(clean_letters(view(spark, d, "fx_letters"), fx.PHRASES, fx.REWRITES), fresh_dir(spark, "letters"))
    return urls.url_score(cleaned, view(spark, d, "fx_url_status"), ["path"])


_MINIMUM = "CASE letter_type WHEN 'diagnosis' THEN 10 WHEN 'medically_necessary' THEN 20 WHEN 'treatment' THEN 15 ELSE 5 END"
_SCORED = f"""{_CLEANED}, {_LINKED}, scored AS (SELECT cleaned.*, CASE WHEN text IS NULL THEN -1e25 ELSE CAST({_BIAS} + coalesce(url_score, 0) AS DOUBLE)
    + CASE WHEN letter_type = 'appeal' THEN length(text) / 100.0::DOUBLE WHEN length(text) < {_MINIMUM} THEN 0 ELSE -(length(text) / 100.0::DOUBLE) END END AS base_score
  FROM cleaned LEFT JOIN linked USING (path)),
  best AS (SELECT * FROM (SELECT case_id, letter_type, path, text, base_score + CASE WHEN letter_type <> 'appeal' AND text = '' THEN 20 ELSE 0 END AS score,
    row_number() OVER (PARTITION BY case_id, letter_type ORDER BY base_score + CASE WHEN letter_type <> 'appeal' AND text = '' THEN 20 ELSE 0 END DESC, path) AS nth FROM scored) WHERE nth = 1)"""


def _scored(spark, d):
    return scored_letters(view(spark, d, "fx_letters"), fx.PHRASES, fx.REWRITES, fresh_dir(spark, "letters"), view(spark, d, "fx_url_status"))


@entry("g2_choose_best", f"WITH {_SCORED} SELECT case_id, letter_type, path, round(score, 6) AS score FROM best", "fx_letters", "fx_url_status")
def _(spark, d):
    return select.choose_best(_scored(spark, d)).select("case_id", "letter_type", "path", F.round("score", 6).alias("score"))


_UNIQUE = f"{_FOUND}, uniq AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_KEY.format('recommendation')} ORDER BY pdf, page_no, pos) AS nth FROM found) WHERE nth = 1)"


@entry("g3_dedup_first", f"WITH {_UNIQUE} SELECT pdf, page_no, pos, recommendation FROM uniq", "fx_guideline_pages")
def _(spark, d):
    return records.recommendations(view(spark, d, "fx_guideline_pages"))


@entry("g4_concat_per", f"WITH {_UNIQUE} SELECT pdf, string_agg(recommendation, '-' || chr(10) ORDER BY page_no, pos) AS joined FROM uniq GROUP BY pdf", "fx_guideline_pages")
def _(spark, d):
    return records.concat_per(records.recommendations(view(spark, d, "fx_guideline_pages")), "pdf", "recommendation", ["page_no", "pos"], "-\n")


@entry("l2_generate", """SELECT conv_id, turn, CASE WHEN length(text) % 11 = 0 OR attempt > 3 THEN NULL ELSE concat(CAST(attempt AS STRING), ':', substr(text, 1, 20)) END AS response,
    CAST(CASE WHEN length(text) % 11 = 0 THEN 3 ELSE least(attempt, 3) END AS INTEGER) AS attempts,
    CASE WHEN length(text) % 11 = 0 OR attempt > 3 THEN concat('Could not generate for ', text) END AS error
  FROM (SELECT *, 1 + (4 - length(text) % 4) % 4 AS attempt FROM conversations)""")
def _(spark, d):
    def make():
        return lambda prompts, attempt: [None if len(p) % 11 == 0 else f"{attempt}:{p[:20]}" if (len(p) + attempt - 1) % 4 == 0 else "" for p in prompts]

    return generate.generate(view(spark, d, "conversations"), make, lambda answer: answer != "", prompt="text").select("conv_id", "turn", "response", "attempts", "error")


@entry("g5_counts", "SELECT count(*) AS total, count(*) FILTER (contains(Determination, 'Overturned')) AS overturned, count(*) FILTER (Determination IS NULL) AS unknown FROM fx_imr", "fx_imr")
def _(spark, d):
    return records.counts(view(spark, d, "fx_imr"), overturned=F.contains("Determination", F.lit("Overturned")), unknown=F.col("Determination").isNull())


@entry("g7_distinct_per_page", f"WITH {_FOUND} SELECT pdf, page_no, count(*) AS n FROM found GROUP BY pdf, page_no", "fx_guideline_pages")
def _(spark, d):
    pages = view(spark, d, "fx_guideline_pages").withColumn("text", T.normalise_page(F.col("text")))
    return extract.extract_recommendations(pages).groupBy("pdf", "page_no").agg(F.count("*").alias("n"))


@entry("g8_keyword_score", "SELECT doc_id, CAST(" + " + ".join(f"CASE WHEN contains(lower(text), '{w}') THEN {n} ELSE 0 END" for w, n in fx.WEIGHTS.items()) + " AS BIGINT) AS score FROM documents")
def _(spark, d):
    return view(spark, d, "documents").select("doc_id", select.keyword_score(F.col("text"), fx.WEIGHTS).alias("score"))


_WIDE = ", ".join(f"max(CASE WHEN letter_type = '{t}' THEN text END) AS {t}" for t in records.WIDE_TYPES)


@entry("g9_case_wide", f"WITH {_SCORED} SELECT case_id, {_WIDE} FROM best GROUP BY case_id", "fx_letters", "fx_url_status")
def _(spark, d):
    return select.case_wide(select.choose_best(_scored(spark, d)), records.WIDE_TYPES)


_PER_REJECTION = f"""{_SCORED}, rejections AS (SELECT case_id, path AS rejection_path, text AS rejection FROM scored WHERE letter_type = 'rejection'),
  chosen AS (SELECT * FROM (SELECT rejection_path, r.case_id, o.letter_type, o.path AS option_path, o.text AS option_text, base_score + CASE WHEN contains(lower(rejection), lower(o.text)) THEN 20 ELSE 0 END AS score,
    row_number() OVER (PARTITION BY rejection_path, o.letter_type ORDER BY base_score + CASE WHEN contains(lower(rejection), lower(o.text)) THEN 20 ELSE 0 END DESC, o.path) AS nth
    FROM rejections r JOIN scored o ON r.case_id = o.case_id AND o.letter_type IN ('treatment', 'reason_for_denial') AND o.text IS NOT NULL) WHERE nth = 1)"""


@entry("h2_best_per_rejection", f"WITH {_PER_REJECTION} SELECT rejection_path, letter_type, option_path, round(score, 6) AS score FROM chosen", "fx_letters", "fx_url_status")
def _(spark, d):
    chosen = select.best_per_rejection(_scored(spark, d), ("treatment", "reason_for_denial"))
    return chosen.select("rejection_path", "letter_type", "option_path", F.round("score", 6).alias("score"))


# --- I, J: search and sets ----------------------------------------------------------------------


@entry("i3_topk", """SELECT query_id, vec_id, similarity, rank FROM (
  SELECT q.vec_id AS query_id, v.vec_id, round(list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 6) + 0.0 AS similarity,
    row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 6) DESC, v.vec_id) AS rank
  FROM embeddings q JOIN embeddings v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0) WHERE rank <= 5""")
def _(spark, d):
    vectors = view(spark, d, "embeddings")
    # The stated query set of a search: every id divisible by 20, against all rows.
    queries = vectors.filter("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    return retrieval.topk(queries, vectors, 5, exclude_self=True)


@entry("j1_all_records", f"""SELECT 'drug' AS origin, 'You know drugs.' AS system, {_DRUG_Q} AS instruction, {_DRUG_A} AS result FROM fx_drugs WHERE primary_site IS NOT NULL
  UNION ALL SELECT 'chat', '', a.text, b.text FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user' AND b.role = 'assistant'""", "fx_drugs")
def _(spark, d):
    chat = _pairs(spark, d).select(F.lit("").alias("system"), F.col("ask").alias("instruction"), F.col("reply").alias("result"))
    return records.all_records(drug=_drug_records(spark, d), chat=chat)


@entry("j2_distinct_rows", "SELECT DISTINCT text, lang FROM documents")
def _(spark, d):
    return records.distinct_rows(view(spark, d, "documents"), ["text", "lang"])


# --- K: training records and preparation --------------------------------------------------------

_R = fx.RECORDS
_CLAUSED = {f"{name}_clause": f"CASE WHEN {value} IS NOT NULL THEN {_slot_sql(_R.clauses[f'{name}_clause'], value=value)} ELSE '' END"
            for name, value in (("treatment", "t_text"), ("history", "patient_history"), ("diagnosis", "w_diagnosis"))}
_OWN = {"history_clause": _CLAUSED["history_clause"], "diagnosis": "w_diagnosis", "treatment": "w_treatment", "rejection": "rejection",
        "treatment_clause": _CLAUSED["treatment_clause"], "diagnosis_clause": _CLAUSED["diagnosis_clause"]}
_CASES = f"""{_PER_REJECTION}, wide AS (SELECT case_id, {_WIDE.replace('AS diagnosis', 'AS w_diagnosis').replace('AS treatment', 'AS w_treatment')} FROM best GROUP BY case_id),
  per_rejection AS (SELECT rejections.*, wide.* EXCLUDE (case_id), (SELECT option_text FROM chosen c WHERE c.rejection_path = rejections.rejection_path AND letter_type = 'treatment') AS t_text,
    (SELECT option_text FROM chosen c WHERE c.rejection_path = rejections.rejection_path AND letter_type = 'reason_for_denial') AS r_text FROM rejections LEFT JOIN wide USING (case_id)),
  made AS (""" + " UNION ALL ".join([
    *[f"SELECT case_id, '{kind}' AS kind, '' AS source_path, '{_R.kinds[kind].system}' AS system, {_slot_sql(_R.kinds[kind].instruction, **_OWN)} AS instruction, {result} AS result "
      f"FROM wide WHERE {result} IS NOT NULL AND w_treatment IS NOT NULL AND w_diagnosis IS NOT NULL" for kind, result in (("why", "medically_necessary"), ("studies", "studies"))],
    *[f"SELECT case_id, '{kind}', rejection_path, '{_R.kinds[kind].system}', {_slot_sql(_R.kinds[kind].instruction, **_OWN)}, {result} FROM per_rejection WHERE {result} IS NOT NULL"
      for kind, result in (("appeal", "appeal"), ("reason", "r_text"), ("treatment", "t_text"), ("diagnosis", "w_diagnosis"))]]) + ")"


@entry("k1_case_records", f"WITH {_CASES} SELECT case_id, kind, source_path, system, instruction, result FROM made", "fx_letters", "fx_url_status")
def _(spark, d):
    return curate(view(spark, d, "fx_letters"), fx.PHRASES, fx.REWRITES, fx.RECORDS, fresh_dir(spark, "cleaned-letters"), view(spark, d, "fx_url_status"))


@entry("k2_drug_records", f"SELECT 'You know drugs.' AS system, {_DRUG_Q} AS instruction, {_DRUG_A} AS result FROM fx_drugs WHERE primary_site IS NOT NULL", "fx_drugs")
def _(spark, d):
    return _drug_records(spark, d)


@entry("k3_guideline_records", f"""WITH {_UNIQUE} SELECT pdf, 'You advise.' AS system, concat('What does ', pdf, ' advise?') AS instruction, coalesce(joined, '') AS result
  FROM (SELECT DISTINCT pdf FROM fx_guideline_pages) LEFT JOIN (SELECT pdf, string_agg(recommendation, '-' || chr(10) ORDER BY page_no, pos) AS joined FROM uniq GROUP BY pdf) USING (pdf)""", "fx_guideline_pages")
def _(spark, d):
    return records.guideline_records(view(spark, d, "fx_guideline_pages"), fx.GUIDELINE)


@entry("k4_to_sft", f"""WITH {_UNIQUE} SELECT pdf, concat('[INST] <<SYS>>You advise.<</SYS>>What does ', pdf, ' advise? [/INST]') AS instruction, substr(coalesce(joined, ''), 1, 20480) AS output
  FROM (SELECT DISTINCT pdf FROM fx_guideline_pages) LEFT JOIN (SELECT pdf, string_agg(recommendation, '-' || chr(10) ORDER BY page_no, pos) AS joined FROM uniq GROUP BY pdf) USING (pdf)""", "fx_guideline_pages")
def _(spark, d):
    return records.to_sft(records.guideline_records(view(spark, d, "fx_guideline_pages"), fx.GUIDELINE))


_INTRO = _quoted(f"{prep.INTRO}\n\n{prep.INSTRUCTION_KEY}\n")


@entry("k5_to_instruct", f"""SELECT conv_id, turn, concat('{{ ''prompt'': ', {_INTRO}, text, CASE WHEN role <> 'user' THEN concat(chr(10), chr(10), 'Input:', chr(10), role) ELSE '' END,
  chr(10), chr(10), '### Response:', ', ''response'': ', text, ' }}') AS text FROM conversations""")
def _(spark, d):
    rows = view(spark, d, "conversations").withColumn("given", F.when(F.col("role") != "user", F.col("role")))
    return prep.to_instruct(rows, "text", "text", "given").select("conv_id", "turn", "text")


_HASH = "CAST('0x' || substr(md5(concat(CAST(doc_id AS STRING), '|68')), 1, 8) AS BIGINT)"


@entry("k6_split_exact", f"SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {_HASH}, doc_id) <= 100 THEN 'eval' ELSE 'train' END AS split FROM documents")
def _(spark, d):
    return prep.split_exact(view(spark, d, "documents"), "doc_id", 100).select("doc_id", "split")


@entry("k6_split_fraction", f"SELECT doc_id, CASE WHEN {_HASH} % 10000 < 500 THEN 'eval' ELSE 'train' END AS split FROM documents")
def _(spark, d):
    return prep.split_fraction(view(spark, d, "documents"), "doc_id").select("doc_id", "split")


@entry("k7_truncate_tokens", r"SELECT doc_id, coalesce(array_to_string(regexp_extract_all(text, '\S+')[1:512], ' '), '') AS text FROM documents")
def _(spark, d):
    return prep.truncate_rows(view(spark, d, "documents"), "text").select("doc_id", "text")


@entry("k8_pack", r"""WITH RECURSIVE sized AS (
    SELECT doc_id, least(coalesce(len(regexp_extract_all(text, '\S+')), 0), 8192) AS n, CAST('0x' || substr(md5(doc_id || '|0'), 1, 8) AS BIGINT) AS h FROM documents),
  ordered AS (SELECT doc_id, CAST(n AS BIGINT) AS n, row_number() OVER (ORDER BY h, doc_id) AS r FROM sized),
  fold AS (SELECT r, doc_id, n, CAST(0 AS BIGINT) AS bin, CAST(0 AS BIGINT) AS position FROM ordered WHERE r = 1
    UNION ALL SELECT o.r, o.doc_id, o.n, CASE WHEN f.position + f.n + o.n > 8192 THEN f.bin + 1 ELSE f.bin END, CASE WHEN f.position + f.n + o.n > 8192 THEN 0 ELSE f.position + f.n END
    FROM fold f JOIN ordered o ON o.r = f.r + 1)
  SELECT doc_id, n AS n_tokens, bin, position FROM fold""")
def _(spark, d):
    sized = view(spark, d, "documents").select("doc_id", F.size(T.tokens(F.col("text"))).alias("n"))
    return packing.pack(sized, "doc_id", "n")


@entry("k9_chunk", _CHUNKS)
def _(spark, d):
    return prep.chunk(view(spark, d, "documents"), "doc_id")


@entry("g5_observed", f"""WITH {_CLEANED} SELECT 'read' AS step, count(*) AS n, count(*) FILTER (coalesce(raw_text, '') = '') AS n_empty FROM fx_letters
  UNION ALL SELECT 'decoded', count(*), count(*) FILTER (coalesce(raw_text, '') = '') FROM decoded WHERE case_id IS NOT NULL
  UNION ALL SELECT 'gated', count(*), count(*) FILTER (coalesce(raw_text, '') = '') FROM gated WHERE case_id IS NOT NULL
  UNION ALL SELECT 'cleaned', count(*), count(*) FILTER (coalesce(text, '') = '') FROM cleaned""", "fx_letters")
def _(spark, d):
    return staged_with_counts(view(spark, d, "fx_letters"), fx.PHRASES, fx.REWRITES, fresh_dir(spark, "letters"))[1]


_SENTENCES = r"""
  WITH RECURSIVE sentences AS (
    SELECT doc_id, pos, sentence FROM (SELECT doc_id, string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS s FROM documents),
      unnest(s) WITH ORDINALITY AS u(sentence, pos)),
  units AS (
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos, i) AS u, t[i + 1:i + 512] AS piece
    FROM (SELECT doc_id, pos, t, unnest(range(0, len(t), 512)) AS i FROM (SELECT doc_id, pos, regexp_extract_all(sentence, '\S+') AS t FROM sentences))),
  sums AS (
    SELECT doc_id, list_prepend(CAST(0 AS BIGINT), list(s ORDER BY u)) AS s FROM (
      SELECT doc_id, u, CAST(sum(len(piece)) OVER (PARTITION BY doc_id ORDER BY u) AS BIGINT) AS s FROM units) GROUP BY doc_id),
  cut AS (
    SELECT doc_id, s, CAST(0 AS BIGINT) AS chunk_no, CAST(0 AS BIGINT) AS first, CAST(len(list_filter(s, lambda x: x <= 512)) - 1 AS BIGINT) AS upto FROM sums
    UNION ALL
    SELECT doc_id, s, chunk_no + 1, next, CAST(len(list_filter(s, lambda x: x <= s[next + 1] + 512)) - 1 AS BIGINT) FROM (
      SELECT doc_id, s, chunk_no, CAST(len(list_filter(s, lambda x: x < s[upto + 1] - least(20, 512 - (s[upto + 2] - s[upto + 1])))) AS BIGINT) AS next
      FROM cut WHERE upto < len(s) - 1))
  SELECT c.doc_id, chunk_no, any_value(c.s[upto + 1] - c.s[first + 1]) AS n_tokens, string_agg(array_to_string(piece, ' '), ' ' ORDER BY u) AS text
  FROM cut c JOIN units ON c.doc_id = units.doc_id AND u > first AND u <= upto GROUP BY c.doc_id, chunk_no"""


@entry("k9_chunk_sentences", _SENTENCES)
def _(spark, d):
    return prep.chunk_sentences(view(spark, d, "documents"), "doc_id")


@entry("k10_index_table", f"SELECT c.doc_id, chunk_no, n_tokens, text, label FROM ({_CHUNKS}) c JOIN embeddings ON c.doc_id = vec_id")
def _(spark, d):
    chunks = prep.chunk(view(spark, d, "documents"), "doc_id")
    vectors = view(spark, d, "embeddings").withColumnRenamed("vec_id", "doc_id")
    return retrieval.build_index_table(chunks, vectors, ["doc_id"]).drop("embedding")
