"""Scalar text functions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lettermill.rules import (
    BANNED_COMPLETION, MARKUP_TAGS, MAX_ANSWER_CHARS, MEMBER_MARKER, OUTPUT_MARKERS, RESPONSE_MARKER,
    RewriteRule, fill_template, rewrite,
)

CURLY_QUOTES = "\u201c\u201d"


# Bytes as Latin-1 characters: the sequences of two to four bytes that are UTF-8, as the standard tells them.
_SEQUENCE = (r"[\xC2-\xDF][\x80-\xBF]|\xE0[\xA0-\xBF][\x80-\xBF]|[\xE1-\xEC\xEE\xEF][\x80-\xBF]{2}|\xED[\x80-\x9F][\x80-\xBF]"
             r"|\xF0[\x90-\xBF][\x80-\xBF]{2}|[\xF1-\xF3][\x80-\xBF]{3}|\xF4[\x80-\x8F][\x80-\xBF]{2}")


def repair_utf8(raw: Column) -> Column:
    """Decode bytes, dropping those that are part of no UTF-8 sequence; all others stay, a replacement character that was
    there among them."""
    decoded = raw.cast("string")
    kept = F.regexp_replace(F.decode(raw, "ISO-8859-1"), rf"({_SEQUENCE})|[\x80-\xFF]", "$1")
    return F.when(F.is_valid_utf8(decoded), decoded).otherwise(F.encode(kept, "ISO-8859-1").cast("string"))


def strip_control(text: Column) -> Column:
    """Remove characters of Unicode category C, keeping line feeds."""
    return F.regexp_replace(text, r"[\p{C}&&[^\n]]", "")


def negate(text: Column, verbs: Sequence[str] = ("is", "are", "were", "be"), adverb: str = "medically",
           adjectives: Sequence[str] = ("necessary", "required")) -> Column:
    """Put "not" after the verb of "<verb> <adverb> <adjective>", any case."""
    # Fixed behaviour: what stands between verb, adverb and adjective may be any white space, or none.
    pattern = rf"(?iu)({'|'.join(verbs)})\s*{adverb}\s*({'|'.join(adjectives)})"
    return F.regexp_replace(text, pattern, f"$1 not {adverb} $2")


def repair_rejection(text: Column, denial_markers: Sequence[str], rules: Sequence[RewriteRule] = (),
                     denial_sentence: str = "Your request is denied.", **negation) -> Column:
    """Make a rejection read as one: a denial sentence, a salutation, negated necessity, then rewrites."""
    marker = "(?iu)(" + "|".join(re.escape(m) for m in denial_markers) + ")"
    denied = F.when(text.rlike(marker), text).otherwise(F.concat(text, F.lit(f". {denial_sentence}")))
    greeted = F.when(F.contains(denied, F.lit(MEMBER_MARKER)), denied).otherwise(
        F.concat(F.lit(f"Dear {MEMBER_MARKER}; "), denied, F.lit(".")))
    return rewrite(negate(greeted, **negation), rules)


def normalise_page(text: Column) -> Column:
    """Join words hyphenated at a line end, drop line feeds, straighten double quotes."""
    joined = F.replace(F.replace(text, F.lit("-\n"), F.lit("")), F.lit("\n"), F.lit(""))
    return F.translate(joined, CURLY_QUOTES, '""')


def dedup_key(text: Column) -> Column:
    """Lowercase, without the letters "the" in a row and without spaces."""
    return F.replace(F.replace(F.lower(text), F.lit("the"), F.lit("")), F.lit(" "), F.lit(""))


def truncate_chars(text: Column, limit: int = MAX_ANSWER_CHARS) -> Column:
    return F.substring(text, 1, limit)


def trim_newlines(text: Column) -> Column:
    return F.btrim(text, F.lit("\n"))


def parse_record(text: Column) -> Column:
    """Drop paragraph markup; keep what follows the first response marker, up to the next one."""
    plain = F.regexp_replace(text, rf"<\s*/?\s*({'|'.join(MARKUP_TAGS)})\s*>", "")
    marker = F.lit(RESPONSE_MARKER)
    return F.when(F.contains(plain, marker), F.split_part(plain, marker, F.lit(2))).otherwise(plain)


def drop_sentences(text: Column, markers: Sequence[str], separator: str = ". ") -> Column:
    """Drop the sentences that hold any of ``markers``."""
    def keep(sentence: Column) -> Column:
        found = F.lit(False)
        for marker in markers:
            found = found | F.contains(sentence, F.lit(marker))
        return ~found

    return F.array_join(F.filter(F.split(text, re.escape(separator)), keep), separator)


def wrap_prompt(system: Column | None, instruction: Column, context: Column | None = None) -> Column:
    """Instruction tags round system text, instruction and context; the system tag is added once."""
    system = F.coalesce(system, F.lit("")) if system is not None else F.lit("")
    context = F.coalesce(context, F.lit("")) if context is not None else F.lit("")
    tagged = F.when((system == "") | F.contains(system, F.lit("<<SYS>>")), system).otherwise(
        F.concat(F.lit("<<SYS>>"), system, F.lit("<</SYS>>")))
    return F.concat(F.lit("[INST] "), tagged, instruction, F.lit(" "), context, F.lit("[/INST]"))


def chat_wrap(prompt: Column) -> Column:
    """The form in which a prompt is given to an instruct model."""
    return F.concat(F.lit("<s>[INST]"), prompt, F.lit("[/INST]"))


def drug_qa(question: str, answer: str, **fields: Column) -> tuple[Column, Column]:
    """Question and answer columns from two templates; absent values become empty text."""
    return fill_template(question, **fields), fill_template(answer, **fields)


def json_record(**fields: Column) -> Column:
    """One JSON object per row; keys in the order given."""
    return F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))


def length_score(text: Column) -> Column:
    return F.length(text) / F.lit(100.0)


def is_unknown(value: Column) -> Column:
    """Null, empty, "other" in any case, or marked as unknown (in its usual misspelling)."""
    lowered = F.lower(value)
    return value.isNull() | F.contains(lowered, F.lit("unkown")) | lowered.isin("other", "")


def optional_clause(value: Column, template: str) -> Column:
    """The template filled with the value, or nothing when the value is null or "other"."""
    known = value.isNotNull() & (F.lower(value) != "other")
    return F.when(known, fill_template(template, value=value)).otherwise("")


def mentions_study(value: Column, keywords: Sequence[str] = ("journal", "article", "study by"),
                   mode: str = "intended") -> Column:
    """Whether the text names a study; ``mode='reference'`` looks for all keywords between slashes."""
    if mode == "reference":
        pattern = "(?iu)/" + "/".join(re.escape(k) for k in keywords) + "/"
    else:
        pattern = "(?iu)(" + "|".join(re.escape(k) for k in keywords) + ")"
    return F.coalesce(value.rlike(pattern), F.lit(False))


def clean_completion(prompt: Column, raw: Column, banned: str = BANNED_COMPLETION,
                     markers: Sequence[str] = OUTPUT_MARKERS) -> Column:
    """The answer inside a raw completion; empty where there is none."""
    text = F.when(F.contains(raw, F.lit(banned)), F.lit("")).otherwise(raw)
    answer = F.when(F.startswith(text, prompt), F.right(text, F.length(text) - F.length(prompt)))
    for marker in markers:
        answer = answer.when(F.contains(text, F.lit(marker)), F.split_part(text, F.lit(marker), F.lit(2)))
    return F.coalesce(answer.otherwise(text), F.lit(""))


def cleaned_or_error(prompt: Column, raw: Column, **cleaning) -> Column:
    """(result, error) of a completion: the answer inside it, or an error naming the prompt where there is none."""
    return F.transform(F.array(clean_completion(prompt, raw, **cleaning)), lambda answer: F.struct(
        F.when(answer != "", answer).alias("result"),
        F.when(answer == "", F.concat(F.lit("Could not generate for "), prompt)).alias("error")))[0]


def response_content(envelope: Column) -> Column:
    """The text of the first choice in a chat-completion response."""
    return F.get_json_object(envelope, "$.choices[0].message.content")


def tokens(text: Column) -> Column:
    """Whitespace tokens; empty text has none."""
    return F.regexp_extract_all(text, F.lit(r"\S+"), F.lit(0))


def truncate_tokens(text: Column, limit: int = 512) -> Column:
    """The first ``limit`` whitespace tokens, joined by single spaces."""
    return F.array_join(F.slice(tokens(text), 1, limit), " ")
