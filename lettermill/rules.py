"""Rule values and their compilation to Spark columns.

Rules live on the driver: a rule set is a short, hand-written list, so its size does not depend on
the data. Rules kept in a table are handled by ``operators.gate.match_phrases``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: results depend on these being exactly what they are. -----------------------

LETTER_TYPES = (
    "appeal", "rejection", "denial", "json", "medically_necessary", "treatment", "diagnosis",
    "patient_history", "patient_history_questions", "studies", "reason_for_denial",
)
TYPE_ALIASES = {"denial": "rejection"}
PRODUCER_TAGS = ("MAGIC[0-9]*-*[0-9]*", "FARTS[0-9]*", "farts[0-9]", "EXTRACTED")
MODEL_TAGS = ("MAGIC", "EXTRACTED")
HUMAN_BIAS = 1_000_000
RESPONSE_MARKER = "### Response:"
MARKUP_TAGS = ("PARAGRAPH", "FREETEXT")
OUTPUT_MARKERS = ("[ASN]", "[OUT]", "[/INST][/INST]", "[/INST]")
BANNED_COMPLETION = "The reviewer determined that the requested"
MEMBER_MARKER = "[MEMBER]"
URL_LOOSE = r"https?://\S+"
URL_STRICT = (
    r"https?://(?:www\.)?[-a-zA-Z0-9@:%._+~#=]{1,256}\.[a-zA-Z0-9()]{1,6}\b[-a-zA-Z0-9@:%_+.~#?&/=]*"
)
URL_TAIL = ".:;,?>"
URL_VALID, URL_GOV, URL_INVALID = 200, 100, -100
CONTAINED_BONUS = 20
NULL_SCORE = -1e25
MIN_LENGTHS = {"diagnosis": 10, "medically_necessary": 20, "treatment": 15, "patient_history": 20}
DEFAULT_MIN_LENGTH = 5
# The case history is scored under a key of its own, which has no minimum length of its own.
SCORE_KEYS = {"patient_history": "history"}
MAX_ANSWER_CHARS = 20480
RECOMMENDATION_SEPARATOR = "-\n"
PROMPT_ORDER = (
    "treatment", "diagnosis", "reason_for_denial", "denial", "appeal", "medically_necessary",
    "studies", "patient_history", "patient_history_questions",
)
DECISION_COLUMNS = (
    "Determination", "TreatmentCategory", "TreatmentSubCategory", "DiagnosisCategory",
    "DiagnosisSubCategory", "Type", "Findings", "ReferenceID",
)
JSON_REQUIRED_KEYS = ("condition", "approval_reason")
# --- End of fixed values. ---------------------------------------------------------------------


@dataclass(frozen=True)
class ExtractRule:
    """One step of an extraction cascade: a regular expression and the capture group to keep."""

    pattern: str
    group: int = 1


@dataclass(frozen=True)
class RewriteRule:
    """Replace ``pattern`` by ``replacement``, any case; ``is_regex`` rules may refer to ``\\1``."""

    pattern: str
    replacement: str = ""
    is_regex: bool = False

    def java_pattern(self) -> str:
        return "(?iu)" + (self.pattern if self.is_regex else re.escape(self.pattern))

    def java_replacement(self) -> str:
        if not self.is_regex:
            return self.replacement.replace("\\", "\\\\").replace("$", "\\$")
        return re.sub(r"\\(\d)", r"$\1", self.replacement.replace("$", "\\$"))

    def may_match(self, text: Column, lowered: Column) -> Column:
        """True for every text the rule matches; for ASCII text and pattern a plain byte search."""
        tried = text.rlike(self.java_pattern())
        if not self.is_regex and self.pattern.isascii():
            # Other letters may fold to ASCII ones in the pattern but not in lower(): there the pattern is tried.
            return F.contains(lowered, F.lit(self.pattern.lower())) | ((F.octet_length(text) != F.length(text)) & tried)
        return tried

    def apply(self, text: Column) -> Column:
        return F.regexp_replace(text, F.lit(self.java_pattern()), F.lit(self.java_replacement()))


@dataclass(frozen=True)
class RewriteSet:
    """Rewrite rules for all letters (``general``) and, after those, for one letter type."""

    general: Sequence[RewriteRule] = ()
    by_type: Mapping[str, Sequence[RewriteRule]] = field(default_factory=dict)

    def for_type(self, letter_type: str | None) -> tuple[RewriteRule, ...]:
        own: list[RewriteRule] = []
        for name, rules in self.by_type.items():
            if TYPE_ALIASES.get(name, name) == letter_type:
                own.extend(rules)
        return (*self.general, *own)

    def types(self) -> list[str]:
        return sorted({TYPE_ALIASES.get(name, name) for name in self.by_type})


def check_rewrites(rules: Sequence[RewriteRule]) -> None:
    """Reject a literal rule whose replacement holds its own pattern: it could never settle."""
    for rule in rules:
        if rule.is_regex or rule.pattern.lower() == rule.replacement.lower():
            continue
        if rule.pattern.lower() in rule.replacement.lower():
            raise ValueError(f"rewrite rule never settles: {rule.pattern!r} -> {rule.replacement!r}")


# What a text under rewriting is: still changing, changed by no rule, back at what it was before.
OPEN, SETTLED, CYCLIC = 0, 1, 2
Passer = tuple[Callable[[Column], Column], Callable[[Column], Column]]


def open_state(text: Column) -> Column:
    """A text of which no pass was made: (text, status, seen), ``seen`` being hashes of what it was."""
    return F.struct(text.alias("text"), F.lit(OPEN).alias("status"), F.array(F.xxhash64(text)).alias("seen"))


def after_passes(state: Column, passes: Column, one_pass: Callable[[Column], Column], may_match: Callable[[Column], Column]) -> Column:
    """``state`` after up to ``passes`` passes: it is left alone once it is settled or cyclic."""
    def made(before: Column, after: Column) -> Column:
        met = F.array_contains(before["seen"], F.xxhash64(after))
        status = F.when(after == before["text"], SETTLED).when(met, CYCLIC).otherwise(OPEN)
        return F.struct(after.alias("text"), status.alias("status"), F.array_append(before["seen"], F.xxhash64(after)).alias("seen"))

    def step(before: Column, _: Column) -> Column:
        settled = F.struct(before["text"].alias("text"), F.lit(SETTLED).alias("status"), before["seen"].alias("seen"))
        return (F.when(before["status"] != OPEN, before).when(~may_match(before["text"]), settled)
                .otherwise(F.transform(F.array(one_pass(before["text"])), lambda after: made(before, after))[0]))

    return F.aggregate(F.sequence(F.lit(1), passes), state, step)


def one_pass_of(rules: Sequence[RewriteRule]) -> Passer:
    """(one pass of the rules, whether any may match)."""
    def one_pass(value: Column) -> Column:
        for rule in rules:
            value = rule.apply(value)
        return value

    def may_match(value: Column) -> Column:
        def test(lowered: Column) -> Column:
            found = F.lit(False)
            for rule in rules:
                found = found | rule.may_match(value, lowered)
            return found

        return F.exists(F.array(F.lower(value)), test)

    return one_pass, may_match


def _by_type(letter_type: Column, rules: RewriteSet, choose: Callable[[str | None], Column]) -> Column:
    result = None
    for name in rules.types():
        result = F.when(letter_type == name, choose(name)) if result is None else result.when(letter_type == name, choose(name))
    return choose(None) if result is None else result.otherwise(choose(None))


def one_pass_by_type(letter_type: Column, rules: RewriteSet) -> Passer:
    """``one_pass_of`` the general rules, then of those of the letter's own type."""
    return (lambda value: _by_type(letter_type, rules, lambda name: one_pass_of(rules.for_type(name))[0](value)),
            lambda value: _by_type(letter_type, rules, lambda name: one_pass_of(rules.for_type(name))[1](value)))


def rewrite(text: Column, rules: Sequence[RewriteRule], first_passes: int = 8) -> Column:
    """Apply ``rules`` in order, again and again until the text stops changing.

    One pass is the chain of replacements, so every pattern is compiled once per task; a text that no rule can
    match is left alone. After ``first_passes`` the few texts still changing get as many passes as they have
    characters, more than any rules that shrink a text need. A text in a cycle stays as it was when it came back, one
    that grows without end as it is then: neither ends the job. ``operators.rewriting`` tells which texts these are.
    """
    if not rules:
        return text
    check_rewrites(rules)
    one_pass, may_match = one_pass_of(rules)
    first = after_passes(open_state(text), F.lit(first_passes), one_pass, may_match)
    whole = F.transform(F.array(first), lambda state: F.when(state["status"] != OPEN, state).otherwise(
        after_passes(state, F.length(state["text"]) + 1, one_pass, may_match)))[0]
    return F.when(text.isNotNull(), whole["text"])


def rewrite_by_type(text: Column, letter_type: Column, rules: RewriteSet) -> Column:
    """General rules, then those of the letter's own type."""
    return _by_type(letter_type, rules, lambda name: rewrite(text, rules.for_type(name)))


def fill_template(template: str, **slots: Column) -> Column:
    """Concatenate the literal parts of ``template`` with the columns named in its ``{slot}`` marks."""
    parts: list[Column] = []
    for piece in re.split(r"(\{\w+\})", template):
        if piece[:1] == "{" and piece[-1:] == "}":
            parts.append(F.coalesce(slots[piece[1:-1]], F.lit("")))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts) if parts else F.lit("")
