"""Chat formatting: turn order checked by a finite-state machine, text segments with loss flags.

Built-in Spark functions only. A template declares, per role, the marks round a turn and whether its text
counts for the loss; the machine is a table of allowed steps.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill.llm.common import table


@dataclass(frozen=True)
class RoleMarks:
    """What stands before and after a turn of a role, and whether the turn's text is learned."""

    opens: str
    closes: str
    loss: bool = False


@dataclass(frozen=True)
class ChatTemplate:
    """Marks per role, and the machine that says which role may follow.

    A role without marks of its own is written as ``other.opens``, the role's name, ``name_end``, the text,
    ``other.closes``. ``steps`` maps (state, role) to the next state; states are names, the first is
    ``start``. A conversation is valid if every step is allowed and the last state is in ``accepting``.
    """

    roles: Mapping[str, RoleMarks] = field(default_factory=lambda: {
        "system": RoleMarks("[SYS]", "[/SYS]"),
        "user": RoleMarks("[INST]", "[/INST]"),
        "assistant": RoleMarks("<s>", "</s>", loss=True),
    })
    other: RoleMarks = RoleMarks("[ROLE]", "[END]")
    name_end: str = "[/ROLE]"
    start: str = "start"
    steps: Mapping[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user",
        ("user", "assistant"): "assistant", ("assistant", "user"): "user",
    })
    accepting: Sequence[str] = ("assistant",)

    def __post_init__(self) -> None:
        marks = self.marks()
        firsts = {m[0] for m in marks}
        if len(set(marks)) < len(marks):
            raise ValueError("marks must differ")
        if any(len(m) < 2 or "\\" in m or firsts & set(m[1:]) for m in marks):
            raise ValueError("a mark needs two characters, no backslash, and no first character of a mark inside")

    def marks(self) -> list[str]:
        sides = [s for r in (*self.roles.values(), self.other) for s in (r.opens, r.closes)]
        return [*sides, self.name_end]


def _mark_patterns(template: ChatTemplate) -> list[tuple[str, str]]:
    """Per first character of a mark: that character, and an alternation of what may follow it."""
    rests: dict[str, list[str]] = {}
    for mark in template.marks():
        rests.setdefault(mark[0], []).append(re.escape(mark[1:]))
    return [(re.escape(first), "|".join(sorted(own))) for first, own in sorted(rests.items())]


def escape(text: Column, template: ChatTemplate) -> Column:
    """Put a backslash after the first character of every mark in ``text``; marks already so escaped, by any
    number of backslashes, get one more. So no mark is left in the text, and ``unescape`` is exact."""
    for first, rest in _mark_patterns(template):
        text = F.regexp_replace(text, rf"({first})(\\*)({rest})", r"$1\\$2$3")
    return text


def unescape(text: Column, template: ChatTemplate) -> Column:
    for first, rest in _mark_patterns(template):
        text = F.regexp_replace(text, rf"({first})\\(\\*)({rest})", "$1$2$3")
    return text


def _segments(turn: Column, template: ChatTemplate) -> Column:
    def part(text: Column | str, loss: bool = False) -> Column:
        value = F.lit(text) if isinstance(text, str) else text
        return F.struct(value.alias("text"), F.lit(loss).alias("loss"))

    said = escape(turn["text"], template)
    named = F.concat(escape(turn["role"], template), F.lit(template.name_end))
    parts = None
    for role, marks in template.roles.items():
        own = F.array(part(marks.opens), part(said, marks.loss), part(marks.closes))
        parts = F.when(turn["role"] == role, own) if parts is None else parts.when(turn["role"] == role, own)
    rest = F.array(part(template.other.opens), part(named), part(said, template.other.loss), part(template.other.closes))
    return rest if parts is None else parts.otherwise(rest)


def _walk(turns: Column, template: ChatTemplate) -> Column:
    """The machine's end: (state, bad), ``bad`` the place of the first turn that no step allows, else null."""
    allowed_steps = F.create_map(*[F.lit(x) for (state, role), to in template.steps.items() for x in (f"{state}\n{role}", to)])

    def step(at: Column, turn: Column) -> Column:
        to = F.try_element_at(allowed_steps, F.concat(at["state"], F.lit("\n"), turn["role"]))
        allowed = at["bad"].isNull() & to.isNotNull()
        return F.struct(F.when(allowed, to).otherwise(at["state"]).alias("state"), (at["place"] + 1).alias("place"),
                        F.when(allowed, F.lit(None)).otherwise(F.coalesce(at["bad"], at["place"])).cast("int").alias("bad"))

    begin = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("place"), F.lit(None).cast("int").alias("bad"))
    return F.aggregate(turns, begin, step)


def format_conversations(rows: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """One row per ``conv_id`` of ``rows`` (conv_id, turn, role, text; other columns are ignored).

    Returns ``conv_id``, ``segments`` (array of text, loss), ``formatted`` (their texts joined), ``valid`` and
    ``first_bad_turn`` (place from 0 of the first turn out of order). Conversations out of order are formatted
    like the others. Turns are ordered by turn (null first), role, text, so that ties and repeated rows have
    one order; null role and null text count as empty; null ``conv_id`` is one conversation. A conversation is
    one output row and is therefore held by one task.
    """
    template = template or ChatTemplate()
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    cut = whole.select(
        "conv_id", F.flatten(F.transform("turns", lambda t: _segments(t, template))).alias("segments"),
        _walk(F.col("turns"), template).alias("end"))
    return cut.select(
        "conv_id", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        (F.col("end.bad").isNull() & F.col("end.state").isin(*template.accepting)).alias("valid"),
        F.col("end.bad").alias("first_bad_turn"))


def read_turns(formatted: Column, template: ChatTemplate | None = None) -> Column:
    """The turns (role, text) of a formatted conversation, marks removed and texts unescaped."""
    template = template or ChatTemplate()
    opens = [m.opens for m in (*template.roles.values(), template.other)]
    closes = [m.closes for m in (*template.roles.values(), template.other)]
    pattern = f"(?s)(?:{'|'.join(map(re.escape, opens))}).*?(?:{'|'.join(map(re.escape, closes))})"

    def turn(whole: Column) -> Column:
        def inside(marks: RoleMarks) -> Column:
            return F.substring(whole, F.lit(len(marks.opens) + 1), F.length(whole) - len(marks.opens) - len(marks.closes))

        def read(role: Column, text: Column) -> Column:
            return F.struct(role.alias("role"), unescape(text, template).alias("text"))

        found = None
        for role, marks in template.roles.items():
            own = read(F.lit(role), inside(marks))
            found = F.when(F.startswith(whole, F.lit(marks.opens)), own) if found is None else found.when(
                F.startswith(whole, F.lit(marks.opens)), own)
        other = inside(template.other)
        name_at = F.instr(other, template.name_end)
        rest = read(unescape(F.substring(other, F.lit(1), name_at - 1), template),
                    F.substring(other, name_at + len(template.name_end), F.length(other)))
        return rest if found is None else found.otherwise(rest)

    return F.transform(F.regexp_extract_all(formatted, F.lit(pattern), F.lit(0)), turn)


def loss_text(segments: Column, template: ChatTemplate | None = None) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    template = template or ChatTemplate()
    learned = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(learned, lambda s: unescape(s["text"], template)), "")


def chat_digest(formatted: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """Counts and digests read back from the output of ``format_conversations``."""
    template = template or ChatTemplate()
    read = formatted.select(
        "conv_id", read_turns(F.col("formatted"), template).alias("turns"), loss_text(F.col("segments"), template).alias("learned"),
        F.length("formatted").cast("bigint").alias("formatted_chars"), "valid", F.col("first_bad_turn").cast("bigint").alias("first_bad_turn"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars", "valid", "first_bad_turn")


# Its texts look like marks: they must come back as they are.
SAMPLE = "VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]')"


def op2_chat(spark, sf_dir: str) -> DataFrame:
    sample = spark.sql(f"SELECT * FROM {SAMPLE} AS t(conv_id, turn, role, text)")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(sample)
    return chat_digest(format_conversations(rows))


OP2_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT conv_id, turn, role, text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place,
    regexp_replace(regexp_replace(text, '(<)(\\*)(/s>|s>)', '\1\\\2\3', 'g'),
      '(\[)(\\*)(/INST\]|/ROLE\]|/SYS\]|END\]|INST\]|ROLE\]|SYS\])', '\1\\\2\3', 'g') AS escaped,
    regexp_replace(regexp_replace(role, '(<)(\\*)(/s>|s>)', '\1\\\2\3', 'g'),
      '(\[)(\\*)(/INST\]|/ROLE\]|/SYS\]|END\]|INST\]|ROLE\]|SYS\])', '\1\\\2\3', 'g') AS named,
    CASE WHEN role IN ('system', 'user', 'assistant') THEN role ELSE 'other' END AS kind,
    coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text), 'start') AS before
  FROM said),
steps AS (
  SELECT *, (before = 'start' AND place = 0 AND role IN ('system', 'user')) OR (before = 'system' AND role = 'user')
    OR (before = 'user' AND role = 'assistant') OR (before = 'assistant' AND role = 'user') AS allowed
  FROM marked)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END), 0) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY place)) AS loss_sha256,
  CAST(sum(length(escaped) + CASE kind WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
    ELSE 18 + length(named) END) AS BIGINT) AS formatted_chars,
  bool_and(allowed) AND arg_max(role, place) = 'assistant' AS valid,
  min(CASE WHEN NOT allowed THEN place END) AS first_bad_turn
FROM steps GROUP BY conv_id
"""
