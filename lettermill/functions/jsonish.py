"""Reading JSON that a model wrote: quotes, colons and closing braces may be missing.

A text is cut into tokens once, and each token is written anew by what stands on either side of it; lines are taken
apart once. All of it is linear in the length of the text.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lettermill.functions.text import strip_control
from lettermill.rules import JSON_REQUIRED_KEYS

# A token with the white space before it: a string that ends in its line (at a quote after an even number of
# backslashes), a mark, or a run of anything else; a quote that nothing closes stands alone.
_TOKEN = r'\s*+(?:"(?:[^\n]*?"(?<=(?<!\\)(?:\\\\){0,20}"))?|[{}\[\],:]|[^\s"{}\[\],:]++)|\s++'
_WORD = r"^[A-Za-z_]\w*$"


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is named."""
    return F.transform(F.array(value), use)[0]


def _written(text: Column, colons: bool) -> Column:
    """The text with bare keys quoted, and with a colon after those that lack one before a value in their line."""
    def each(tokens: Column, cores: Column) -> Column:
        def token(own: Column, i: Column) -> Column:
            core, after, gap = cores[i], F.get(cores, i + 1), F.get(tokens, i + 1)
            opened = F.coalesce(F.get(cores, i - 1).isin("{", ","), F.lit(False)) & core.rlike(_WORD)
            space = F.substring(own, 1, F.length(own) - F.length(core))
            quoted = F.concat(space, F.lit('"'), core, F.lit('"'))
            out = F.when(opened & (after == ":"), quoted)
            if colons:
                value = ~after.isin(":", ",", "}", "]", "") & gap.rlike(r"^[ \t]")
                out = out.when(opened & value, F.concat(quoted, F.lit(":")))
            return out.otherwise(own)

        return F.array_join(F.transform(tokens, token), "")

    white = F.lit(" \t\n\r\f\x0b")
    return F.when(text.isNotNull(), _bind(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), lambda tokens: _bind(
        F.transform(tokens, lambda t: F.ltrim(t, white)), lambda cores: each(tokens, cores))))


def quote_keys(text: Column) -> Column:
    """Quote bare keys, outside of strings."""
    return _written(text, colons=False)


def repair_json_text(text: Column) -> Column:
    """Quote bare keys, and put a colon between a bare key and the value that follows it without one."""
    return _written(text, colons=True)


def strict_json(text: Column) -> Column:
    """The text if it is exactly one JSON value, else null; trailing characters are refused."""
    one_value = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    return F.when(one_value & F.try_parse_json(text).isNotNull(), text)


def _bare(text: Column) -> Column:
    return F.ltrim(F.rtrim(F.btrim(text, F.lit(" \t\r")), F.lit('",')), F.lit('"'))


def _as_string(text: Column) -> Column:
    """A JSON string."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, 2, F.length(listed) - 2)


def _line_value(text: Column) -> Column:
    """A line's value as JSON text: itself if it is JSON, else the bare words as a JSON string."""
    return F.coalesce(strict_json(F.btrim(text, F.lit(" \t\r"))), _as_string(_bare(text)))


def by_lines(text: Column, required: Sequence[str] = JSON_REQUIRED_KEYS) -> Column:
    """``key: value`` lines as a JSON object, kept only when every required key is there; of a key that comes twice the
    last value stands, at its place."""
    def pair(line: Column, i: Column) -> Column:
        colon = F.instr(line, ":")
        return F.struct(_bare(F.substring(line, F.lit(1), colon - 1)).alias("key"), i.alias("i"), F.substring(line, colon + 1, F.length(line)).alias("value"))

    def last_of_each(ordered: Column) -> Column:
        # Equal keys are neighbours, in the order of their lines.
        return F.filter(ordered, lambda p, i: F.coalesce(F.get(ordered, i + 1)["key"] != p["key"], F.lit(True)))

    def object_of(pairs: Column) -> Column:
        complete = F.lit(True)
        for key in required:
            complete = complete & F.exists(pairs, lambda p: p["key"] == key)
        in_lines = F.array_sort(F.transform(pairs, lambda p: F.struct(p["i"].alias("i"), p["key"].alias("key"), p["value"].alias("value"))))
        body = F.array_join(F.transform(in_lines, lambda p: F.concat(_as_string(p["key"]), F.lit(":"), _line_value(p["value"]))), ",")
        return F.when(complete, F.concat(F.lit("{"), body, F.lit("}")))

    lines = F.filter(F.split(text, "\n"), lambda line: F.contains(line, F.lit(":")))
    return _bind(F.array_sort(F.transform(lines, pair)), lambda ordered: _bind(last_of_each(ordered), object_of))


def tolerant_json(text: Column, required: Sequence[str] = JSON_REQUIRED_KEYS) -> Column:
    """JSON text read from nearly-JSON text, or null: as it is, with keys quoted, closed by a brace,
    closed by a quote and a brace, and at last line by line."""
    plain = strip_control(F.replace(text, F.lit("None"), F.lit("null")))
    plain = F.replace(F.rtrim(plain, F.lit(",")), F.lit(",}"), F.lit("}"))
    return _bind(plain, lambda p: F.coalesce(strict_json(p), _bind(quote_keys(p), lambda quoted: F.coalesce(
        strict_json(quoted),
        strict_json(F.concat(quoted, F.lit("}"))),
        strict_json(F.concat(quoted, F.lit('"}'))),
        by_lines(quoted, required),
    ))))
