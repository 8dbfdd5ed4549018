"""Text cleaning. The order of the steps decides the result."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewloom.functions.parts import parts
from reviewloom.functions.text import UNICODE, WS, stepwise, strip

# Characters and what replaces them, in order.
REPLACEMENTS = (
    ("\u2019", "'"),
    ("\u2018", "'"),
    ("\u201C", '"'),
    ("\u201D", '"'),
    ("\u2013", "-"),
    ("\u2014", "--"),
    ("\u2026", "..."),
    ("\u00A0", " "),
    ("\u200B", ""),
)

# What cleaning drops, which is all but tab, line feed, carriage
# return, U+0020 to U+007E and U+00A0 to U+FFFF. The low ones are listed singly:
# the regex engine looks those up in a table.
_LOW_DROPPED = "".join(
    f"\\x{code:02X}"
    for code in range(0xA0)
    if chr(code) not in "\t\n\r" and not 0x20 <= code <= 0x7E
)
DROPPED_CHARACTERS = _LOW_DROPPED + r"\x{10000}-\x{10FFFF}"

# Characters that composition leaves alone, whatever stands next to them: all up
# to U+02FF, most dashes and quotes, currency signs, Han characters.
ALWAYS_COMPOSED = r"\u0000-\u02FF\u2010-\u2027\u2030-\u205E\u20A0-\u20CF\u4E00-\u9FFF"
# All others. As the negation of the above the class takes more than ten times as long on
# Latin text.
MAYBE_COMPOSED = r"\u0300-\u200F\u2028-\u202F\u205F-\u209F\u20D0-\u4DFF\uA000-\x{10FFFF}"

# Every step first takes a cheap look whether it has anything to do; most texts
# need few of them, and a search for a short string costs far less than a regex.


def _where(needed: Column, step: Column, text: Column) -> Column:
    return F.when(needed, step).otherwise(text)


def compose(text: Column) -> Column:
    """Unicode NFC. Only texts with a character that may change travel to Python, in
    Arrow batches, of which a small part at a time becomes Python texts; all others stay
    where they are.

    The call is deterministic, so that filters on other columns pass it and reach the
    scan. It cannot stand inside a ``stepwise`` step.
    """

    @F.arrow_udf("string")
    def composed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts(batches):
            yield pa.array(
                [None if t is None else unicodedata.normalize("NFC", t) for t in texts.to_pylist()],
                pa.string(),
            )

    needed = text.rlike(f"[{MAYBE_COMPOSED}]")
    return F.coalesce(composed(F.when(needed, text)), text)


def replace_typographic(text: Column) -> Column:
    replaced = text
    for character, plain in REPLACEMENTS:
        replaced = F.replace(replaced, F.lit(character), F.lit(plain))
    return replaced


def fix_encoding(text: Column) -> Column:
    """NFC, then plain forms of typographic characters."""

    def fix(value: Column) -> Column:
        # Latin text has no typographic character but this space.
        return _where(value.rlike(r"[\u00A0\u0300-\x{10FFFF}]"), replace_typographic(value), value)

    return stepwise(compose(F.coalesce(text, F.lit(""))), fix)


def strip_tags(text: Column) -> Column:
    """Each tag becomes one space.

    Only what ends with the last ">" is searched: there every "<" finds its end,
    while in the rest each of them would be followed to the end of the text.
    """

    def strip_all(value: Column) -> Column:
        rest = F.substring_index(value, ">", -1)
        tagged = F.left(value, F.length(value) - F.length(rest))
        return F.concat(F.regexp_replace(tagged, "<[^>]++>", " "), rest)

    return _where(F.contains(text, F.lit("<")), strip_all(text), text)


def drop_control_characters(text: Column) -> Column:
    return F.regexp_replace(text, f"[{DROPPED_CHARACTERS}]+", "")


def collapse_blanks(text: Column) -> Column:
    """Runs of spaces and tabs to one space; single spaces are not touched."""
    return _where(
        F.contains(text, F.lit("  ")) | F.contains(text, F.lit("\t")),
        F.regexp_replace(text, "\t[ \t]*+| [ \t]++", " "),
        text,
    )


def collapse_blank_lines(text: Column) -> Column:
    return _where(
        F.contains(text, F.lit("\n\n\n")), F.regexp_replace(text, "\n{3,}", "\n\n"), text
    )


def tighten_punctuation(text: Column) -> Column:
    """No white space before . , ! ? ; :, tried once per run of white space."""
    return _where(
        text.rlike(f"{UNICODE}[.,!?;:](?<=[{WS}].)"),
        F.regexp_replace(text, f"{UNICODE}(?<![{WS}])[{WS}]++([.,!?;:])", "$1"),
        text,
    )


def clean_text(text: Column) -> Column:
    return stepwise(
        fix_encoding(text),
        strip_tags,
        drop_control_characters,
        collapse_blanks,
        collapse_blank_lines,
        tighten_punctuation,
        strip,
    )
