"""Text helpers that follow Python's string rules inside Catalyst expressions.

The JVM's idea of white space, of a line and of a number differs from Python's;
each difference is settled here, once.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters for which Python's str.isspace() holds.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200A"
    "\u2028\u2029\u202F\u205F\u3000"
)
# The same set as the inside of a Java character class, in patterns that start
# with UNICODE. A class that lists the ranges one by one is ten times slower.
UNICODE = "(?U)"
WS = r"\s\x1c-\x1f"

# Where Python's str.splitlines() breaks.
LINE_BREAK = r"\r\n|[\n\x0b\x0c\r\x1c-\x1e\x85\u2028\u2029]"

# What Python's float() takes, after surrounding white space is gone.
_DIGITS = r"[0-9]++(?:_[0-9]++)*+"
_NUMBER = rf"^[+-]?({_DIGITS}\.?({_DIGITS})?|\.{_DIGITS})([eE][+-]?{_DIGITS})?$"
_INFINITE = r"^(?i)[+-]?inf(inity)?$"
_NAN = r"^(?i)[+-]?nan$"


def stepwise(text: Column, *steps: Callable[[Column], Column]) -> Column:
    """Apply the steps one after the other, each on the value of the one before.

    Plain nesting would copy the whole expression so far wherever a step names
    its input twice; the variable of a transform is a value.
    """
    value = F.array(text)
    for step in steps:
        # In a function of one parameter: with a second one it would get the position.
        value = F.transform(value, lambda current: step(current))
    return value[0]


def strip(text: Column) -> Column:
    """Drop white space at both ends; Spark's plain trim only drops U+0020."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    return strip(text) == ""


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def word_count(text: Column) -> Column:
    """Number of white-space separated words.

    Every word, with the space around it, is turned into one character and the
    characters are counted: one compiled pattern and no array of words.
    """
    word = f"{UNICODE}[{WS}]*+[^{WS}]++[{WS}]*+"
    one_per_word = F.regexp_replace(text, word, "x")
    return F.when(text.rlike(f"{UNICODE}[^{WS}]"), F.length(one_per_word)).otherwise(0)


def stripped_lines(text: Column) -> Column:
    """The non-blank lines of a text, each stripped."""
    lines = F.transform(F.split(text, LINE_BREAK, -1), strip)
    return F.filter(lines, lambda line: line != "")


@lru_cache(maxsize=1)
def _decimal_digits() -> tuple[str, str]:
    """All non-ASCII decimal digits and, in the same order, their ASCII forms."""
    source, target = [], []
    for code in range(0x80, 0x20000):
        value = unicodedata.decimal(chr(code), None)
        if value is not None:
            source.append(chr(code))
            target.append(str(value))
    return "".join(source), "".join(target)


def python_float(text: Column) -> Column:
    """float(text) as a double, null where Python raises ValueError.

    A bare cast would take "0.9d" and "0x1p3" and refuse "1_0".
    """
    source, target = _decimal_digits()

    def ascii_digits(value: Column) -> Column:
        return F.when(is_ascii(value), value).otherwise(F.translate(value, source, target))

    def number(value: Column) -> Column:
        plain = F.replace(value, F.lit("_"), F.lit("")).try_cast("double")
        return (
            F.when(value.rlike(_NUMBER), plain)
            .when(value.rlike(_NAN), F.lit(float("nan")))
            .when(value.rlike(_INFINITE), plain)
        )

    return stepwise(text, ascii_digits, number)
