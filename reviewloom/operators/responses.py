"""Tolerant parsing of model answers, as expressions on arrays of answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.text import python_float, strip, stripped_lines

# The tags of the answer format and the defaults.
SENTIMENT, CONFIDENCE, KEY_POINTS, SUMMARY = (
    "SENTIMENT:",
    "CONFIDENCE:",
    "KEY_POINTS:",
    "SUMMARY:",
)
NO_SENTIMENT = "Unknown"
KEY_POINT_SEPARATOR = " | "


def _last_value(lines: Column, tag: str) -> Column:
    """What the last line with this tag says, null where no line has it."""
    tagged = F.filter(lines, lambda line: F.startswith(line, F.lit(tag)))
    last = F.try_element_at(tagged, F.lit(-1))
    return strip(F.replace(last, F.lit(tag), F.lit("")))


def _key_points(lines: Column) -> Column:
    """Dashed lines of every key point block, without their dashes.

    A block runs from its tag to the next line with another tag; lines that are
    neither end it nor count.
    """
    start = F.struct(
        F.array().cast("array<string>").alias("points"), F.lit(False).alias("inside")
    )

    def read(state: Column, line: Column) -> Column:
        opens = F.startswith(line, F.lit(KEY_POINTS))
        closes = (
            F.startswith(line, F.lit(SENTIMENT))
            | F.startswith(line, F.lit(CONFIDENCE))
            | F.startswith(line, F.lit(SUMMARY))
        )
        point = state["inside"] & F.startswith(line, F.lit("-"))
        text = strip(F.ltrim(line, F.lit("- ")))
        return F.struct(
            F.when(point, F.concat(state["points"], F.array(text)))
            .otherwise(state["points"])
            .alias("points"),
            (opens | (state["inside"] & ~closes)).alias("inside"),
        )

    return F.aggregate(lines, start, read, lambda state: state["points"])


def parse_answers(raws: Column) -> Column:
    """An array of answers to an array of structs with the parsed fields.

    Two passes: the first binds the lines of an answer, so that the four readers
    of the second share them.
    """
    split = F.transform(
        raws, lambda raw: F.struct(raw.alias("raw"), stripped_lines(raw).alias("lines"))
    )

    def fields(answer: Column) -> Column:
        lines = answer["lines"]
        points = _key_points(lines)
        return F.struct(
            F.coalesce(_last_value(lines, SENTIMENT), F.lit(NO_SENTIMENT)).alias("sentiment"),
            python_float(_last_value(lines, CONFIDENCE)).alias("confidence"),
            points.alias("key_points"),
            F.coalesce(_last_value(lines, SUMMARY), F.lit("")).alias("llm_summary"),
            answer["raw"].alias("raw_response"),
        )

    return F.transform(split, fields)


def parse_responses(responses: DataFrame, raw: str = "raw_response") -> DataFrame:
    """Adds sentiment, confidence, key_points, llm_summary and key_points_str."""
    parsed = responses.withColumn("_parsed", parse_answers(F.array(F.col(raw)))[0])
    return parsed.select(
        "*",
        "_parsed.sentiment",
        "_parsed.confidence",
        "_parsed.key_points",
        "_parsed.llm_summary",
        F.array_join("_parsed.key_points", KEY_POINT_SEPARATOR).alias("key_points_str"),
    ).drop("_parsed")
