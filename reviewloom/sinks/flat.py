"""Flat export: projection and CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from reviewloom.schemas import EXPORT_COLUMNS

# Columns that change their name on the way out.
RENAMED = {
    "original_review": "review_text",
    "cleaned_review": "cleaned_text",
    "key_points": "key_points_str",
}
NUMERIC = {"rating": "int", "token_count": "int", "chunk_count": "int", "confidence": "double"}
BYTE_ORDER_MARK = "\uFEFF"


def export_rows(reviews: DataFrame) -> DataFrame:
    """The 14 export columns. What is missing is empty, or null in a number
    column; a missing chunk count is 1."""

    def exported(name: str) -> Column:
        source = RENAMED.get(name, name)
        kind = NUMERIC.get(name, "string")
        value = F.col(source) if source in reviews.columns else F.lit(None).cast(kind)
        if name == "chunk_count":
            value = F.coalesce(value, F.lit(1))
        elif kind == "string":
            value = F.coalesce(value, F.lit(""))
        return value.alias(name)

    return reviews.select(*[exported(name) for name in EXPORT_COLUMNS])


def _texts(table: DataFrame, change) -> DataFrame:
    """The table with every text column changed."""
    return table.select(
        *[
            change(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else f.name
            for f in table.schema
        ]
    )


def one_line(text: Column) -> Column:
    """A text without line ends: they are written as \\n and \\r, a backslash as two."""
    for character, written in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(character), F.lit(written))
    return text


def all_lines(text: Column) -> Column:
    """The text that ``one_line`` wrote. A pair of backslashes is set apart first, as what
    follows it is none of its letters."""
    parts = F.transform(
        F.split(text, r"\\\\", -1),
        lambda part: F.replace(
            F.replace(part, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")
        ),
    )
    return F.when(F.contains(text, F.lit("\\")), F.array_join(parts, "\\")).otherwise(text)


def write_csv(
    export: DataFrame, path: str, overwrite: bool = False, splittable: bool = False
) -> str:
    """CSV with header and doubled quotes; each file opens with a byte order mark.

    The mark is part of the first column's name, hence of the header line. A line end in
    a text stands in quotes, as other readers expect it; such a file is read by one task.
    With ``splittable`` a record is one line (see ``one_line``), and any part of a file
    can be read by itself.
    """
    if splittable:
        export = _texts(export, one_line)
    first, *rest = export.columns
    marked = export.select(F.col(first).alias(BYTE_ORDER_MARK + first), *rest)
    marked.write.csv(
        path,
        header=True,
        escape='"',
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        mode="overwrite" if overwrite else "errorifexists",
    )
    return path


def read_csv(spark: SparkSession, path: str, splittable: bool = False) -> DataFrame:
    """A written export, in the form it was written in; empty text comes back as null."""
    fields = ", ".join(f"{name} {NUMERIC.get(name, 'string')}" for name in EXPORT_COLUMNS)
    table = spark.read.csv(
        path,
        schema=fields,
        header=True,
        enforceSchema=True,
        multiLine=not splittable,
        escape='"',
        # One value may be longer than the parser's own limit.
        maxCharsPerColumn=-1,
    )
    return _texts(table, all_lines) if splittable else table
