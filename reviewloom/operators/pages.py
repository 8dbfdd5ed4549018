"""Product metadata from a table of pages with the columns url and html."""

from __future__ import annotations

from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.times import moment
from reviewloom.operators.page_parser import FIELDS, read_page
from reviewloom.schemas import PAGE_FIELDS

# Words of the star rating and what stands for a missing field.
STARS = {"One": 1, "Two": 2, "Three": 3, "Four": 4, "Five": 5}
NO_TITLE = "Unknown"
MISSING = "N/A"


# What a page must hold, letter for letter, to have a field at all; unless it
# writes its class or id with character references.
MARKS = {
    "title": "(?i)<h1",
    "star": "star-rating",
    "price": "price_color",
    "availability": "instock",
    "description": "product_description",
    "specs": "table-striped",
}
# White space as Python's patterns and the reader know it.
SPACE = r"\s\x1c-\x1f"
ENCODED_NAME = (
    rf"""(?iU)(?:class|id)[{SPACE}]*=[{SPACE}]*(?:"[^"&]*&|'[^'&]*&|[^{SPACE}"'>&]*&)"""
)


def possible_fields(html: Column, wanted=FIELDS) -> Column:
    """Names of the wanted fields that a page can have, by what stands in its text."""
    marked = [F.when(html.rlike(MARKS[name]), F.lit(name)) for name in wanted]
    return F.when(html.rlike(ENCODED_NAME), F.array(*[F.lit(name) for name in wanted])).otherwise(
        F.array_compact(F.array(*marked))
    )


def page_fields(html: Column, wanted=FIELDS) -> Column:
    """Struct with the wanted page fields; null for a page that can have none of them.

    Only pages that can have a field travel to Python, and only what they can have is
    waited for: a page without product marks is left after its title.
    """
    pair = pa.struct([("name", pa.string()), ("value", pa.string())])
    fields_type = pa.struct(
        [
            ("title", pa.string()),
            ("star", pa.string()),
            ("price", pa.string()),
            ("availability", pa.string()),
            ("description", pa.string()),
            ("specs", pa.list_(pair)),
        ]
    )

    @F.arrow_udf(PAGE_FIELDS)
    def read(pages: pa.Array, possible: pa.Array) -> pa.Array:
        found = []
        for page, names in zip(pages, possible):
            fields = read_page(page.as_py(), names.as_py()) if page.is_valid else None
            if fields:
                fields["specs"] = [{"name": name, "value": value} for name, value in fields["specs"]]
            found.append(fields)
        return pa.array(found, fields_type)

    possible = possible_fields(html, wanted)
    return read(F.when(F.size(possible) > 0, html), possible)


def spec_map(rows: Column) -> Column:
    """Map of the rows of a specification table by normalised name; of rows of one name
    the last counts."""
    named = F.transform(
        F.coalesce(rows, F.array()),
        lambda row, i: F.struct(
            F.replace(F.lower(row["name"]), F.lit(" "), F.lit("_")).alias("key"),
            (-i).alias("back"),
            row["value"].alias("value"),
        ),
    )

    def last_ones(ordered: Column) -> Column:
        return F.filter(
            ordered, lambda x, i: (i == 0) | (F.get(ordered, i - 1)["key"] != x["key"])
        )

    # Bound as the one element of an array, so that rows are sorted once, not for each.
    kept = F.transform(F.array(F.sort_array(named)), last_ones)[0]
    in_order = F.sort_array(
        F.transform(kept, lambda x: F.struct((-x["back"]).alias("at"), x["key"], x["value"]))
    )
    return F.map_from_entries(F.transform(in_order, lambda x: F.struct(x["key"], x["value"])))


def page_titles(pages: DataFrame) -> DataFrame:
    """Title of every page."""
    titles = pages.withColumn("_fields", page_fields(F.col("html"), ("title",)))
    return titles.select(
        "*", F.coalesce(F.col("_fields.title"), F.lit(NO_TITLE)).alias("product_title")
    ).drop("_fields", "html")


def overall_rating(star: Column, spec: Column) -> Column:
    """1 to 5 by the word, 0 for another word, null where there is no rating."""
    words = F.create_map(*[F.lit(part) for pair in STARS.items() for part in pair])
    by_word = F.when(star.isNotNull(), F.coalesce(F.try_element_at(words, star), F.lit(0)))
    return F.when(spec.isNotNull(), spec.try_cast("int")).otherwise(by_word)


def product_metadata(pages: DataFrame, scraped_at: datetime | None = None) -> DataFrame:
    """One row of metadata per page.

    A row of the specification table takes the place of the field of its name;
    the page's own address and the time of the run cannot be replaced.
    """
    read = pages.select("url", page_fields(F.col("html")).alias("page"))
    read = read.withColumn("specs", spec_map(F.col("page.specs")))
    spec = {
        name: F.try_element_at(F.col("specs"), F.lit(name))
        for name in ("product_title", "overall_rating", "price", "availability", "description")
    }

    def field(name: str, source: str, missing: str) -> Column:
        return F.coalesce(spec[name], F.col(source), F.lit(missing)).alias(name)

    return read.select(
        field("product_title", "page.title", NO_TITLE),
        overall_rating(F.col("page.star"), spec["overall_rating"]).alias("overall_rating"),
        field("price", "page.price", MISSING),
        field("availability", "page.availability", MISSING),
        field("description", "page.description", MISSING),
        "specs",
        F.col("url").alias("scraped_url"),
        moment(scraped_at).alias("scraped_at"),
    )
