"""One JSON document per product, whatever its number of reviews.

All documents have one layout: ``<path>/pieces`` holds rows of an address, a
section, a review key and a text. Section 0 is the document up to its list of
reviews, 1 a review, 2 the end; in this order, with commas between the reviews, the
texts are the document. ``<path>/index`` lists all products with their totals.
Nothing is gathered per product, at any size.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewloom.functions.times import iso, moment
from reviewloom.sources.tables import STORED_AS

PART_BYTES = 128 * 2**20
PIECE_ORDER = ("source_url", "section", "review_key")
# Size of a review's JSON text, where the table has it from the run that stored it.
STORED_BYTES = "json_bytes"
NOT_WRITTEN = ("chunks", "review_key", STORED_BYTES)
PAGE_COLUMNS = ("product_title", "overall_rating", "price", "availability", "description")
RUN_COLUMNS = ("scraped_url", "scraped_at")


def _json(*columns: str | Column) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def _address(column: str) -> Column:
    """Reviews and pages without an address share the empty one."""
    return F.coalesce(column, F.lit("")).alias("source_url")


def _members(json_object: Column) -> Column:
    """A JSON object without its braces."""
    return F.substring(json_object, F.lit(2), F.length(json_object) - 2)


def metadata_json(products: DataFrame) -> DataFrame:
    """Metadata object per address: page fields, then spec rows, then the run."""
    page = _members(_json(*PAGE_COLUMNS))
    extra = F.map_filter(
        F.coalesce("specs", F.expr("cast(map() as map<string,string>)")),
        lambda name, _: ~name.isin(*PAGE_COLUMNS, *RUN_COLUMNS),
    )
    specs = F.when(F.size(extra) > 0, _members(F.to_json(extra)))
    run = _members(_json("scraped_url", iso(F.col("scraped_at")).alias("scraped_at")))
    listed = products.select(
        _address("scraped_url"),
        F.concat(F.lit("{"), F.concat_ws(",", page, specs, run), F.lit("}")).alias("metadata"),
    )
    # One object per address, also where a page is listed twice: by rule the first in
    # the order of their texts.
    return listed.groupBy("source_url").agg(F.min("metadata").alias("metadata"))


def review_json(enriched: DataFrame) -> Column:
    return _json(*[name for name in enriched.columns if name not in NOT_WRITTEN])


def with_json_bytes(enriched: DataFrame) -> DataFrame:
    """Adds the size of each review's JSON text; stored with the reviews, it saves
    ``write_documents`` one reading of all texts."""
    return enriched.withColumn(STORED_BYTES, F.octet_length(review_json(enriched)))


def _opening(generated_at: datetime) -> Column:
    time = iso(moment(generated_at))
    return F.concat(
        F.lit('{"product_metadata":'),
        F.coalesce("metadata", F.lit("{}")),
        F.lit(',"total_reviews":'),
        F.col("total_reviews").cast("string"),
        F.lit(',"generated_at":"'),
        time,
        F.lit('","reviews":['),
    )


def write_documents(
    enriched: DataFrame,
    products: DataFrame,
    path: str,
    generated_at: datetime,
    overwrite: bool = False,
) -> str:
    """Write all documents, the pieces last. Reads ``enriched`` more than once: pass a stored table,
    with a review_key that is unique within its product."""
    spark, mode = enriched.sparkSession, "overwrite" if overwrite else "errorifexists"
    sized = enriched if STORED_BYTES in enriched.columns else with_json_bytes(enriched)
    totals = sized.groupBy(_address("source_url")).agg(
        F.count("*").alias("total_reviews"), F.sum(F.col(STORED_BYTES) + 1).alias("bytes")
    )
    totals.join(metadata_json(products), "source_url", "left").write.mode(mode).parquet(
        f"{path}/index"
    )
    index = spark.read.parquet(f"{path}/index")
    all_bytes = index.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]

    no_key = F.lit(None).cast(enriched.schema["review_key"].dataType).alias("review_key")

    def edge(section: int, text: Column) -> DataFrame:
        return index.select(
            "source_url", F.lit(section).alias("section"), no_key, text.alias("value")
        )

    bodies = enriched.select(
        _address("source_url"),
        F.lit(1).alias("section"),
        "review_key",
        review_json(enriched).alias("value"),
    )
    pieces = edge(0, _opening(generated_at)).union(bodies).union(edge(2, F.lit("]}")))
    # The range covers the review key, so a product is spread over many tasks.
    tasks = all_bytes // PART_BYTES + 1
    ordered = pieces.repartitionByRange(tasks, *PIECE_ORDER).sortWithinPartitions(*PIECE_ORDER)
    ordered.write.mode(mode).options(**STORED_AS).parquet(f"{path}/pieces")
    return path


def misplaced_pieces(spark: SparkSession, path: str) -> DataFrame:
    """source_url and how many of its pieces stand before one that belongs before them.

    A piece is compared with the one before it in its file, and the first of a file with
    the last of the file before it; a file is a bounded part of the order.
    """
    rows = spark.read.parquet(f"{path}/pieces").select(
        F.struct(*PIECE_ORDER).alias("place"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )
    in_file = Window.partitionBy("file").orderBy("row")
    inside = rows.select("place", F.lag("place").over(in_file).alias("before"))
    edges = rows.groupBy("file").agg(
        F.min_by("place", "row").alias("place"), F.max_by("place", "row").alias("last")
    )
    # A row per file. File names ascend as the ranges do.
    between = edges.select("place", F.lag("last").over(Window.orderBy("file")).alias("before"))
    wrong = inside.union(between).where(F.col("before") > F.col("place"))
    return wrong.groupBy("place.source_url").agg(F.count("*").alias("misplaced"))


def read_openings(spark: SparkSession, path: str) -> DataFrame:
    """source_url and the fields that stand before the reviews, for every document."""
    schema = "product_metadata map<string,string>, total_reviews bigint, generated_at string"
    opening = F.from_json(F.concat("value", F.lit("]}")), schema)
    pieces = spark.read.parquet(f"{path}/pieces").where("section = 0")
    return pieces.select("source_url", opening.alias("opening")).select("source_url", "opening.*")


def read_reviews(spark: SparkSession, path: str, fields: str) -> DataFrame:
    """source_url, review_key and review (its fields as a DDL string) of every document."""
    pieces = spark.read.parquet(f"{path}/pieces").where("section = 1")
    return pieces.select("source_url", "review_key", F.from_json("value", fields).alias("review"))
