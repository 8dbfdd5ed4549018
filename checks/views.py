"""Inputs that exercise every operator, derived from the given tables by Spark.

SQL that reads the same in both engines is written once, with the tables as
placeholders; it is used here and by the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.sources.tables import read_table

REVIEWS_SQL = """
select d.doc_id as review_key,
       substr(md5(concat(d.source, d.lang, cast(d.doc_id as string))),1,8) as review_id,
       d.source as product_title,
       case when d.doc_id % 7 = 0 then null
            else concat('user', cast(d.doc_id % 50 as string)) end as author,
       case when l.doc_id is null then null when d.doc_id % 11 = 0 then 0
            else 1 + 3*l.quality + cast(d.doc_id % 2 as int) end as rating,
       concat('2024-0', cast(1 + d.doc_id % 9 as string), '-1', cast(d.doc_id % 10 as string))
         as date,
       d.text as review_text,
       concat('https://', d.source, '.example.com/') as source_url
from {documents} d left join {labels} l on d.doc_id = l.doc_id
"""

PRODUCT_PAGES_SQL = """
select p_partkey, concat('https://shop.example.com/', cast(p_partkey as string)) as url, concat(
 '<html><head><title>t</title></head><body><h1> ', p_name, ' &amp; Co </h1>',
 case p_size % 7 when 0 then ''
   when 1 then '<p class="star-rating One"></p>'   when 2 then '<p class="star-rating Two"></p>'
   when 3 then '<p class="star-rating Three"></p>' when 4 then '<p class="star-rating Four"></p>'
   when 5 then '<p class="star-rating Five"></p>'  else '<p class="star-rating Zero"></p>' end,
 '<p class="price_color">\u00A3', cast(p_retailprice as string), '</p>',
 case when p_partkey % 4 = 0 then ''
   else '<p class="instock availability"><i></i> In stock </p>' end,
 case when p_partkey % 6 = 0 then ''
   else concat('<div id="product_description"><h2>D</h2></div><p>A ', p_type,
               ' thing by ', p_brand, '.</p>') end,
 '<table class="table table-striped"><tr><th>UPC</th><td>', cast(p_partkey as string),
 '</td></tr><tr><th>Price (excl. tax)</th><td>\u00A3', cast(p_retailprice as string),
 '</td></tr>',
 case when p_partkey % 5 = 0 then '<tr><th>Availability</th><td>Sold out</td></tr>' else '' end,
 '<tr><th>orphan</th></tr></table></body></html>') as html
from {part}
"""

# What is put on both sides of a text, by document number modulo 12.
DIRT = (
    "hey\u2003! you\u3000. \n ; end",
    "a\u2019b \u2018c\u2019",
    "\u201Cq\u201D",
    "x\u2013y\u2014z",
    "wait\u2026",
    "a\u00A0b",
    "a\u200Bb",
    "e\u0301te\u0301",
    "ok \U0001f600 done\u0007\u000b\u0085",
    "<br/>a <b>bold</b> 1 < 2 > 0",
    "a \t  b",
    "a\n\n\n\n\nb",
)


# Positions of added blank chunks.
BLANKS_FROM = 1_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/documents.parquet", "doc_id")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/pages.parquet", "page_id")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """long reviews, with ratings that are missing or 0."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return spark.sql(REVIEWS_SQL, documents=documents(spark, sf_dir), labels=labels)


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """texts with the dirt that cleaning treats."""
    piece = F.get(F.array(*[F.lit(dirt) for dirt in DIRT]), F.col("doc_id") % len(DIRT))
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("review_key"),
        F.concat_ws(" ", piece, "text", piece).alias("review_text"),
    )


def product_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """product pages rendered from parts."""
    part = read_table(spark, f"{sf_dir}/part.parquet", "p_partkey")
    return spark.sql(PRODUCT_PAGES_SQL, part=part)


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 before the answer: every turn as a chunk with its position, and blank ones added."""
    talks = read_table(spark, f"{sf_dir}/conversations.parquet", "conv_id", "turn")
    texts = talks.select(
        F.col("conv_id").alias("review_key"),
        F.col("turn").cast("int").alias("chunk_idx"),
        F.col("text").alias("chunk"),
    )
    blanks = texts.where(F.col("chunk_idx") % 5 == 3)
    return texts.union(
        blanks.select("review_key", F.col("chunk_idx") + BLANKS_FROM, F.lit(" \u2003"))
    )


def byte_at(position: int):
    return F.conv(F.substring(F.col("digest"), position, 2), 16, 10).cast("int")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """well and badly formed answers, by the digest of the chunk."""
    lab = F.concat(
        F.lit("SENTIMENT: "),
        F.get(
            F.array(*[F.lit(x) for x in ("Positive", "Negative", "Neutral", "Mixed")]),
            byte_at(1) % 4,
        ),
    )
    ci = byte_at(3) % 101
    cf = F.concat(
        F.lit("CONFIDENCE: "),
        F.when(ci == 100, "1.00").otherwise(
            F.concat(F.lit("0."), F.lpad(ci.cast("string"), 2, "0"))
        ),
    )
    total = F.concat(F.lit("SUMMARY: s "), F.substring("digest", 1, 8))
    kp = F.lit("KEY_POINTS:")

    def point(mark: str, index: int):
        word = F.coalesce(F.get(F.split("chunk", " "), F.lit(index)), F.lit(""))
        return F.concat(F.lit(mark), word)

    def joined(*lines, by="\n"):
        return F.concat_ws(by, *lines)

    well_formed = joined(lab, cf, kp, point("- ", 0), point("- ", 1), point("- ", 2), total)
    v = byte_at(5) % 12
    raw = (
        F.when(v == 0, F.lit(None).cast("string"))
        .when(v == 1, F.lit(""))
        .when(
            v == 2,
            joined(
                F.replace(lab, F.lit("SENTIMENT"), F.lit("sentiment")),
                F.replace(cf, F.lit("CONFIDENCE"), F.lit("confidence")),
            ),
        )
        .when(v == 3, joined(lab, F.concat(F.lit("CONFIDENCE: "), ci, F.lit("%")), total))
        .when(v == 4, joined(cf, kp, point("- ", 0), total))
        .when(
            v == 5,
            joined(lab, cf, F.lit("KEY_POINTS: - lost"), point("* ", 0), F.lit("SUMMARY:")),
        )
        .when(
            v == 6,
            joined(
                lab, kp, point("- ", 0), cf, point("- ", 1), kp, F.lit("note"), point("-- ", 2),
                total,
            ),
        )
        .when(v == 7, joined(F.concat(F.lit("SENTIMENT: "), lab), cf, F.lit("CONFIDENCE: n/a")))
        .when(
            v == 8,
            joined(
                F.concat(F.lit("  "), lab), F.lit(""), cf, kp, point("- ", 0), total, F.lit(""),
                by="\r\n",
            ),
        )
        .otherwise(well_formed)
    )
    digested = turns(spark, sf_dir).withColumn("digest", F.md5("chunk"))
    return digested.withColumn("raw_response", raw).drop("digest")
