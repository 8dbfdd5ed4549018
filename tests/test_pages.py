import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from reviewloom.operators.generate import TEMPLATES, generate_reviews
from reviewloom.operators.page_parser import FIELDS, read_page
from reviewloom.operators.pages import (
    page_fields,
    page_titles,
    possible_fields,
    product_metadata,
    spec_map,
)
from reviewloom.sources.tables import fetched

WHEN = datetime(2024, 5, 20, 14, 32, 1)
PAGE = """<!DOCTYPE html>
<html><head><title>no</title><script>var h = "<h1>no</h1>";</script></head>
<body><!-- <h1>no</h1> -->
<div class="product_main"><h1>A &lt;Light&gt; &amp; <i>Attic</i></h1>
<p class="price_color">\u00A351.77</p>
<p class="instock availability">
    <i class="icon-ok"></i>

        In stock (22 available)

</p>
<p class="star-rating Three"><i></i></p></div>
<div id="product_description" class="sub-header"><h2>Description</h2></div>
<p>It's hard to imagine.
Second line</p><p>other</p>
<table class="table table-striped">
<tr><th>UPC</th><td>a897</td></tr>
<tr><th>Price (excl. tax)</th><td>\u00A351.77</td></tr>
<tr><th>Availability</th><td> In stock (22) </td></tr>
<tr><th>orphan</th></tr><tr><td>also</td></tr>
<tr><th>UPC</th><td>later</td></tr>
</table>
<table class="table-striped"><tr><th>second</th><td>table</td></tr></table>
<h1>second</h1><p class="price_color">\u00A31</p></body></html>"""


def test_whole_page():
    assert read_page(PAGE) == {
        "title": "A <Light> & Attic",
        "star": "Three",
        "price": "\u00A351.77",
        "availability": "In stock (22 available)",
        "description": "It's hard to imagine.\nSecond line",
        "specs": [
            ("UPC", "a897"),
            ("Price (excl. tax)", "\u00A351.77"),
            ("Availability", "In stock (22)"),
            ("UPC", "later"),
        ],
    }


@pytest.mark.parametrize(
    "html, field, value",
    [
        ("<h1> x </h1><h1>y</h1>", "title", "x"),
        ("<h1></h1><h1>y</h1>", "title", ""),
        ("<h1>never closed", "title", "never closed"),
        ("<p>no heading</p>", "title", None),
        ("<p class='star-rating'>", "star", ""),
        ("<p class='big star-rating Five'>", "star", "star-rating"),
        ("<div class='star-rating Five'>", "star", None),
        ("<p class='star-rating  One'>", "star", "One"),
        ("<p class=price_color>1<p>2", "price", "1"),
        ("<p class='availability instock'>x</p>", "availability", None),
        ("<p class='instock availability now'>x</p>", "availability", None),
        ("<p class='instock\n availability'>x</p>", "availability", "x"),
        ("<div id=product_description></div><h2>t</h2><p>d</p>", "description", "d"),
        ("<div><div id=product_description></div></div><p>d</p>", "description", None),
        ("<div id=product_description><p>inside</p></div>", "description", None),
        ("<div id=product_description></div><div><p>in</p></div><p>d</p>", "description", "d"),
        ("<div id=product_description></div>", "description", None),
        ("<table class='x table-striped'><tr><th>A b<td>1<tr><th>C<td>2</table>", "specs",
         [("A b", "1"), ("C", "2")]),
        ("<table class=x><tr><th>A<td>1</table>", "specs", []),
        ("<table class=table-striped><tbody><tr><td>1</td><th>K</th></tr></tbody></table>",
         "specs", [("K", "1")]),
        ("<table class=table-striped><tr><th>A</th><th>B</th><td>1</td><td>2</td></tr></table>",
         "specs",
         [("A", "1")]),
        ("", "title", None),
        ("<H1 id=x>big</H1>", "title", "big"),
        ("<p class='star&#45;rating Two'>", "star", "Two"),
        ("<p CLASS = price&#95;color>9</p>", "price", "9"),
        ("<p title='a&b' class=price_color>9</p>", "price", "9"),
        ("</p></div></i>" * 3 + "<div><b>" * 2000 + "</em></p>" * 2000 + "<h1>deep</h1>", "title",
         "deep"),
    ],
)
def test_single_fields(html, field, value):
    assert read_page(html)[field] == value
    # Stopping early changes nothing.
    assert read_page(html, (field,))[field] == value


def test_only_pages_that_can_have_a_field_are_read(spark):
    htmls = [
        None, "", "<p>h1 star rating</p>", "<H1>x", "<p class='star&#45;rating Two'>",
        "<p\u2003ID\x1c=\u2003 price&#95;color>", "<a href='x?a&b' class=c>", PAGE,
    ]
    rows = page_rows(spark, *htmls).select("url", possible_fields(F.col("html")).alias("names"))
    names = [row.names for row in rows.orderBy("url").collect()]
    every = list(FIELDS)
    assert names == [[], [], [], ["title"], every, every, [], every]
    read = page_rows(spark, *htmls).select("url", page_fields(F.col("html")).alias("page"))
    assert [row.page is None for row in read.orderBy("url").collect()] == [not x for x in names]


def test_spec_names(apply):
    """Against a dictionary: the last row of a name wins."""
    rng = random.Random(3)
    names = ["", "UPC", "upc", "Price (excl. tax)", "price_(EXCL. TAX)", "\u00C9T\u00C9", "\u039F\u03A3 x"]
    tables = [[(rng.choice(names), str(i)) for i in range(rng.randint(0, 9))] for _ in range(50)]
    tables += [[(f"N {i % 20000}", str(i)) for i in range(40000)], None]
    found = apply(spec_map, tables, "array<struct<name:string,value:string>>")
    for rows, specs in zip(tables, found):
        assert specs == {name.lower().replace(" ", "_"): value for name, value in rows or []}


def page_rows(spark, *htmls):
    return spark.createDataFrame(
        [(f"http://x/{i}", html) for i, html in enumerate(htmls)], "url string, html string"
    )


def test_defaults(spark):
    row = product_metadata(page_rows(spark, "<p>bare</p>"), WHEN).first().asDict()
    assert row == {
        "product_title": "Unknown",
        "overall_rating": None,
        "price": "N/A",
        "availability": "N/A",
        "description": "N/A",
        "specs": {},
        "scraped_url": "http://x/0",
        "scraped_at": WHEN,
    }


def test_spec_rows_win_over_fields_but_not_over_the_run(spark):
    rows = "".join(
        f"<tr><th>{key}</th><td>{value}</td></tr>"
        for key, value in [
            ("Product title", "T"), ("Price", "7"), ("Description", ""), ("Scraped url", "no"),
        ]
    )
    html = f"<h1>h</h1><p class='star-rating Nine'><table class=table-striped>{rows}</table>"
    row = product_metadata(page_rows(spark, html), WHEN).first()
    assert (row.product_title, row.price, row.description) == ("T", "7", "")
    assert (row.overall_rating, row.scraped_url) == (0, "http://x/0")


def test_titles_and_missing_pages(spark):
    rows = page_rows(spark, PAGE, None, "<p>")
    assert [r.product_title for r in page_titles(fetched(rows)).orderBy("url").collect()] == [
        "A <Light> & Attic",
        "Unknown",
    ]
    assert fetched(rows, "http://x/2").count() == 1


@pytest.mark.parametrize(
    "overall, ratings",
    [
        (None, [None] * 7),
        (0, [0, 1, 5, 1, 0, 5, 2]),
        (1, [1, 1, 5, 1, 1, 5, 2]),
        (3, [3, 2, 5, 1, 3, 5, 2]),
        (5, [5, 4, 5, 3, 5, 5, 4]),
    ],
)
def test_generated_ratings(spark, overall, ratings):
    products = spark.createDataFrame(
        [("T", overall, "d", "u")],
        "product_title string, overall_rating int, description string, scraped_url string",
    )
    rows = generate_reviews(products).orderBy("review_key").collect()
    assert [r.rating for r in rows] == ratings


def test_generated_reviews(spark):
    description = "".join(chr(0x4E00 + i) for i in range(200))
    products = spark.createDataFrame(
        [("T", 3, description, "u1"), ("S", 3, "short", "u2")],
        "product_title string, overall_rating int, description string, scraped_url string",
    )
    rows = generate_reviews(products).orderBy("review_key").collect()
    first, second = rows[:7], rows[7:]
    assert [r.author for r in first] == [t["author"] for t in TEMPLATES]
    assert first[0].review_text.startswith(f"I absolutely loved 'T'. {description[:120]}... The")
    assert f"expectations. {description[50:160]}... The author" in first[2].review_text
    assert "expectations. ... The author" in second[2].review_text
    # The short id does not name the product, the key does.
    assert [r.review_id for r in first] == [r.review_id for r in second]
    assert len({r.review_key for r in rows}) == 14
    assert {r.source_url for r in first} == {"u1"}
