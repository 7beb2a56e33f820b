"""Article text from pages, and replacing article bodies with it."""

import time

import pytest
from pyspark.sql import functions as F

from builders import plan_of
from gazette.functions.html import cap_bytes, extract_text
from gazette.sources.pages import body_fetchable, page_bodies, replace_body

P1, P2, P3 = ("First paragraph of the story.", "Second one with more.", "And the third paragraph.")


@pytest.mark.parametrize("page,text", [
    (f"<html><body><nav><p>Menu</p></nav><article><p>{P1}</p><p>{P2}</p><p>{P3}</p></article>"
     "<footer><p>Imprint</p></footer></body></html>", f"{P1}\n\n{P2}\n\n{P3}"),
    (f"<html><body><p>{P1}</p><p>{P2} {P3}</p></body></html>", f"{P1}\n\n{P2} {P3}"),
    ("<html><body><p>Hi</p></body></html>", None),
    ("", None),
    (None, None),
    (f"<body><p>skip this</p><main><p>{P1} {P2}</p></main></body>", f"{P1} {P2}"),
    (f"<body><p>skip</p><div role='main'><p>{P1} {P2}</p></div></body>", f"{P1} {P2}"),
    (f"<title>t</title><p>{P1} {P2}</p><div data-role='main'><p>{P3}</p></div>",
     f"{P1} {P2}\n\n{P3}"),
    (f"<title>a</title>{P1}<br>{P2}", f"{P1}\n{P2}"),
    (f"<body><main><p>no</p></main><article><p>{P1} {P2}</p></article></body>", f"{P1} {P2}"),
    (f"<body><header><article><p>no</p></article></header><p>{P1} {P2}</p></body>", f"{P1} {P2}"),
    (f"<article><div>{P1}</div> <div> {P2}<br>{P3}</div></article>", f"{P1}\n{P2}\n{P3}"),
    (f"<article><p>{P1} <b>bold</b> and <i> more </i></p><p>{P2}</p></article>",
     f"{P1}boldandmore\n\n{P2}"),
    (f"<article><p>{P1}<p>{P2}<p>{P3}</article>", f"{P1}\n\n{P2}\n\n{P3}"),
    (f"<article><p><b>{P1}<p>{P2}</p>{P3}</article>", f"{P1}\n\n{P2}"),
    (f"<article><p>{P1} <script>var a = '<p>x</p>';</script> {P2} x</p></article>", f"{P1}{P2} x"),
    (f"<article><p>{P1} &amp; {P2} &lt;3 &eacute;</p></article>", f"{P1} & {P2} <3 é"),
    (f"<article><!-- <p>no</p> --><p>{P1} {P2}</p></article>", f"{P1} {P2}"),
    (f"<article><figure><p>no</p></figure><form><p>no</p></form><p>{P1} {P2}</p></article>",
     f"{P1} {P2}"),
    ("<head><title>A title that is long enough to be taken for an article text</title></head>",
     None),
    ("<article><p>" + "x" * 50 + "</p></article>", None),
    ("<article><p>" + "x" * 51 + "</p></article>", "x" * 51),
    ("<article><p>" + " " * 60 + "</p></article>", None),
    (f"<ARTICLE class=\"a>b\"><P title='<p>'>{P1} {P2}</P></ARTICLE>", f"{P1} {P2}"),
])
def test_extract_text(page, text):
    assert extract_text(page) == text


def test_only_fetchable_addresses(spark):
    rows = spark.createDataFrame(
        [
            ("https://a.b/c", "text/html; charset=utf-8"),
            ("https://a.b/c", "application/pdf"),
            ("https://a.b/c", None),
            ("", "text/html"),
            (None, "text/html"),
            ("https://news.ycombinator.com/item?id=1", "text/html"),
        ],
        "url string, type string",
    )
    flags = rows.select(
        body_fetchable("url", "type").alias("a"), body_fetchable("url").alias("b")
    ).collect()
    assert [r.a for r in flags] == [True, False, False, False, False, False]
    assert [r.b for r in flags] == [True, True, True, False, False, False]


def test_pages_are_cut_by_bytes(spark):
    rows = spark.createDataFrame([("abc",), ("éé",), ("aé",)], "x string")
    # A cut inside a character gives no text rather than broken text.
    assert [r.y for r in rows.select(cap_bytes("x", 2).alias("y")).collect()] == ["ab", "é", None]


def test_bodies_replace_one_to_one(spark):
    text = f"{P1} {P2}"
    pages = spark.createDataFrame(
        [
            (1, "u/1", f"<article><p>{text}</p></article>"),
            (2, "u/1", f"<article><p>{text} later copy</p></article>"),
            (3, "u/2", "<p>too short</p>"),
        ],
        "page_id long, url string, html string",
    )
    articles = spark.createDataFrame(
        [(i, f"a/{i}", f"u/{i % 4}" if i < 8 else None, "old") for i in range(9)],
        "seq long, article_id string, source_url string, body string",
    )
    bodies = page_bodies(pages)
    assert "ArrowEvalPython" in plan_of(bodies) and "BatchEvalPython" not in plan_of(bodies)
    done = replace_body(articles, bodies, rows_per_slice=2).orderBy("seq").collect()
    assert [r.body for r in done] == [text if r.source_url == "u/1" else "old" for r in done]
    assert len(done) == 9 and "extracted" not in done[0]


def test_unused_pages_are_not_parsed(spark):
    pages = spark.createDataFrame([(1, "u", "<p>x</p>")], "page_id long, url string, html string")
    assert "ArrowEvalPython" not in plan_of(page_bodies(pages).select(F.col("url")))


@pytest.mark.parametrize(
    "page",
    ["<a " * 350_000, "<script " * 130_000, "<script>" * 130_000, "<a \"" * 250_000 + ">",
     "<a " * 350_000 + "' >", "<div>" * 200_000, "<div>" * 100_000 + "</p>" * 100_000, "<!--" * 250_000,
     "<" * 1_000_000],
    ids=lambda p: p[:12],
)
def test_broken_pages_take_linear_time(page):
    began = time.process_time()
    extract_text(page)
    assert time.process_time() - began < 5


def test_mail_dates(spark):
    from gazette.functions.text import parse_time

    dates = {
        "Tue, 05 Mar 2024 10:30:00 GMT": "2024-03-05 10:30:00",
        "Tue, 5 Mar 24 10:30 EST": "2024-03-05 15:30:00",
        "05 Mar 2024 10:30:00 +0200": "2024-03-05 08:30:00",
        "Tuesday, 05 March 2024 10:30:00 -07:00": "2024-03-05 17:30:00",
        "2024-03-05T10:30:00Z": "2024-03-05 10:30:00",
        "Tue, 35 Mar 2024 10:30:00 GMT": None,
        "yesterday": None,
    }
    rows = spark.createDataFrame([(d,) for d in dates], "d string")
    found = rows.select("d", parse_time("d").cast("string").alias("t")).collect()
    assert {r.d: r.t for r in found} == dates
