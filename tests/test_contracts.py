"""Record contracts, expectations and dead letters, one broken field at a time."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from builders import AS_OF, SUMMARY, enriched, frame, raw
from gazette.operators.validate import (
    article_checks,
    article_failures,
    dead_letter,
    enriched_failures,
    expectation_failures,
    first_missing,
    gate_error,
    passes,
    project_fields,
    split,
    validated_failures,
)
from gazette.schemas import ARTICLE, ENRICHED, STORED_FIELDS, VALIDATED


def failures(spark, schema, records, column):
    rows = frame(spark, schema, records).select(column.alias("f")).collect()
    return [[m.split(":")[0] for m in r.f] for r in rows]


@pytest.mark.parametrize("broken,field", [
    ({}, None),
    ({"body": ""}, None),
    ({"article_id": ""}, "article_id"),
    ({"article_id": " 　"}, "article_id"),
    ({"article_id": None}, "article_id"),
    ({"headline": "\n"}, "headline"),
    ({"headline": None}, "headline"),
    ({"body": None}, "body"),
    ({"section": "sports"}, "section"),
    ({"section": "Technology"}, "section"),
    ({"section": None}, "section"),
    ({"source_url": "not a url"}, "source_url"),
    ({"published_at": None}, "published_at"),
])
def test_article_contract(spark, broken, field):
    found = failures(spark, ARTICLE, [raw(**broken)], article_failures())
    assert found == [[field] if field else []]
    ok = frame(spark, ARTICLE, [raw(**broken)]).select(passes(article_checks()).alias("ok"))
    assert ok.first().ok is (field is None)


@pytest.mark.parametrize("broken,field", [
    ({}, None),
    ({"entities": []}, None),
    ({"summary": " " * 30 + "x" * 50 + " " * 600}, None),
    ({"summary": "x" * 500}, None),
    ({"summary": ""}, "summary"),
    ({"summary": "x" * 49}, "summary"),
    ({"summary": "x" * 501}, "summary"),
    ({"summary": None}, "summary"),
    ({"entities": ["a"] * 6}, "entities"),
    ({"entities": ["a", " "]}, "entities"),
    ({"entities": None}, "entities"),
    ({"sentiment": "Mixed"}, "sentiment"),
    ({"sentiment_reason": " "}, "sentiment_reason"),
    ({"domain_tag": "Sports"}, "domain_tag"),
    ({"enriched_at": None}, "enriched_at"),
])
def test_enriched_contract(spark, broken, field):
    found = failures(spark, ENRICHED, [enriched(**broken)], enriched_failures())
    assert found == [[field] if field else []]


@pytest.mark.parametrize("broken,message", [
    ({}, None),
    ({"summary": "short is fine here"}, None),
    ({"embedding": [0.1] * 100}, "Embedding dimension mismatch: expected 384, got 100"),
    ({"embedding": []}, "Embedding dimension mismatch: expected 384, got 0"),
    ({"embedding": None}, "Embedding dimension mismatch: expected 384, got 0"),
    ({"embedding": [None] + [0.1] * 383}, "embedding: must not hold nulls"),
    ({"validated_at": None}, "validated_at: missing or unreadable"),
    ({"published_at": None}, "published_at: missing or unreadable"),
])
def test_validated_contract(spark, broken, message):
    record = {**enriched(), "embedding": [0.1] * 384, "validated_at": "2024-01-18T12:00:00Z"}
    row = frame(spark, VALIDATED, [{**record, **broken}]).select(validated_failures().alias("f"))
    assert row.first().f == ([message] if message else [])


@pytest.mark.parametrize("values,messages", [
    ({}, []),
    ({"summary": "x" * 50}, []),
    ({"summary": "x" * 500}, []),
    ({"summary": "x" * 9}, ["summary_length: 9 not in [50, 500]"]),
    ({"summary": "x" * 501}, ["summary_length: 501 not in [50, 500]"]),
    ({"summary": None}, ["summary_length: 0 not in [50, 500]"]),
    ({"summary": " " * 60}, []),
    ({"sentiment": "Unknown"},
     ["sentiment: 'Unknown' not in {'Negative', 'Neutral', 'Positive'}"]),
    ({"sentiment": None}, ["sentiment: '' not in {'Negative', 'Neutral', 'Positive'}"]),
    ({"published_at": AS_OF - dt.timedelta(days=3)}, []),
    ({"published_at": AS_OF - dt.timedelta(days=7)}, []),
    ({"published_at": AS_OF - dt.timedelta(days=7, seconds=1)},
     ["recency: published_at 2024-01-13T11:59:59+00:00 older than 7 days"]),
    ({"published_at": AS_OF + dt.timedelta(days=9)}, []),
    ({"published_at": None}, []),
])
def test_expectations(spark, values, messages):
    record = {"summary": SUMMARY, "sentiment": "Positive", "published_at": AS_OF, **values}
    rows = spark.createDataFrame(
        [tuple(record.values())], "summary string, sentiment string, published_at timestamp"
    )
    assert rows.select(expectation_failures(AS_OF).alias("f")).first().f == messages


def test_three_failures_give_three_messages_and_one_error(spark):
    rows = spark.createDataFrame(
        [("x", "y", dt.datetime(2020, 1, 1)), (SUMMARY, "Neutral", AS_OF)],
        "summary string, sentiment string, published_at timestamp",
    )
    found = expectation_failures(AS_OF)
    bad, good = rows.select(found.alias("f"), gate_error(found).alias("e")).collect()
    assert len(bad.f) == 3 and bad.e == "GX validation failed: " + "; ".join(bad.f)
    assert good.f == [] and good.e is None


def test_first_missing_reports_in_order(spark):
    rows = spark.createDataFrame(
        [("a", "h", "b"), ("", None, None), ("a", "", "b"), ("a", " ", None)],
        "article_id string, headline string, body string",
    )
    found = rows.select(first_missing("article_id", "headline", "body").alias("e")).collect()
    assert [r.e for r in found] == [None] + [
        f"missing required field: {f}" for f in ("article_id", "headline", "body")
    ]


def test_split_and_dead_letter_lose_nothing(spark):
    rows = frame(spark, ARTICLE, [raw("a/1"), raw("a/2", section="x"), raw(" ")])
    good, bad = split(rows.withColumn("_failures", article_failures()))
    assert [r.article_id for r in good.collect()] == ["a/1"] and "_failures" not in good.columns
    letters = dead_letter(bad, F.concat_ws("; ", "_failures"), AS_OF, "quality-gate").collect()
    assert len(letters) == 2
    assert json.loads(letters[0].value)["headline"] == "Headline of a/2"
    assert letters[0]._failed_stage == "quality-gate" and letters[0]._failed_at is not None
    assert letters[0]._error.startswith("section:")


def test_project_fields_keeps_what_is_there(spark):
    rows = frame(spark, ARTICLE, [raw()])
    assert project_fields(rows, STORED_FIELDS).columns == [
        "article_id", "headline", "section", "published_at", "source_url",
    ]
