"""Small records for the tests."""

import datetime as dt
import json

UTC = dt.timezone.utc
AS_OF = dt.datetime(2024, 1, 20, 12, tzinfo=UTC)
LONG = " ".join(["word"] * 250)
SHORT = " ".join(["word"] * 50)
SUMMARY = "First sentence of the summary. Second one follows. And here is the third."


def raw(article_id="a/1", body=LONG, section="technology", **more):
    record = {
        "article_id": article_id,
        "headline": f"Headline of {article_id}",
        "body": body,
        "section": section,
        "published_at": "2024-01-18T10:30:00Z",
        "source_url": f"https://example.com/{article_id}",
    }
    return {k: v for k, v in {**record, **more}.items() if v is not ...}


def message(record, offset, topic="raw-news"):
    value = record if isinstance(record, str) else json.dumps(record)
    key = None if isinstance(record, str) else record.get("article_id")
    return key, value, None, offset, AS_OF, topic


def log(spark, records, topic="raw-news", start=0):
    from gazette.schemas import LOG

    rows = [message(r, start + i, topic) for i, r in enumerate(records)]
    return spark.createDataFrame(rows, LOG)


def enriched(article_id="a/1", **more):
    extra = {
        "summary": SUMMARY,
        "entities": ["Someone", "Somewhere"],
        "sentiment": "Neutral",
        "sentiment_reason": "Plain wording.",
        "domain_tag": "AI",
        "enriched_at": "2024-01-18T11:00:00Z",
    }
    return raw(article_id, **{**extra, **more})


def article_row(record):
    """A record with its times as datetimes, for typed DataFrames."""
    times = ("published_at", "enriched_at", "validated_at")
    return {
        k: dt.datetime.fromisoformat(v) if k in times and isinstance(v, str) else v
        for k, v in record.items()
    }


def frame(spark, schema, records):
    names = schema.fieldNames()
    rows = [tuple(article_row(r).get(n) for n in names) for r in records]
    return spark.createDataFrame(rows, schema)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
