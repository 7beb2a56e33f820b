"""Retention, gaps, backfill and health checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from gazette.operators.maintenance import backfill, expire, find_gaps, prune, stalled_topics
from gazette.plans.backfill import backfill_messages, missed_articles
from gazette.schemas import GUARDIAN_PAGE
from gazette.sources.daylog import drop_expired, read_days, write_days
from gazette.workload.base import ALL_SECTIONS, articles, pick, query, shown_time, sql, sql_time, table
from gazette.workload.feeds import (
    DOCS,
    SQL_WHEN,
    events_log,
    landed,
    text_of,
    when_published,
)
from gazette.workload.logs import folder
from gazette.workload.metrics import EVENTS_AS_OF, events

PRUNE_AS_OF = "2024-02-10 06:00:00"


@query(
    f"""SELECT ts < TIMESTAMP '{PRUNE_AS_OF}' - INTERVAL 30 DAY AS deleted, count(*) AS n,
               sum(event_id)::BIGINT AS id_sum FROM events GROUP BY 1"""
)
def prune_events(spark, sf_dir):
    """What a prune keeps and what it deletes."""
    kept, deleted = prune(events(spark, sf_dir), PRUNE_AS_OF, key="event_id")
    both = kept.select("event_id", F.lit(False).alias("deleted")).unionByName(
        deleted.select("event_id", F.lit(True).alias("deleted"))
    )
    return both.groupBy("deleted").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum")
    )


@query(
    f"""WITH gone AS (SELECT event_id FROM events
          WHERE ts < TIMESTAMP '{PRUNE_AS_OF}' - INTERVAL 30 DAY
          ORDER BY ts, event_id LIMIT 1000)
        SELECT event_id IN (SELECT event_id FROM gone) AS deleted, count(*) AS n,
               sum(event_id)::BIGINT AS id_sum FROM events GROUP BY 1"""
)
def prune_events_capped(spark, sf_dir):
    """At most 1000 deletions in one run, oldest first; the cap is the operator's."""
    kept, deleted = prune(events(spark, sf_dir), PRUNE_AS_OF, cap=1000, key="event_id")
    both = kept.select("event_id", F.lit(False).alias("deleted")).unionByName(
        deleted.select("event_id", F.lit(True).alias("deleted"))
    )
    return both.groupBy("deleted").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum")
    )


def sparse_store(spark, sf_dir):
    """Articles labelled toxic: few enough to leave dates without any."""
    marked = table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("seq"))
    return articles(spark, sf_dir).join(marked, "seq", "left_semi")


GAPS_AS_OF = "2024-02-02 10:00:00"
GAP_DATES = f"""SELECT CAST(d AS DATE) AS date
    FROM generate_series(DATE '2024-01-03', DATE '2024-02-02', INTERVAL 1 DAY) t(d)
    WHERE CAST(d AS DATE) NOT IN (
      SELECT CAST(published_at AS DATE) FROM articles
      WHERE seq IN (SELECT doc_id FROM labels WHERE toxic = 1)
        AND published_at > TIMESTAMP '{GAPS_AS_OF}' - INTERVAL 720 HOUR)"""


@query(sql(f"SELECT date::VARCHAR AS date FROM ({GAP_DATES})", "articles"))
def article_gaps(spark, sf_dir):
    gaps = find_gaps(sparse_store(spark, sf_dir), GAPS_AS_OF, hours=720)
    return gaps.select(F.col("date").cast("string").alias("date"))


@query(
    f"""SELECT CAST(d AS DATE)::VARCHAR AS date
        FROM generate_series(DATE '2024-01-29', DATE '2024-01-31', INTERVAL 1 DAY) t(d)
        WHERE CAST(d AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events
          WHERE ts > TIMESTAMP '2024-01-31 10:00:00' - INTERVAL 48 HOUR)"""
)
def event_gaps(spark, sf_dir):
    gaps = find_gaps(events(spark, sf_dir), "2024-01-31 10:00:00")
    return gaps.select(F.col("date").cast("string").alias("date"))


@query(
    sql(
        f"""SELECT article_id, seq, section, {sql_time("published_at")} AS published_at
              FROM articles WHERE section <> 'entertainment'
                AND CAST(published_at AS DATE) IN (SELECT date FROM gaps)""",
        "articles",
        gaps=GAP_DATES,
    )
)
def backfill_gaps(spark, sf_dir):
    """The archive rows for every missing date and section."""
    gaps = find_gaps(sparse_store(spark, sf_dir), GAPS_AS_OF, hours=720)
    found = backfill(gaps, articles(spark, sf_dir))
    return found.select(
        "article_id", "seq", "section", shown_time("published_at").alias("published_at")
    )


@query(
    sql(
        f"""SELECT '{{"article_id":"guardian/' || doc_id || '"' AS value_start,
                   NULL::VARCHAR AS key, 'raw-news' AS topic
            FROM (SELECT *, {SQL_WHEN} AS published FROM docs)
            WHERE section <> 'entertainment'
              AND CAST(published AS DATE) IN (SELECT date FROM gaps)""",
        "articles",
        gaps=GAP_DATES,
        docs=DOCS,
    )
)
def backfill_as_messages(spark, sf_dir):
    """From the gaps of a store and an archive of search pages to raw messages."""
    record = F.struct(
        F.struct(
            F.array(
                F.struct(
                    text_of("guardian/").alias("id"),
                    F.date_format(when_published(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(
                        "webPublicationDate"
                    ),
                    pick(ALL_SECTIONS, F.col("doc_id") % 6).alias("sectionId"),
                )
            ).alias("results")
        ).alias("response")
    )
    pages = landed(spark, sf_dir, record, GUARDIAN_PAGE)
    found = missed_articles(sparse_store(spark, sf_dir), pages, GAPS_AS_OF, hours=720)
    return backfill_messages(found, GAPS_AS_OF).select(
        F.regexp_extract("value", '^[^,]*', 0).alias("value_start"), "key", "topic"
    )


EXPECTED = ("click", "error", "refund", "quiet")


@query(
    """SELECT topic, topic || CASE WHEN topic = 'quiet' THEN ' (empty)' ELSE ' (missing)' END
              AS problem
       FROM (SELECT unnest(['click', 'error', 'refund', 'quiet']) AS topic)
       WHERE topic NOT IN (SELECT event_type FROM events)"""
)
def stalled_event_topics(spark, sf_dir):
    """Expected topics without messages; one of them exists but is empty."""
    log = events_log(spark, sf_dir).select("topic", "value")
    marker = spark.createDataFrame([("quiet", None)], "topic string, value string")
    return stalled_topics(log.unionByName(marker), EXPECTED)


RETENTION = {"click": 1, "view": 2, "error": 7}


@query(
    f"""SELECT event_type AS topic, count(*) AS n FROM events
        WHERE ts >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 1 DAY * CASE event_type
              WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'error' THEN 7 ELSE 10000 END
        GROUP BY 1"""
)
def expire_messages(spark, sf_dir):
    """Messages that are still within their topic's retention."""
    kept = expire(events_log(spark, sf_dir), EVENTS_AS_OF, RETENTION)
    return kept.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""SELECT event_type AS topic, count(*) AS n, count(DISTINCT ts::DATE) AS days,
               count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-24 12:00:00') AS late FROM events
        WHERE ts >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 1 DAY * CASE event_type
              WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'error' THEN 7 ELSE 10000 END
        GROUP BY 1"""
)
def expire_days(spark, sf_dir):
    """A log by topic and day after retention: messages within it, days still there, and the
    messages of a reader that starts late."""
    root = folder(spark, "days")
    write_days(events_log(spark, sf_dir), root)
    drop_expired(spark, root, dt.datetime.fromisoformat(EVENTS_AS_OF), RETENTION)
    kept = expire(read_days(spark, root), EVENTS_AS_OF, RETENTION).groupBy("topic")
    kept = kept.agg(F.count(F.lit(1)).alias("n"))
    left = read_days(spark, root).groupBy("topic")
    left = left.agg(F.countDistinct(F.to_date("timestamp")).alias("days"))
    late = expire(read_days(spark, root, since=dt.datetime(2024, 1, 24, 12)), EVENTS_AS_OF, RETENTION)
    late = late.groupBy("topic").agg(F.count(F.lit(1)).alias("late"))
    return (
        kept.join(left, "topic", "left")
        .join(late, "topic", "left")
        .select("topic", "n", "days", F.coalesce("late", F.lit(0)).alias("late"))
    )
