"""Feed and metric queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from gazette.operators.reports import (
    count_all,
    count_by,
    count_by_each,
    count_recent,
    covered_dates,
    facet_filter,
    facets,
    latest,
    pass_rate,
    published_after,
    published_before,
    ranked_counts,
    topic_depth,
    weekly_report,
)
from gazette.operators.validate import hours_before
from gazette.sources.store import scan
from gazette.workload.base import articles, enriched, query, shown_time, sql, sql_time, table
from gazette.workload.feeds import events_log

EVENTS_AS_OF = "2024-01-30 12:00:00"


def events(spark, sf_dir):
    """Events as rows with a publication time."""
    return table(spark, sf_dir, "events").withColumn(
        "published_at", F.col("ts").cast("timestamp")
    )


SQL_LATEST = "SELECT * FROM enriched ORDER BY published_at DESC, article_id LIMIT 50"


@query(
    sql(
        f"""SELECT article_id, {sql_time("published_at")} AS published_at, section,
                   sha256(article_id) AS uuid
            FROM enriched ORDER BY enriched.published_at DESC, article_id LIMIT 50""",
        "articles",
        "enriched",
    )
)
def latest_articles(spark, sf_dir):
    page = latest(enriched(spark, sf_dir))
    return page.select(
        "article_id",
        shown_time("published_at").alias("published_at"),
        "section",
        F.sha2("article_id", 256).alias("uuid"),
    )


@query(
    sql(
        """SELECT (SELECT string_agg(x, ',' ORDER BY x) FROM
                    (SELECT DISTINCT coalesce(domain_tag, 'Other') AS x FROM page)) AS tags,
                  (SELECT string_agg(x, ',' ORDER BY x) FROM
                    (SELECT DISTINCT coalesce(sentiment, 'Neutral') AS x FROM page)) AS sentiments""",
        "articles",
        "enriched",
        page=SQL_LATEST,
    )
)
def feed_facets(spark, sf_dir):
    page = facets(latest(enriched(spark, sf_dir)))
    return page.select(
        F.array_join("tags", ",").alias("tags"),
        F.array_join("sentiments", ",").alias("sentiments"),
    )


@query(
    sql(
        """SELECT article_id, seq FROM page
           WHERE coalesce(domain_tag, 'Other') IN ('AI', 'Climate', 'Other')
             AND coalesce(sentiment, 'Neutral') IN ('Positive', 'Neutral')""",
        "articles",
        "enriched",
        page=SQL_LATEST,
    )
)
def filtered_feed(spark, sf_dir):
    page = latest(enriched(spark, sf_dir))
    return facet_filter(page, ["AI", "Climate", "Other"], ["Positive", "Neutral"]).select(
        "article_id", "seq"
    )


@query("SELECT count(*) AS total FROM events")
def count_events(spark, sf_dir):
    return count_all(events(spark, sf_dir))


@query(
    f"""SELECT count(*) FILTER (ts > TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 24 HOUR) AS last_24h,
               count(*) FILTER (ts > TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 1 HOUR) AS last_1h
        FROM events"""
)
def count_recent_events(spark, sf_dir):
    return count_recent(events(spark, sf_dir), EVENTS_AS_OF)


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def count_by_type(spark, sf_dir):
    return count_by(events(spark, sf_dir), "event_type")


@query(
    sql(
        "SELECT 'sentiment' AS property, sentiment AS value, count(*) AS n FROM enriched "
        "WHERE sentiment IS NOT NULL GROUP BY ALL UNION ALL "
        "SELECT 'domain_tag', domain_tag, count(*) FROM enriched WHERE domain_tag IS NOT NULL "
        "GROUP BY ALL UNION ALL SELECT 'section', section, count(*) FROM enriched GROUP BY ALL",
        "articles",
        "enriched",
    )
)
def article_counts(spark, sf_dir):
    """Articles per sentiment, per tag and per section."""
    return count_by_each(enriched(spark, sf_dir), ("sentiment", "domain_tag", "section"))


@query(sql("SELECT section, count(*) AS n FROM articles GROUP BY 1", "articles"))
def sections_ranked(spark, sf_dir):
    return ranked_counts(articles(spark, sf_dir), "section")


@query("SELECT event_type AS topic, count(*) AS messages FROM events GROUP BY 1")
def messages_per_topic(spark, sf_dir):
    return topic_depth(events_log(spark, sf_dir))


@query(
    f"""SELECT DISTINCT CAST(ts AS DATE)::VARCHAR AS date FROM events
        WHERE ts > TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 480 HOUR"""
)
def dates_covered(spark, sf_dir):
    dates = covered_dates(events(spark, sf_dir), hours_before(EVENTS_AS_OF, 480))
    return dates.select(F.col("date").cast("string").alias("date"))


@query(
    """SELECT count(*) FILTER (ts > TIMESTAMP '2024-01-15') AS after_,
              count(*) FILTER (ts < TIMESTAMP '2024-01-15') AS before_ FROM events"""
)
def published_windows(spark, sf_dir):
    rows, moment = events(spark, sf_dir), F.lit("2024-01-15").cast("timestamp")
    one, none = F.lit(1), F.lit(0)
    after = published_after(rows, moment).select(one.alias("a"), none.alias("b"))
    before = published_before(rows, moment).select(none.alias("a"), one.alias("b"))
    return after.unionByName(before).agg(
        F.sum("a").alias("after_"), F.sum("b").alias("before_")
    )


SQL_RATE = (
    "CASE WHEN validated + failed = 0 THEN 0.0 ELSE "
    "CAST(printf('%.1f', validated::DOUBLE / (validated + failed)::DOUBLE * 100) AS DOUBLE) END"
)


@query(
    f"""SELECT validated, failed, validated + failed AS total, {SQL_RATE} AS pass_rate
        FROM (SELECT count(*) FILTER (quality = 1) AS validated,
                     count(*) FILTER (quality <> 1) AS failed FROM labels)"""
)
def label_pass_rate(spark, sf_dir):
    return pass_rate(table(spark, sf_dir, "labels"), F.col("quality") == 1)


@query(
    f"""SELECT validated, failed, validated + failed AS total, {SQL_RATE} AS pass_rate
        FROM (SELECT
          count(*) FILTER (event_type <> 'error'
            AND ts > TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 7 DAY) AS validated,
          count(*) FILTER (event_type = 'error'
            AND ts >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 7 DAY) AS failed FROM events)"""
)
def weekly_pass_rate(spark, sf_dir):
    """Error events stand for the dead letters, the others for stored articles."""
    store = events(spark, sf_dir).where("event_type <> 'error'")
    failed = events_log(spark, sf_dir).where("topic = 'error'")
    return weekly_report(store, failed, EVENTS_AS_OF)


@query(
    sql(
        f"""SELECT article_id, {sql_time("published_at")} AS published_at FROM articles
            WHERE section = 'science'""",
        "articles",
    )
)
def scan_section(spark, sf_dir):
    """A filtered and sorted scan of the collection."""
    rows = scan(articles(spark, sf_dir), "section = 'science'", [F.desc("published_at"), "seq"])
    return rows.select("article_id", shown_time("published_at").alias("published_at"))
