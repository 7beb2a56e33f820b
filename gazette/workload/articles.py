"""Deduplication, word filter, routing, insertion."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gazette.functions.text import hash16, min_words, word_count
from gazette.operators.dedup import (
    first_seen,
    first_seen_long,
    label_inserts,
    label_qualifying,
    merge_ranked,
)
from gazette.operators.reports import existing, publish_counts, tick_stats
from gazette.operators.route import fan_out, keyed_messages, route_section
from gazette.plans.tick import seen_after, tick
from gazette.schemas import MIN_WORDS
from gazette.session import checkpoint_root
from gazette.sources.normalize import union_sources
from gazette.streaming.dedup import first_qualifying, first_seen_ttl, no_empty_batches
from gazette.workload.base import ALL_SECTIONS, SQL_TOPIC, articles, pick, query, sql, sql_words, table

FIRSTS = """SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY seq) AS rn
            FROM articles"""


@query(
    sql(
        f"""SELECT {SQL_TOPIC} AS topic, count(*) AS n FROM firsts
            WHERE rn = 1 AND {sql_words("body")} >= 200 GROUP BY 1""",
        "articles",
        firsts=FIRSTS,
    )
)
def route_articles(spark, sf_dir):
    """Messages per topic after first-seen deduplication and the word filter."""
    routed = fan_out(first_seen_long(articles(spark, sf_dir), unique=True))
    return routed.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query(
    sql(
        f"""SELECT seq, article_id, {SQL_TOPIC} AS topic FROM firsts
            WHERE rn = 1 AND {sql_words("body")} >= 200""",
        "articles",
        firsts=FIRSTS,
    )
)
def fan_out_rows(spark, sf_dir):
    return fan_out(first_seen_long(articles(spark, sf_dir), unique=True)).select("seq", "article_id", "topic")


@query(sql("SELECT seq, article_id FROM firsts WHERE rn = 1", "articles", firsts=FIRSTS))
def dedup_first(spark, sf_dir):
    return first_seen(articles(spark, sf_dir), unique=True).select("seq", "article_id")


@query(
    sql(
        f"SELECT seq, {sql_words('body')} AS words, {sql_words('body')} >= 200 AS long_enough "
        "FROM articles",
        "articles",
    )
)
def min_words_flags(spark, sf_dir):
    return articles(spark, sf_dir).select(
        "seq",
        word_count("body").cast("long").alias("words"),
        min_words("body", 200).alias("long_enough"),
    )


def toxic_ids(spark, sf_dir):
    """Ids of the articles labelled toxic; they stand for ids seen before."""
    marked = table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("seq"))
    return articles(spark, sf_dir).join(marked, "seq", "left_semi").select("article_id")


TICK_CTES = {
    "seen": """SELECT DISTINCT article_id FROM articles
               WHERE seq IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
    "ok": f"SELECT *, {sql_words('body')} >= 200 AS good FROM articles",
    "labelled": """SELECT seq, article_id, CASE
        WHEN article_id IN (SELECT article_id FROM seen)
          OR coalesce(max(good) OVER (PARTITION BY article_id ORDER BY seq
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) THEN 'duplicate'
        WHEN good THEN 'published' ELSE 'filtered' END AS label FROM ok""",
}


@query(sql("SELECT * FROM labelled", "articles", **TICK_CTES))
def tick_labels(spark, sf_dir):
    labelled = label_qualifying(articles(spark, sf_dir), toxic_ids(spark, sf_dir))
    return labelled.select("seq", "article_id", "label")


@query(
    sql(
        """SELECT count(*) AS fetched,
                  count(*) FILTER (label = 'duplicate') AS duplicates,
                  count(*) FILTER (label = 'filtered') AS filtered,
                  count(*) FILTER (label = 'published' AND seq % 10 <> 3) AS published,
                  count(*) FILTER (label = 'published' AND seq % 10 = 3) AS buffered
           FROM labelled""",
        "articles",
        **TICK_CTES,
    )
)
def tick_counts(spark, sf_dir):
    labelled = label_qualifying(articles(spark, sf_dir), toxic_ids(spark, sf_dir))
    return tick_stats(labelled, delivered=F.col("seq") % 10 != 3)


@query(
    sql(
        """SELECT article_id FROM seen UNION ALL
           SELECT article_id FROM labelled WHERE label = 'published'""",
        "articles",
        **TICK_CTES,
    )
)
def tick_seen_after(spark, sf_dir):
    """The ids the next round will treat as duplicates."""
    seen = toxic_ids(spark, sf_dir).distinct()
    return seen_after(label_qualifying(articles(spark, sf_dir), seen), seen)


@query(
    sql(
        """SELECT seq, lang, CASE
             WHEN coalesce(max(good) OVER (PARTITION BY lang ORDER BY seq
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) THEN 'duplicate'
             WHEN good THEN 'published' ELSE 'filtered' END AS label
           FROM ok""",
        "articles",
        ok=TICK_CTES["ok"],
    )
)
def tick_labels_heavy_keys(spark, sf_dir):
    """The same labels with the language as key: four keys hold all rows."""
    labelled = label_qualifying(articles(spark, sf_dir), key="lang", rows_per_slice=50)
    return labelled.select("seq", "lang", "label")


@query(
    sql(
        """SELECT count(*) FILTER (seq % 10 <> 3) AS sent,
                  count(*) FILTER (seq % 10 = 3) AS buffered FROM articles""",
        "articles",
    )
)
def publish_outcome(spark, sf_dir):
    return publish_counts(articles(spark, sf_dir), F.col("seq") % 10 != 3)


def four_sources(spark, sf_dir):
    """Four tables as the four kinds of source."""

    def source(name, kind, key, text, order):
        return table(spark, sf_dir, name).select(
            F.concat(F.lit(f"{kind}/"), hash16(key)).alias("article_id"),
            F.col(text).alias("body"),
            order.alias("seq"),
        )

    turn = F.col("conv_id") * 1000 + F.col("turn")
    return {
        "guardian": source("documents", "doc", "text", "text", F.col("doc_id")),
        "rss": source("conversations", "doc", "text", "text", turn),
        "hackernews": source("benchmark", "doc", "text", "text", F.col("item_id")),
        "bluesky": source("pages", "doc", "url", "html", F.col("page_id")),
    }


def _sql_source(number: int, name: str, table_name: str, key: str, text: str, order: str) -> str:
    return (
        f"SELECT 'doc/' || substr(sha256({key}), 1, 16) AS article_id, {text} AS body, "
        f"{order} + {number << 56} AS seq, '{name}' AS source_name FROM {table_name}"
    )


SOURCES_SQL = " UNION ALL ".join(
    [
        _sql_source(0, "guardian", "documents", "text", "text", "doc_id"),
        _sql_source(1, "rss", "conversations", "text", "text", "conv_id * 1000 + turn"),
        _sql_source(2, "hackernews", "benchmark", "text", "text", "item_id"),
        _sql_source(3, "bluesky", "pages", "url", "html", "page_id"),
    ]
)


@query(sql("SELECT seq, source_name, article_id FROM merged", merged=SOURCES_SQL))
def union_all_sources(spark, sf_dir):
    return union_sources(four_sources(spark, sf_dir)).select("seq", "source_name", "article_id")


@query(
    sql(
        """SELECT source_name, label, count(*) AS n FROM (
             SELECT source_name, CASE
               WHEN coalesce(max(good) OVER (PARTITION BY article_id ORDER BY seq
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) THEN 'duplicate'
               WHEN good THEN 'published' ELSE 'filtered' END AS label
             FROM ok) GROUP BY ALL""",
        merged=SOURCES_SQL,
        ok=f"SELECT *, {sql_words('body')} >= 50 AS good FROM merged",
    )
)
def tick_all_sources(spark, sf_dir):
    """One polling round over four sources; earlier sources win."""
    labelled = tick(four_sources(spark, sf_dir), qualifies=min_words("body", 50))
    return labelled.groupBy("source_name", "label").agg(F.count(F.lit(1)).alias("n"))


def insert_candidates(spark, sf_dir):
    """Articles with the vector of the same number; short texts get no id."""
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("seq"), "embedding"
    )
    short = F.length("body") < 100
    return (
        articles(spark, sf_dir)
        .withColumn("article_id", F.when(short, "").otherwise(F.col("article_id")))
        .join(vectors, "seq", "left")
    )


INSERT_CTES = {
    "stored": """SELECT article_id FROM articles
                 WHERE seq IN (SELECT doc_id FROM labels WHERE quality = 0)""",
    "candidates": """SELECT a.seq,
          CASE WHEN length(body) < 100 THEN '' ELSE article_id END AS article_id,
          e.embedding IS NOT NULL AS good
        FROM articles a LEFT JOIN embeddings e ON e.vec_id = a.seq""",
    "labelled": """SELECT seq, CASE WHEN article_id = '' THEN 'dead-letter'
        WHEN article_id IN (SELECT article_id FROM stored)
          OR coalesce(max(good) OVER (PARTITION BY article_id ORDER BY seq
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) THEN 'skipped'
        WHEN good THEN 'inserted' ELSE 'dead-letter' END AS label FROM candidates""",
}


@query(sql("SELECT seq, label FROM labelled", "articles", **INSERT_CTES))
def insert_if_absent(spark, sf_dir):
    poor = table(spark, sf_dir, "labels").where("quality = 0").select(
        F.col("doc_id").alias("seq")
    )
    stored = articles(spark, sf_dir).join(poor, "seq", "left_semi").select("article_id")
    return label_inserts(insert_candidates(spark, sf_dir), stored).select("seq", "label")


@query(
    sql(
        """SELECT article_id, bool_or(seq IN (SELECT doc_id FROM labels)) AS stored
           FROM articles GROUP BY article_id""",
        "articles",
    )
)
def point_lookup(spark, sf_dir):
    """Which ids are stored, where labelled articles stand for the store."""
    labelled = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("seq"))
    rows = articles(spark, sf_dir)
    return existing(rows, rows.join(labelled, "seq", "left_semi"))


MERGE_LIMIT = 300


@query(
    f"""WITH lists AS (
          SELECT 0 AS list_no, (doc_id * 7919) % 1009 AS id, doc_id AS position FROM documents
          WHERE doc_id < {MERGE_LIMIT}
          UNION ALL
          SELECT 1, (doc_id * 104729) % 1013, doc_id FROM documents WHERE doc_id < {MERGE_LIMIT}),
        first AS (
          SELECT id, list_no, position AS list_position,
                 row_number() OVER (PARTITION BY id ORDER BY list_no, position) AS rn FROM lists)
        SELECT id, list_no, list_position FROM first WHERE rn = 1
        ORDER BY list_no, list_position LIMIT {MERGE_LIMIT}"""
)
def merge_ranked_ids(spark, sf_dir):
    """Two ranked id lists merged; the cap on stories is part of the operator."""
    docs = table(spark, sf_dir, "documents")
    position = F.col("doc_id").alias("position")
    top = docs.select(((F.col("doc_id") * 7919) % 1009).alias("id"), position)
    new = docs.select(((F.col("doc_id") * 104729) % 1013).alias("id"), position)
    return merge_ranked([top, new], MERGE_LIMIT)


@query(
    sql(
        f"""SELECT article_id AS key, {SQL_TOPIC} AS topic, md5(body) AS body_md5,
                   strftime(published_at, '%Y-%m-%dT%H:%M:%SZ') AS published_at, headline
            FROM articles""",
        "articles",
    )
)
def keyed_json(spark, sf_dir):
    """Articles as keyed JSON messages, read back from the JSON."""
    messages = keyed_messages(articles(spark, sf_dir), route_section("section"))
    shape = "headline string, body string, published_at string"
    return messages.withColumn("r", F.from_json("value", shape)).select(
        "key",
        "topic",
        F.md5("r.body").alias("body_md5"),
        F.col("r.published_at").alias("published_at"),
        F.col("r.headline").alias("headline"),
    )


@query(
    sql(
        f"""SELECT {SQL_TOPIC} AS topic, count(*) AS n, sum(seq)::BIGINT AS seq_sum FROM firsts
            WHERE rn = 1 AND {sql_words("body")} >= 200 GROUP BY 1""",
        "articles",
        firsts=FIRSTS,
    )
)
def dedup_ttl_stream(spark, sf_dir):
    """The documents as a file stream through the stateful deduplication."""
    root = f"{checkpoint_root(spark).rstrip('/')}/dedup-ttl-{uuid.uuid4().hex}"
    shape = table(spark, sf_dir, "documents").schema
    # A pattern, because a file stream takes no single file: one file or a folder.
    stream = spark.readStream.schema(shape).parquet(f"{sf_dir}/documents.parquet*")
    rows = stream.select(
        F.concat(F.lit("doc/"), hash16("text")).alias("article_id"),
        route_section(pick(ALL_SECTIONS, F.col("doc_id") % 6)).alias("topic"),
        min_words("text", MIN_WORDS).alias("long_enough"),
        F.col("doc_id").alias("offset"),
    )
    routed = first_seen_ttl(rows, then=F.col("long_enough")).select("topic", "offset")
    writer = routed.writeStream.format("parquet").option("path", f"{root}/out")
    writer = writer.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
    with no_empty_batches(spark):
        running = writer.start()
    running.awaitTermination()
    out = spark.read.schema("topic string, offset bigint").parquet(f"{root}/out")
    return out.groupBy("topic").agg(
        F.count(F.lit(1)).alias("n"), F.sum("offset").alias("seq_sum")
    )


@query(
    sql(
        "SELECT seq, article_id FROM labelled WHERE label = 'published'", "articles", **TICK_CTES
    )
)
def tick_published_stream(spark, sf_dir):
    """The published rows of a polling round, by a stream that knows the ids seen before."""
    root = f"{checkpoint_root(spark).rstrip('/')}/tick-{uuid.uuid4().hex}"
    shape = table(spark, sf_dir, "documents").schema
    stream = spark.readStream.schema(shape).parquet(f"{sf_dir}/documents.parquet*")
    rows = stream.select(
        F.concat(F.lit("doc/"), hash16("text")).alias("article_id"),
        F.col("doc_id").alias("offset"),
        min_words("text", MIN_WORDS).alias("good"),
    )
    published = first_qualifying(rows, toxic_ids(spark, sf_dir), qualifies=F.col("good"))
    writer = published.writeStream.format("parquet").option("path", f"{root}/out")
    writer = writer.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
    writer.start().awaitTermination()
    out = spark.read.schema("article_id string, offset bigint").parquet(f"{root}/out")
    return out.select(F.col("offset").alias("seq"), "article_id")
