"""Contracts, expectations and the quality gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from gazette.functions.vectors import check_dim, hashing_embedder
from gazette.operators.gate import quality_gate
from gazette.operators.validate import (
    article_failures,
    dead_letter,
    enriched_failures,
    expectation_failures,
    first_missing,
    gate_error,
    project_fields,
    split,
    too_old,
    validated_failures,
)
from gazette.schemas import (
    DOMAIN_TAGS,
    EMBEDDING_DIM,
    SECTIONS,
    SENTIMENTS,
    STAGE_GATE,
    STORED_FIELDS,
)
from gazette.sources.store import as_stored
from gazette.workload.base import (
    AS_OF,
    articles,
    enriched,
    query,
    shown_time,
    sql,
    sql_list,
    sql_strip,
    sql_time,
    table,
)


def broken(rows):
    """Articles with one field broken in some of them."""
    seq = F.col("seq")
    return rows.withColumns(
        {
            "article_id": F.when(seq % 31 == 0, "  ").otherwise(F.col("article_id")),
            "headline": F.when(seq % 17 == 0, " \n").otherwise(F.col("headline")),
            "body": F.when(seq % 13 != 0, F.col("body")),
            "published_at": F.when(seq % 11 != 0, F.col("published_at")),
            "source_url": F.when(seq % 7 == 0, "ftp://example.com/x")
            .when(seq % 7 == 1, "")
            .when(seq % 7 == 2, "HTTP://EXAMPLE.com")
            .otherwise(F.col("source_url")),
        }
    )


BROKEN = """SELECT * REPLACE (
    CASE WHEN seq % 31 = 0 THEN '  ' ELSE article_id END AS article_id,
    CASE WHEN seq % 17 = 0 THEN chr(160) || chr(10) ELSE headline END AS headline,
    CASE WHEN seq % 13 <> 0 THEN body END AS body,
    CASE WHEN seq % 11 <> 0 THEN published_at END AS published_at,
    CASE seq % 7 WHEN 0 THEN 'ftp://example.com/x' WHEN 1 THEN '' WHEN 2 THEN 'HTTP://EXAMPLE.com'
         ELSE source_url END AS source_url)"""


def sql_one_of(name: str, allowed) -> str:
    return (
        f"CASE WHEN coalesce({name}, '') NOT IN ({sql_list(allowed)[1:-1]}) "
        f"THEN '{name}: must be one of {', '.join(allowed)}' END"
    )


def sql_present(name: str) -> str:
    return f"CASE WHEN {name} IS NULL THEN '{name}: missing or unreadable' END"


def sql_not_blank(name: str) -> str:
    blank = f"coalesce({sql_strip(name)}, '') = ''"
    return f"CASE WHEN {blank} THEN '{name}: must not be empty or blank' END"


SQL_URL = """CASE WHEN NOT coalesce(regexp_matches(source_url, '^(?i:https?)://[^/\\s?#]+'), false)
    THEN 'source_url: must be an http(s) URL' END"""
SQL_ARTICLE_CHECKS = [
    sql_not_blank("article_id"),
    sql_not_blank("headline"),
    sql_present("body"),
    sql_one_of("section", SECTIONS),
    sql_present("published_at"),
    SQL_URL,
]
SQL_SUMMARY_LENGTH = f"length({sql_strip('summary')})"


def sql_messages(checks) -> str:
    return f"array_to_string(list_filter([{', '.join(checks)}], lambda x: x IS NOT NULL), '; ')"


@query(
    sql(
        f"SELECT seq, {sql_messages(SQL_ARTICLE_CHECKS)} AS failures FROM rows_",
        "articles",
        rows_=BROKEN + " FROM articles",
    )
)
def validate_articles(spark, sf_dir):
    rows = broken(articles(spark, sf_dir))
    return rows.select("seq", F.concat_ws("; ", article_failures()).alias("failures"))


@query(
    sql(
        "SELECT seq, "
        + sql_messages(
            [
                *SQL_ARTICLE_CHECKS,
                sql_present("summary"),
                f"CASE WHEN {SQL_SUMMARY_LENGTH} < 50 THEN 'summary: must be at least 50 "
                f"characters, got ' || {SQL_SUMMARY_LENGTH} END",
                f"CASE WHEN {SQL_SUMMARY_LENGTH} > 500 THEN 'summary: must be at most 500 "
                f"characters, got ' || {SQL_SUMMARY_LENGTH} END",
                "CASE WHEN len(entities) > 5 THEN 'entities: must have at most 5 items' END",
                "CASE WHEN len(list_filter(entities, lambda e: "
                f"{sql_strip('e')} = '')) > 0 "
                "THEN 'entities: each must be a non-empty string' END",
                sql_one_of("sentiment", SENTIMENTS),
                sql_not_blank("sentiment_reason"),
                sql_one_of("domain_tag", DOMAIN_TAGS),
            ]
        )
        + " AS failures FROM rows_",
        "articles",
        "enriched",
        rows_=BROKEN + " FROM enriched",
    )
)
def validate_enriched_articles(spark, sf_dir):
    rows = broken(enriched(spark, sf_dir))
    return rows.select("seq", F.concat_ws("; ", enriched_failures()).alias("failures"))


TEST_DIM = 64


def with_vectors(spark, sf_dir):
    """Enriched articles with the test vectors, some of them cut short."""
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("seq"),
        F.when(F.col("vec_id") % 9 == 0, F.slice("embedding", 1, 10))
        .otherwise(F.col("embedding"))
        .alias("embedding"),
    )
    rows = enriched(spark, sf_dir).join(vectors, "seq", "left")
    return rows.withColumn(
        "validated_at", F.when(F.col("seq") % 8 != 0, F.col("enriched_at"))
    )


SQL_SIZE = "CASE WHEN e.vec_id IS NULL THEN 0 WHEN e.vec_id % 9 = 0 THEN 10 ELSE 64 END"


@query(
    sql(
        "SELECT seq, "
        + sql_messages(
            [
                sql_present("article_id"),
                sql_present("headline"),
                sql_present("body"),
                sql_one_of("section", SECTIONS),
                sql_present("summary"),
                sql_one_of("sentiment", SENTIMENTS),
                sql_one_of("domain_tag", DOMAIN_TAGS),
                f"CASE WHEN size <> {TEST_DIM} THEN "
                f"'Embedding dimension mismatch: expected {TEST_DIM}, got ' || size END",
                "CASE WHEN seq % 8 = 0 THEN 'validated_at: missing or unreadable' END",
            ]
        )
        + " AS failures FROM sized",
        "articles",
        "enriched",
        sized=f"SELECT a.*, {SQL_SIZE} AS size FROM enriched a "
        "LEFT JOIN embeddings e ON e.vec_id = a.seq",
    )
)
def validate_validated_articles(spark, sf_dir):
    rows = with_vectors(spark, sf_dir)
    return rows.select("seq", F.concat_ws("; ", validated_failures(TEST_DIM)).alias("failures"))


@query(
    f"""SELECT size AS n, CASE WHEN size <> {TEST_DIM} THEN
          'Embedding dimension mismatch: expected {TEST_DIM}, got ' || size END AS problem,
          count(*) AS vectors
        FROM (SELECT CASE WHEN vec_id % 9 = 0 THEN 10 ELSE len(embedding) END AS size
              FROM embeddings) GROUP BY ALL"""
)
def check_dimensions(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select(
        F.when(F.col("vec_id") % 9 == 0, F.slice("embedding", 1, 10))
        .otherwise(F.col("embedding"))
        .alias("embedding")
    )
    return (
        vectors.select(
            F.size("embedding").cast("long").alias("n"),
            check_dim("embedding", TEST_DIM).alias("problem"),
        )
        .groupBy("n", "problem")
        .agg(F.count(F.lit(1)).alias("vectors"))
    )


@query(
    sql(
        """SELECT seq, CASE WHEN seq % 6 = 0 THEN 'missing required field: article_id'
             WHEN seq % 10 = 1 THEN 'missing required field: headline'
             WHEN seq % 15 = 2 THEN 'missing required field: body' END AS error
           FROM articles""",
        "articles",
    )
)
def require_fields(spark, sf_dir):
    """The first required field that is missing or empty; white space passes."""
    seq = F.col("seq")
    rows = articles(spark, sf_dir).withColumns(
        {
            "article_id": F.when(seq % 6 == 0, "").otherwise(F.col("article_id")),
            "headline": F.when(seq % 10 != 1, F.concat(F.lit(" "), "headline")),
            "body": F.when(seq % 15 == 2, "").otherwise(F.concat(F.lit(" "), "body")),
        }
    )
    return rows.select("seq", first_missing("article_id", "headline", "body").alias("error"))


GATE_AS_OF = "2024-01-20 12:00:00"
SQL_EXPECTATIONS = sql_messages(
    [
        "CASE WHEN coalesce(length(summary), 0) NOT BETWEEN 50 AND 500 THEN 'summary_length: ' "
        "|| coalesce(length(summary), 0) || ' not in [50, 500]' END",
        "CASE WHEN coalesce(sentiment, '') NOT IN ('Negative', 'Neutral', 'Positive') THEN "
        "'sentiment: ''' || coalesce(sentiment, '') || ''' not in "
        "{''Negative'', ''Neutral'', ''Positive''}' END",
        f"CASE WHEN published_at < TIMESTAMP '{GATE_AS_OF}' - INTERVAL 7 DAY THEN "
        "'recency: published_at ' || strftime(published_at, '%Y-%m-%dT%H:%M:%S') "
        "|| '+00:00 older than 7 days' END",
    ]
)


@query(sql(f"SELECT seq, {SQL_EXPECTATIONS} AS failures FROM enriched", "articles", "enriched"))
def check_expectations(spark, sf_dir):
    failures = expectation_failures(GATE_AS_OF)
    return enriched(spark, sf_dir).select("seq", F.concat_ws("; ", failures).alias("failures"))


@query(
    sql(
        f"""SELECT published_at < TIMESTAMP '{GATE_AS_OF}' - INTERVAL 7 DAY AS old, count(*) AS n,
                   {sql_time("max(published_at)")} AS newest FROM articles GROUP BY 1""",
        "articles",
    )
)
def recency(spark, sf_dir):
    old = too_old(GATE_AS_OF).alias("old")
    return (
        articles(spark, sf_dir)
        .groupBy(old)
        .agg(
            F.count(F.lit(1)).alias("n"), shown_time(F.max("published_at")).alias("newest")
        )
    )


@query(
    sql(
        f"""SELECT seq, article_id, 'GX validation failed: ' || failures AS _error,
                   '{AS_OF}' AS _failed_at, '{STAGE_GATE}' AS _failed_stage,
                   md5(body) AS original_body_md5
            FROM (SELECT *, {SQL_EXPECTATIONS} AS failures FROM enriched) WHERE failures <> ''""",
        "articles",
        "enriched",
    )
)
def dead_letters(spark, sf_dir):
    """Articles that fail an expectation, with reason, stage and the original."""
    rows = enriched(spark, sf_dir).withColumn("_failures", expectation_failures(GATE_AS_OF))
    _, failed = split(rows)
    letters = dead_letter(failed, gate_error(F.col("_failures")), AS_OF, STAGE_GATE)
    return letters.select(
        "seq",
        "article_id",
        "_error",
        shown_time("_failed_at").alias("_failed_at"),
        "_failed_stage",
        F.md5(F.get_json_object("value", "$.body")).alias("original_body_md5"),
    )


@query(
    sql(
        f"""SELECT failures = '' AS passed, count(*) AS n, sum(seq)::BIGINT AS seq_sum
            FROM (SELECT seq, {SQL_EXPECTATIONS} AS failures FROM enriched) GROUP BY 1""",
        "articles",
        "enriched",
    )
)
def gate_split(spark, sf_dir):
    """Every row ends up on exactly one side of the split."""
    rows = enriched(spark, sf_dir).withColumn("_failures", expectation_failures(GATE_AS_OF))
    passed, failed = split(rows)
    both = passed.select("seq", F.lit(True).alias("passed")).unionByName(
        failed.select("seq", F.lit(False).alias("passed"))
    )
    return both.groupBy("passed").agg(
        F.count(F.lit(1)).alias("n"), F.sum("seq").alias("seq_sum")
    )


SQL_GATE_ERROR = f"""coalesce(
    CASE WHEN coalesce(summary, '') = '' THEN 'missing required field: summary' END,
    'GX validation failed: ' || nullif({SQL_EXPECTATIONS}, ''),
    nullif({sql_messages([sql_one_of("section", SECTIONS), sql_one_of("domain_tag", DOMAIN_TAGS)])},
           ''))"""


@query(
    sql(
        f"""SELECT seq, error, CASE WHEN stopped IS NULL THEN {EMBEDDING_DIM} END AS dims
            FROM (SELECT seq, {SQL_GATE_ERROR} AS error,
                         coalesce(CASE WHEN coalesce(summary, '') = '' THEN 'x' END,
                                  nullif({SQL_EXPECTATIONS}, '')) AS stopped FROM enriched)""",
        "articles",
        "enriched",
    )
)
def gate_articles(spark, sf_dir):
    """The whole gate: required fields, expectations, embedding, final contract."""
    checked = quality_gate(enriched(spark, sf_dir), hashing_embedder(), GATE_AS_OF)
    return checked.select(
        "seq", F.col("_error").alias("error"), F.size("embedding").alias("dims")
    )


@query(
    sql(
        f"""SELECT {", ".join(f for f in STORED_FIELDS if f not in ("entities", "published_at"))},
                   array_to_string(entities, ',') AS entities,
                   {sql_time("published_at")} AS published_at FROM enriched""",
        "articles",
        "enriched",
    )
)
def project_stored_fields(spark, sf_dir):
    """Only the properties the store keeps."""
    kept = project_fields(enriched(spark, sf_dir), STORED_FIELDS)
    return kept.withColumns(
        {
            "entities": F.array_join("entities", ","),
            "published_at": shown_time("published_at"),
        }
    )


@query(
    sql(
        """SELECT a.article_id, sha256(a.article_id) AS uuid, CAST(a.published_at AS DATE)::VARCHAR
                  AS dt, len(e.embedding) AS dims
           FROM enriched a JOIN embeddings e ON e.vec_id = a.seq""",
        "articles",
        "enriched",
    )
)
def stored_rows(spark, sf_dir):
    """Rows as they are written to the store."""
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("seq"), "embedding"
    )
    rows = as_stored(enriched(spark, sf_dir).join(vectors, "seq"))
    return rows.select(
        "article_id",
        "uuid",
        F.col("dt").cast("string").alias("dt"),
        F.size("embedding").cast("long").alias("dims"),
    )
