"""Registry, table adapters and SQL building blocks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.functions.text import hash16
from gazette.schemas import DEFAULT_TOPIC, DOMAIN_TAGS, SECTION_TOPICS, SECTIONS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF = "2024-01-31 00:00:00"


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL it must equal."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# One section the library does not know, so that defaults are exercised.
ALL_SECTIONS = (*SECTIONS, "entertainment")
ALL_SENTIMENTS = ("Positive", "Negative", "Neutral", "Mixed")
ALL_TAGS = (*DOMAIN_TAGS, "Sports")


def pick(values, index):
    """The value at a 0-based position."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles. Equal texts share an id, which gives real duplicates."""
    doc = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc/"), hash16("text")).alias("article_id"),
        F.substring("text", 1, 120).alias("headline"),
        F.col("text").alias("body"),
        pick(ALL_SECTIONS, doc % 6).alias("section"),
        (
            F.lit("2024-01-01 00:00:00").cast("timestamp")
            + F.make_dt_interval(F.lit(0), F.lit(0), ((doc % 1000) * 43).cast("int"))
        ).alias("published_at"),
        F.concat(F.lit("https://example.com/"), "source", F.lit("/"), doc.cast("string")).alias(
            "source_url"
        ),
        doc.alias("seq"),
        "lang",
    )


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with enrichment fields, some of which break the contract."""
    doc = F.col("seq")
    words = F.split(F.substring("body", 1, 200), " ")
    return articles(spark, sf_dir).withColumns(
        {
            "summary": F.when(
                doc % 19 != 0, F.substring("body", 5, (20 + (doc * 37) % 560).cast("int"))
            ),
            "entities": F.slice(words, 1, (doc % 7).cast("int")),
            "sentiment": F.when(doc % 23 != 0, pick(ALL_SENTIMENTS, doc % 4)),
            "sentiment_reason": pick(("tone of the lead", "wording", " ", "figures"), doc % 4),
            "domain_tag": F.when(doc % 29 != 0, pick(ALL_TAGS, doc % 9)),
            "enriched_at": F.col("published_at") + F.expr("INTERVAL '1' HOUR"),
        }
    )


# --- SQL -----------------------------------------------------------------------


def sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


SQL_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\pZ]"


def sql_words(column: str) -> str:
    return (
        f"len(list_filter(regexp_split_to_array({column}, '{SQL_SPACE}+'), "
        "lambda x: x <> ''))"
    )


def sql_strip(column: str) -> str:
    return (
        f"regexp_replace(regexp_replace({column}, '^{SQL_SPACE}+', ''), '{SQL_SPACE}+$', '')"
    )


def sql_time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def shown_time(column) -> F.Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


SQL_TOPIC = (
    "CASE section "
    + " ".join(f"WHEN '{s}' THEN '{t}'" for s, t in SECTION_TOPICS.items())
    + f" ELSE '{DEFAULT_TOPIC}' END"
)

CTES = {
    "articles": f"""articles AS (
        SELECT 'doc/' || substr(sha256(text), 1, 16) AS article_id,
               substr(text, 1, 120) AS headline, text AS body,
               {sql_list(ALL_SECTIONS)}[CAST(doc_id % 6 AS INT) + 1] AS section,
               TIMESTAMP '2024-01-01 00:00:00' + to_minutes((doc_id % 1000) * 43) AS published_at,
               'https://example.com/' || source || '/' || doc_id AS source_url,
               doc_id AS seq, lang
        FROM documents)""",
    "enriched": f"""enriched AS (
        SELECT *,
               CASE WHEN seq % 19 <> 0
                    THEN substr(body, 5, CAST(20 + (seq * 37) % 560 AS INT)) END AS summary,
               string_split(substr(body, 1, 200), ' ')[1:CAST(seq % 7 AS INT)] AS entities,
               CASE WHEN seq % 23 <> 0
                    THEN {sql_list(ALL_SENTIMENTS)}[CAST(seq % 4 AS INT) + 1] END AS sentiment,
               ['tone of the lead', 'wording', ' ', 'figures'][CAST(seq % 4 AS INT) + 1]
                    AS sentiment_reason,
               CASE WHEN seq % 29 <> 0
                    THEN {sql_list(ALL_TAGS)}[CAST(seq % 9 AS INT) + 1] END AS domain_tag,
               published_at + INTERVAL 1 HOUR AS enriched_at
        FROM articles)""",
}


def sql(body: str, *ctes: str, **more: str) -> str:
    """``body`` after the named common table expressions and further ones."""
    parts = [CTES[name] for name in ctes] + [f"{n} AS ({text})" for n, text in more.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
