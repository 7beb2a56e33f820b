"""Record contracts and the fixed values they refer to."""

from pyspark.sql import types as T

# --- fixed values: enumerations -------------------------------------------
SECTIONS = ("technology", "business", "money", "world", "science")
SENTIMENTS = ("Negative", "Neutral", "Positive")
DOMAIN_TAGS = (
    "AI",
    "Crypto",
    "Regulation",
    "Geopolitics",
    "Earnings",
    "Climate",
    "Cybersecurity",
    "Other",
)

# --- fixed values: topics, their routing and their retention ---------------
TOPIC_RAW = "raw-news"
TOPIC_TECH = "tech-news"
TOPIC_FINANCE = "finance-news"
TOPIC_WORLD = "world-news"
TOPIC_ENRICHED = "enriched-news"
TOPIC_VALIDATED = "validated-news"
TOPIC_FAILED = "news-failed"
# Records the routing stage cannot read at all; see ``plans.stages``.
TOPIC_CORRUPT = "news-corrupt"

SECTION_TOPICS = {
    "technology": TOPIC_TECH,
    "business": TOPIC_FINANCE,
    "money": TOPIC_FINANCE,
    "world": TOPIC_WORLD,
    "science": TOPIC_WORLD,
}
DEFAULT_TOPIC = TOPIC_WORLD

RETENTION_DAYS = {
    TOPIC_RAW: 1,
    TOPIC_TECH: 2,
    TOPIC_FINANCE: 2,
    TOPIC_WORLD: 2,
    TOPIC_ENRICHED: 2,
    TOPIC_VALIDATED: 2,
    TOPIC_FAILED: 7,
}

# --- fixed values: stage names written to dead letters ---------------------
STAGE_GATE = "quality-gate"
STAGE_INGEST = "weaviate-ingestion"
STAGE_ENRICH = "enrichment"

# --- fixed values: thresholds ----------------------------------------------
MIN_WORDS = 200
SEEN_TTL_HOURS = 48
BODY_CONTEXT_CHARS = 1500
SUMMARY_MIN = 50
SUMMARY_MAX = 500
MAX_ENTITIES = 5
RECENCY_DAYS = 7
EMBEDDING_DIM = 384
PRUNE_DAYS = 30
GAP_HOURS = 48

ARTICLE = T.StructType(
    [
        T.StructField("article_id", T.StringType()),
        T.StructField("headline", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("section", T.StringType()),
        T.StructField("published_at", T.TimestampType()),
        T.StructField("source_url", T.StringType()),
    ]
)

ENRICHED = T.StructType(
    ARTICLE.fields
    + [
        T.StructField("summary", T.StringType()),
        T.StructField("entities", T.ArrayType(T.StringType())),
        T.StructField("sentiment", T.StringType()),
        T.StructField("sentiment_reason", T.StringType()),
        T.StructField("domain_tag", T.StringType()),
        T.StructField("enriched_at", T.TimestampType()),
    ]
)

VALIDATED = T.StructType(
    ENRICHED.fields
    + [
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("validated_at", T.TimestampType()),
    ]
)

# The stored article: no body, no stage timestamps, plus the vector.
STORED_FIELDS = (
    "article_id",
    "headline",
    "summary",
    "entities",
    "sentiment",
    "sentiment_reason",
    "domain_tag",
    "section",
    "published_at",
    "source_url",
)

STORE = T.StructType(
    [f for f in ENRICHED.fields if f.name in STORED_FIELDS]
    + [
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("uuid", T.StringType()),
    ]
)

# A topic record at rest. An offset counts within its partition only, so records
# of one topic are ordered by LOG_ORDER; a log in files may have no partitions.
LOG_ORDER = ("timestamp", "partition", "offset")
LOG = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("topic", T.StringType()),
    ]
)

# JSON carries timestamps as text; they are parsed explicitly so that a bad
# one becomes NULL in one column instead of spoiling the whole record.
def json_form(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [
            T.StructField(
                f.name,
                T.StringType() if isinstance(f.dataType, T.TimestampType) else f.dataType,
            )
            for f in schema.fields
        ]
    )


TIMESTAMP_COLUMNS = ("published_at", "enriched_at", "validated_at")

# --- raw feed shapes, as DDL: importing this module must not need a session --
GUARDIAN_PAGE = (
    "response struct<results: array<struct<id: string, webTitle: string, webUrl: string, "
    "webPublicationDate: string, sectionId: string, "
    "fields: struct<headline: string, bodyText: string>>>>"
)
RSS_ENTRY = (
    "id string, link string, title string, summary string, description string, "
    "published string, updated string"
)
HN_ITEM = (
    "id bigint, type string, dead boolean, deleted boolean, title string, url string, "
    "text string, time bigint"
)
SOCIAL_POST = (
    "post struct<uri: string, record: struct<text: string, createdAt: string>, "
    "embed: struct<external: struct<title: string, uri: string, description: string>>>"
)

# --- fixed values: feeds and accounts and the section each one maps to ------
FEED_SECTIONS = {
    "http://feeds.bbci.co.uk/news/technology/rss.xml": "technology",
    "http://feeds.bbci.co.uk/news/business/rss.xml": "business",
    "http://feeds.bbci.co.uk/news/world/rss.xml": "world",
    "http://feeds.bbci.co.uk/news/science_and_environment/rss.xml": "science",
    "https://techcrunch.com/feed/": "technology",
    "https://feeds.arstechnica.com/arstechnica/index": "technology",
}
ACCOUNT_SECTIONS = {
    "theguardian.com": "world",
    "nytimes.com": "world",
    "reuters.com": "world",
    "washingtonpost.com": "world",
    "theverge.com": "technology",
    "techcrunch.com": "technology",
    "arstechnica.com": "technology",
    "wired.com": "technology",
}

# --- fixed values: title keywords, checked in this order --------------------
SECTION_KEYWORDS = {
    "business": ("startup", "funding", "vc", "valuation", "ipo", "revenue", "market"),
    "science": ("research", "study", "climate", "physics", "biology", "space", "nasa"),
    "world": ("government", "policy", "war", "election", "geopolit", "sanction"),
}
KEYWORD_DEFAULT = "technology"
