"""Prompts, model replies and enrichment with a rule in place of a model."""

from __future__ import annotations

import json
import time
from collections.abc import Sequence

from pyspark.sql import functions as F

from gazette.functions.vectors import embed_text, hashing_embedder
from gazette.operators.enrich import (
    PROMPTS,
    build_context,
    coerce_sentiment,
    coerce_summary,
    coerce_tag,
    enrich,
    parse_unified,
    render_prompt,
)
from gazette.operators.gate import embedding_text
from gazette.operators.route import as_json
from gazette.plans.stages import enrich_stage, gate_stage, route_stage

from gazette.schemas import (
    ARTICLE,
    DOMAIN_TAGS,
    SECTIONS,
    SENTIMENTS,
    SUMMARY_MAX,
    TOPIC_ENRICHED,
    TOPIC_RAW,
)
from gazette.session import cut_lineage
from gazette.workload.base import (
    ALL_SENTIMENTS,
    ALL_TAGS,
    AS_OF,
    articles,
    enriched,
    pick,
    query,
    sql,
    sql_list,
    sql_strip,
    sql_text,
    sql_words,
)
from gazette.workload.gate import GATE_AS_OF

SQL_CONTEXT = "headline || chr(10) || chr(10) || substr(body, 1, 1500)"
SQL_WHOLE = "headline || chr(10) || chr(10) || body"


@query(
    sql(
        f"""SELECT seq, length({SQL_CONTEXT}) AS n_chars, md5({SQL_CONTEXT}) AS context_md5
            FROM articles""",
        "articles",
    )
)
def model_context(spark, sf_dir):
    context = build_context()
    return articles(spark, sf_dir).select(
        "seq", F.length(context).cast("long").alias("n_chars"), F.md5(context).alias("context_md5")
    )


def _sql_prompt(kind: str) -> str:
    before, after = PROMPTS[kind].split("{article}")
    return f"md5({sql_text(before)} || {SQL_CONTEXT} || {sql_text(after)})"


@query(
    sql(
        "SELECT seq, "
        + ", ".join(f'{_sql_prompt(kind)} AS "{kind}"' for kind in PROMPTS)
        + " FROM articles",
        "articles",
    )
)
def model_prompts(spark, sf_dir):
    return articles(spark, sf_dir).select(
        "seq", *[F.md5(render_prompt(kind, build_context())).alias(kind) for kind in PROMPTS]
    )


# --- replies ----------------------------------------------------------------------


def replies(spark, sf_dir):
    """Model replies of many shapes: fenced, padded, cut, nulls, wrong types."""
    seq = F.col("seq")
    lead = F.substring("body", 1, 60)
    record = F.struct(
        F.when(seq % 12 != 1, F.concat(F.lit("  "), lead)).alias("summary"),
        F.when(seq % 6 != 2, F.array(F.lit(" a "), F.lit(""), lead, F.lit("0"))).alias("entities"),
        F.when(seq % 12 != 3, pick((*ALL_SENTIMENTS, " Positive"), seq % 5)).alias("sentiment"),
        F.when(seq % 4 != 1, F.lit(" because ")).alias("sentiment_reason"),
        F.when(seq % 5 != 1, pick((*ALL_TAGS, "AI\n"), seq % 10)).alias("domain_tag"),
    )
    plain = F.to_json(record)
    nulls = F.concat(
        F.lit('{"summary": null, "sentiment": null, "sentiment_reason": null, "domain_tag": null,'),
        F.lit(' "entities": [1, 0, null, false, true, "x", 2.5, " "]}'),
    )
    return articles(spark, sf_dir).select(
        "seq",
        F.when(seq % 10 == 0, F.concat(F.lit("```json\n"), plain, F.lit("\n``` ")))
        .when(seq % 10 == 1, F.concat(F.lit("```"), plain, F.lit("```")))
        .when(seq % 10 == 2, F.concat(F.lit("["), plain, F.lit("]")))
        .when(seq % 10 == 3, F.concat(F.lit("Sure: "), plain))
        .when(seq % 10 == 4, nulls)
        .otherwise(plain)
        .alias("reply"),
    )


SQL_LEAD = "substr(body, 1, 60)"
PARSED_CTES = {
    "shaped": f"""SELECT seq, seq % 10 AS shape, CASE WHEN seq % 12 <> 1 THEN {SQL_LEAD} END AS s,
        {SQL_LEAD} AS lead_,
        CASE WHEN seq % 12 <> 3
             THEN {sql_list((*ALL_SENTIMENTS, " Positive"))}[CAST(seq % 5 AS INT) + 1] END AS sent,
        CASE WHEN seq % 4 <> 1 THEN 'because' ELSE '' END AS reason,
        CASE WHEN seq % 5 <> 1 THEN {sql_list((*ALL_TAGS, "AI"))}[CAST(seq % 10 AS INT) + 1]
             END AS tag
        FROM articles""",
    "judged": """SELECT *, CASE WHEN shape IN (2, 3) THEN false WHEN shape = 4 THEN true
        ELSE s IS NOT NULL AND sent IS NOT NULL END AS readable FROM shaped""",
}


@query(
    sql(
        f"""SELECT seq, readable,
              CASE WHEN readable THEN CASE WHEN shape = 4 THEN 'None'
                   ELSE {sql_strip("s")} END END AS summary,
              CASE WHEN readable THEN CASE WHEN shape = 4 THEN '1|True|x|2.5|'
                   WHEN seq % 6 = 2 THEN ''
                   WHEN lead_ = '' THEN 'a|0'
                   ELSE 'a|' || {sql_strip("lead_")} || '|0' END END AS entities,
              CASE WHEN readable THEN CASE WHEN shape <> 4
                    AND trim(sent) IN ({sql_list(SENTIMENTS)[1:-1]})
                   THEN trim(sent) ELSE 'Neutral' END END AS sentiment,
              CASE WHEN readable THEN CASE WHEN shape = 4 THEN 'None' ELSE reason END END AS reason,
              CASE WHEN readable THEN CASE WHEN shape <> 4 AND tag IN ({sql_list(DOMAIN_TAGS)[1:-1]})
                   THEN tag ELSE 'Other' END END AS domain_tag
            FROM judged""",
        "articles",
        **PARSED_CTES,
    )
)
def parse_replies(spark, sf_dir):
    parsed = parse_unified(replies(spark, sf_dir), F.col("reply"), into="p")
    return parsed.select(
        "seq",
        F.col("p").isNotNull().alias("readable"),
        F.col("p.summary").alias("summary"),
        F.array_join("p.entities", "|").alias("entities"),
        F.col("p.sentiment").alias("sentiment"),
        F.col("p.sentiment_reason").alias("reason"),
        F.col("p.domain_tag").alias("domain_tag"),
    )


SQL_LONG = f"CASE WHEN length(x) > {SUMMARY_MAX} THEN substr(x, 1, {SUMMARY_MAX - 3}) || '...' ELSE x END"


@query(
    sql(
        f"""SELECT seq, {SQL_LONG} AS summary,
              CASE WHEN sentiment IN ({sql_list(SENTIMENTS)[1:-1]}) THEN sentiment
                   ELSE 'Neutral' END AS sentiment,
              CASE WHEN domain_tag IN ({sql_list(DOMAIN_TAGS)[1:-1]}) THEN domain_tag
                   ELSE 'Other' END AS domain_tag
            FROM (SELECT *, {sql_strip("summary")} AS x FROM enriched)""",
        "articles",
        "enriched",
    )
)
def coerce_fields(spark, sf_dir):
    return enriched(spark, sf_dir).select(
        "seq",
        coerce_summary(F.col("summary")).alias("summary"),
        coerce_sentiment(F.concat(F.col("sentiment"), F.lit("\n"))).alias("sentiment"),
        coerce_tag(F.concat(F.lit(" "), F.col("domain_tag"))).alias("domain_tag"),
    )


# --- a rule in place of a model -------------------------------------------------------


def rule_model():
    """A model whose replies follow from the length of the article it is shown.

    Some unified replies are fenced and some are unreadable, so that the
    separate prompts are used; some articles make every call fail.
    """
    starts = {kind: text.split("{article}")[0] for kind, text in PROMPTS.items()}

    def reply_to(prompt: str) -> str:
        kind, start = next((k, s) for k, s in starts.items() if prompt.startswith(s))
        article = prompt[len(start) :]
        n = len(article)
        if n % 11 == 0:
            raise TimeoutError(f"no reply for {n} characters")
        answers = {
            "summary": article[: 40 + n % 100],
            "entities": article.split()[: n % 7],
            "sentiment": ALL_SENTIMENTS[n % 4],
            "sentiment_reason": f"{n} characters",
            "domain_tag": ALL_TAGS[n % 9],
        }
        if kind == "unified":
            if n % 5 == 0:
                return "I would rather not."
            text = json.dumps(answers)
            return f"```json\n{text}\n```" if n % 3 == 0 else text
        if kind == "entities":
            return json.dumps(answers["entities"])
        if kind == "sentiment":
            return json.dumps(
                {"sentiment": answers["sentiment"], "reason": answers["sentiment_reason"]}
            )
        return answers[kind]

    def model(prompts: Sequence[str]) -> list[str]:
        return [reply_to(p) for p in prompts]

    return model


SQL_TOKENS = (
    r"list_filter(regexp_split_to_array(ctx, '[\s\x0b\x1c-\x1f\x{85}\pZ]+'), lambda x: x <> '')"
)
RULE_CTES = {
    "shown": f"SELECT *, {SQL_CONTEXT} AS ctx, length({SQL_CONTEXT}) AS n FROM articles",
    "answered": f"""SELECT seq, n, section, article_id,
        {sql_strip("substr(ctx, 1, CAST(40 + n % 100 AS INT))")} AS summary,
        {SQL_TOKENS}[1:least(CAST(n % 7 AS INT), 5)] AS entities,
        {sql_list(ALL_SENTIMENTS)}[CAST(n % 4 AS INT) + 1] AS sent,
        {sql_list(ALL_TAGS)}[CAST(n % 9 AS INT) + 1] AS tag FROM shown""",
    "judged": f"""SELECT *, coalesce(
        CASE WHEN n % 11 = 0 THEN 'no reply for ' || n || ' characters' END,
        nullif(array_to_string(list_filter([
            CASE WHEN section NOT IN ({sql_list(SECTIONS)[1:-1]})
                 THEN 'section: must be one of {", ".join(SECTIONS)}' END,
            CASE WHEN length(summary) < 50
                 THEN 'summary: must be at least 50 characters, got ' || length(summary) END
            ], lambda x: x IS NOT NULL), '; '), '')) AS error FROM answered""",
}


@query(
    sql(
        f"""SELECT seq, error,
              CASE WHEN n % 11 <> 0 THEN summary END AS summary,
              CASE WHEN n % 11 <> 0 THEN array_to_string(entities, '|') END AS entities,
              CASE WHEN n % 11 <> 0 THEN
                   CASE WHEN sent = 'Mixed' THEN 'Neutral' ELSE sent END END AS sentiment,
              CASE WHEN n % 11 <> 0 THEN n || ' characters' END AS reason,
              CASE WHEN n % 11 <> 0 THEN CASE WHEN tag = 'Sports' THEN 'Other' ELSE tag END END
                   AS domain_tag
            FROM judged""",
        "articles",
        **RULE_CTES,
    )
)
def enrich_articles(spark, sf_dir):
    """Whole enrichment: prompt, reply, fallback, coercion, contract."""
    done = enrich(articles(spark, sf_dir), rule_model, AS_OF)
    return done.select(
        "seq",
        F.col("_error").alias("error"),
        "summary",
        F.array_join("entities", "|").alias("entities"),
        "sentiment",
        F.col("sentiment_reason").alias("reason"),
        "domain_tag",
    )


HANGING = 499
WITHIN = 3


def hanging_model():
    """The same model, which does not come back for some articles."""
    model = rule_model()
    starts = [text.split("{article}")[0] for text in PROMPTS.values()]

    def slow(prompts: Sequence[str]) -> list[str]:
        for prompt in prompts:
            start = next(x for x in starts if prompt.startswith(x))
            if len(prompt[len(start) :]) % HANGING == 0:
                time.sleep(3 * WITHIN)
        return model(prompts)

    return slow


@query(
    sql(
        f"""SELECT seq, CASE WHEN n % {HANGING} = 0 THEN 'no reply within {WITHIN} seconds'
                        ELSE error END AS error,
              CASE WHEN n % 11 <> 0 AND n % {HANGING} <> 0 THEN summary END AS summary,
              CASE WHEN n % 11 <> 0 AND n % {HANGING} <> 0 THEN n || ' characters' END AS reason
            FROM judged""",
        "articles",
        **{k: v.replace(SQL_CONTEXT, SQL_WHOLE) for k, v in RULE_CTES.items()},
    )
)
def enrich_within_deadlines(spark, sf_dir):
    """Whole bodies; a call that hangs costs its own article only."""
    done = enrich(
        articles(spark, sf_dir), hanging_model, AS_OF, body_chars=None, seconds=WITHIN, at_once=16
    )
    return done.select(
        "seq", F.col("_error").alias("error"), "summary", F.col("sentiment_reason").alias("reason")
    )


def article_log(spark, sf_dir):
    """The articles as raw messages, logged a second after one another."""
    rows = articles(spark, sf_dir)
    return rows.select(
        F.col("article_id").alias("key"),
        as_json(rows, ARTICLE.fieldNames()).alias("value"),
        F.col("seq").alias("offset"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("seq")).alias("timestamp"),
        F.lit(TOPIC_RAW).alias("topic"),
    )


@query(
    sql(
        """SELECT 'enrich' AS stage,
                  CASE WHEN error IS NULL THEN 'enriched-news' ELSE 'news-failed' END AS topic,
                  count(*) AS n, sum(seq)::BIGINT AS seq_sum FROM picked GROUP BY ALL
           UNION ALL
           SELECT 'gate', CASE WHEN fresh THEN 'validated-news' ELSE 'news-failed' END,
                  count(*), sum(seq)::BIGINT FROM picked WHERE error IS NULL GROUP BY ALL""",
        "articles",
        **RULE_CTES,
        firsts=f"""SELECT seq, row_number() OVER (PARTITION BY article_id ORDER BY seq) AS rn,
                   {sql_words("body")} AS words, published_at FROM articles""",
        picked=f"""SELECT j.*, f.published_at >= TIMESTAMP '{GATE_AS_OF}' - INTERVAL 7 DAY AS fresh
                   FROM judged j JOIN firsts f USING (seq) WHERE rn = 1 AND words >= 200""",
    )
)
def staged_messages(spark, sf_dir):
    """Raw messages through routing, enrichment and the gate: messages per topic."""
    routed = route_stage(article_log(spark, sf_dir))
    # Read by the next stage and by the counts: written once, as a topic would be.
    enriched_log = cut_lineage(enrich_stage(routed, rule_model, AS_OF))
    passed = enriched_log.where(F.col("topic") == TOPIC_ENRICHED)
    gated = gate_stage(passed, hashing_embedder(), GATE_AS_OF)
    both = enriched_log.select(F.lit("enrich").alias("stage"), "topic", "offset").unionByName(
        gated.select(F.lit("gate").alias("stage"), "topic", "offset")
    )
    return both.groupBy("stage", "topic").agg(
        F.count(F.lit(1)).alias("n"), F.sum("offset").alias("seq_sum")
    )


HASH_DIM = 64


def _hashed(text: str, source: str) -> dict[str, str]:
    return {
        "words": rf"""SELECT seq, unnest(list_filter(regexp_split_to_array(
                {text}, '[\s\x0b\x1c-\x1f\x{{85}}\pZ]+'), lambda x: x <> '')) AS word FROM {source}""",
        "counts": f"""SELECT seq, ('0x' || substr(sha256(word), 1, 8))::UBIGINT % {HASH_DIM} AS bucket,
                             count(*) AS c FROM words GROUP BY ALL""",
        "norms": "SELECT seq, sqrt(sum(c * c)) AS norm FROM counts GROUP BY seq",
    }


@query(
    sql(
        f"""SELECT t.seq, bucket::BIGINT AS bucket, round(c / norm, 4) AS weight
            FROM counts t JOIN norms USING (seq)""",
        "articles",
        "enriched",
        **_hashed("headline || ' ' || coalesce(summary, '')", "enriched"),
    )
)
def embed_articles(spark, sf_dir):
    """Vectors of headline and summary, as their non-zero positions."""
    return _weights(enriched(spark, sf_dir), embedding_text())


@query(
    sql(
        """SELECT t.seq, bucket::BIGINT AS bucket, round((c / norm)::FLOAT::DOUBLE, 4) AS weight
            FROM counts t JOIN norms USING (seq)""",
        "articles",
        **_hashed("body", "articles"),
    )
)
def embed_bodies(spark, sf_dir):
    """Vectors of whole bodies, as their non-zero positions."""
    return _weights(articles(spark, sf_dir), F.coalesce("body", F.lit("")))


def _weights(rows, text):
    rows = rows.select("seq", embed_text(text, hashing_embedder(HASH_DIM), HASH_DIM).alias("e"))
    return (
        rows.select("seq", F.posexplode("e.vector").alias("bucket", "weight"))
        .where("weight <> 0")
        .select("seq", F.col("bucket").cast("long").alias("bucket"),
                F.round(F.col("weight").cast("double"), 4).alias("weight"))
    )
