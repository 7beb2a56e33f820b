"""Vector search, ranking and the answer prompt."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gazette.functions.vectors import embed_text, hashing_embedder, similarity
from gazette.operators.gate import embedding_text
from gazette.operators.index import add_to_index, build_index, search_index
from gazette.operators.search import (
    context_block,
    knn,
    knn_many,
    rag_context,
    rag_contexts,
    rag_prompt,
    with_rank,
)
from gazette.schemas import EMBEDDING_DIM
from gazette.session import checkpoint_root
from gazette.workload.base import enriched, query, sql, sql_text, table

K = 10
QUESTION = "What moved the markets this week?"


def one_vector(spark, sf_dir) -> list[float]:
    """The vector a question would be turned into: here the first stored one."""
    vectors = table(spark, sf_dir, "embeddings")
    return vectors.where("vec_id = 0").first()["embedding"]


SQL_NEAREST = f"""SELECT vec_id, round(d, 6) AS distance FROM (
      SELECT e.vec_id, 1 - list_cosine_similarity(e.embedding::DOUBLE[],
             (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0)) AS d
      FROM embeddings e) ORDER BY d, vec_id LIMIT {K}"""


@query(SQL_NEAREST)
def knn_cosine(spark, sf_dir):
    hits = knn(
        table(spark, sf_dir, "embeddings"), one_vector(spark, sf_dir), K, tie_break="vec_id"
    )
    return hits.select("vec_id", F.round("distance", 6).alias("distance"))


@query(
    f"""SELECT vec_id, round(greatest(0, 1 - distance), 5) AS similarity,
               round(greatest(0, 1 - distance) * 100)::BIGINT AS percent
        FROM ({SQL_NEAREST})"""
)
def match_strength(spark, sf_dir):
    hits = knn_cosine(spark, sf_dir)
    strength = similarity("distance")
    return hits.select(
        "vec_id",
        F.round(strength, 5).alias("similarity"),
        F.round(strength * 100).cast("long").alias("percent"),
    )


@query(
    """SELECT question::BIGINT AS question, vec_id, round(d, 6) AS distance, rank FROM (
         SELECT q.label AS question, e.vec_id, d,
                row_number() OVER (PARTITION BY q.label ORDER BY d, e.vec_id) AS rank
         FROM (SELECT label, arg_min(embedding, vec_id)::DOUBLE[] AS v
               FROM embeddings GROUP BY label) q,
              embeddings e,
              LATERAL (SELECT 1 - list_cosine_similarity(e.embedding::DOUBLE[], q.v) AS d))
       WHERE rank <= 5"""
)
def knn_many_questions(spark, sf_dir):
    """One question per label: the first vector of the label."""
    vectors = table(spark, sf_dir, "embeddings")
    firsts = vectors.groupBy("label").agg(F.min("vec_id").alias("vec_id"))
    chosen = vectors.join(firsts, ["label", "vec_id"], "left_semi").select("label", "embedding")
    found = knn_many(vectors, chosen, 5, key="vec_id")
    return found.select(
        "question",
        "vec_id",
        F.round("distance", 6).alias("distance"),
        F.col("rank").cast("long").alias("rank"),
    )


TWENTIETH = f"""SELECT q.vec_id AS question, e.vec_id, d,
        row_number() OVER (PARTITION BY q.vec_id ORDER BY round(d, 12), e.vec_id) AS rank
    FROM embeddings q, embeddings e,
         LATERAL (SELECT 1 - list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS d)
    WHERE q.vec_id % 20 = 0 QUALIFY rank <= {K}"""


def every_twentieth(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return vectors.where("vec_id % 20 = 0").select("vec_id", "embedding")


def nearest_of_twentieth(spark, sf_dir):
    return knn_many(
        table(spark, sf_dir, "embeddings"), every_twentieth(spark, sf_dir), K, key="vec_id"
    )


@query(f"SELECT question, vec_id, round(d, 6) AS distance, rank FROM ({TWENTIETH})")
def knn_every_twentieth(spark, sf_dir):
    """All vectors whose id is divisible by 20 ask the whole store."""
    return nearest_of_twentieth(spark, sf_dir).select(
        "question",
        "vec_id",
        F.round("distance", 6).alias("distance"),
        F.col("rank").cast("long").alias("rank"),
    )


@query("SELECT count(*) AS questions, true AS found_nine_of_ten FROM embeddings WHERE vec_id % 20 = 0")
def index_recall(spark, sf_dir):
    """The same questions asked of an index, half of it added later: the share of true hits."""
    vectors = table(spark, sf_dir, "embeddings")
    path = f"{checkpoint_root(spark).rstrip('/')}/index-{uuid.uuid4().hex}"
    build_index(vectors.where("vec_id % 2 = 0"), path, key="vec_id")
    add_to_index(vectors.where("vec_id % 2 != 0"), path, key="vec_id")
    found = search_index(spark, path, every_twentieth(spark, sf_dir), K, key="vec_id")
    true = nearest_of_twentieth(spark, sf_dir).select("question", "vec_id")
    told = true.join(found.select("question", "vec_id", F.lit(1).alias("hit")), ["question", "vec_id"], "left")
    return told.agg(
        F.count_distinct("question").alias("questions"),
        (F.coalesce(F.avg(F.coalesce("hit", F.lit(0))), F.lit(1)) >= 0.9).alias("found_nine_of_ten"),
    )


RANKED = f"""SELECT a.*, d, row_number() OVER (ORDER BY d, seq) AS rank
    FROM (SELECT e.vec_id, 1 - list_cosine_similarity(e.embedding::DOUBLE[],
                 (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0)) AS d
          FROM embeddings e) n JOIN enriched a ON a.seq = n.vec_id
    ORDER BY d, seq LIMIT {K}"""
SQL_BLOCK = """'[' || rank || '] ' || coalesce(headline, 'Untitled')
    || chr(10) || '    Summary: ' || coalesce(summary, 'N/A')
    || chr(10) || '    Sentiment: ' || coalesce(sentiment, 'N/A')
    || ' | Tag: ' || coalesce(domain_tag, 'N/A')
    || chr(10) || '    Entities: ' || coalesce(array_to_string(entities, ', '), '')
    || chr(10) || '    Source: ' || coalesce(source_url, 'N/A')"""


def ranked_hits(spark, sf_dir):
    """Vectors are ranked on their own; the articles join the few that are left."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("seq"), "embedding")
    known = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq"))
    near = knn(
        vectors.join(known, "seq", "left_semi"), one_vector(spark, sf_dir), K, tie_break="seq"
    )
    return with_rank(near, "seq").join(enriched(spark, sf_dir), "seq")


@query(
    sql(f"SELECT rank, seq, {SQL_BLOCK} AS block FROM ranked", "articles", "enriched", ranked=RANKED)
)
def context_blocks(spark, sf_dir):
    hits = ranked_hits(spark, sf_dir)
    return hits.select(
        F.col("rank").cast("long").alias("rank"),
        "seq",
        context_block(F.col("rank")).alias("block"),
    )


@query(
    sql(
        f"""SELECT question, md5(string_agg({SQL_BLOCK}, chr(10) || chr(10) ORDER BY rank)) AS context_md5
            FROM (SELECT t.question, t.rank, a.* FROM twentieth t JOIN enriched a ON a.seq = t.vec_id)
            GROUP BY question""",
        "articles",
        "enriched",
        twentieth=TWENTIETH,
    )
)
def answer_contexts(spark, sf_dir):
    """A context for each of many questions; only the hits join the articles."""
    hits = nearest_of_twentieth(spark, sf_dir).withColumnRenamed("vec_id", "seq")
    found = hits.join(enriched(spark, sf_dir), "seq")
    return rag_contexts(found).select("question", F.md5("context").alias("context_md5"))


@query(
    sql(
        f"SELECT string_agg({SQL_BLOCK}, chr(10) || chr(10) ORDER BY rank) AS context FROM ranked",
        "articles",
        "enriched",
        ranked=RANKED,
    )
)
def answer_context(spark, sf_dir):
    return rag_context(ranked_hits(spark, sf_dir))


PROMPT_HEAD = (
    "Answer the question from the numbered articles below and from nothing else. Cite "
    "them as [1], [2] and so on, and say so if they do not hold the answer.\n\nArticles:\n"
)


@query(
    sql(
        f"""SELECT md5({sql_text(PROMPT_HEAD)} || string_agg({SQL_BLOCK}, chr(10) || chr(10)
                   ORDER BY rank) || {sql_text(f"{chr(10)}{chr(10)}Question:{chr(10)}{QUESTION}")}
                   || {sql_text(f"{chr(10)}{chr(10)}Answer:")}) AS prompt_md5 FROM ranked""",
        "articles",
        "enriched",
        ranked=RANKED,
    )
)
def answer_prompts(spark, sf_dir):
    context = rag_context(ranked_hits(spark, sf_dir))
    return context.select(F.md5(rag_prompt(QUESTION, F.col("context"))).alias("prompt_md5"))


HASHED = {
    "words": r"""SELECT seq, unnest(list_filter(regexp_split_to_array(
            headline || ' ' || coalesce(summary, ''), '[\s\x0b\x1c-\x1f\x{85}\pZ]+'),
            lambda x: x <> '')) AS word FROM enriched""",
    "counts": f"""SELECT seq, ('0x' || substr(sha256(word), 1, 8))::UBIGINT % {EMBEDDING_DIM}
            AS bucket, count(*) AS c FROM words GROUP BY ALL""",
    "norms": "SELECT seq, sqrt(sum(c * c)) AS norm FROM counts GROUP BY seq",
    "q": "SELECT bucket, c / (SELECT norm FROM norms WHERE seq = 3) AS w FROM counts WHERE seq = 3",
    "near": """SELECT n.seq, 1 - coalesce(sum(c.c / n.norm * q.w), 0) AS d
            FROM norms n JOIN counts c USING (seq) LEFT JOIN q USING (bucket) GROUP BY n.seq""",
}


@query(
    sql(
        """SELECT seq, round(d, 5) AS distance FROM near ORDER BY round(d, 5), seq LIMIT 5""",
        "articles",
        "enriched",
        **HASHED,
    )
)
def ask_articles(spark, sf_dir):
    """From the text of a question to the nearest articles, all vectors computed here."""
    rows = enriched(spark, sf_dir)
    asked = rows.where("seq = 3").select(embedding_text().alias("t")).first()["t"]
    store = rows.withColumn("embedding", embed_text(embedding_text(), hashing_embedder())["vector"])
    query_vector = hashing_embedder()()([asked])[0]
    return knn(store, query_vector, 5, tie_break="seq", digits=5).select("seq", "distance")


