"""From a question to ranked articles and an answer prompt."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.functions.vectors import EmbedderFactory, similarity
from gazette.operators.enrich import ModelFactory, infer
from gazette.operators.search import knn, rag_context, rag_prompt, with_rank


def find_articles(store: DataFrame, question: str, factory: EmbedderFactory, k: int = 5):
    """The ``k`` stored articles nearest to a question, ranked, with similarity."""
    query = factory()([question])[0]
    return with_rank(knn(store, query, k)).withColumn("similarity", similarity("distance"))


def answer_prompt(hits: DataFrame, question: str) -> DataFrame:
    """One row: the context built from the hits and the prompt around it."""
    return rag_context(hits).withColumn("prompt", rag_prompt(question, F.col("context")))


def answer(hits: DataFrame, question: str, model: ModelFactory) -> DataFrame:
    """One row: the model's reply to the answer prompt."""
    asked = answer_prompt(hits, question).withColumn("_r", infer(F.array("prompt"), model))
    return asked.select("context", F.get("_r", 0)["text"].alias("answer"))
