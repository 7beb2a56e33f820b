"""Quality gate: expectations, embedding, final contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.functions.text import as_col
from gazette.functions.vectors import EmbedderFactory, embed_text
from gazette.operators.validate import (
    as_of_literal,
    expectation_failures,
    first_missing,
    gate_error,
    validated_failures,
)
from gazette.schemas import EMBEDDING_DIM, RECENCY_DAYS, SUMMARY_MAX, SUMMARY_MIN


def embedding_text(headline: Column | str = "headline", summary: Column | str = "summary"):
    """The text an article is embedded by."""
    return F.concat(
        F.coalesce(as_col(headline), F.lit("")),
        F.lit(" "),
        F.coalesce(as_col(summary), F.lit("")),
    )


def gate_check(
    as_of,
    min_length: int = SUMMARY_MIN,
    max_length: int = SUMMARY_MAX,
    recency_days: int = RECENCY_DAYS,
) -> Column:
    """What stops an article before it is embedded, NULL if nothing does."""
    return F.coalesce(
        first_missing("article_id", "headline", "summary"),
        gate_error(expectation_failures(as_of, min_length, max_length, recency_days)),
    )


def quality_gate(
    df: DataFrame,
    factory: EmbedderFactory,
    as_of,
    dim: int = EMBEDDING_DIM,
    recency_days: int = RECENCY_DAYS,
    min_length: int = SUMMARY_MIN,
    max_length: int = SUMMARY_MAX,
) -> DataFrame:
    """Enriched articles with ``embedding``, ``validated_at`` and ``_error``.

    ``_error`` is NULL for a good article. The embedder only sees articles that
    met every expectation.
    """
    stopped = gate_check(as_of, min_length, max_length, recency_days)
    checked = df.withColumn("_stopped", stopped)
    text = F.when(F.col("_stopped").isNull(), embedding_text())
    embedded = checked.withColumn("_embedded", embed_text(text, factory, dim)).withColumns(
        {
            "embedding": F.col("_embedded.vector"),
            "validated_at": F.when(F.col("_embedded.vector").isNotNull(), as_of_literal(as_of)),
        }
    )
    failures = validated_failures(dim)
    return embedded.withColumn(
        "_error",
        F.coalesce(
            F.col("_stopped"),
            F.col("_embedded.error"),
            F.when(F.size(failures) > 0, F.concat_ws("; ", failures)),
        ),
    ).drop("_stopped", "_embedded")
