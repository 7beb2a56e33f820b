"""Vector expressions: embedding, dimension check, cosine distance."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette.functions.text import as_col
from gazette.schemas import EMBEDDING_DIM

# Called once per task; returns what turns texts into one vector per text.
EmbedderFactory = Callable[[], Callable[[Sequence[str]], np.ndarray]]

EMBEDDED = T.StructType(
    [
        T.StructField("vector", T.ArrayType(T.FloatType())),
        T.StructField("error", T.StringType()),
    ]
)


@lru_cache(maxsize=200_000)
def _token_number(token: str) -> int:
    return int(hashlib.sha256(token.encode()).hexdigest()[:8], 16)


def hashing_embedder(dim: int = EMBEDDING_DIM) -> EmbedderFactory:
    """A deterministic stand-in for a sentence model.

    Every token counts towards the bucket its hash selects; the vector of
    counts is scaled to unit length. Text without tokens gives a zero vector.
    """

    def factory() -> Callable[[Sequence[str]], np.ndarray]:
        def embed(texts: Sequence[str]) -> np.ndarray:
            tokens = [text.split() for text in texts]
            row = np.repeat(np.arange(len(texts)), [len(t) for t in tokens])
            buckets = np.fromiter(map(_token_number, chain.from_iterable(tokens)), np.int64) % dim
            out = np.bincount(row * dim + buckets, minlength=len(texts) * dim)
            out = out.astype(np.float64).reshape(-1, dim)
            norms = np.linalg.norm(out, axis=1, keepdims=True)
            return (out / np.where(norms == 0, 1, norms)).astype(np.float32)

        return embed

    return factory


def _run_embedder(model, texts: list[str], dim: int) -> list[tuple[list | None, str | None]]:
    def one_call(chunk: list[str]) -> list[tuple[list | None, str | None]]:
        vectors = [np.asarray(v, dtype=np.float32) for v in model(chunk)]
        return [
            (v, None)
            if len(v) == dim
            else (None, f"Embedding dimension mismatch: expected {dim}, got {len(v)}")
            for v in vectors
        ]

    try:
        return one_call(texts)
    except Exception as exc:  # halve the batch until the bad text is alone
        if len(texts) == 1:
            return [(None, str(exc))]
        half = len(texts) // 2
        return _run_embedder(model, texts[:half], dim) + _run_embedder(model, texts[half:], dim)


def embed_text(text: Column | str, factory: EmbedderFactory, dim: int = EMBEDDING_DIM) -> Column:
    """``struct<vector, error>`` for a text column.

    The model is built once per task and is given whole Arrow batches. It never
    sees a NULL text: NULL in, NULL vector and NULL error out.
    """

    @F.arrow_udf(EMBEDDED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = factory()
        for batch in batches:
            texts = batch.to_pylist()
            wanted = [i for i, t in enumerate(texts) if t is not None]
            found = _run_embedder(model, [texts[i] for i in wanted], dim) if wanted else []
            vectors: list = [None] * len(texts)
            errors: list = [None] * len(texts)
            for i, (vector, error) in zip(wanted, found):
                vectors[i], errors[i] = vector, error
            yield pa.StructArray.from_arrays(
                [pa.array(vectors, pa.list_(pa.float32())), pa.array(errors, pa.string())],
                names=["vector", "error"],
            )

    return run.asNondeterministic()(as_col(text))


def check_dim(vector: Column | str, dim: int) -> Column:
    """NULL for a vector of the right length, otherwise the reason."""
    size = F.coalesce(F.size(as_col(vector)), F.lit(0))
    size = F.when(as_col(vector).isNull(), F.lit(0)).otherwise(size)
    return F.when(
        size != dim,
        F.concat(
            F.lit(f"Embedding dimension mismatch: expected {dim}, got "), size.cast("string")
        ),
    )


def _matrix(vectors: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of length ``dim`` as rows, and which rows of the batch they are."""
    lengths = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    usable = lengths == dim
    flat = vectors.filter(pa.array(usable)).flatten()
    rows = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dim)
    return rows, usable


def unit(vector: Sequence[float]) -> np.ndarray:
    q = np.asarray(vector, dtype=np.float64)
    return q / np.linalg.norm(q)


def cosine_distance(vector: Column | str, query: Sequence[float]) -> Column:
    """``1 - cos(vector, query)``; NULL for a NULL, zero or wrongly sized vector."""
    wanted = unit(query)

    @F.arrow_udf(T.DoubleType())
    def distance(vectors: pa.Array) -> pa.Array:
        rows, usable = _matrix(vectors, len(wanted))
        out = np.full(len(vectors), np.nan)
        with np.errstate(divide="ignore", invalid="ignore"):
            out[usable] = 1.0 - (rows @ wanted) / np.linalg.norm(rows, axis=1)
        return pa.array(out, mask=np.isnan(out))

    return distance(as_col(vector))


def similarity(distance: Column | str) -> Column:
    """Match strength from a cosine distance, never below zero."""
    return F.greatest(F.lit(0.0), F.lit(1.0) - as_col(distance))
