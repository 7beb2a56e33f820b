"""Vector search over stored articles and the answer prompt built from it."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from itertools import batched

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette.functions.vectors import _matrix, cosine_distance, unit

# A block of questions travels to every task inside the function; this bounds it.
QUESTION_BLOCK = 1024
# Rows of the store that meet a block of questions in one cell.
STORE_BLOCK = 8192


def knn(
    store: DataFrame,
    query: Sequence[float],
    k: int = 5,
    vector: str = "embedding",
    tie_break: str = "article_id",
    digits: int | None = None,
) -> DataFrame:
    """The ``k`` rows nearest to ``query`` by cosine distance, nearest first.

    Exact: every vector is compared, and each task hands on at most ``k`` rows. With
    ``digits`` the distance is rounded before it is ranked, so near ties are ties.
    """
    distance = cosine_distance(vector, query)
    measured = store.withColumn("distance", distance if digits is None else F.round(distance, digits))
    nearest = measured.orderBy(F.col("distance").asc_nulls_last(), tie_break).limit(k)
    # After the limit: a filter before it would work out every distance twice.
    return nearest.where(F.col("distance").isNotNull())


def knn_many(
    store: DataFrame,
    questions: Mapping[int, Sequence[float]] | DataFrame,
    k: int = 5,
    key: str = "article_id",
    vector: str = "embedding",
    block: int = QUESTION_BLOCK,
) -> DataFrame:
    """The ``k`` nearest keys for each question: ``(question, key, distance, rank)``.

    A mapping is worked in blocks that travel to every task of a scan of the store. A
    table of (id, vector) may be as long as the store: both are dealt over a grid, and each
    of its cells multiplies a block of questions with a block of the store. Either way
    ``k`` rows for each question and task or cell are shuffled, never a row for each pair.
    """
    if isinstance(questions, DataFrame):
        return _knn_grid(store, questions, k, key, vector, block)
    blocks = [_knn_block(store, dict(some), k, key, vector) for some in batched(questions.items(), block)]
    if not blocks:
        raise ValueError("no questions")
    return reduce(DataFrame.union, blocks)


def _knn_grid(
    store: DataFrame, questions: DataFrame, k: int, key: str, vector: str, block: int
) -> DataFrame:
    """Rows without an id or a vector are left out; vectors of other lengths do not meet."""
    asked = questions.toDF("question", "_q").where("question is not null and _q is not null")
    asked = asked.select(F.col("question").cast("long"), F.col("_q").cast("array<double>"))
    rows = store.select(F.col(key).alias("_key"), F.col(vector).cast("array<double>").alias("_v"))
    rows = rows.where("_key is not null and _v is not null")
    across = max(1, -(-asked.count() // block))
    down = max(1, -(-rows.count() // STORE_BLOCK))

    def blocks(column: str, n: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(n), column), F.lit(n)).cast("int")

    every = [F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (down, across)]
    left = asked.withColumn("_a", blocks("question", across)).withColumn("_d", every[0])
    right = rows.withColumn("_d", blocks("_key", down)).withColumn("_a", every[1])
    return best_of_cells(left, right, ["_a", "_d"], k, store.schema[key], key)


def best_of_cells(
    asked: DataFrame, rows: DataFrame, cell: list[str], k: int, key: T.StructField, name: str
) -> DataFrame:
    """The ``k`` nearest rows of each question among the cells in which it meets them.

    ``asked`` has (question, _q) and ``rows`` (_key, _v) beside the columns of ``cell``. A cell is a
    block of either, so its product is bounded. Distances that differ by less than 1e-12
    tie, and ties go to the smaller key.
    """
    schema = T.StructType(
        [
            T.StructField("question", T.LongType()),
            T.StructField(name, key.dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )

    def best(here: pa.Table, there: pa.Table) -> pa.Table:
        there = there.sort_by("_key").combine_chunks()
        here = here.combine_chunks()
        found = []
        lengths = pc.unique(pc.list_value_length(here.column("_q"))).to_pylist() if len(here) else []
        for dim in [x for x in lengths if x]:
            q, is_q = _matrix(_whole(here.column("_q")), dim)
            v, is_v = _matrix(_whole(there.column("_v")), dim)
            if not len(q) or not len(v):
                continue
            with np.errstate(divide="ignore", invalid="ignore"):
                q = q / np.linalg.norm(q, axis=1)[:, None]
                distance = np.round(1.0 - (q @ v.T) / np.linalg.norm(v, axis=1), 12)
            distance[np.isnan(distance)] = np.inf
            bound = np.partition(distance, min(k, len(v)) - 1, axis=1)[:, min(k, len(v)) - 1]
            row, column = np.nonzero((distance <= bound[:, None]) & np.isfinite(distance))
            order = np.lexsort((column, distance[row, column], row))
            row, column = row[order], column[order]
            keep = np.arange(len(row)) - np.searchsorted(row, row) < k
            row, column = row[keep], column[keep]
            found.append((np.flatnonzero(is_q)[row], np.flatnonzero(is_v)[column], distance[row, column]))
        at_q, at_v, distance = (
            (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
        )
        return pa.table(
            {
                "question": here.column("question").take(pa.array(at_q)),
                name: there.column("_key").take(pa.array(at_v)),
                "distance": pa.array(distance, pa.float64()),
            }
        )

    nearest = asked.groupBy(*cell).cogroup(rows.groupBy(*cell)).applyInArrow(best, schema)
    ranked = Window.partitionBy("question").orderBy("distance", name)
    return nearest.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)


def _knn_block(
    store: DataFrame, questions: dict[int, Sequence[float]], k: int, key: str, vector: str
) -> DataFrame:
    ids = list(questions)
    wanted = np.stack([unit(questions[i]) for i in ids])
    dim = wanted.shape[1]
    key_type = store.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField("question", T.LongType()),
            T.StructField(key, key_type),
            T.StructField("distance", T.DoubleType()),
        ]
    )

    def best_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Per question the best (distance, key) pairs met so far.
        best: list[list] = [[] for _ in ids]
        key_arrow = None
        for batch in batches:
            key_arrow = batch.schema.field(key).type
            rows, usable = _matrix(batch.column(vector), dim)
            if not len(rows):
                continue
            keys = batch.column(key).filter(pa.array(usable)).to_pylist()
            with np.errstate(divide="ignore", invalid="ignore"):
                distances = 1.0 - (rows @ wanted.T) / np.linalg.norm(rows, axis=1)[:, None]
            for q, column in enumerate(distances.T):
                near = np.flatnonzero(~np.isnan(column))
                if len(near) > k:
                    bound = np.partition(column[near], k - 1)[k - 1]
                    near = near[column[near] <= bound]
                found = best[q] + [(column[i], keys[i]) for i in near]
                best[q] = sorted(found)[:k]
        out = [(ids[q], key_, float(d)) for q, pairs in enumerate(best) for d, key_ in pairs]
        if out:
            question, keys, distance = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(question, pa.int64()),
                    pa.array(keys, key_arrow),
                    pa.array(distance, pa.float64()),
                ],
                names=["question", key, "distance"],
            )

    ranked = Window.partitionBy("question").orderBy("distance", key)
    return (
        store.select(key, vector)
        .mapInArrow(best_of_task, schema)
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
    )


def context_block(rank: Column) -> Column:
    """One numbered source of the answer context."""

    def shown(name: str, default: str) -> Column:
        return F.coalesce(F.col(name), F.lit(default))

    # --- fixed format: the layout of one source ------------------------------
    return F.concat(
        F.lit("["), rank.cast("string"), F.lit("] "), shown("headline", "Untitled"),
        F.lit("\n    Summary: "), shown("summary", "N/A"),
        F.lit("\n    Sentiment: "), shown("sentiment", "N/A"),
        F.lit(" | Tag: "), shown("domain_tag", "N/A"),
        F.lit("\n    Entities: "), F.coalesce(F.array_join("entities", ", "), F.lit("")),
        F.lit("\n    Source: "), shown("source_url", "N/A"),
    )


def rag_context(hits: DataFrame, rank: str = "rank") -> DataFrame:
    """One row: the blocks of the ranked hits, joined by blank lines.

    ``hits`` is the result of a top-k search, so it is small by construction.
    """
    block = F.struct(F.col(rank).alias("rank"), context_block(F.col(rank)).alias("block"))
    return hits.agg(F.array_sort(F.collect_list(block)).alias("_blocks")).select(
        F.array_join(F.transform("_blocks", lambda b: b["block"]), "\n\n").alias("context")
    )


def rag_contexts(hits: DataFrame, question: str = "question", rank: str = "rank") -> DataFrame:
    """A context for each question: the blocks of its ranked hits, joined by blank lines.

    A question has as many hits as were asked for, so its group is small by construction.
    """
    block = F.struct(F.col(rank).alias("rank"), context_block(F.col(rank)).alias("block"))
    gathered = hits.groupBy(question).agg(F.array_sort(F.collect_list(block)).alias("_blocks"))
    return gathered.select(
        question, F.array_join(F.transform("_blocks", lambda b: b["block"]), "\n\n").alias("context")
    )


def with_rank(hits: DataFrame, tie_break: str = "article_id") -> DataFrame:
    """Number the hits of one question from 1, nearest first."""
    return hits.withColumn(
        "rank",
        F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("distance", tie_break)),
    )


def rag_prompt(question: str, context: Column) -> Column:
    """The prompt that asks a model to answer from the context alone."""
    return F.concat(
        F.lit(
            "Answer the question from the numbered articles below and from nothing else. Cite "
            "them as [1], [2] and so on, and say so if they do not hold the answer.\n\n"
            "Articles:\n"
        ),
        context,
        F.lit(f"\n\nQuestion:\n{question}\n\nAnswer:"),
    )
