"""An inverted file of vectors: approximate candidates, ranked exactly.

Centroids are fitted on a bounded sample; every row is filed under the centroid that is
nearest by angle, in a parquet table partitioned by centroid. A question opens the lists of
its nearest centroids only and ranks what is in them exactly. Rows can be added at
any time: the centroids stay, and so does what is filed.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.functions.vectors import _matrix
from gazette.operators.search import QUESTION_BLOCK, STORE_BLOCK, best_of_cells

SAMPLE = 20_000  # rows the centroids are fitted on
MOST_CENTROIDS = 2_048
ROUNDS = 8
RECALL = 0.95  # of the nearest ten, within the sample; decides how many lists a question opens
ASKED = 500  # rows of the sample that are asked to find that number


def _unit_rows(rows: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return rows / np.linalg.norm(rows, axis=1)[:, None]


def _fitted(sample: np.ndarray, n: int, seed: int = 7) -> np.ndarray:
    """Centroids of length one, by rounds of assigning and averaging."""
    rng = np.random.default_rng(seed)
    centroids = sample[rng.choice(len(sample), n, replace=False)]
    for _ in range(ROUNDS):
        nearest = (sample @ centroids.T).argmax(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        lost = np.linalg.norm(sums, axis=1) == 0
        sums[lost] = sample[rng.choice(len(sample), int(lost.sum()))]
        centroids = _unit_rows(sums)
    return centroids


def _probes(sample: np.ndarray, fitted: np.ndarray, recall: float) -> int:
    """How many lists questions must open to find that share of their nearest ten in the sample."""
    asked = sample[:ASKED]
    near = np.argsort(-(asked @ sample.T), axis=1, kind="stable")[:, :10]
    own = (sample @ fitted.T).argmax(1)
    opened = np.argsort(-(asked @ fitted.T), axis=1, kind="stable").argsort(1)
    needed = np.sort(np.take_along_axis(opened, own[near], 1).ravel())
    return int(needed[min(len(needed) - 1, int(recall * len(needed)))]) + 1


def build_index(
    store: DataFrame,
    path: str,
    key: str = "article_id",
    vector: str = "embedding",
    centroids: int | None = None,
    sample: int = SAMPLE,
    recall: float = RECALL,
) -> None:
    """Write an index of all rows of ``store`` that have a key and a usable vector.

    The sample is that of the smallest hashed keys, so it is the same in every run. There are
    as many lists as the root of the number of rows, at most ``MOST_CENTROIDS``. How many of them
    a question opens is measured on the sample, for ``recall``, and kept with the centroids.
    """
    spark = store.sparkSession
    rows = store.select(key, vector).where(F.col(key).isNotNull() & F.col(vector).isNotNull())
    some = rows.orderBy(F.xxhash64(key)).limit(sample).select(F.col(vector).cast("array<double>")).toArrow()
    lengths = pc.list_value_length(some.column(0)).to_pylist()
    dim = max(set(lengths), key=lengths.count) if lengths else 0
    found = _matrix(some.column(0).combine_chunks(), dim)[0] if dim else np.zeros((0, 0))
    found = _unit_rows(found)
    found = found[np.isfinite(found).all(1)] if dim else found
    n = min(centroids or max(1, isqrt(rows.count())), MOST_CENTROIDS, len(found))
    fitted = _fitted(found, n) if n else found
    probes = _probes(found, fitted, recall) if n else 0
    table = [(i, c.tolist(), probes) for i, c in enumerate(fitted)]
    spark.createDataFrame(table, "centroid int, c array<double>, probes int").coalesce(1).write.mode("overwrite").parquet(
        f"{path}/centroids"
    )
    _file(rows, path, key, vector, fitted, "overwrite")


def add_to_index(rows: DataFrame, path: str, key: str = "article_id", vector: str = "embedding") -> None:
    """File more rows; only the new ones are read and written."""
    rows = rows.select(key, vector).where(F.col(key).isNotNull() & F.col(vector).isNotNull())
    fitted = _centroids(rows.sparkSession, path)[0]
    if not len(fitted):
        raise ValueError("the index was built of nothing; build it again")
    _file(rows, path, key, vector, fitted, "append")


def _centroids(spark: SparkSession, path: str) -> tuple[np.ndarray, int]:
    rows = spark.read.parquet(f"{path}/centroids").orderBy("centroid").collect()  # MOST_CENTROIDS at most
    return np.array([r["c"] for r in rows]), rows[0]["probes"] if rows else 0


def _file(rows: DataFrame, path: str, key: str, vector: str, fitted: np.ndarray, mode: str) -> None:
    filed = _nearest(rows.select(F.col(key).alias("_key"), F.col(vector).alias("_v")), "_v", fitted, 1)
    # a list with many rows is spread over several files
    filed.hint("rebalance", "centroid").write.mode(mode).partitionBy("centroid").parquet(f"{path}/lists")


def _nearest(rows: DataFrame, vector: str, fitted: np.ndarray, n: int) -> DataFrame:
    """``rows`` once for each of the ``n`` nearest centroids; rows without a usable vector go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, usable = _matrix(batch.column(vector), fitted.shape[1] if len(fitted) else -1)
            v = _unit_rows(v)
            good = np.isfinite(v).all(1)
            at = np.flatnonzero(usable)[good] if len(fitted) else np.zeros(0, np.int64)
            if not len(at):
                continue
            near = np.argsort(-(v[good] @ fitted.T), axis=1, kind="stable")[:, :n]
            taken = batch.take(pa.array(np.repeat(at, near.shape[1])))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(near.ravel().astype(np.int32))], names=[*batch.schema.names, "centroid"]
            )

    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)
    return rows.mapInArrow(run, f"{schema}, centroid int")


def search_index(
    spark: SparkSession,
    path: str,
    questions: DataFrame,
    k: int = 5,
    key: str = "article_id",
    probes: int | None = None,
    block: int = QUESTION_BLOCK,
) -> DataFrame:
    """(question, key, distance, rank) from the lists that ``questions`` (id, vector) open.

    Only the partitions of lists that some question opens are read. A list with many rows,
    or many questions, is dealt over a grid of blocks. A question that finds fewer than ``k`` rows in
    its lists gets these.
    """
    fitted, measured = _centroids(spark, path)
    if not len(fitted):
        return spark.createDataFrame([], f"question long, `{key}` string, distance double, rank int")
    asked = questions.toDF("question", "_q").where("question is not null and _q is not null")
    asked = asked.select(F.col("question").cast("long"), F.col("_q").cast("array<double>"))
    asked = _nearest(asked, "_q", fitted, measured if probes is None else probes)
    wanted = {r["centroid"]: r["n"] for r in asked.groupBy("centroid").agg(F.count("*").alias("n")).collect()}
    lists = spark.read.parquet(f"{path}/lists").where(F.col("centroid").isin(sorted(wanted)))
    sizes = {r["centroid"]: r["n"] for r in lists.groupBy("centroid").agg(F.count("*").alias("n")).collect()}
    grid = [(c, -(-wanted[c] // block), -(-n // STORE_BLOCK)) for c, n in sizes.items()]
    # a row for each list: MOST_CENTROIDS at most
    grid = F.broadcast(spark.createDataFrame(grid, "centroid int, across int, down int"))

    def dealt(rows: DataFrame, column: str, own: str, other: str, name: str, every: str) -> DataFrame:
        return (
            rows.join(grid, "centroid")
            .withColumn(name, F.pmod(F.xxhash64(F.col(column)), F.col(own)).cast("int"))
            .withColumn(every, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
            .drop("across", "down")
        )

    left = dealt(asked, "question", "across", "down", "_a", "_d")
    rows = lists.select("_key", F.col("_v").cast("array<double>").alias("_v"), "centroid")
    right = dealt(rows, "_key", "down", "across", "_d", "_a")
    return best_of_cells(left, right, ["centroid", "_a", "_d"], k, lists.schema["_key"], key)
