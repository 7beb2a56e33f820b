"""Hard negatives of anchor vectors by exact inner products of packed integers.

Components are whole numbers. Several candidates' components, biased so that none is
negative, stand in separated fields of one wide integer; an anchor's component multiplies
them all at once. The sum over the components holds each candidate's product in its own field:
a second bias keeps fields from borrowing from each other, and both are taken off again. The
width of a field follows from the norms at hand. As long as two fields take at most 53 bits the
integers are exact in doubles and the sums are a matrix product; otherwise they are
Python's integers, which have no limit.

Anchors and candidates are dealt over a grid of cells, a block of each, and every cell
hands on its best few for each anchor.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazette.llm.common import arrow_map, scratch

BLOCK = 8192  # anchors, and candidates, of a cell
AT_ONCE = 256  # anchors of a cell that are multiplied at the same time
POSITIVES, NEGATIVES = 5, 3
EXACT_BITS = 53
WIDE_FIELDS = 16  # to a wide integer, where no two fit into a double


def whole_vectors(rows: DataFrame, vector: str = "embedding", steps: int = 256) -> DataFrame:
    """``rows`` with ``v`` in place of ``vector``: floor(steps * x) of its components, as doubles.

    ``v`` is null where the vector is null or holds a null or a value that is not finite,
    also after it is multiplied.
    """

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        lists = batch.column(vector)
        length = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        values = pc.cast(lists.flatten(), pa.float64())
        with np.errstate(over="ignore"):
            whole = np.floor(steps * values.to_numpy(zero_copy_only=False).astype(float))
        ends = np.append(0, np.cumsum(length))
        bad = np.append(0, np.cumsum(~np.isfinite(whole)))[ends]
        unusable = (np.diff(bad) > 0) | pc.is_null(lists).to_numpy(zero_copy_only=False)
        whole = whole + 0.0  # no negative zero
        packed = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(),
            len(lists),
            [None, pa.py_buffer((8 * ends).astype(np.int64)), pa.py_buffer(whole)],
        )
        return [pc.if_else(pa.array(unusable), None, pc.cast(packed, pa.binary()))]

    return arrow_map(rows, run, "v binary", drop=(vector,))


def _bits(norm_a: float, norm_b: float) -> int:
    """Enough for any product of integers of such squared norms, and its sign."""
    return (2 * (isqrt(int(norm_a)) + 1) * (isqrt(int(norm_b)) + 1)).bit_length() + 1


class Packed:
    """Candidates, biased and packed, to be multiplied by blocks of anchors."""

    def __init__(self, candidates: np.ndarray, most_norm: float):
        """``most_norm``: the largest squared norm of an anchor."""
        self.n = len(candidates)
        self.bias = -min(float(candidates.min(initial=0.0)), 0.0)
        raised = candidates + self.bias
        if float(np.abs(raised).max(initial=0.0)) >= 2.0**EXACT_BITS:
            self.bias = int(self.bias)
            raised = np.array([[int(x) + self.bias for x in row] for row in candidates.tolist()], object)
            norm = max((sum(x * x for x in row) for row in raised.tolist()), default=0)
        else:
            norm = float((raised**2).sum(1).max(initial=0.0)) * (1 + 1e-9)
        self.width = _bits(most_norm * (1 + 1e-9) if isinstance(most_norm, float) else most_norm, norm)
        fields = EXACT_BITS // self.width
        self.exact = fields >= 2 and raised.dtype != object
        fields = fields if self.exact else WIDE_FIELDS
        kind = float if self.exact else object
        if kind is object and raised.dtype != object:
            raised = np.array([[int(x) for x in row] for row in raised.tolist()], object).reshape(raised.shape)
        groups = -(-self.n // fields)
        padded = np.zeros((groups * fields, candidates.shape[1]), kind)
        padded[: self.n] = raised
        # candidate f * groups + g stands in field f of integer g
        self.fields = padded.reshape(fields, groups, candidates.shape[1])
        factor = [(1 << (self.width * f)) if kind is object else float(1 << (self.width * f)) for f in range(fields)]
        self.words = sum(x * y for x, y in zip(self.fields, factor, strict=True))

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """The inner products (anchors, candidates), exact; beyond a long the nearest long."""
        half, number = 1 << (self.width - 1), len(self.fields)
        level = sum(half << (self.width * f) for f in range(number))
        mask = (1 << self.width) - 1
        if self.exact:
            total = (anchors @ self.words.T).astype(np.int64) + level
            back = (self.bias * anchors.sum(1)).astype(np.int64)
        else:
            whole = np.array([[int(x) for x in row] for row in anchors.tolist()], object)
            whole = whole.reshape(anchors.shape)
            total = (whole @ self.words.T) + level if anchors.shape[1] else np.full(
                (len(anchors), len(self.words)), level, object
            )
            back = int(self.bias) * whole.sum(1) if anchors.shape[1] else np.zeros(len(anchors), object)
        parts = [((total >> (self.width * f)) & mask) - half for f in range(number)]
        out = np.concatenate(parts, axis=1)[:, : self.n] - back[:, None]
        return out if self.exact else np.clip(out, -(2**63), 2**63 - 1)


def _matrix(values: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.float64).reshape(len(values), -1)


def _norms(matrix: np.ndarray) -> float | int:
    """The largest squared norm."""
    most = float((matrix**2).sum(1).max(initial=0.0))
    if most < 2.0**EXACT_BITS:
        return most
    return max(sum(int(x) ** 2 for x in row) for row in matrix.tolist())


def _best(row: np.ndarray, score: np.ndarray, identity: np.ndarray, k: int) -> np.ndarray:
    """The places of the ``k`` highest scores of each row, ties by identity."""
    order = np.lexsort((identity, -score, row))
    ordered = row[order]
    first = np.searchsorted(ordered, ordered, side="left")
    return order[np.arange(len(order)) - first < k]


def _ranked(scores: np.ndarray) -> np.ndarray:
    """Numbers in the order of the scores, small enough to be negated and sorted."""
    if scores.dtype != object:
        return scores
    steps = {x: n for n, x in enumerate(sorted(set(scores.tolist())))}
    return np.array([steps[x] for x in scores.tolist()], np.int64)


def _over_grid(anchors: DataFrame, rows: DataFrame, function, schema: str, block: int) -> DataFrame:
    """``function`` on (anchors, candidates) of every cell of one vector length."""
    counted = anchors.agg(F.count("*")).first()[0], rows.agg(F.count("*")).first()[0]
    across, down = (max(1, -(-n // block)) for n in counted)
    own = F.pmod(F.xxhash64(F.lit(3), "vec_id", "v"), F.lit(across)).cast("int")
    other = F.pmod(F.xxhash64(F.lit(4), "vec_id", "v"), F.lit(down)).cast("int")
    left = anchors.withColumn("_a", own).withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(down - 1))))
    right = rows.withColumn("_c", other).withColumn("_a", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    cell = [F.length("v").alias("_size"), "_a", "_c"]
    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(function, schema)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: float = 0.5,
    most: float = 0.95,
    block: int = BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` has vec_id, label and the vector ``v`` of ``whole_vectors``. Of each row for which
    ``is_anchor`` holds, the positives are the rows of other ids and the same label that score
    highest; the negatives of a positive are the best of another label whose score is
    ``least`` to ``most`` times the positive's, both in hundredths. Ties go to the smaller id.

    Rows with a null id, label or vector take no part; vectors of different lengths do not
    meet. Of repeated rows each is a candidate; equal anchors count once, and anchors that share
    an id only are anchors of their own. A score beyond a long counts as the nearest long.
    """
    low, high = round(100 * least), round(100 * most)
    rows = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "v", is_anchor.alias("_is"))
    rows = scratch(rows.where("vec_id is not null and label is not null and v is not null"))
    anchors = rows.where("_is").select("vec_id", "label", "v").distinct()
    anchors = scratch(anchors.withColumn("aid", F.xxhash64("label", "v")))
    rows = rows.drop("_is")

    def nearest(here: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        out = []
        for label, of in here.groupby("label"):
            others = there[there["label"] == label].sort_values("vec_id", kind="stable")
            if not len(others):
                continue
            vectors, ids = _matrix(of["v"]), others["vec_id"].to_numpy()
            packed = Packed(_matrix(others["v"]), _norms(vectors))
            for at in range(0, len(of), AT_ONCE):
                part = of.iloc[at : at + AT_ONCE]
                scores = packed.scores(vectors[at : at + AT_ONCE])
                ranked = _ranked(scores.ravel()).reshape(scores.shape)
                ranked = np.where(ids[None, :] == part["vec_id"].to_numpy()[:, None], -(2**62), ranked)
                if len(ids) > positives:
                    bound = np.partition(ranked, -positives, axis=1)[:, -positives]
                    row, column = np.nonzero((ranked >= bound[:, None]) & (ranked > -(2**62)))
                else:
                    row, column = np.nonzero(ranked > -(2**62))
                keep = _best(row, ranked[row, column], ids[column], positives)
                row, column = row[keep], column[keep]
                out.append((part["vec_id"].to_numpy()[row], part["aid"].to_numpy()[row], ids[column], scores[row, column]))
        return _table(out, ("anchor_id", "aid", "positive_id", "positive_score"))

    found = _over_grid(
        anchors, rows, nearest, "anchor_id long, aid long, positive_id long, positive_score long", block
    )
    by = Window.partitionBy("anchor_id", "aid").orderBy(F.desc("positive_score"), "positive_id")
    found = scratch(found.withColumn("_n", F.row_number().over(by)).where(F.col("_n") <= positives))
    each = found.groupBy("anchor_id", "aid").agg(
        F.sort_array(F.collect_list(F.struct("_n", "positive_score"))).alias("_p")
    )
    asked = anchors.join(
        each.select(F.col("anchor_id").alias("vec_id"), "aid", F.col("_p.positive_score").alias("wanted")),
        ["vec_id", "aid"],
    )

    def harder(here: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        out = []
        if not len(here) or not len(there):
            return _table(out, ("anchor_id", "aid", "_n", "negative_id", "negative_score"))
        there = there.sort_values("vec_id", kind="stable")
        ids, labels = there["vec_id"].to_numpy(), there["label"].to_numpy()
        vectors = _matrix(here["v"])
        packed = Packed(_matrix(there["v"]), _norms(vectors))
        for at in range(0, len(here), AT_ONCE):
            part = here.iloc[at : at + AT_ONCE]
            scores = packed.scores(vectors[at : at + AT_ONCE])
            kind = np.int64 if scores.dtype != object else object
            wanted = [[int(x) for x in each] for each in part["wanted"]]
            other = part["label"].to_numpy()[:, None] != labels[None, :]
            # no band begins below the lowest or ends above the highest positive's
            floor = np.array([min(low * x for x in w) for w in wanted], kind)
            ceiling = np.array([max(high * x for x in w) for w in wanted], kind)
            row, column = np.nonzero(
                other & (100 * scores >= floor[:, None]) & (100 * scores <= ceiling[:, None])
            )
            score = scores[row, column]
            ranked, hundred = _ranked(score), 100 * score
            for n in range(positives):
                p = np.array([w[n] if n < len(w) else 0 for w in wanted], kind)
                there_is = np.array([n < len(w) for w in wanted])
                in_band = there_is[row] & (low * p[row] <= hundred) & (hundred <= high * p[row])
                mine = np.flatnonzero(in_band.astype(bool))
                keep = mine[_best(row[mine], ranked[mine], ids[column[mine]], negatives)]
                r = row[keep]
                out.append(
                    (part["vec_id"].to_numpy()[r], part["aid"].to_numpy()[r], np.full(len(r), n + 1), ids[column[keep]], score[keep])
                )
        return _table(out, ("anchor_id", "aid", "_n", "negative_id", "negative_score"))

    hard = _over_grid(
        asked, rows, harder, "anchor_id long, aid long, _n int, negative_id long, negative_score long", block
    )
    by = Window.partitionBy("anchor_id", "aid", "_n").orderBy(F.desc("negative_score"), "negative_id")
    hard = hard.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= negatives)
    return hard.join(found, ["anchor_id", "aid", "_n"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def _table(parts: list[tuple], names: tuple[str, ...]) -> pd.DataFrame:
    columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [[] for _ in names]
    return pd.DataFrame({n: np.asarray(c, np.int64) for n, c in zip(names, columns, strict=True)})


SQL = """
WITH q AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
           list_inner_product(a.v, c.v)::BIGINT AS score
    FROM q a JOIN q c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id
                               ORDER BY score DESC, other_id) AS INT) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
