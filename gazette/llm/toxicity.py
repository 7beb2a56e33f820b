"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over which words, and which beginnings of words, a text
has. It is trained in numpy from confirmed toxic documents and unlabelled ones: the
risk on negatives is that on unlabelled text less the positives' part in it, by
the class prior, and never allowed to fall below zero. Both samples are bounded by
parameters; the prior is taken over all labels, and all texts are scored whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import arrow_map, scratch, text_bytes

POSITIVES = 2_000  # labelled documents to learn from, at most
UNLABELLED = 6_000  # others, whose labels are not looked at
FEATURES = 4_000
HELD = 150_000  # features that a task counts before it hands them on
PREFIXES = (4, 5, 6, 7)  # bytes
LEAST_DOCUMENTS = 8
LEAST_EXPECTED = 3  # toxic documents that have a feature, or would have it by chance
LEAST_Z = 6.0
LEAST_RATIO = 2.0  # of the shares of toxic and unlabelled documents that have a feature
ROUNDS = 300
DECAY = 1e-3
THRESHOLD = 0.3

# Marks become spaces and A-Z become a-z; bytes over 127 stay.
_FOLD = bytes(
    ord(chr(c).lower()) if chr(c).isalnum() or c > 127 else 32 for c in range(128)
) + bytes(range(128, 256))


def features(text: bytes) -> set[bytes]:
    """The words of a text, and their beginnings marked by their length."""
    words = set(text.translate(_FOLD).split())
    found = {b"=" + w for w in words}
    for k in PREFIXES:
        found |= {b"%d" % k + w[:k] for w in words if len(w) >= k}
    return found


@dataclass
class Classifier:
    """Weights of features; without any, every score is 0."""

    weights: dict[bytes, float]
    bias: float

    def split(self) -> tuple[dict[bytes, float], dict[int, dict[bytes, float]]]:
        whole = {f[1:]: w for f, w in self.weights.items() if f[:1] == b"="}
        parts = {
            k: {f[1:]: w for f, w in self.weights.items() if f[:1] == b"%d" % k} for k in PREFIXES
        }
        return whole, parts

    def scores(self, texts) -> np.ndarray:
        """Probabilities; ``texts`` are bytes."""
        whole, parts = self.split()
        logits = []
        for text in texts:
            words = set(text.translate(_FOLD).split())
            total = self.bias
            for w in whole.keys() & words:
                total += whole[w]
            for k, known in parts.items():
                for w in known.keys() & {w[:k] for w in words}:
                    total += known[w]
            logits.append(total)
        return 1 / (1 + np.exp(-np.clip(np.array(logits, float), -700, 700)))


def train(
    sets: list[list[int]], positive: np.ndarray, n_features: int, prior: float, rounds: int = ROUNDS
) -> tuple[np.ndarray, float]:
    """Weights and bias by the non-negative risk, with logistic loss and Adam.

    ``sets`` has the features of each document.
    """
    sizes = np.array([len(s) for s in sets])
    row = np.repeat(np.arange(len(sets)), sizes)
    column = np.concatenate([np.array(s, np.int64) for s in sets]) if sizes.sum() else row
    n_positive, n_other = max(positive.sum(), 1), max((~positive).sum(), 1)
    w = np.zeros(n_features + 1)
    w[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        g = np.bincount(row, w[column], len(sets)) + w[-1]
        p = 1 / (1 + np.exp(-g))
        as_negative = np.logaddexp(0, g)  # the loss of calling a document toxic
        rest = as_negative[~positive].sum() / n_other - prior * as_negative[positive].sum() / n_positive
        slope = np.where(positive, -prior * p / n_positive, p / n_other)
        if rest >= 0:
            slope = slope + np.where(positive, -prior * (1 - p) / n_positive, 0.0)
        else:  # undo what drove the risk below zero
            slope = -slope
        step_by = np.append(np.bincount(column, slope[row], n_features), slope.sum())
        step_by[:-1] += DECAY * w[:-1]
        first = 0.9 * first + 0.1 * step_by
        second = 0.999 * second + 0.001 * step_by**2
        w -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def held_out(column: str = "doc_id") -> Column:
    """A quarter of the ids, whose labels are not learnt from."""
    number = F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))
    return number % 4 == 2


def document_counts(texts: DataFrame, column: str = "text", held: int = HELD) -> DataFrame:
    """(f, n): in how many of the texts each feature is, as partial counts.

    A task hands its counts on whenever it holds ``held`` features, and at its end.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for frame in frames:
            for text in frame[column]:
                counts.update(features(text))
                if len(counts) >= held:
                    yield pd.DataFrame({"f": list(counts), "n": list(counts.values())})
                    counts.clear()
        yield pd.DataFrame({"f": list(counts), "n": list(counts.values())})

    return texts.select(column).mapInPandas(count, "f binary, n long")


def fit(
    docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED
) -> Classifier:
    """A classifier from ``labels`` (doc_id, toxic) outside the held-out ids.

    The labelled documents with the smallest hashed ids are learnt from: ``positives`` of
    those labelled toxic, and ``unlabelled`` of all, whatever their label.
    """
    known = labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    prior = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    if not prior:
        return Classifier({}, -np.inf)
    prior = min(prior, 0.95)
    order = F.xxhash64(F.lit(3), "doc_id")
    toxic = known.where("toxic = 1").select("doc_id").orderBy(order).limit(positives)
    plain = known.select("doc_id").orderBy(order).limit(unlabelled)
    chosen = toxic.withColumn("positive", F.lit(True)).union(plain.withColumn("positive", F.lit(False)))
    texts = docs.select("doc_id", text_bytes().alias("text"))
    # at most positives + unlabelled ids, whatever the corpus
    sample = scratch(texts.join(F.broadcast(scratch(chosen)), "doc_id"))
    n_p, n_u = max(sample.where("positive").count(), 1), max(docs.count(), 1)
    share = (F.col("p") + F.col("u")) / (n_p + n_u)
    z = (F.col("p") / n_p - F.col("u") / n_u) / F.sqrt(share * (1.0001 - share) * (1 / n_p + 1 / n_u))
    none = F.lit(0).cast("long")
    of_toxic = document_counts(sample.where("positive")).select("f", F.col("n").alias("p"), none.alias("u"))
    of_all = document_counts(texts).select("f", none.alias("p"), F.col("n").alias("u"))
    picked = (
        of_toxic.union(of_all)
        .groupBy("f")
        .agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
        .where(F.col("p") + F.col("u") >= LEAST_DOCUMENTS)
        .where(F.greatest(F.col("p").cast("double"), F.col("u") * (n_p / n_u)) >= LEAST_EXPECTED)
        .withColumn("z", F.abs(z))
        .where(F.col("z") >= LEAST_Z)
        .where(F.abs(F.log((F.col("p") + 0.5) / n_p) - F.log((F.col("u") + 0.5) / n_u)) >= math.log(LEAST_RATIO))
        .orderBy(F.desc("z"), "f")
        .limit(FEATURES)
        .toPandas()
    )
    names = [bytes(f) for f in picked["f"]]
    index = {f: i for i, f in enumerate(names)}

    def look_up(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [sorted(index[f] for f in features(t) & index.keys()) for t in frame["text"]]
            yield pd.DataFrame({"positive": frame["positive"], "found": found})

    rows = sample.mapInPandas(look_up, "positive boolean, found array<int>").toPandas()
    # an order that does not depend on how the sample was read
    rows = rows.iloc[np.lexsort((rows["found"].map(str), rows["positive"]))]
    weights, bias = train(
        [list(x) for x in rows["found"]], rows["positive"].to_numpy(bool), len(names), prior
    )
    return Classifier(dict(zip(names, weights.tolist(), strict=True)), bias)


def score(docs: DataFrame, classifier: Classifier, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; a null text is an empty one."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array(classifier.scores(batch.column("_text").to_pylist()), pa.float64())]

    rows = docs.select("doc_id", held_out().alias("held_out"), text_bytes().alias("_text"))
    scored = arrow_map(rows, run, "score double", drop=("_text",))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
