"""Perplexity of documents under an n-gram model of trusted text.

The model is an interpolated modified Kneser-Ney model of order 4 over UTF-8
bytes. All trusted text is counted, in shards, and the counts are joined with
their contexts' totals, discounts and continuation counts as Spark tables. Each
order that backs off is bounded by the alphabet (2^24 entries at most); the grams of order
4 are not, so they are handed to the tasks in shards of a fixed size. Every byte of a
text falls to one shard, so a text's bits are the sum over the shards. Documents are
scored where they are read; joining them gram by gram would shuffle dozens of
times their size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import frugal, scratch, text_bytes

PAD = b"\n\n\n"  # stands before every text
FLUSH = 2_000_000  # distinct grams a task holds before it hands them on
BATCH_BYTES = 1 << 20
SHRINK = 100  # bytes at the language's mean added to every text, for short ones
QUANTILE = 0.995  # of the trusted documents of a language
MARGIN = 2.0  # the threshold's distance from the mean, in that of the quantile
PULL = 50  # trusted documents that the pooled distance weighs as much as
SHARD = 1 << 22  # grams of order 4 that a task looks up at a time
WIDEN = 10.0  # bits a byte added to the threshold, divided by the trusted documents


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The 4-gram that ends at each byte of the texts, as an integer, and the texts' ends."""
    joined = b"".join(PAD + t for t in texts)
    b = np.frombuffer(joined, np.uint8).astype(np.uint32)
    ids = (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:] if len(b) > 3 else b[:0]
    lengths = np.array([len(t) for t in texts])
    ends = np.cumsum(lengths + len(PAD)) - len(PAD)
    inside = np.ones(len(ids), bool)
    for end in ends[:-1].tolist():
        inside[end : end + len(PAD)] = False
    return ids[inside], np.cumsum(lengths)


def count_grams(texts: DataFrame) -> DataFrame:
    """(gram, n) over a column ``text`` of bytes. Tasks count what they read first."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros((2, 0), np.int64)
        for frame in frames:
            for batch in in_batches(frame["text"]):
                ids, n = np.unique(grams(batch)[0], return_counts=True)
                both = np.concatenate([held[0], ids]), np.concatenate([held[1], n])
                ids, place = np.unique(both[0], return_inverse=True)
                held = np.stack([ids, np.bincount(place, both[1]).astype(np.int64)])
                if held.shape[1] > FLUSH:
                    yield pd.DataFrame({"gram": held[0], "n": held[1]})
                    held = held[:, :0]
        yield pd.DataFrame({"gram": held[0], "n": held[1]})

    return texts.mapInPandas(frugal(run), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def in_batches(texts) -> Iterator[list[bytes]]:
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= BATCH_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def discounted(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of (context, byte, n): (context, byte, p) without, and (context, rest) with back-off.

    ``p`` is what remains of a gram's share after its discount; ``rest`` is the share
    that the context leaves to the next lower order.
    """
    counts = scratch(counts)
    many = dict(
        counts.where("n <= 4").groupBy("n").agg(F.count("*").alias("c")).collect()
    )  # at most four rows
    n1, n2, n3, n4 = (many.get(i, 0) for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    d = [
        y,
        min(max(2 - 3 * y * n3 / n2, y), 2) if n2 and n3 else y,
        min(max(3 - 4 * y * n4 / n3, y), 3) if n3 and n4 else y,
    ]
    discount = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, min(d[1], 2)).otherwise(min(d[2], 3))
    totals = counts.groupBy("context").agg(
        F.sum("n").alias("total"), F.sum(discount).alias("left")
    )
    joined = counts.join(totals, "context")
    seen = joined.select("context", "byte", ((F.col("n") - discount) / F.col("total")).alias("p"))
    return seen, totals.select("context", (F.col("left") / F.col("total")).alias("rest"))


class Model:
    """Bits of grams. ``shards`` hold those of the grams of order 4 that trusted text has.

    ``lower`` is for all others: the shares that contexts of three bytes leave to order 3, the
    probabilities of grams of order 3, the shares of contexts of two bytes, and the
    probabilities of grams of order 2.
    """

    def __init__(self, shards: list[tuple[np.ndarray, np.ndarray]], lower: tuple):
        self.shards, self.lower = shards, lower

    @classmethod
    def train(cls, texts: DataFrame, shard: int = SHARD) -> Model:
        """From a column ``text`` of bytes, all of it."""
        four = scratch(count_grams(texts))
        context, byte = F.shiftright("gram", 8), F.col("gram").bitwiseAND(255)
        orders, lower = [four.select(context.alias("context"), byte.alias("byte"), "n")], four.select("gram")
        for bits in (24, 16, 8):  # how many different bytes stand before a shorter gram
            lower = scratch(
                lower.groupBy(F.col("gram").bitwiseAND((1 << bits) - 1).alias("gram")).agg(
                    F.count("*").alias("n")
                )
            )
            orders.append(lower.select(context.alias("context"), byte.alias("byte"), "n"))
        (seen4, rest4), (seen3, rest3), (seen2, rest2), (seen1, rest1) = map(discounted, orders)

        def gathered(table: DataFrame, value: str) -> tuple[np.ndarray, np.ndarray]:
            """Keys and values, by key; at most 2^24 rows, or a shard."""
            key = F.col("context") if value == "rest" else F.col("context") * 256 + F.col("byte")
            rows = table.select(key.alias("k"), F.col(value).cast("float")).toPandas().sort_values("k")
            return rows["k"].to_numpy(np.uint32), rows[value].to_numpy(np.float32)

        one = np.full(256, (gathered(rest1, "rest")[1] if four.head(1) else np.ones(1))[0] / 256, np.float64)
        at, p = gathered(seen1, "p")
        one[at] += p
        share2, share3 = np.ones(1 << 8), np.ones(1 << 16, np.float32)
        at, p = gathered(rest2, "rest")
        share2[at] = p
        two = (share2[:, None] * one).ravel()
        at, p = gathered(seen2, "p")
        two[at] += p
        at, p = gathered(rest3, "rest")
        share3[at] = p
        at, p = gathered(seen3, "p")
        three = at, (p + share3[at >> 8] * two[at & 0xFFFF]).astype(np.float32)
        model = cls([], (gathered(rest4, "rest"), three, share3, two.astype(np.float32)))
        number = max(1, -(-four.count() // shard))
        for i in range(number):
            mine = seen4.where(F.pmod(F.xxhash64("context", "byte"), F.lit(number)) == i) if number > 1 else seen4
            at, p = gathered(mine, "p")
            model.shards.append((at, -np.log2(p + model.backed_off(at)).astype(np.float32)))
        return model

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """The bits that each text takes, over all shards."""
        return sum(Shard(self, i).bits(texts) for i in range(len(self.shards)))

    def backed_off(self, grams: np.ndarray) -> np.ndarray:
        """The probability that grams get from the orders below."""
        rest4, three, share3, two = self.lower
        short = grams & np.uint32(0xFFFFFF)
        p = _at(*three, short, 0.0)
        none = np.flatnonzero(p == 0)
        p[none] = share3[(short[none] >> np.uint32(8))] * two[short[none] & np.uint32(0xFFFF)]
        return p * _at(*rest4, grams >> np.uint32(8), 1.0)


def _at(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, otherwise: float) -> np.ndarray:
    """Values of ascending keys."""
    if not len(keys):
        return np.full(len(wanted), otherwise, np.float32)
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[place] == wanted, values[place], np.float32(otherwise))


class Shard:
    """The bits of one shard's grams, in a hash table, and of grams that no shard has."""

    def __init__(self, model: Model, number: int):
        self.model, self.number, self.all = model, number, len(model.shards)
        keys, bits = model.shards[number]
        self.shift = np.uint32(32 - max(8, (2 * len(keys)).bit_length()))
        self.mask = (1 << (32 - int(self.shift))) - 1
        self.keys = np.zeros(self.mask + 1, np.uint32)
        self.values = np.full(self.mask + 1, -1, np.float32)  # below 0: free
        while len(keys):
            at = self._places(keys)
            own, first = np.unique(at, return_index=True)
            self.keys[own], self.values[own] = keys[first], bits[first]
            left = np.ones(len(keys), bool)
            left[first] = False
            keys, bits = keys[left], bits[left]

    def _places(self, grams: np.ndarray) -> np.ndarray:
        at = ((grams * np.uint32(0x9E3779B1)) >> self.shift).astype(np.int64)
        off = np.flatnonzero((self.keys[at] != grams) & (self.values[at] >= 0))
        while len(off):
            at[off] = (at[off] + 1) & self.mask
            there = at[off]
            off = off[(self.keys[there] != grams[off]) & (self.values[there] >= 0)]
        return at

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """The bits of each text that the grams of this shard take."""
        ids, ends = grams(texts)
        at = self._places(ids)
        bits = self.values[at].astype(np.float64)
        none = np.flatnonzero((bits < 0) | (self.keys[at] != ids))
        if self.number == 0:  # what no shard has counts once, with the first
            unseen = none
            for keys, _ in self.model.shards[1:]:
                unseen = unseen[~_among(keys, ids[unseen])]
            bits[none] = 0.0
            bits[unseen] = -np.log2(self.model.backed_off(ids[unseen]))
        else:
            bits[none] = 0.0
        total = np.append(0.0, np.cumsum(bits))
        return np.diff(total[np.append(0, ends)])


def _among(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    place = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return keys[place] == wanted if len(keys) else np.zeros(len(wanted), bool)


def trusted(labels: DataFrame) -> DataFrame:
    """(doc_id): labelled of good quality, and never of another."""
    return labels.groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1").select("doc_id")


def trusted_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The texts, as bytes, of trusted documents.

    Labels grow with the corpus, so they are never sent to every task, few as
    they may be: the join takes the same course at every size.
    """
    texts = docs.select("doc_id", text_bytes().alias("text"))
    return texts.join(trusted(labels).hint("merge"), "doc_id", "left_semi").select("text")


def add_bits(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (text and more) with ``n_bytes`` and ``bits``."""
    text = F.coalesce("text", F.lit(""))
    scored = docs.withColumns({"n_bytes": F.octet_length(text).cast("long"), "bits": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)
    for number in range(len(model.shards)):

        def run(batches, number=number):
            own = Shard(shared.value, number)
            for batch in batches:
                texts = [b"" if t is None else t.encode() for t in batch.column("text").to_pylist()]
                found = np.concatenate([own.bits(b) for b in in_batches(texts)] or [np.zeros(0)])
                bits = pc.add(batch.column("bits"), pa.array(found))
                place = batch.schema.get_field_index("bits")
                yield batch.set_column(place, "bits", bits)

        scored = scored.mapInArrow(frugal(run), ", ".join(f"`{c}` {t}" for c, t in scored.dtypes))
    return scored


def thresholds(scores: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """(_lang, _mean, _most) from ``scores`` (doc_id, lang, n_bytes, bits) of all documents.

    ``_mean`` is the bits a byte of the trusted documents of a language; ``_most`` lies
    ``MARGIN`` times as far above it as the given quantile of their smoothed bits a
    byte, and ``WIDEN / n`` further. That distance is shrunk to the one of all languages, each
    from its own mean, by the language's number ``n`` of trusted documents. Few documents
    are known by heart to the model, and others of their language are not, so the
    fewer there are the wider the threshold; without any it is infinite.
    """
    good = scratch(scores.where("n_bytes > 0").join(trusted(labels), "doc_id", "left_semi"))
    mean = F.sum("bits") / F.sum("n_bytes")
    overall = good.agg(mean.alias("m")).first()["m"]
    langs = good.groupBy("lang").agg(mean.alias("mean"), F.count("*").alias("n"))
    named = good.join(langs.withColumnRenamed("lang", "_l"), F.col("lang").eqNullSafe(F.col("_l")))
    above = named.withColumn("above", smoothed(F.col("mean")) - F.col("mean"))
    at = F.percentile_approx("above", quantile, 10_000)
    own = above.groupBy("_l").agg(at.alias("own"))
    pooled = float(above.agg(at.alias("p")).first()["p"] or 0.0)
    found = langs.join(own, F.col("lang").eqNullSafe(F.col("_l")))
    distance = (F.col("n") * F.col("own") + PULL * pooled) / (F.col("n") + PULL)
    most = F.col("mean") + MARGIN * distance + WIDEN / F.col("n")
    return (
        scores.select("lang")
        .distinct()
        .withColumnRenamed("lang", "_lang")
        .join(found.withColumn("most", most), F.col("_lang").eqNullSafe(F.col("lang")), "left")
        .select(
            "_lang",
            F.coalesce("mean", F.lit(float(overall or 0.0))).alias("_mean"),
            F.coalesce("most", F.lit(math.inf)).alias("_most"),
        )
    )


def smoothed(mean):
    return (F.col("bits") + SHRINK * mean) / (F.col("n_bytes") + SHRINK)


ADDED = ("n_bytes", "bits", "perplexity", "threshold", "kept")


def judge(docs: DataFrame, labels: DataFrame, texts: bool = False) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, lang, ...) with what ``ADDED`` names.

    ``perplexity`` is two to the power of the smoothed bits a byte; a document goes if it
    is above the threshold of its language. Null and empty texts say nothing and are
    kept, as is everything in a language without trusted text. ``texts`` says whether all
    columns of ``docs`` are returned, or doc_id and lang alone; columns that have a name in
    ``ADDED`` are replaced. A row that is repeated is judged as often; labels that contradict
    each other trust nothing.
    """
    docs = docs.drop(*ADDED)
    model = Model.train(trusted_texts(docs, labels))
    whole = docs if texts else docs.select("doc_id", "lang", "text")
    scores = add_bits(whole, model)
    scores = scratch(scores if texts else scores.drop("text"))
    limits = scratch(thresholds(scores.select("doc_id", "lang", "n_bytes", "bits"), labels))
    # The table of languages is small or Spark shuffles it: its size is known.
    score = smoothed(F.col("_mean"))
    return (
        scores.join(limits, F.col("lang").eqNullSafe(F.col("_lang")), "left")
        .withColumn("perplexity", F.pow(F.lit(2.0), score))
        .withColumn("threshold", F.pow(F.lit(2.0), F.col("_most")))
        .withColumn("kept", (F.col("n_bytes") == 0) | (score <= F.col("_most")))
        .select(*scores.columns, "perplexity", "threshold", "kept")
    )
