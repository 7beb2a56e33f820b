"""Exact substring deduplication by a depth-limited radix sort of sampled suffixes.

A string of ``threshold`` bytes that starts in two places makes every byte it covers
go. To find all such strings, suffixes are ordered through ``threshold`` bytes by
digits, most significant first, and equal groups are the repeated strings:

1. Of the ``WINDOW`` grams of ``GRAM`` bytes in a string the one with the smallest
   hash is its anchor. Neighbouring strings mostly share it, so only one suffix in
   dozens is sorted. The first digit is the anchor's gram: suffixes with a digit of
   their own need no further look.
2. The second digit is the span, all bytes of the strings that have this anchor.
   Equal spans: all their strings are repeated. A digit with one span needs nothing more.
3. The last digit, for spans that differ after an equal gram, are the single strings.

Digits are counted in buckets by their leading bits. Texts are kept in batches of a
few megabytes; a batch sends each of its distinct digits once, however often it
has them, and gets a verdict for it. So a string that a third of all documents share
weighs no more than a rare one in any task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import in_text, scratch, text_bytes

THRESHOLD = 200
BATCH_BYTES = 2 << 20
BUCKET_BYTES = 64 << 20  # of text for each bucket of digits
LEAST_BUCKETS = 512
PART = 1 << 20  # strings looked at together
_AT = np.uint64((1 << 21) - 1)
_BASE = 0x9E3779B97F4A7C15

ONCE, ALL, ALL_SHOWN, SINGLY = 0, 1, 2, 3  # verdicts on spans


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base & (2**64 - 1), np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


_power: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def gram_hashes(b: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from every position; equal grams, equal hashes."""
    n = PART + 4 * THRESHOLD
    while n < len(b):
        n *= 2
    if n not in _power:
        _power[n] = _powers(_BASE, n), _powers(pow(_BASE, -1, 2**64), n)
    up, down = _power[n]
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[: len(b)], out=sums[1:])
    m = len(b) - gram + 1
    h = (sums[gram:] - sums[:m]) * down[:m]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def spans_of(
    text: bytes, ends: np.ndarray, threshold: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings with one anchor in texts that stand one after the other.

    Returns the first and last+1 position of the strings, the digit and the span's
    hash. Strings do not cross the ``ends`` of texts.
    """
    gram = max(threshold // 4, 1)
    window = threshold - gram + 1
    total = len(text) - threshold + 1
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    last = np.maximum(ends - threshold + 1, starts)
    edge = np.zeros(len(text) + 2, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, last, -1)
    inside = np.cumsum(edge) > 0
    heads = starts[last > starts]
    out: list[tuple] = []
    everything = np.frombuffer(text, np.uint8)
    digest = xxhash.xxh3_64_intdigest
    for part in range(0, max(total, 0), PART):
        b = everything[part : part + PART + threshold - 1]
        h = gram_hashes(b, gram)
        least = (h & ~_AT) | np.arange(len(h), dtype=np.uint64)
        reach = 1
        while reach * 2 <= window:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < window:
            least = np.minimum(least[: reach - window], least[window - reach :])
        anchor = (least & _AT).astype(np.int64)
        good = inside[part : part + len(anchor)]
        new = np.ones(len(anchor), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (good[1:] != good[:-1])
        new[heads[(heads >= part) & (heads < part + len(anchor))] - part] = True
        a = np.flatnonzero(new)
        z = np.append(a[1:], len(anchor))
        a, z = a[good[a]], z[good[a]]
        at = anchor[a]
        if len(a):
            piece = b.tobytes()
            span = [
                digest(piece[i : j + threshold - 1], k)
                for i, j, k in zip(a.tolist(), z.tolist(), (at - a).tolist(), strict=True)
            ]
            # the smallest of many hashes is a small number: mix it again for the buckets
            digit = h[at] * np.uint64(0xD6E8FEB86659FD93)
            out.append((a + part, z + part, digit, np.array(span, np.uint64)))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _distinct(digit: np.ndarray, span: np.ndarray):
    """Distinct (digit, span) in order; which one each row is, a first row, and whether several."""
    order = np.lexsort((span, digit))
    d, s = digit[order], span[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (s[1:] != s[:-1])
    which = np.empty(len(d), np.int64)
    which[order] = np.cumsum(new) - 1
    first = order[new]
    several = np.diff(np.append(np.flatnonzero(new), len(d))) > 1
    return d[new], s[new], which, first, several


def _messages(batch: int, bucket: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple]:
    """The rows of each bucket, which are together, as (bucket, batch, columns' bytes)."""
    cuts = np.flatnonzero(np.diff(bucket)) + 1 if len(bucket) else []
    for rows in np.split(np.arange(len(bucket)), cuts) if len(bucket) else []:
        a, z = rows[0], rows[-1] + 1
        yield int(bucket[a]), batch, *(c[a:z].tobytes() for c in columns)


class Batch:
    """One row of the table of batches, taken apart again."""

    def __init__(self, row, threshold: int, buckets: int):
        self.number = row.batch
        self.threshold = threshold
        self.text = zstandard.decompress(row.texts)
        self.ends = np.cumsum(np.asarray(row.lengths, np.int64))
        self.shift = np.uint64(64 - (buckets.bit_length() - 1))
        self.a, self.z, digit, span = spans_of(self.text, self.ends, threshold)
        self.digit, self.span, self.which, self.first, self.several = _distinct(digit, span)
        self.bucket = (self.digit >> self.shift).astype(np.int64)

    def digits(self) -> Iterator[tuple]:
        return _messages(
            self.number, self.bucket, [self.digit, self.span, self.several.astype(np.uint8)]
        )

    def verdicts(self, answers) -> np.ndarray:
        """The verdict on each distinct span."""
        out = np.zeros(len(self.digit), np.uint8)
        for answer in answers if answers is not None else ():
            a = int(np.searchsorted(self.bucket, answer["bucket"]))
            got = np.frombuffer(answer["data"], np.uint8)
            out[a : a + len(got)] = got
        return out

    def strings(self, verdicts: np.ndarray):
        """Of spans to be looked at singly: each distinct string once, by bucket.

        Returns bucket, key and whether there are several, and for each string of a
        span that is in question its position and which of these it is.
        """
        asked = np.flatnonzero(verdicts >= ALL_SHOWN)
        rows = self.first[asked]
        n = self.z[rows] - self.a[rows]
        at = np.repeat(self.a[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        digest, text, size = xxhash.xxh3_128_digest, self.text, self.threshold
        both = np.frombuffer(b"".join([digest(text[p : p + size]) for p in at.tolist()]), ">u8")
        both = both.reshape(-1, 2).astype(np.uint64)
        high, low, which, _, several = _distinct(both[:, 0], both[:, 1])
        query = np.repeat(verdicts[asked] == SINGLY, n)
        return (high >> self.shift).astype(np.int64), high, low, several, at[query], which[query]

    def repeated(self, verdicts: np.ndarray, answers) -> np.ndarray:
        """For every position whether the string from there is repeated."""
        edge = np.zeros(len(self.text) + 1, np.int32)
        whole = np.isin(verdicts[self.which], (ALL, ALL_SHOWN)) if len(self.which) else self.which > 0
        np.add.at(edge, self.a[whole], 1)
        np.add.at(edge, self.z[whole], -1)
        out = np.cumsum(edge)[:-1] > 0
        if (verdicts == SINGLY).any():
            bucket, _, _, _, at, which = self.strings(verdicts)
            twice = np.zeros(len(bucket), bool)
            for answer in answers if answers is not None else ():
                a = int(np.searchsorted(bucket, answer["bucket"]))
                got = np.frombuffer(answer["data"], np.uint8)
                twice[a : a + len(got)] = got > 0
            out[at[twice[which]]] = True
        return out


def make_batches(docs: DataFrame, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(batch, ids, lengths, texts, size): the texts of ``docs``, compressed and written once."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, number = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0

        def row() -> pd.DataFrame:
            packed = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            values = [(task << 32) + number, ids, [len(t) for t in texts], packed, size]
            return pd.DataFrame([values], columns=["batch", "ids", "lengths", "texts", "size"])

        for frame in frames:
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                ids.append(doc_id)
                texts.append(text)
                size += len(text)
                if size >= batch_bytes:
                    yield row()
                    number += 1
                    ids, texts, size = [], [], 0
        if texts:
            yield row()

    schema = "batch long, ids array<string>, lengths array<long>, texts binary, size long"
    rows = in_text(docs.select("doc_id", text_bytes().alias("text")))
    return scratch(rows.mapInPandas(run, schema))


def _judge_digits(group: pd.DataFrame) -> pd.DataFrame:
    """All digits of a bucket: verdicts on the spans of each batch."""
    group = group.sort_values("batch", ignore_index=True)
    digit, span, several = (
        np.frombuffer(b"".join(group[c]), t)
        for c, t in (("digits", np.uint64), ("spans", np.uint64), ("several", np.uint8))
    )
    order = np.lexsort((span, digit))  # stable: batches in order
    d, s = digit[order], span[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (s[1:] != s[:-1])
    which = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    often = (np.diff(np.append(starts, len(d))) > 1) | (
        np.maximum.reduceat(several[order], starts) > 0
    )
    same_digit = d[starts][1:] == d[starts][:-1]
    mixed = np.append(same_digit, False) | np.append(False, same_digit)
    verdict = np.where(often[which], ALL, np.where(mixed[which], SINGLY, ONCE))
    verdict[starts[often & mixed]] = ALL_SHOWN  # one batch shows the strings for all
    out = np.empty(len(d), np.uint8)
    out[order] = verdict
    return _answers(group, out, [len(x) // 8 for x in group["digits"]])


def _judge_strings(group: pd.DataFrame) -> pd.DataFrame:
    """All strings of a bucket: which of them are in more than one span."""
    group = group.sort_values("batch", ignore_index=True)
    high, low, several = (
        np.frombuffer(b"".join(group[c]), t)
        for c, t in (("digits", np.uint64), ("spans", np.uint64), ("several", np.uint8))
    )
    order = np.lexsort((low, high))
    h, k = high[order], low[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (k[1:] != k[:-1])
    starts = np.flatnonzero(new)
    often = (np.diff(np.append(starts, len(h))) > 1) | (
        np.maximum.reduceat(several[order], starts) > 0
    )
    out = np.empty(len(h), np.uint8)
    out[order] = often[np.cumsum(new) - 1]
    return _answers(group, out, [len(x) // 8 for x in group["digits"]])


def _answers(group: pd.DataFrame, values: np.ndarray, sizes: list[int]) -> pd.DataFrame:
    ends = np.cumsum(sizes)
    rows = [
        (batch, bucket, values[end - size : end].tobytes())
        for batch, bucket, end, size in zip(
            group["batch"], group["bucket"], ends, sizes, strict=True
        )
        if values[end - size : end].any()
    ]
    return pd.DataFrame(rows, columns=["batch", "bucket", "data"])


def _by_batch(answers: DataFrame, name: str) -> DataFrame:
    return scratch(
        answers.groupBy("batch").agg(F.collect_list(F.struct("bucket", "data")).alias(name))
    )


_MESSAGE = "bucket long, batch long, digits binary, spans binary, several binary"
_ANSWER = "batch long, bucket long, data binary"


def remove_repeats(
    docs: DataFrame, threshold: int = THRESHOLD, batch_bytes: int = BATCH_BYTES, keep: bool = True
) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): what is left without repeated bytes.

    n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, spans (start and
    end of each run in the bytes of the text) and, with ``keep``, kept, the bytes left.
    A byte goes if it is in a string of ``threshold`` bytes that starts anywhere else as
    well, in the same text or in that of another row, equal rows included. A null text
    is empty; shorter texts stay as they are; ids may be null or repeated.
    """
    batches = make_batches(docs, batch_bytes)
    size = batches.agg(F.sum("size")).first()[0] or 0
    buckets = max(LEAST_BUCKETS, 1 << (size // BUCKET_BYTES).bit_length())

    def show_digits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                found = Batch(row, threshold, buckets).digits()
                yield pd.DataFrame(found, columns=_COLUMNS)

    def show_strings(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                one = Batch(row, threshold, buckets)
                bucket, high, low, several, _, _ = one.strings(one.verdicts(row.first))
                found = _messages(one.number, bucket, [high, low, several.astype(np.uint8)])
                yield pd.DataFrame(found, columns=_COLUMNS)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                one = Batch(row, threshold, buckets)
                yield _cut(row, one, one.repeated(one.verdicts(row.first), row.second), keep)

    spans = (
        batches.mapInPandas(show_digits, _MESSAGE)
        .groupBy("bucket")
        .applyInPandas(_judge_digits, _ANSWER)
    )
    first = _by_batch(spans, "first")
    judged = batches.join(first, "batch", "left")
    strings = (
        judged.select("batch", "lengths", "texts", "first")
        .mapInPandas(show_strings, _MESSAGE)
        .groupBy("bucket")
        .applyInPandas(_judge_strings, _ANSWER)
    )
    second = _by_batch(strings, "second")
    both = first.join(second, "batch", "left")
    key = dict(docs.dtypes)["doc_id"]
    schema = (
        "doc_id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "spans array<struct<start:long,end:long>>"
    ) + ", kept binary" * keep
    left = batches.join(both, "batch", "left").mapInPandas(cut, schema)
    return left.withColumn("doc_id", F.col("doc_id").cast(key))


_COLUMNS = ["bucket", "batch", "digits", "spans", "several"]


def _cut(row, one: Batch, repeated: np.ndarray, keep: bool) -> pd.DataFrame:
    so_far = np.concatenate([[0], np.cumsum(repeated)])
    covers = np.maximum(np.arange(len(repeated)) + 1 - one.threshold, 0)
    gone = so_far[1:] - so_far[covers] > 0
    out, start = [], 0
    everything = np.frombuffer(one.text, np.uint8)
    for doc_id, end in zip(row.ids, one.ends.tolist(), strict=True):
        mask = gone[start:end]
        flips = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
        runs = [{"start": a, "end": z} for a, z in flips.reshape(-1, 2).tolist()]
        left = everything[start:end][~mask].tobytes()
        digest = hashlib.sha256(left).hexdigest()
        out.append((doc_id, end - start, int(mask.sum()), len(runs), digest, runs, left))
        start = end
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
    frame = pd.DataFrame(out, columns=names)
    return frame if keep else frame.drop(columns="kept")
