"""Tokens of two tokenizers of the same text, aligned by where they end.

Both tokenizers cut the same bytes. Offsets at which tokens of both end cut the
tokens into groups. They are found by galloping: each end of the shorter list is
searched in the longer one from where the last was found, in doubling steps and then by
halving, for all ends of a document at once. The ranks of a token's two ends in the
other list differ by the tokens that overlap it, so overlaps are ranges.

How often two ids overlap in the corpus is counted in documents. A block of
documents first counts its own distinct pairs, so a pair is one row for each block however
common it is, and gets the corpus's counts back the same way.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gazette.llm.common import scratch

BLOCK_BYTES = 4 << 20  # of text that a block has, or one document
_SPACE = "▁"
# Fixed value: how byte-level tokenizers part texts into words.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_aligners: dict = {}


# --- tokens ---------------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies, and its byte.

    Printable bytes stand for themselves, the others for letters from 256 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(others)}


class ByteTokens:
    """Ids by a byte-level BPE file of the tokenizers library; ``bytes_of`` of every id."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        letters = _byte_letters()
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        self.bytes_of = [b""] * (self.tokenizer.get_vocab_size() + 1)
        plain = {}
        for token, i in whole["model"]["vocab"].items():
            if all(c in letters for c in token):
                self.bytes_of[i] = bytes(letters[c] for c in token)
                plain[self.bytes_of[i]] = i
        self.fast = self._ranked(whole, plain)

    def _ranked(self, whole: dict, plain: dict[bytes, int]):
        """A faster encoder for the same ids, where the ids of merges are in their order."""
        cut, model = whole.get("pre_tokenizer") or {}, whole["model"]
        usual = cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
        usual = usual and not cut.get("add_prefix_space") and not whole.get("normalizer")
        usual = usual and not model.get("dropout") and not model.get("ignore_merges")
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [model["vocab"]["".join(m)] for m in merges]
        wanted = set(ids)
        ranks = {b: i for b, i in plain.items() if len(b) == 1 or i in wanted}
        usual = usual and ids == sorted(wanted) and len(ranks) == 256 + len(ids) and min(ids) >= 256
        if not usual:
            return None
        import tiktoken

        return tiktoken.Encoding("plain", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.fast is not None:
            return [self.fast.encode_ordinary(t) for t in texts]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [e.ids for e in found]


class PieceTokens:
    """Ids by a sentencepiece model; ``bytes_of`` of every id."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = model = SentencePieceProcessor(model_file=path)
        self.bytes_of = [
            bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(_SPACE, " ").encode()
            for i, piece in enumerate(map(model.id_to_piece, range(model.get_piece_size())))
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def _aligner(byte_path: str, piece_path: str) -> Aligner:
    key = byte_path, piece_path
    if key not in _aligners:
        _aligners[key] = Aligner(*key)
    return _aligners[key]


# --- alignment ------------------------------------------------------------------------


def gallop(short: np.ndarray, long: np.ndarray, near: np.ndarray) -> np.ndarray:
    """For ascending ``short``, the first places in ascending ``long`` that are no smaller.

    The search for a value starts at the place ``near`` it, goes on in steps of 1, 2, 4 ...
    until the value lies between two steps, and then by halving. ``near`` decides the
    number of steps only.
    """
    n = len(long)
    if not n or not len(short):
        return np.zeros(len(short), np.int64)
    at = np.clip(near, 0, n - 1)
    up = long[at] < short
    # long[low] < value <= long[high], where -1 and n lie beyond both ends
    low, high = np.where(up, at, -1), np.where(up, n, at)
    step, open_ = 1, np.arange(len(short))
    while len(open_):
        rises = up[open_]
        probe = np.clip(at[open_] + np.where(rises, step, -step), -1, n)
        inside = (probe >= 0) & (probe < n)
        less = np.where(inside, long[np.clip(probe, 0, n - 1)] < short[open_], probe < 0)
        low[open_[less]] = probe[less]
        high[open_[~less]] = probe[~less]
        open_ = open_[inside & (less == rises)]
        step *= 2
    open_ = np.flatnonzero(high - low > 1)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        less = long[middle] < short[open_]
        low[open_[less]] = middle[less]
        high[open_[~less]] = middle[~less]
        open_ = open_[high[open_] - low[open_] > 1]
    return high


def shares(mine: np.ndarray, others: np.ndarray) -> np.ndarray:
    """For each of the rows of tokens of several texts, where the other's row is as far on.

    ``mine`` and ``others`` are the numbers of tokens of each text.
    """
    text = np.repeat(np.arange(len(mine)), mine)
    since = np.arange(len(text)) - (np.cumsum(mine) - mine)[text]
    pace = others / np.maximum(mine, 1)
    return (np.cumsum(others) - others)[text] + (since * pace[text]).astype(np.int64)


def align(ends_a: np.ndarray, ends_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the ends of two rows of tokens of the same bytes: what groups and overlaps follow.

    The rows are of several texts, one after the other, with ``n_a`` and ``n_b`` tokens each.
    (in_a, in_b, first, last): the places, in each row, of the ends that both have, and for each
    token of the first row the range of tokens of the other that overlap it.
    """
    if not len(ends_a):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    if len(ends_a) <= len(ends_b):
        before = gallop(ends_a, ends_b, shares(n_a, n_b))  # ends of b before each end of a
        in_a = np.flatnonzero(ends_b[before] == ends_a)
        in_b = before[in_a]
    else:
        found = gallop(ends_b, ends_a, shares(n_b, n_a))
        in_b = np.flatnonzero(ends_a[found] == ends_b)
        in_a = found[in_b]
        before = np.cumsum(np.bincount(found, minlength=len(ends_a)))
        before[in_a] -= 1
    by = before.copy()  # ... or at it
    by[in_a] += 1
    return in_a, in_b, np.append(0, by[:-1]), before + 1


class Aligner:
    """Aligns blocks of texts."""

    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = ByteTokens(byte_path), PieceTokens(piece_path)
        self.length_a = np.array([len(x) for x in self.a.bytes_of])
        self.length_b = np.array([len(x) for x in self.b.bytes_of])
        # ids as text, each with what may follow it: ",", or "|" after the last of a's and ";" of b's
        names_a = [f"{i}{mark}" for i in range(len(self.length_a)) for mark in ",|"]
        names_b = [f"{i}{mark}" for i in range(len(self.length_b)) for mark in ",;"]
        self.names = names_a + names_b

    def tokens(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """The ids of both; none where either does not give the text back."""
        rows = self.a.encode([" " + t for t in texts]), self.b.encode(texts)
        for i, text in enumerate(texts):
            whole = (" " + text).encode()
            same = text and all(
                b"".join([side.bytes_of[x] for x in row[i]]) == whole
                for side, row in zip((self.a, self.b), rows, strict=True)
            )
            if not same:
                rows[0][i], rows[1][i] = [], []
        return rows

    def block(self, texts: list[str]) -> dict:
        """Per text counts and digests; the block's distinct pairs and who has them how often."""
        rows_a, rows_b = self.tokens(texts)
        n_a, n_b = (np.array([len(r) for r in rows]) for rows in (rows_a, rows_b))
        a, b = (np.fromiter(chain.from_iterable(r), np.int64) for r in (rows_a, rows_b))
        # one line of ends for the block: every text's last end is common to both, so none is crossed
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        in_a, in_b, first, last = align(ends_a, ends_b, n_a, n_b)
        many = last - first
        from_a = np.repeat(np.arange(len(a)), many)
        at_b = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
        doc = np.repeat(np.arange(len(texts)), n_a)
        n_links = np.bincount(doc, many, len(texts)).astype(np.int64)
        n_groups = np.bincount(doc[in_a], minlength=len(texts))
        own, pair = np.unique((a[from_a] << 32) | b[at_b], return_inverse=True)
        held, times = np.unique(doc[from_a] * max(len(own), 1) + pair, return_counts=True)
        held_by, held = np.divmod(held, max(len(own), 1))
        return {
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": n_groups,
            "n_links": n_links,
            "digests": self._digests(a, b, in_a, in_b, n_a + n_b),
            "own": own,
            "with": np.bincount(held, minlength=len(own)),
            "held_by": held_by,
            "held": held,
            "times": times,
        }

    def _digests(self, a, b, in_a, in_b, tokens) -> list[str]:
        """Of each text's groups written as a1,a2|b1;a3|b2,b3."""
        closes_a, closes_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        closes_a[in_a], closes_b[in_b] = 1, 1
        group_a, group_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
        names = np.empty(len(a) + len(b), np.int64)
        # a group's tokens of a stand after all of b's of the groups before, and b's after both
        names[np.arange(len(a)) + np.append(0, in_b + 1)[group_a]] = 2 * a + closes_a
        names[np.arange(len(b)) + (in_a + 1)[group_b]] = 2 * (b + len(self.length_a)) + closes_b
        out, at = [], 0
        for n in tokens.tolist():
            text = "".join([self.names[x] for x in names[at : at + n].tolist()])
            out.append(hashlib.sha256(text[:-1].encode()).hexdigest() if n else "")
            at += n
        return out


def _in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches cut again into blocks of about ``BLOCK_BYTES`` of text."""
    held, size = [], 0
    for batch in batches:
        lengths = pc.binary_length(batch.column("_text"))
        at = 0
        for row, n in enumerate(lengths.to_pylist(), 1):
            size += n
            if size >= BLOCK_BYTES:
                held.append(batch.slice(at, row - at))
                yield pa.Table.from_batches(held).combine_chunks()
                held, size, at = [], 0, row
        if at < len(batch):
            held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def align_documents(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """How the tokens of both tokenizers overlap in each document, and how usually so.

    Returns (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every
    row of ``docs`` (doc_id, text, ...). The texts, with a space before, are cut by the byte-level
    BPE file ``byte_path`` (a) and, as they are, by the sentencepiece model ``piece_path`` (b), which
    adds the space. A link is a pair of overlapping tokens; its count is the number of rows of
    ``docs`` that have such a link of these two ids. ``n_best`` counts the links whose count
    is the highest of their id in a. Texts that are null or empty, or that a tokenizer does not
    give back byte by byte, have no tokens. Ids may be null, repeated and of any type.
    """
    key = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    numbers = ("n_a", "n_b", "n_groups", "n_links")
    schema = (
        f"doc_id {key}, {', '.join(f'{n} long' for n in numbers)}, groups_sha256 string, "
        "block string, at int, own binary, docs_with binary, held binary"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(byte_path, piece_path)
        for table in _in_blocks(batches):
            found, size = aligner.block(table.column("_text").to_pylist()), len(table)
            block = uuid.uuid4().hex
            columns = {
                "doc_id": table.column("doc_id").chunk(0),
                **{n: pa.array(found[n], pa.int64()) for n in numbers},
                "groups_sha256": pa.array(found["digests"], pa.string()),
                "block": pa.array([block] * size, pa.string()),
                "at": pa.array(range(size), pa.int32()),
                **{n: pa.nulls(size, pa.binary()) for n in ("own", "docs_with", "held")},
            }
            yield pa.RecordBatch.from_pydict(columns)
            # and a row for the block itself
            last = {n: pa.nulls(1, c.type) for n, c in columns.items()}
            last["block"] = pa.array([block], pa.string())
            held = _fold(found["held_by"], found["held"], found["times"])
            for name, value in (("own", _fold(found["own"])), ("docs_with", _fold(found["with"])), ("held", held)):
                last[name] = pa.array([value], pa.binary())
            yield pa.RecordBatch.from_pydict(last)

    made = scratch(rows.mapInArrow(run, schema))
    blocks = made.where("at is null")

    def unfold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for block, own, with_ in zip(frame["block"], frame["own"], frame["docs_with"], strict=True):
                (own,), (with_,) = _unfold(own, 1), _unfold(with_, 1)
                place = np.arange(len(own), dtype=np.int32)
                yield pd.DataFrame(
                    {"block": block, "place": place, "a": own >> 32, "b": own & 0xFFFFFFFF, "n": with_}
                )

    each = blocks.select("block", "own", "docs_with").mapInPandas(
        unfold, "block string, place int, a long, b long, n long"
    )
    counts = scratch(each.groupBy("a", "b").agg(F.sum("n").alias("count")))
    highest = F.max("count").over(Window.partitionBy("a"))
    counts = scratch(counts.withColumn("best", F.col("count") == highest))
    told = each.drop("n").join(counts, ["a", "b"]).select("block", "place", "count", "best")

    def judge(mine: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        out = []
        count, best = np.zeros(len(known), np.int64), np.zeros(len(known), np.int64)
        place = known["place"].to_numpy()
        count[place], best[place] = known["count"], known["best"]
        for block, held in zip(mine["block"], mine["held"], strict=True):
            by, held, times = _unfold(held, 3)
            at, start = np.unique(by, return_index=True)
            if len(at):
                sums = (np.add.reduceat(x[held] * times, start) for x in (best, count))
                out.append(pd.DataFrame(dict(zip(("block", "at", "n_best", "count_sum"), (block, at, *sums), strict=True))))
        none = {"block": [], "at": [], "n_best": [], "count_sum": []}
        return pd.concat(out) if out else pd.DataFrame(none)

    judged = (
        blocks.select("block", "held")
        .groupBy("block")
        .cogroup(told.groupBy("block"))
        .applyInPandas(judge, "block string, at int, n_best long, count_sum long")
    )
    # texts without tokens have no links
    sums = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    documents = made.where("at is not null").drop("own", "docs_with", "held")
    return documents.join(judged, ["block", "at"], "left").select(
        "doc_id", *numbers, *sums, "groups_sha256"
    )


def _fold(*columns: np.ndarray) -> bytes:
    """Columns of longs as differences, a byte of each at a time, so that they compress."""
    out = []
    for column in columns:
        steps = np.diff(column.astype("<i8"), prepend=0).astype("<i8")
        out.append(steps.view(np.uint8).reshape(-1, 8).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def _unfold(packed: bytes, number: int) -> list[np.ndarray]:
    whole = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    planes = whole.reshape(number, 8, -1)
    return [np.cumsum(np.ascontiguousarray(p.T).view("<i8").ravel()) for p in planes]
