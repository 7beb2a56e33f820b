"""Packing token pieces into sequences of a fixed capacity: best-two-fit.

Which document a piece comes from does not matter for how well lengths fit
together. So the plan is made from the histogram of piece lengths alone, at
most ``capacity`` numbers however large the corpus: a bin is filled greedily with the
longest lengths that fit; then its shortest piece gives way to two pieces that
fill the widened gap better; the bin's pattern is used as often as the lengths last.
Spark numbers the pieces of each length, and the number decides the slot.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import arrow_map, frugal, numbered, scratch, text_bytes

CAPACITY = 2048
MEMO_BYTES = 80 << 20  # of words and their ids that a task remembers, twice

_encoders: dict = {}
_PIECE = ("piece", "start", "length", "ids_crc32", "ids")
_KINDS = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())


class WordEncoder:
    """Ids of a text by a tokenizer that drops white space, word by word.

    Such a tokenizer never joins what white space parts, so the ids of a text are
    those of its words in a row, and a word needs encoding only once. Letters A-Z
    are lower-cased first, as the tokenizer does itself, unless the text may
    hold a special token. Where the tokenizer marks the last id of a word, new words
    of letters are encoded many at a time and taken apart at the marks.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        # Words used of late, and words used before them: what is not used is forgotten.
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        self.size = 0

    def encode_apart(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def encode_joined(self, words: list[str]) -> list[bytes]:
        """``words``: one or more letters each, none of which the tokenizer changes."""
        if not words:
            return []
        joined = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(joined[0].ids, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            return self.encode_apart(words)
        packed, ends = ids.tobytes(), (4 * ends).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def learn(self, words: set[bytes]) -> None:
        if self.size > MEMO_BYTES:
            self.before, self.known, self.size = self.known, {}, 0
        known = self.known
        found = self.before.keys() & words
        known.update({w: self.before[w] for w in found})
        words = words - found
        # A word of letters before marks: both are found again, also apart.
        pairs: dict[bytes, tuple[bytes, bytes]] = {}
        plain: dict[bytes, str] = {}
        other: dict[bytes, str] = {}
        for word in words:
            stem = word.rstrip(b".,!?;:*$%&#|")
            if stem in known and stem != word:
                marks = word[len(stem) :]
                if marks in known:
                    known[word] = known[stem] + known[marks]
                    continue
            text = stem.decode("utf-8", "replace")
            if text.isalpha() and (
                text.isascii() or (text == text.lower() and is_normalized("NFC", text))
            ):
                if stem not in known:
                    plain[stem] = text
                if stem != word:
                    marks = word[len(stem) :]
                    pairs[word] = (stem, marks)
                    if marks not in known:
                        other[marks] = marks.decode()
            elif word not in known:
                other[word] = word.decode("utf-8", "replace")
        known.update(zip(plain, self.encode_joined(list(plain.values())), strict=True))
        known.update(zip(other, self.encode_apart(list(other.values())), strict=True))
        known.update({w: known[a] + known[b] for w, (a, b) in pairs.items()})
        # with what a dictionary and two objects take
        self.size += 190 * (len(plain) + len(other) + len(pairs) + len(found))
        self.size += 8 * sum(map(len, words))

    def forget(self) -> None:
        """Free the words; the tokenizer stays."""
        self.known, self.before, self.size = {}, {}, 0

    def ids(self, text: bytes) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        words = (text if b"<|" in text else text.lower()).split()
        found = list(map(self.known.get, words))
        new = [i for i, ids in enumerate(found) if ids is None]
        if new:
            self.learn({words[i] for i in new})
            for i in new:
                found[i] = self.known[words[i]]
        return b"".join(found)


def _encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = 0, ids: bool = False
) -> DataFrame:
    """The token pieces of every text: doc_id, piece, start, length, ids_crc32.

    ``tokenizer`` is the path, on every machine, of a file of the tokenizers library
    that drops white space. Every document is followed by the id ``end``; a null
    text counts as empty and so has that id alone. Only documents over ``capacity``
    ids are cut, into pieces of that many and a rest. ``ids`` adds the ids themselves.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer)
        last = np.array([end], "<u4").tobytes()
        try:
            for batch in batches:
                rows, out = [], []
                for row, text in enumerate(batch.column("text").to_pylist()):
                    found = encode.ids(text) + last
                    for at in range(0, len(found), 4 * capacity):
                        part = found[at : at + 4 * capacity]
                        rows.append(row)
                        out.append((at // 4 // capacity, at // 4, len(part) // 4, zlib.crc32(part), part))
                # ids stay in Arrow: beside a null, pandas would make them doubles
                made = {"doc_id": batch.column("doc_id").take(pa.array(rows, pa.int64()))}
                for name, kind, values in zip(_PIECE, _KINDS, zip(*out, strict=True) if out else [[]] * 5, strict=True):
                    made[name] = pa.array(values, kind)
                if not ids:
                    del made["ids"]
                yield pa.RecordBatch.from_pydict(made)
        finally:  # the worker goes on to other stages
            encode.forget()

    key = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {key}, piece int, start long, length long, ids_crc32 long"
    rows = docs.select("doc_id", text_bytes().alias("text"))
    return rows.mapInArrow(frugal(run), schema + ", ids binary" * ids)


def _replace_smallest(pattern: list[int], left: np.ndarray, gap: int) -> list[int]:
    """Put two lengths in the place of the shortest, if they fill its room better."""
    shortest = min(pattern)
    room = gap + shortest
    free = left.copy()
    for length in pattern:
        free[length] -= 1
    free[shortest] += 1
    have = np.arange(len(free)) * (free > 0)
    up_to = np.maximum.accumulate(have)  # the longest free length that is no longer
    first = np.flatnonzero(free[:room] > 0)
    first = first[first > 0]
    if not len(first):
        return pattern
    second = up_to[np.minimum(first, room - first)]
    same = (second == first) & (free[first] < 2)
    second = np.where(same, up_to[np.maximum(first - 1, 0)], second)
    total = np.where(second > 0, first + second, 0)
    best = int(total.argmax())
    if total[best] <= shortest:
        return pattern
    kept = list(pattern)
    kept.remove(shortest)
    return [*kept, int(first[best]), int(second[best])]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """(times, lengths) of the patterns that use up a histogram of lengths."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    patterns = []
    while left.any():
        free, pattern, gap = left.copy(), [], capacity
        while len(fit := np.flatnonzero(free[: gap + 1])):
            length = int(fit[-1])
            # as many as fit at once, so that short lengths are no long loop
            n = min(int(free[length]), gap // length)
            pattern += [length] * n
            free[length] -= n
            gap -= n * length
        if gap and len(pattern) > 1:
            pattern = _replace_smallest(pattern, left, gap)
        used = Counter(pattern)
        times = min(int(left[length]) // n for length, n in used.items())
        for length, n in used.items():
            left[length] -= times * n
        patterns.append((times, pattern))
    return patterns


def slots(patterns: list[tuple[int, list[int]]]) -> pd.DataFrame:
    """For ranges of the pieces of a length: the first sequence, and the place in it."""
    rows, taken, sequence = [], Counter(), 0
    for times, pattern in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, taken[length], sequence, offset))
            taken[length] += times
            offset += length
        sequence += times
    frame = pd.DataFrame(rows, columns=["length", "from_rank", "sequence", "offset"])
    return frame.sort_values(["length", "from_rank"], ignore_index=True)


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (with doc_id, piece, length, ids_crc32) plus sequence_id and offset.

    The sequences are gapless from 0. Equal rows are told apart by their number
    only, so they get different slots. An empty table gives an empty one. Columns ``rank``,
    ``sequence_id`` and ``offset`` of ``parts`` are replaced.
    """
    parts = scratch(parts.drop("rank", "sequence_id", "offset"))
    counted = parts.groupBy("length").count().collect()  # at most ``capacity`` rows
    where = slots(plan({r["length"]: r["count"] for r in counted}, capacity))
    lengths = where["length"].to_numpy(np.int64)
    ranks, sequences, offsets = (
        where[c].to_numpy(np.int64) for c in ("from_rank", "sequence", "offset")
    )

    first = {int(v): i for v, i in zip(*np.unique(lengths, return_index=True), strict=True)}
    ordered = sorted(first, key=first.get)
    last = dict(zip(ordered, [*(first[x] for x in ordered[1:]), len(lengths)], strict=False))

    def place(batch: pa.RecordBatch) -> list[pa.Array]:
        at = np.empty(len(batch), np.int64)
        of, rank = (batch.column(c).to_numpy() for c in ("length", "_rank"))
        for length in np.unique(of):
            mine = of == length
            lo, hi = first[int(length)], last[int(length)]
            at[mine] = lo + np.searchsorted(ranks[lo:hi], rank[mine], side="right") - 1
        return [pa.array(sequences[at] + rank - ranks[at]), pa.array(offsets[at])]

    spread = F.xxhash64("doc_id", "piece", "ids_crc32")
    ranked = numbered(parts, "length", spread, ["doc_id", "piece", "ids_crc32"])
    ranked = ranked.select(*parts.columns, F.col("rank").alias("_rank"))
    return arrow_map(ranked, place, "sequence_id long, offset long", drop=("_rank",))


def sequences(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, ids binary, doc_ids) of the packed sequences; ``parts`` has ``ids``."""
    packed = pack(parts, capacity)
    row = F.struct("offset", "ids", "doc_id")
    return packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(row)).alias("r")).select(
        "sequence_id",
        F.expr("aggregate(r.ids, cast('' as binary), (a, b) -> concat(a, b))").alias("ids"),
        F.col("r.doc_id").alias("doc_ids"),
    )
