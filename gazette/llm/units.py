"""Substring deduplication by hashed units: what is repeated stays where it came first.

A unit is a paragraph of its own making: it begins at the first word of a line or at a word
whose hash is the least among its neighbours, and ends at the first such place, or at the
end of the text, that is ``MIN_WORDS`` words away or more. Where units begin and end
depends on the words around only, so a passage that stands in the middle of other lines
elsewhere has the same units there, and short lines that many documents share are none.
Digests of units are grouped globally.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import WORD, arrow_map, frugal, scratch, text_digest

MIN_WORDS = 24
REACH = 8  # words to either side that a least hash is compared with
BATCH_WORDS = 200_000
MEMO = 200_000  # words a task remembers the hashes of
_WORD = re.compile(WORD)


class Cutter:
    """Finds the units of texts."""

    def __init__(self, min_words: int = MIN_WORDS, reach: int = REACH):
        self.min_words, self.reach = min_words, reach
        self.memo: dict[bytes, int] = {}

    def hashes(self, words: list[bytes]) -> np.ndarray:
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        for word in set(words) - memo.keys():
            memo[word] = int.from_bytes(hashlib.md5(word, usedforsecurity=False).digest()[:4], "big")
        return np.fromiter(map(memo.__getitem__, words), np.int64, len(words))

    def units(self, texts: list[str]) -> Iterator[tuple[np.ndarray, ...]]:
        """(text, first word, words, digest halves) of the units of some texts at a time."""
        held, size = [], 0
        for at, text in enumerate(texts):
            lines = [line.split() for line in text.lower().encode().split(b"\n")]
            held.append((at, lines))
            size += sum(map(len, lines))
            if size > BATCH_WORDS:
                yield self._units(held)
                held, size = [], 0
        yield self._units(held)

    def _units(self, texts: list[tuple[int, list[list[bytes]]]]) -> tuple[np.ndarray, ...]:
        words = [w for _, lines in texts for line in lines for w in line]
        per_line = np.array([len(line) for _, lines in texts for line in lines], np.int64)
        n = np.array([sum(map(len, lines)) for _, lines in texts], np.int64)
        ends = np.cumsum(n)
        text = np.repeat(np.arange(len(texts)), n)
        v = self.hashes(words)
        begins = np.ones(len(v), bool)
        for step in range(1, self.reach + 1):
            apart = text[step:] != text[:-step]
            begins[step:] &= apart | (v[step:] < v[:-step])
            begins[:-step] &= apart | (v[:-step] <= v[step:])
        line_starts = np.cumsum(per_line) - per_line
        begins[line_starts[per_line > 0]] = True
        first = np.flatnonzero(begins)
        edges = np.union1d(first, ends)
        until = np.searchsorted(edges, first + self.min_words)
        last = np.append(edges, np.iinfo(np.int64).max)[until]
        whole = last <= ends[text[first]] if len(first) else np.zeros(0, bool)
        first, last = first[whole], last[whole]
        joined = b" ".join(words)
        place = np.cumsum(np.fromiter((len(w) + 1 for w in words), np.int64, len(words)))
        start = (place - np.fromiter((len(w) + 1 for w in words), np.int64, len(words)))[first]
        digest = xxhash.xxh3_128_digest
        found = b"".join(
            [digest(joined[a:z]) for a, z in zip(start.tolist(), (place[last - 1] - 1).tolist(), strict=True)]
        )
        halves = np.frombuffer(found, "<i8").reshape(-1, 2)
        row = text[first]
        number = np.array([at for at, _ in texts], np.int64)
        return number[row], first - (ends - n)[row], last - first, halves[:, 0], halves[:, 1]


def hashed_units(docs: DataFrame, min_words: int = MIN_WORDS, reach: int = REACH) -> DataFrame:
    """(doc_id, digest, at, words, h, g): the units of every row, by first word and size."""
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", text_digest().alias("digest"), F.coalesce("text", F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(min_words, reach)
        for batch in batches:
            for row, at, words, h, g in cutter.units(batch.column("_text").to_pylist()):
                taken = batch.select(["doc_id", "digest"]).take(pa.array(row))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": taken.column(0),
                        "digest": taken.column(1),
                        "at": pa.array(at.astype(np.int32)),
                        "words": pa.array(words.astype(np.int32)),
                        "h": pa.array(h),
                        "g": pa.array(g),
                    }
                )

    return rows.mapInArrow(frugal(run), f"doc_id {kind}, digest long, at int, words int, h long, g long")


def repeated_units(docs: DataFrame, min_words: int = MIN_WORDS, reach: int = REACH) -> DataFrame:
    """(doc_id, digest, n_units, repeated): the units of documents that are elsewhere as well.

    ``repeated`` has (at, words, first) of each of them. The occurrence with the smallest
    (doc_id, digest of the text, position) is ``first``, null ids last. Rows with the same
    id and text count as one document.
    """
    hashed = scratch(hashed_units(docs, min_words, reach))
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "digest", "at")
    first = scratch(
        hashed.groupBy("h", "g")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where("first != last")
        .drop("last")
    )
    told = hashed.join(first, ["h", "g"]).select(
        "doc_id", "digest", F.struct("at", "words", (place == F.col("first")).alias("first")).alias("unit")
    )
    found = told.groupBy("doc_id", "digest").agg(F.collect_set("unit").alias("repeated"))
    counted = hashed.groupBy("doc_id", "digest").agg(F.countDistinct("at").cast("int").alias("n_units"))
    counted = counted.withColumnsRenamed({"doc_id": "_id", "digest": "_digest"})
    return counted.join(
        found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left"
    ).select(F.col("_id").alias("doc_id"), F.col("_digest").alias("digest"), "n_units", "repeated")


def without(text: str, repeated: list[dict]) -> tuple[str, list[dict]]:
    """The text without the words of later occurrences that no first one has, and where they were."""
    words = [m.span() for m in _WORD.finditer(text)]
    gone = np.zeros(len(words), bool)
    for unit in repeated:
        if not unit["first"]:
            gone[unit["at"] : unit["at"] + unit["words"]] = True
    for unit in repeated:
        if unit["first"]:
            gone[unit["at"] : unit["at"] + unit["words"]] = False
    flips = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))).reshape(-1, 2)
    runs = [(words[a][0], words[z - 1][1]) for a, z in flips.tolist()]
    kept, at = [], 0
    for start, end in runs:
        kept.append(text[at:start])
        at = end
    return "".join(kept) + text[at:], [{"start": a, "length": z - a} for a, z in runs]


def drop_repeated_units(docs: DataFrame, min_words: int = MIN_WORDS, reach: int = REACH) -> DataFrame:
    """Every row of ``docs`` with ``kept``, its text without repeated units.

    Words of a unit that came earlier go, with the white space between them, unless they are
    also in the first occurrence of a unit that comes again. ``removed`` holds the start, in code points
    of the original text, and the length of each run that went; ``n_units`` counts the units
    before. Units are compared lower-cased, with white space as one space. A document may
    be left empty; no row is dropped. A null text is an empty one. Columns of ``docs`` named
    like one of the three are replaced.
    """
    docs = docs.drop("kept", "removed", "n_units")
    gone = repeated_units(docs, min_words, reach)
    gone = gone.select(
        F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "n_units", F.col("repeated").alias("_units")
    )

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        texts, units = batch.column("text").to_pylist(), batch.column("_units").to_pylist()
        found = [without(t, u) if u else (t or "", []) for t, u in zip(texts, units, strict=True)]
        spans = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
        return [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], spans)]

    columns = docs.columns
    joined = docs.withColumn("_d", text_digest()).join(
        gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_d") == F.col("_digest")), "left"
    )
    joined = joined.select(*columns, F.coalesce("n_units", F.lit(0)).alias("n_units"), "_units")
    return arrow_map(
        joined, run, "kept string, removed array<struct<start:long,length:long>>", drop=("_units",)
    )


_SPACE = r"[\x20\x09-\x0D]+"
_TOKENS = rf"regexp_extract_all(coalesce(text, ''), '{_SPACE}|{WORD}')"
SQL = rf"""
WITH t AS (
    SELECT doc_id, unnest({_TOKENS}) AS t, generate_subscripts({_TOKENS}, 1) AS p FROM documents),
a AS (
    SELECT *, NOT regexp_matches(t, '^{_SPACE}') AS is_word, lag(t) OVER o AS gap,
           sum(length(t)) OVER o - length(t) AS start
    FROM t WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
w AS (
    SELECT doc_id, p, lower(t) AS word, gap, row_number() OVER o - 1 AS k,
           ('0x' || substr(md5(lower(t)), 1, 8))::UBIGINT AS v, count(*) OVER (PARTITION BY doc_id) AS n
    FROM a WHERE is_word WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
b AS (
    SELECT *, k = 0 OR contains(gap, chr(10)) OR (
               coalesce(v < min(v) OVER (o ROWS BETWEEN {REACH} PRECEDING AND 1 PRECEDING), true)
               AND coalesce(v <= min(v) OVER (o ROWS BETWEEN 1 FOLLOWING AND {REACH} FOLLOWING), true)
           ) AS begins
    FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY k)),
u AS (
    SELECT x.doc_id, x.k AS s, coalesce(min(y.k), any_value(x.n)) AS e
    FROM b x LEFT JOIN b y ON x.doc_id = y.doc_id AND y.begins AND y.k >= x.k + {MIN_WORDS}
    WHERE x.begins AND x.n >= x.k + {MIN_WORDS} GROUP BY x.doc_id, x.k),
d AS (
    SELECT u.doc_id, s, e, string_agg(word, ' ' ORDER BY k) AS unit
    FROM u JOIN b ON u.doc_id = b.doc_id AND k >= s AND k < e GROUP BY u.doc_id, s, e),
r AS (
    SELECT *, row_number() OVER (PARTITION BY unit ORDER BY doc_id, s) AS nth,
           count(*) OVER (PARTITION BY unit) AS many FROM d),
g AS (
    SELECT b.doc_id, b.p, coalesce(bool_or(nth > 1), false)
           AND NOT coalesce(bool_or(nth = 1 AND many > 1), false) AS gone
    FROM b LEFT JOIN r ON b.doc_id = r.doc_id AND k >= s AND k < e GROUP BY b.doc_id, b.p),
z AS (
    SELECT a.*, gone, CASE WHEN is_word THEN gone
               ELSE coalesce(lag(gone) OVER o AND lead(gone) OVER o, false) END AS away,
           is_word AND gone AND NOT coalesce(lag(gone, 2) OVER o, false) AS opens
    FROM a LEFT JOIN g USING (doc_id, p) WINDOW o AS (PARTITION BY a.doc_id ORDER BY a.p)),
k AS (
    SELECT doc_id, count(*) FILTER (opens) AS n,
           string_agg(CAST(start AS BIGINT)::VARCHAR, ',' ORDER BY p) FILTER (opens) AS starts,
           string_agg(t, '' ORDER BY p) FILTER (NOT away) AS kept
    FROM z GROUP BY doc_id),
c AS (SELECT doc_id, count(*) AS n_units FROM u GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_units, 0) AS INT) AS n_units, CAST(coalesce(k.n, 0) AS INT) AS n_removed,
       coalesce(starts, '') AS removed_starts, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN c USING (doc_id) LEFT JOIN k USING (doc_id)
"""
