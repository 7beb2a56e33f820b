"""Fingerprints by a randomised edit embedding.

A walk over the characters of a text repeats each of them for as many steps as a
random function of (character, step) says; the function is the same for all texts. After
an edit two walks find back into step, so texts at a small edit distance agree in
most steps of their walks. A fingerprint samples the walk: each of its slots takes
one step, drawn so that texts of about the same length draw the same step, and keeps four bits
of the characters there. Equal slots then measure the likeness, and bands of
slots find candidates.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import (
    Forest,
    deal_blocks,
    in_cells,
    in_text,
    meet_here,
    pairs_by_shift,
    scratch,
)
from gazette.llm.graph import name_components

SLOTS = 128
PERIOD = 4096  # steps after which the random function repeats
BATCH_CHARS = 8_000_000
BUCKET_ROWS = 500
MOST_BUCKETS = 20_000
SAMPLED = 16
BEGINNING = 24  # characters


def _random_function() -> np.ndarray:
    """How many steps a walk that comes to (character class, step) stays there."""
    moves = np.random.default_rng(1).integers(0, 2, (256, PERIOD)).astype(bool)
    stay = np.zeros((256, 2 * PERIOD), np.uint8)
    later = np.full(256, 1, np.int64)
    for step in range(2 * PERIOD - 1, -1, -1):
        later = np.where(moves[:, step % PERIOD], 1, np.minimum(later + 1, 255))
        stay[:, step] = later
    return np.ascontiguousarray(stay[:, :PERIOD])


def _draws() -> list[np.ndarray]:
    """For each slot the growing series of steps it may take; it takes the last within a walk.

    The n-th step is taken with probability 1/n, so the step is uniform over the walk, and
    a slot keeps it if the walk grows a little.
    """
    rng, series = np.random.default_rng(2), []
    for _ in range(SLOTS):
        steps = [0]
        while steps[-1] < 1 << 40:
            steps.append(int((steps[-1] + 1) / (1 - rng.random())))
        series.append(np.unique(np.array(steps, np.int64)))
    return series


STAY = _random_function().ravel()
DRAWS = _draws()


def classes_of(text: str) -> np.ndarray:
    """The characters of a text as 256 classes; ASCII characters are classes of their own."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    high = points >> np.uint32(7)
    return np.where(high == 0, points, np.uint32(128) | ((points ^ (high * np.uint32(37))) & np.uint32(127))).astype(np.uint8)


def walk(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, state: np.ndarray) -> np.ndarray:
    """The steps spent at every character, for many texts in lockstep.

    Texts are ``flat[start : start + length]``; ``state`` is the step (modulo the
    period) at which each begins and is changed to the one at which it ends.
    """
    spent = np.zeros(len(flat), np.uint8)
    order = np.argsort(-lengths, kind="stable")
    at, now, left = starts[order].astype(np.int64), state[order], -lengths[order]
    active, step, longest = len(order), 0, int(lengths.max(initial=0))
    while step < longest:
        active = int(np.searchsorted(left, -step, side="left"))
        until = int(lengths[order[active - 1]])  # nobody leaves before
        here, j = at[:active], now[:active]
        for _ in range(step, until):
            d = STAY[(flat[here].astype(np.int64) << 12) + j]
            spent[here] = d
            j += d
            j &= PERIOD - 1
            here += 1
        step = until
    state[order] = now
    return spent


def slots_of(spent: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The fingerprint of one text as 4-bit numbers; of an empty one all are zero."""
    if not len(codes):
        return np.zeros(SLOTS, np.uint8)
    ends = np.cumsum(spent, dtype=np.int64)
    steps = np.array([s[np.searchsorted(s, ends[-1], side="left") - 1] for s in DRAWS])
    place = np.searchsorted(ends, steps, side="right")
    padded = np.concatenate([codes, np.zeros(3, np.uint8)]).astype(np.uint32)
    here = padded[place] | padded[place + 1] << 8 | padded[place + 2] << 16 | padded[place + 3] << 24
    mixed = (here ^ np.arange(SLOTS, dtype=np.uint32) * np.uint32(0x9E3779B1)) * np.uint32(0x85EBCA6B)
    mixed ^= mixed >> np.uint32(15)
    return ((mixed * np.uint32(0xC2B2AE35)) >> np.uint32(28)).astype(np.uint8)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of equal slots above what chance gives, from 0 to 1; rows of slots."""
    equal = (a == b).mean(-1)
    return np.clip((equal - 1 / 16) / (15 / 16), 0, 1)


def _hex(slots: np.ndarray) -> str:
    return (slots[0::2] << 4 | slots[1::2]).astype(np.uint8).tobytes().hex()


def _slots_from(prints) -> np.ndarray:
    octets = np.frombuffer(b"".join(map(bytes.fromhex, prints)), np.uint8).reshape(-1, SLOTS // 2)
    out = np.empty((len(octets), SLOTS), np.uint8)
    out[:, 0::2], out[:, 1::2] = octets >> 4, octets & 15
    return out


def fingerprints(texts: list[str], tails: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Fingerprints of texts, and of texts whose last floor(n/2) characters ``tails`` replace.

    The walks of a text and its edited form are one as far as they agree.
    """
    codes = [classes_of(t) for t in texts]
    tail_codes = [classes_of(t) for t in tails]
    lengths = np.array([len(c) for c in codes], np.int64)
    kept = lengths - lengths // 2
    n = len(texts)
    flat = np.concatenate([*codes, *tail_codes]) if n else np.zeros(0, np.uint8)
    tail_lengths = np.array([len(c) for c in tail_codes], np.int64)
    starts = np.cumsum(lengths) - lengths
    tail_starts = lengths.sum() + np.cumsum(tail_lengths) - tail_lengths
    state = np.zeros(n, np.int64)
    spent = walk(flat, starts, kept, state)
    # from the middle on, both ways at once
    both = np.concatenate([state, state])
    spent += walk(
        flat,
        np.concatenate([starts + kept, tail_starts]),
        np.concatenate([lengths - kept, tail_lengths]),
        both,
    )
    plain, edited = [], []
    for i in range(n):
        a, m, b = int(starts[i]), int(starts[i] + kept[i]), int(starts[i] + lengths[i])
        t, u = int(tail_starts[i]), int(tail_starts[i] + tail_lengths[i])
        plain.append(slots_of(spent[a:b], flat[a:b]))
        edited.append(
            slots_of(
                np.concatenate([spent[a:m], spent[t:u]]), np.concatenate([flat[a:m], flat[t:u]])
            )
        )
    return plain, edited


def with_neighbours(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) dealt into ranges, in order, each with the row after it.

    The order is that of (doc_id, text), null ids last; ranges are cut by the id and the
    text's beginning, so the rows of one id may be in several. They begin at rows that exist,
    taken from a sample of ``SAMPLED`` a range, so the first row of a range is known and
    goes to the range before as well, with ``_after`` set; that of the first range goes to
    the last. Only these keys pass the driver, for ``MOST_BUCKETS`` ranges at most.
    """
    kind = dict(docs.dtypes)["doc_id"]
    blank = "" if kind == "string" else 0
    names = ("_n", "_i", "_d")
    docs = docs.select(
        "doc_id",
        "text",
        F.col("doc_id").isNull().alias("_n"),
        F.coalesce("doc_id", F.lit(blank).cast(kind)).alias("_i"),
        F.substring("text", 1, BEGINNING).alias("_d"),
    )
    counted = docs.agg(F.count("*").alias("n"), F.min(F.struct(*names)).alias("low")).first()
    n = min(max(counted["n"] // BUCKET_ROWS, 1), MOST_BUCKETS)
    firsts = [tuple(counted["low"])] if counted["low"] else []
    if n > 1:
        one_in = max(counted["n"] // (n * SAMPLED), 1)
        some = F.pmod(F.xxhash64(F.lit(17), "doc_id", "text"), F.lit(one_in)) == 0
        sample = sorted(map(tuple, docs.select(*names).where(some).distinct().collect()))
        step = max(len(sample) // n, 1)
        firsts = sorted({*firsts, *sample[step::step]})
    edges = [
        F.lit([x[i] for x in firsts]).cast(f"array<{t}>") if firsts else F.array().cast(f"array<{t}>")
        for i, t in enumerate(("boolean", kind, "string"))
    ]
    key = F.struct(*names)

    def edge(at) -> Column:
        return F.struct(*(F.get(e, at).alias(c) for e, c in zip(edges, names, strict=True)))

    # the number of range starts up to the row, by halving
    place = F.lit(0)
    width = 1 << max(len(firsts) - 1, 0).bit_length()
    while firsts and width >= 1:
        more = (place + width <= len(firsts)) & (key >= edge(place + (width - 1)))
        docs = docs.withColumn("_place", F.when(more, place + width).otherwise(place))
        place, width = F.col("_place"), width // 2
    last = max(len(firsts) - 1, 0)
    docs = docs.withColumn("_bucket", (place - 1 if firsts else F.lit(0)).cast("int")).drop("_place")
    here = F.struct(F.col("_bucket").alias("b"), F.lit(False).alias("after"))
    before = F.struct(
        F.when(F.col("_bucket") == 0, last).otherwise(F.col("_bucket") - 1).alias("b"),
        F.lit(True).alias("after"),
    )
    starts = key == edge(F.col("_bucket")) if firsts else F.lit(False)
    both = F.when(F.coalesce(starts, F.lit(False)), F.array(here, before)).otherwise(F.array(here))
    dealt = docs.withColumn("_x", F.explode(both)).select(
        "doc_id", "text", F.col("_x.b").alias("_bucket"), F.col("_x.after").alias("_after")
    )
    return dealt.repartition("_bucket").sortWithinPartitions(
        "_bucket", "_after", F.col("doc_id").asc_nulls_last(), "text"
    )


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, as ``op9`` states them.

    The next document is the next in the order of (doc_id, text), null ids last, and the
    first one after the last. Equal rows follow each other in any order. A null
    text is an empty one; a single document follows itself. Ids may be whole numbers or text.
    """
    key = dict(docs.dtypes)["doc_id"]
    rows = with_neighbours(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    rows = in_text(rows).select("doc_id", "text", "_bucket", "_after")

    def finish(held: list[tuple], after: str) -> pd.DataFrame:
        texts = [t for _, t in held] + [after]
        tails = [b[: len(a) // 2] for a, b in zip(texts, texts[1:], strict=False)] + [""]
        plain, edited = fingerprints(texts, tails)
        whole, changed = np.array(plain), np.array(edited)
        near = likeness(whole[:-1], changed[:-1])
        following = likeness(whole[:-1], whole[1:])
        out = []
        for i, (doc_id, text) in enumerate(held):
            new = text[: len(text) - len(text) // 2] + tails[i]
            digest = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
            out.append(
                (doc_id, len(text), digest, _hex(plain[i]), _hex(edited[i]), near[i], following[i])
            )
        return pd.DataFrame(out, columns=COLUMNS)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []  # rows whose next one is still to come, but the last
        size, bucket, first = 0, None, ""
        closed = True
        for frame in frames:
            for doc_id, text, b, after in zip(
                frame["doc_id"], frame["text"], frame["_bucket"], frame["_after"], strict=True
            ):
                if b != bucket:
                    if held:
                        yield finish(held, first)  # only where there are no ranges
                    held, size, bucket, first, closed = [], 0, b, text, False
                if after:
                    if held and not closed:
                        yield finish(held, text)
                        held, size = [], 0
                    closed = True
                    continue
                if size > BATCH_CHARS:
                    yield finish(held, text)
                    held, size = [], 0
                held.append((doc_id, text))
                size += len(text)
        if held:
            yield finish(held, first)

    made = rows.mapInPandas(
        run,
        "doc_id string, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
    return made.withColumn("doc_id", F.col("doc_id").cast(key))


COLUMNS = [
    "doc_id",
    "n_chars",
    "edited_sha256",
    "fingerprint",
    "edited_fingerprint",
    "near_edited",
    "near_next",
]


def near_texts(prints: DataFrame, least: float = 0.8, bands: int = 16, width: int = 4) -> DataFrame:
    """``prints`` (doc_id, fingerprint, ...) with component_id: what a likeness of ``least`` connects.

    Candidates share the ``width`` slots of one of ``bands`` bands, sampled from the bits of the
    fingerprints; they are verified on all slots. Equal fingerprints are one class. Rows
    without an id connect like any others; ``component_id`` is the smallest id within
    reach, null where no row there has one.
    """
    prints = scratch(prints.drop("component", "component_id"))
    classes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    classes = scratch(classes.withColumn("id", F.xxhash64("fingerprint")))
    slots = np.random.default_rng(3).permutation(SLOTS)[: bands * width].reshape(bands, width)
    keys = [
        F.xxhash64(F.lit(i), *[F.substring("fingerprint", int(s) + 1, 1) for s in band])
        for i, band in enumerate(slots)
    ]
    rows = classes.select(F.explode(F.array(*keys)).alias("key"), "id", "fingerprint")

    def link(frame: pd.DataFrame, start: np.ndarray) -> pd.DataFrame:
        ids, values, meet = frame["id"].to_numpy(), _slots_from(frame["fingerprint"]), meet_here(frame)
        forest = Forest(len(frame))
        for a, b in pairs_by_shift(start):
            near = meet(a, b)
            a, b = a[near], b[near]
            near = likeness(values[a], values[b]) >= least
            forest.add(a[near], b[near])
        a, b = forest.links()
        return pd.DataFrame({"a": ids[a], "b": ids[b]})

    links = in_cells(deal_blocks(rows, "key", "id"), "key", link, "a long, b long", 16_384)
    return name_components(prints, classes, ["fingerprint"], links).drop("component")
