"""SimHash fingerprints and all pairs of them within a Hamming distance.

The search follows the general pigeonhole principle. The bits are grouped into
``m`` parts, correlated bits together; part ``i`` gets a threshold ``t_i`` of its
own, or -1 for not being used at all. If the thresholds sum up to
``radius - m + 1``, two fingerprints that differ in at most ``radius`` bits differ in
at most ``t_i`` bits of some part ``i``. Dynamic programming picks the thresholds,
and a comparison of all ``m`` picks the number of parts, by the estimated cost of
rows and candidates. The estimate decides how much work there is, never
what is found.

A part with threshold ``t`` is probed by every pattern that leaves out ``t`` of its
bits: fingerprints that agree on the rest meet in one bucket and are verified
there. Buckets hand on a spanning forest of their links rather than all pairs.

The 256 bits of the near copies are too many, and their radius too wide, to move a row for each
pattern. There every two blocks of rows meet in a tile, and the parts say which rows of it are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import (
    Forest,
    arrow_map,
    deal_blocks,
    in_cells,
    meet_here,
    pairs_by_shift,
    scratch,
    text_bytes,
    text_digest,
)
from gazette.llm.graph import name_components

SEED = 42
BITS = 64
SAMPLE = 4_000  # fingerprints looked at to estimate costs
ROLLS = 16  # pairs looked at for each of them
BLOCK = 2048  # fingerprints of a bucket that meet in one cell
ROW_COST, PAIR_COST = 6e-6, 6e-9  # seconds, with all that moving a row takes


# --- fingerprints -----------------------------------------------------------------


def shingles(text: bytes, words: int) -> list[bytes]:
    """Runs of ``words`` words, repeats included; shorter texts give one; none gives none."""
    found = text.lower().split()
    if not found:
        return []
    joined = b" ".join(found)
    if len(found) <= words:
        return [joined]
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = np.concatenate([[0], ends[:-1]])
    first, last = starts[: len(found) - words + 1].tolist(), (ends[words - 1 :] - 1).tolist()
    return [joined[a:b] for a, b in zip(first, last, strict=True)]


def majority(hashes: np.ndarray) -> np.ndarray:
    """Of rows of 64-bit words: words with the bits that more than half of the rows have."""
    if not len(hashes):
        return np.zeros(hashes.shape[1], np.uint64)
    count = np.zeros(64 * hashes.shape[1], np.int64)
    octets = np.ascontiguousarray(hashes, "<u8").view(np.uint8)
    for i in range(0, len(octets), 255):  # sums of a slice fit into a byte
        bits = np.unpackbits(octets[i : i + 255], axis=1, bitorder="little")
        count += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return np.packbits(count * 2 > len(hashes), bitorder="little").view("<u8")


def fingerprint(text: bytes, words: int) -> int:
    """The 64-bit SimHash over XXH64 of the shingles, as an unsigned integer."""
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(x, SEED) for x in shingles(text, words)], np.uint64)
    return int(majority(hashes.reshape(-1, 1))[0])


def wide_hashes(text: bytes, words: int) -> np.ndarray:
    """256 bits, as four words, for each of the distinct shingles."""
    digest = xxhash.xxh3_128_digest
    found = list(dict.fromkeys(shingles(text, words)))
    halves = [b"".join([digest(x, seed) for x in found]) for seed in (SEED, SEED + 1)]
    return np.hstack([np.frombuffer(h, "<u8").reshape(-1, 2) for h in halves])


def simhash(docs: DataFrame, words: int = 4, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and ``fp``, the fingerprint as a signed long, for every row.

    Null and empty texts get 0. Whole texts are read, row by row in Arrow batches.
    """

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = batch.column("_text").to_pylist()
        values = np.array([fingerprint(t, words) for t in texts], np.uint64)
        return [pa.array(values.view(np.int64))]

    rows = docs.select(*keep, text_bytes().alias("_text"))
    return arrow_map(rows, run, "fp long", drop=("_text",))


# --- parts and thresholds -----------------------------------------------------------


def _bit_matrix(values: np.ndarray) -> np.ndarray:
    octets = np.ascontiguousarray(values, "<i8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(octets, axis=1, bitorder="little")


def _parts(bits: np.ndarray, m: int) -> list[list[int]]:
    """``m`` groups of bits of nearly equal size, each grown by its most correlated bit."""
    spread = bits - bits.mean(0)
    norm = np.sqrt((spread**2).sum(0)) + 1e-9
    likeness = np.abs((spread.T @ spread) / np.outer(norm, norm))
    left, parts = list(range(BITS)), []
    for i in range(m):
        part = [left.pop(0)]
        while len(part) < BITS // m + (i < BITS % m):
            near = likeness[np.ix_(part, left)].sum(0)
            part.append(left.pop(int(near.argmax())))
        parts.append(part)
    return parts


def plan_masks(sample: np.ndarray, n: int, radius: int) -> list[int]:
    """The bit patterns to group ``n`` fingerprints by; complete for every sample."""
    bits = _bit_matrix(sample if len(sample) > 1 else np.array([0, -1]))
    mixed = np.random.default_rng(7).permutation(len(bits))
    best: tuple[float, list[int]] | None = None
    for m in range(1, radius + 2):
        parts = _parts(bits.astype(float), m)
        costs = []
        for part in parts:
            own = bits[mixed][:, part]
            distance = np.concatenate(
                [(own != np.roll(own, i, axis=0)).sum(1) for i in range(1, ROLLS + 1)]
            )
            costs.append([0.0])
            for t in range(radius + 1):
                if t > len(part) or comb(len(part), t) > 2_000:
                    break
                seen = (distance <= t).mean()
                by_chance = sum(comb(len(part), i) for i in range(t + 1)) / 2 ** len(part)
                bucket = n * max((distance == 0).mean() if t == 0 else 0.0, 2.0 ** (t - len(part)))
                rows = comb(len(part), t) * n * max(1.0, bucket / BLOCK)
                pairs = n * n / 2 * max(seen, by_chance)
                costs[-1].append(rows * ROW_COST + pairs * PAIR_COST)
        # least[s]: the cheapest thresholds, counted from -1, of the parts so far with sum s
        least: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for cost in costs:
            grown: dict[int, tuple[float, list[int]]] = {}
            for s, (value, chosen) in least.items():
                for t, more in enumerate(cost):
                    if s + t not in grown or value + more < grown[s + t][0]:
                        grown[s + t] = (value + more, [*chosen, t - 1])
            least = grown
        found = least.get(radius + 1)  # sum of (t + 1) over m parts
        if found and (best is None or found[0] < best[0]):
            masks = []
            for part, t in zip(parts, found[1], strict=True):
                if t >= 0:
                    whole = sum(1 << b for b in part)
                    masks += [whole - sum(1 << b for b in out) for out in combinations(part, t)]
            best = (found[0], masks)
    assert best, "one part with the whole radius is always possible"
    return best[1]


# --- links --------------------------------------------------------------------------


def bits_apart(wide: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return sum(np.bitwise_count((w[a] ^ w[b]).view(np.uint64)).astype(int) for w in wide)


def links_in_buckets(rows: DataFrame, prints: tuple[str, ...], radius: int) -> DataFrame:
    """Links (a, b) of ``rows`` (key, id, prints) with the same key, within ``radius`` bits.

    Within a bucket only a spanning forest is returned.
    """

    def link(frame: pd.DataFrame, start: np.ndarray) -> pd.DataFrame:
        ids, meet = frame["id"].to_numpy(), meet_here(frame)
        wide = [frame[c].to_numpy() for c in prints]
        forest = Forest(len(frame))
        for a, b in pairs_by_shift(start):
            near = bits_apart(wide, a, b) <= radius
            a, b = a[near], b[near]
            if len(a):
                here = meet(a, b)
                forest.add(a[here], b[here])
        a, b = forest.links()
        return pd.DataFrame({"a": ids[a], "b": ids[b]})

    cells = deal_blocks(rows, "key", "id", BLOCK)
    return in_cells(cells, "key", link, "a long, b long")


def hamming_links(prints: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) that connect what fingerprints within ``radius`` bits connect.

    ``prints`` has an ``id``, a distinct one for every row, and a long ``fp``.
    """
    n = prints.count()
    sample = prints.orderBy(F.xxhash64("id")).limit(SAMPLE).select("fp").toPandas()["fp"]
    masks = plan_masks(sample.to_numpy(np.int64), n, radius)
    signed = np.array(masks, np.uint64).view(np.int64).tolist()
    rows = prints.select("id", "fp", F.posexplode(F.lit(signed)).alias("_k", "_m"))
    rows = rows.select(
        F.xxhash64("_k", F.col("fp").bitwiseAND(F.col("_m"))).alias("key"), "id", "fp"
    )
    return links_in_buckets(rows, ("fp",), radius)


def near_components(prints: DataFrame, radius: int) -> DataFrame:
    """``prints`` (doc_id, fp and more) with ``component`` and ``component_id``.

    Rows with equal fingerprints form a class, and only classes are compared.
    ``component`` names what links connect; ``component_id`` is the smallest id within
    reach, null where no row there has one. A row whose id is null is linked like any other.
    """
    prints = scratch(prints)
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    classes = scratch(classes.withColumn("id", F.col("fp")))
    return name_components(prints, classes, ["fp"], hamming_links(classes.drop("least"), radius))


# --- near copies by five-word shingles ----------------------------------------------

WIDE = ("w0", "w1", "w2", "w3")
WIDE_RADIUS = 52  # of 256 bits: an angle whose cosine is 0.8
TILE = 262_144  # rows of a block at most; tiles are pairs of blocks
BLOCKS = 12  # blocks of a smaller table, where they hold BLOCK rows or more
# Seconds for a row in a part, a value of it, a pattern of that, and a pair; few rows of a value cost more.
SORT_COST, VALUE_COST, PATTERN_COST, TEST_COST, FEW = 1.5e-6, 1.2e-4, 2e-7, 3.4e-9, 40
LARGE = 256  # rows of a component that are no more compared with each other
FIELDS, FIELD = 3, 256  # counts side by side in the 24 bits of a float, eight bits each
A_ROWS, B_FIELDS = 256, 1024  # of a product, so that it stays in the cache
PENDING = 65_536  # candidates that are looked at together


def wide_parts(n: int, m: int, radius: int) -> list[tuple[int, int, int]]:
    """(first bit, bits, threshold) of the parts that are used when ``m`` parts hold all bits.

    Thresholds differ by one at most and sum up to ``radius - m + 1``, with -1 for parts not used.
    """
    edges = [n * i // m for i in range(m + 1)]
    each, more = divmod(radius + 1, m)
    found = [(edges[i], edges[i + 1] - edges[i], each + (i < more) - 1) for i in range(m)]
    return [part for part in found if part[2] >= 0]


def plan_parts(rows: int, others: int, radius: int) -> list[tuple[int, int, int]]:
    """The parts by which ``rows`` meet all of ``others`` within ``radius`` at the least cost."""
    # A part of no bits, in which all agree: all are compared with all.
    best = rows * others * TEST_COST, [(0, 0, 0)]
    for m in range(16, 33):
        parts, cost = wide_parts(64 * len(WIDE), m, radius), 0.0
        for _, width, t in parts:
            patterns = sum(comb(width, i) for i in range(t + 1))
            cost += (rows + others) * SORT_COST
            cost += min(rows, 2**width) * (VALUE_COST + patterns * PATTERN_COST)
            cost += (rows + FEW * 2**width) * others * patterns / 2**width * TEST_COST
        if cost < best[0]:
            best = cost, parts
    return best[1]


def _values(octets: np.ndarray, first: int, width: int) -> np.ndarray:
    if not width:
        return np.zeros(len(octets), np.int64)
    low, high = first // 8, (first + width + 7) // 8
    found = np.zeros(len(octets), np.int64)
    for i in range(high - low):
        found |= octets[:, low + i].astype(np.int64) << 8 * i
    return found >> (first - 8 * low) & (1 << width) - 1


def _tested(radius: int) -> int:
    """How many bits a product counts, so that a field holds the count; none if it cannot."""
    return min(143, FIELD // 2 + radius) if radius < FIELD // 2 else 0


def side_by_side(octets: np.ndarray, radius: int) -> np.ndarray:
    """``FIELDS`` fingerprints to a row, for products with rows of bits and a one.

    A field of the product is 128 + ``radius`` less the bits in which the two differ, of those that are
    tested, so its highest bit is set unless these are too many. All sums are whole and below 2^24.
    """
    k, n, most = _tested(radius), len(octets), FIELD // 2 + min(radius, FIELD // 2 - 1)
    made = np.zeros((-(-n // FIELDS), k + 1), np.float32)
    for at in range(0, n, FIELDS * 8192):
        bits = np.unpackbits(octets[at : at + FIELDS * 8192], axis=1, count=k, bitorder="little")
        for field in range(FIELDS):
            own = bits[field::FIELDS]
            rows = made[at // FIELDS : at // FIELDS + len(own)]
            rows[:, :k] += (own * np.float32(2) - 1) * np.float32(FIELD**field)
            rows[:, k] += (most - own.sum(1, dtype=np.float32)) * np.float32(FIELD**field)
    return made


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers of some ranges, one after the other."""
    size = np.maximum(ends - starts, 0)
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + size, size)


def _join(forest: Forest, wide: list[np.ndarray], a: np.ndarray, b: np.ndarray, radius: int) -> None:
    """Link those of the pairs (a, b) that are within ``radius``."""
    apart = forest.root[a] != forest.root[b]
    a, b = a[apart], b[apart]
    near = bits_apart(wide, a, b) <= radius
    if near.any():
        ends = np.sort(forest.root[np.stack([a[near], b[near]])], axis=0)
        forest.add(*np.unique(ends, axis=1))


def _join_next(forest: Forest, octets: np.ndarray, wide: list[np.ndarray], radius: int) -> None:
    """Link rows that are next to each other by some bits: this connects most of a large group."""
    for first in range(0, 64 * len(WIDE), 16):
        order = np.argsort(_values(octets, first, 16), kind="stable")
        _join(forest, wide, order[:-1], order[1:], radius)


class Products:
    """Tells which rows of two sets may be within ``radius`` bits, a block of the two at a time."""

    def __init__(self, octets: np.ndarray, others: np.ndarray, radius: int):
        self.octets, self.k = octets, _tested(radius)
        self.packed = side_by_side(octets[others], radius)
        self.marks = np.array([FIELD // 2 * FIELD**i for i in range(FIELDS)], np.int32)
        # Written again and again, as fresh memory costs more than the product.
        self.bits = np.ones((A_ROWS, self.k + 1), np.float32)
        self.there = np.empty((B_FIELDS, self.k + 1), np.float32)
        self.counts = np.empty(A_ROWS * B_FIELDS, np.float32)
        self.whole = np.empty(A_ROWS * B_FIELDS, np.int32)
        self.marked = np.empty(A_ROWS * B_FIELDS, bool)

    def candidates(self, rows: np.ndarray, places: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(number in ``rows``, number in ``others``), where ``places`` are rows of ``packed``."""
        bits = self.bits[: len(rows)]
        bits[:, : self.k] = np.unpackbits(self.octets[rows], axis=1, count=self.k, bitorder="little")
        for part in range(0, len(places), B_FIELDS):
            there = places[part : part + B_FIELDS]
            n, size = len(there), len(rows) * len(there)
            packed = np.take(self.packed, there, axis=0, out=self.there[:n], mode="clip")
            counts, whole = self.counts[:size], self.whole[:size]
            np.matmul(bits, packed.T, out=counts.reshape(-1, n))
            np.copyto(whole, counts, casting="unsafe")
            np.bitwise_and(whole, self.marks.sum(), out=whole)
            hits = np.flatnonzero(np.not_equal(whole, 0, out=self.marked[:size]))
            if len(hits):
                hit, field = np.nonzero(whole[hits, None] & self.marks)
                a, b = np.divmod(hits[hit], n)
                yield a, FIELDS * there[b] + field


def all_near(rows: np.ndarray, others: np.ndarray, wide: list[np.ndarray], radius: int) -> Forest:
    """A forest that connects every two of ``rows`` and ``others`` within ``radius`` bits.

    Both are positions in ``wide``, the same or none in common. The parts of ``plan_parts`` say which
    values of a part may have such a pair; rows of these are compared by products of matrices.
    Rows that are connected in large numbers already are not compared with each other.
    """
    octets = np.ascontiguousarray(np.stack(wide, 1), "<i8").view(np.uint8)
    forest, same = Forest(len(octets)), rows is others
    if not (len(rows) and len(others)):
        return forest
    _join_next(forest, octets, wide, radius)
    for first, width, most in plan_parts(len(rows), len(others), radius):
        large = np.flatnonzero(np.bincount(forest.root, minlength=len(octets)) >= LARGE)
        label, labels = np.zeros(len(octets), np.int64), len(large) + 1
        label[large] = np.arange(1, labels)
        key = _values(octets, first, width) * labels + label[forest.root]
        left = rows[np.argsort(key[rows], kind="stable")]
        right = left if same else others[np.argsort(key[others], kind="stable")]
        left_key, right_key = key[left], key[right]
        edges = np.searchsorted(right_key, np.arange(2**width + 1) * labels)
        patterns = [sum(1 << i for i in x) for t in range(most + 1) for x in combinations(range(width), t)]
        patterns = np.array(patterns, np.int64)
        # The bits of the part are like in all that meet: others are tested first.
        products = Products(np.roll(octets, -((first + width + 7) // 8), axis=1), right, radius)
        pending, held = [], 0
        cuts = np.flatnonzero(np.diff(left_key, prepend=-1, append=-1)).tolist()
        for start, end in zip(cuts, cuts[1:], strict=False):
            value, group = divmod(int(left_key[start]), labels)
            values = value ^ patterns
            begins, stops = edges[values], edges[values + 1]
            if group:  # not those of the same component
                own = values * labels + group
                begins = np.append(begins, np.searchsorted(right_key, own + 1))
                stops = np.append(np.searchsorted(right_key, own), stops)
            begins, stops = begins // FIELDS, np.where(stops > begins, -(-stops // FIELDS), 0)
            for at in range(start, end, A_ROWS):
                here = left[at : min(at + A_ROWS, end)]
                # Of the same rows a pair is compared from the one that comes first.
                places = _ranges(np.maximum(begins, at // FIELDS) if same else begins, stops)
                for a, b in products.candidates(here, places):
                    pending.append((here[a], right[b]))
                    held += len(a)
                if held >= PENDING or pending and end == len(left):
                    _join(forest, wide, *map(np.concatenate, zip(*pending, strict=True)), radius)
                    pending, held = [], 0
    return forest


def wide_links(prints: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) of ``prints`` (id, WIDE) that connect all that ``radius`` bits connect.

    Every row meets every other in a tile, a pair of blocks of rows, so a row is moved once for
    each block. ``all_near`` misses no pair, whatever parts it chooses.
    """
    n = prints.count()
    side = min(TILE, max(BLOCK, -(-n // BLOCKS)))
    blocks = max(-(-n // side), 1)
    own = F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(blocks)).cast("int")
    rows = prints.select("id", *WIDE, F.lit(0).alias("key"), own.alias("own"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    rows = rows.withColumns({"low": F.least("own", "_other"), "high": F.greatest("own", "_other")})

    def link(frame: pd.DataFrame, start: np.ndarray) -> pd.DataFrame:
        found = []
        for first in np.unique(start):
            tile = frame[start == first]
            own, low, high = (tile[c].to_numpy() for c in ("own", "low", "high"))
            rows = np.flatnonzero(own == low)
            others = rows if low[0] == high[0] else np.flatnonzero(own == high)
            a, b = all_near(rows, others, [tile[w].to_numpy() for w in WIDE], radius).links()
            ids = tile["id"].to_numpy()
            found.append(pd.DataFrame({"a": ids[a], "b": ids[b]}))
        return pd.concat(found)

    tiles = blocks * (blocks + 1) // 2
    # One row is enough for a frame: no more than a tile and what came with its end.
    return in_cells(rows.drop("_other"), "key", link, "a long, b long", frame_rows=1, tasks=tiles)


def drop_near_copies(docs: DataFrame, words: int = 5, wide_radius: int = WIDE_RADIUS) -> DataFrame:
    """One row of ``docs`` (doc_id, text, ...) for each group of near copies: the smallest id.

    Two texts are near copies if the cosine of their sets of five-word shingles, as
    256 bits of SimHash estimate it, is 0.8 or more; a Jaccard similarity of 0.8 has a
    cosine of 0.89, which is 39 differing bits on average. All pairs within ``wide_radius`` bits
    are found, by ``wide_links``, so it depends on the shingles alone, not on whether words
    were added, cut or changed.
    Of rows with equal id and text one stays. Texts without words are copies of
    each other. Rows without an id come after all others.
    """

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = (t.as_py() for t in batch.column("_text"))
        wide = np.array([majority(wide_hashes(t, words)) for t in texts], np.uint64)
        return [pa.array(w) for w in wide.reshape(-1, len(WIDE)).view(np.int64).T]

    rows = docs.select("doc_id", text_digest().alias("digest"), text_bytes().alias("_text"))
    fields = ", ".join(f"{w} long" for w in WIDE)
    prints = scratch(arrow_map(rows, run, fields, drop=("_text",)))
    classes = prints.groupBy(*WIDE).agg(F.min("doc_id").alias("least"))
    classes = scratch(classes.withColumn("id", F.xxhash64(*WIDE)))
    links = wide_links(classes.drop("least"), wide_radius)
    found = name_components(prints, classes, list(WIDE), links)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "digest")).alias("first")
    stay = (
        found.groupBy("component")
        .agg(first)
        .select(F.xxhash64(F.lit(5), "first.doc_id").alias("_k"), F.col("first.digest").alias("_d"))
    )
    keyed = docs.withColumns({"_k": F.xxhash64(F.lit(5), "doc_id"), "_d": text_digest()})
    kept = keyed.join(stay.distinct(), ["_k", "_d"], "left_semi")
    return kept.dropDuplicates(["_k", "_d"]).select(*docs.columns)
