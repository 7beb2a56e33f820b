"""Near duplicates of embeddings by lattice hashing.

Vectors of length one are projected to eight dimensions at random, several times
over, and each projection is decoded to the nearest point of the E8 lattice: its cell. A
vector is filed under its own cell and looked up in the neighbouring cells its
projection lies closest to. What meets in a cell is compared by cosine in double
precision. Projections are rounded to whole numbers first, so cells do not depend on
how rows are batched.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import Forest, arrow_map, deal_blocks, in_cells, meet_here, scratch
from gazette.llm.graph import components

LEAST_COSINE = 0.93
TABLES = 4
PROBES = 8  # neighbouring cells looked up in each table
CELL = 0.75  # length of a lattice unit, for vectors of length one
_WHOLE = 1 << 18  # steps to which vectors are rounded
_FINE = 1 << 12  # ... and projections


def _minimal_vectors() -> np.ndarray:
    """The 240 lattice points next to the origin."""
    pairs = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            pairs.append(v)
    halves = [np.array(s) / 2 for s in product((1.0, -1.0), repeat=8) if np.prod(s) > 0]
    return np.array(pairs + halves)


NEXT = _minimal_vectors()


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """The nearest whole points whose coordinates have an even sum."""
    near = np.rint(x)
    off = x - near
    worst = np.abs(off).argmax(1)
    rows = np.arange(len(x))
    odd = near.sum(1) % 2 != 0
    step = np.where(off[rows, worst] >= 0, 1.0, -1.0)
    near[rows[odd], worst[odd]] += step[odd]
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest points of E8 for rows of eight coordinates."""
    whole, half = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(1) < ((x - whole) ** 2).sum(1)
    return np.where(closer[:, None], half, whole)


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors**2).sum(1, keepdims=True))


def cells(
    vectors: np.ndarray,
    groups: np.ndarray,
    tables: int = TABLES,
    probes: int = PROBES,
    cell: float = CELL,
) -> np.ndarray:
    """Keys of cells, (rows, tables, 1 + probes): a vector's own cell first.

    Vectors of another length or group have other cells.
    """
    n, size = vectors.shape
    whole = np.rint(unit(vectors) * _WHOLE)
    out = np.empty((n, tables, 1 + probes), np.int64)
    odd = np.array([pow(0x9E3779B97F4A7C15, i + 1, 2**64) for i in range(11)], np.uint64)
    for t in range(tables):
        plane = np.random.default_rng(100 + t).standard_normal((size, 8)) / np.sqrt(8) / cell
        # sums of whole numbers, so exact in any order
        at = (whole @ np.rint(plane * _FINE)) / (_WHOLE * _FINE)
        at = np.rint(at * (1 << 20)) / (1 << 20)
        home = decode(at)
        gain = (at - home) @ NEXT.T
        order = np.argsort(-gain, axis=1, kind="stable")[:, :probes]
        points = np.concatenate([home[:, None], home[:, None] + NEXT[order]], axis=1)
        codes = np.rint(2 * points).astype(np.int64).view(np.uint64)
        key = (codes * odd[:8]).sum(2, dtype=np.uint64)
        key += groups.astype(np.int64).view(np.uint64)[:, None] * odd[8]
        key += np.uint64((t * int(odd[9]) + size * int(odd[10])) % 2**64)
        key ^= key >> np.uint64(29)
        key *= np.uint64(0xBF58476D1CE4E5B9)
        out[:, t] = (key ^ (key >> np.uint64(32))).view(np.int64)
    return out


def prepare(rows: DataFrame) -> DataFrame:
    """(vec_id, label, v, h, g): usable vectors as doubles, with a hash of label and vector.

    ``v`` is null where the label or the vector is null, where the vector is empty or zero, or
    where it holds a null or a value that is not finite.
    """

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        lists, labels = batch.column("embedding"), batch.column("label").to_pylist()
        length = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        values = pc.cast(lists.flatten(), pa.float64()).to_numpy(zero_copy_only=False).astype(float) + 0.0
        ends = np.append(0, np.cumsum(length))
        bad, some = (np.diff(np.append(0, np.cumsum(x))[ends]) for x in (~np.isfinite(values), values != 0))
        packed, made, halves = values.tobytes(), [], []
        for i, label in enumerate(labels):
            usable = label is not None and not bad[i] and some[i]
            v = packed[8 * ends[i] : 8 * ends[i + 1]] if usable else None
            made.append(v)
            halves.append(
                divmod(xxhash.xxh3_128_intdigest(v + repr(label).encode()), 2**64) if usable else None
            )
        columns = [pa.array(made, pa.binary())]
        for i in (0, 1):
            columns.append(pa.array([None if x is None else x[i] - 2**63 for x in halves], pa.int64()))
        return columns

    rows = rows.select("vec_id", F.col("label").cast("long"), "embedding")
    return arrow_map(rows, run, "v binary, h long, g long", drop=("embedding",))


def near_vectors(
    rows: DataFrame,
    least: float = LEAST_COSINE,
    tables: int = TABLES,
    probes: int = PROBES,
    cell: float = CELL,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding, label).

    Equal vectors of a label form a class; classes are compared with each other, and
    a link to a class counts for each of its rows. Rows with null, empty, zero or not
    finite vectors and rows without a label have no links. Vectors of different length
    do not meet. A null vec_id is linked like any other and never names a component.
    """
    vectors = scratch(prepare(rows))
    classes = scratch(
        vectors.where(F.col("v").isNotNull())
        .groupBy("h", "g")
        .agg(
            F.min("vec_id").alias("id"),
            F.count("*").alias("many"),
            F.min("label").alias("label"),
            F.min("v").alias("v"),
        )
    )

    def file(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, same in frame.groupby(frame["v"].map(len)):
                found = cells(_stack(same["v"]), same["label"].to_numpy(), tables, probes, cell)
                per = tables * (1 + probes)
                home = np.zeros((len(same), tables, 1 + probes), bool)
                home[:, :, 0] = True
                spread = same.loc[same.index.repeat(per)]
                yield spread.assign(key=found.ravel(), home=home.ravel())

    filed = classes.select("h", "label", "many", "v").mapInPandas(
        file, "h long, label long, many long, v binary, key long, home boolean"
    )

    def link(frame: pd.DataFrame, start: np.ndarray) -> pd.DataFrame:
        names, many, key = (frame[c].to_numpy() for c in ("h", "many", "key"))
        home, meet = frame["home"].to_numpy(bool), meet_here(frame)
        length, label = frame["v"].map(len).to_numpy(), frame["label"].to_numpy()
        forest, links = Forest(len(frame)), np.zeros(len(frame), np.int64)
        # by length and label within a cell, should keys of different ones be equal
        order = np.lexsort((label, length, start))
        kinds = np.stack([start, length, label])[:, order]
        new = np.flatnonzero((kinds[:, 1:] != kinds[:, :-1]).any(0)) + 1
        for same in np.split(order, new):
            if not home[same].any():
                continue
            vectors = _stack(frame["v"].iloc[same])
            own = unit(vectors)
            i, j = np.nonzero(np.triu(own @ own.T >= least, 1))
            x, y = same[i], same[j]
            good = (home[x] | home[y]) & meet(x, y)
            i, j, x, y = i[good], j[good], x[good], y[good]
            if not len(x):
                continue
            # a pair that meets in several cells counts where it does so first
            mine = cells(vectors, label[same], tables, probes, cell)
            swap = names[x] > names[y]
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            x, y = same[i], same[j]
            first = np.zeros(len(x), np.int64)
            open_ = np.ones(len(x), bool)
            for t in range(tables):
                for p, q in ((i, j), (j, i)):
                    there = mine[p, t, 0]
                    here = open_ & (mine[q, t] == there[:, None]).any(1)
                    first[here] = there[here]
                    open_ &= ~here
            counted = first == key[x]
            np.add.at(links, x[counted], many[y[counted]])
            np.add.at(links, y[counted], many[x[counted]])
            forest.add(x, y)
        p, q = forest.links()
        some = links > 0
        return pd.DataFrame(
            {
                "a": np.concatenate([names[p], names[some]]),
                "b": np.concatenate([names[q], names[some]]),
                "n": np.concatenate([np.zeros(len(p), np.int64), links[some]]),
            }
        )

    # written once: it is counted and then joined
    dealt = deal_blocks(scratch(filed), "key", "h", 1024)
    found = scratch(in_cells(dealt, "key", link, "a long, b long, n long", 8_192))
    groups = components(found.where("a != b").select("a", "b"))
    joined = classes.join(groups, classes["h"] == groups["node"], "left").select(
        "h", "g", "id", "many", F.coalesce("component", "h").alias("component")
    )
    joined = scratch(joined)
    least_id = joined.groupBy("component").agg(F.min("id").alias("component_id"))
    counts = found.where("a = b").groupBy(F.col("a").alias("h")).agg(F.sum("n").alias("n"))
    named = scratch(
        joined.join(scratch(least_id), "component")
        .join(counts, "h", "left")
        .select("h", "g", "component_id", (F.coalesce("n", F.lit(0)) + F.col("many") - 1).alias("n_links"))
    )
    # rows without a usable vector match nothing here and are their own components
    result = vectors.select("vec_id", "h", "g").join(named, ["h", "g"], "left")
    component = F.when(F.col("h").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return result.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def _stack(values) -> np.ndarray:
    joined = np.frombuffer(b"".join(values), np.float64)
    return joined.reshape(len(values), -1)
