"""What several operators of this subpackage need."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazette.session import cut_lineage, hadoop_path

# Words are runs of anything but ASCII white space; this is also how
# bytes.split() sees them.
WORD = r"[^\x20\x09-\x0D]+"


def scratch(df: DataFrame) -> DataFrame:
    """Write a table to the shared checkpoint folder and read it from there."""
    return cut_lineage(df)


def drop_scratch(df: DataFrame) -> None:
    """Remove a table of ``scratch`` that nothing reads any more."""
    spark = df.sparkSession
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        fs, target = hadoop_path(spark, path)
        fs.delete(target, True)


def text_bytes(column: str | Column = "text") -> Column:
    """A text as UTF-8 bytes; null counts as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit("")).cast("binary")


def text_digest(column: str = "text") -> Column:
    """Tells the texts of rows with the same id apart."""
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")))


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, over the batches of a task; what it leaves free goes back to the system.

    Spark keeps Python workers for later tasks, of other stages too, beside the executor's
    growing heap, and allocators keep what was free when the last batch had gone.
    """

    def go(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return go


def give_back() -> None:
    """Return the free memory of Arrow and, where it is glibc's, of the C library to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def arrow_map(
    rows: DataFrame, run: Callable[[pa.RecordBatch], list[pa.Array]], added: str, drop: tuple = ()
) -> DataFrame:
    """``rows`` with columns ``added``, which ``run`` makes of each Arrow batch.

    The other columns stay in Arrow, so ids of any type pass unchanged, beside nulls too.
    Columns in ``drop`` are for ``run`` only.
    """
    kept = [c for c in rows.columns if c not in drop]
    schema = ", ".join([f"`{c}` {t}" for c, t in rows.dtypes if c not in drop] + [added])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = None
        for batch in batches:
            new = run(batch)
            names = names or kept + [f.split()[0].strip("`") for f in _fields(added)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + new, names=names)

    return rows.mapInArrow(frugal(go), schema)


def in_text(rows: DataFrame, column: str = "doc_id") -> DataFrame:
    """``rows`` with ids as text: beside a null, pandas would make doubles of whole numbers."""
    return rows.withColumn(column, F.col(column).cast("string"))


def _fields(schema: str) -> list[str]:
    """The fields of a schema in words, without those within brackets."""
    fields, depth = [""], 0
    for c in schema:
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            fields.append("")
        else:
            fields[-1] += c
    return fields


def groups_of(
    frames: Iterator[pd.DataFrame], keys: list[str], rows: int = 65_536
) -> Iterator[pd.DataFrame]:
    """Cut sorted batches again so that no group of ``keys`` is torn.

    Every frame holds whole groups and, unless a single group is larger, about
    ``rows`` rows.
    """
    held: list[pd.DataFrame] = []
    size = 0
    for frame in frames:
        if not len(frame):
            continue
        held.append(frame)
        size += len(frame)
        if size < rows:
            continue
        whole = pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
        last = len(whole) - 1
        same = np.ones(len(whole), bool)
        for key in keys:
            values = whole[key].to_numpy()
            same &= values == values[last]
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut:
            yield whole.iloc[:cut].reset_index(drop=True)
        held, size = [whole.iloc[cut:]], len(whole) - cut
    if size:
        yield pd.concat(held, ignore_index=True)


def group_starts(frame: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """For every row, the position of the first row of its group."""
    new = np.zeros(len(frame), bool)
    new[0] = True
    for key in keys:
        values = frame[key].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    starts = np.flatnonzero(new)
    return np.repeat(starts, np.diff(np.append(starts, len(frame))))


class Forest:
    """Union-find over the rows of one frame; only links that join two trees are kept."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        apart = self.root[a] != self.root[b]
        if not apart.any():
            return
        root = self.root
        for x, y in zip(root[a[apart]].tolist(), root[b[apart]].tolist(), strict=True):
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            if x != y:
                root[max(x, y)] = min(x, y)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, root) of every row that is not its own root."""
        rows = np.flatnonzero(self.root != np.arange(len(self.root)))
        return rows, self.root[rows]


def pairs_by_shift(start: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows in the same group, a diagonal at a time."""
    rows = np.arange(len(start))
    shift = 1
    while True:
        rows = rows[rows + shift < len(start)]
        rows = rows[start[rows + shift] == start[rows]]
        if not len(rows):
            return
        yield rows, rows + shift
        shift += 1


def deal_blocks(rows: DataFrame, key: str, identity: str, block: int = 2048) -> DataFrame:
    """Split the rows of frequent keys over pairs of blocks.

    Adds ``low``, ``high`` (a cell: two blocks of a key) and ``own`` (the row's
    block). Two rows of a key meet in at least one cell, and a cell holds about
    ``2 * block`` rows however frequent its key is. Rows of other keys stay in
    the one cell (0, 0).
    """
    heavy = scratch(
        rows.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > block)
    )
    blocks = F.coalesce(F.ceil(F.col("_n") / block), F.lit(1)).cast("int")
    return (
        rows.join(heavy, key, "left")
        .withColumn("own", F.pmod(F.xxhash64(F.lit(11), identity), blocks).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("low", F.least("own", "_other"))
        .withColumn("high", F.greatest("own", "_other"))
        .drop("_n", "_other")
    )


def in_cells(
    rows: DataFrame,
    key: str,
    function: Callable,
    schema: str,
    frame_rows: int = 65_536,
    tasks: int | None = None,
) -> DataFrame:
    """Apply ``function`` to frames of whole cells of ``deal_blocks``.

    The cells are dealt over ``tasks``; if not given, over as many as their size in bytes asks for.
    """
    cell = [key, "low", "high"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in groups_of(frames, cell, frame_rows):
            start = group_starts(frame, cell)
            size = np.bincount(start, minlength=len(frame))[start]
            if not (size > 1).any():
                continue
            frame = frame[size > 1].reset_index(drop=True)
            yield function(frame, group_starts(frame, cell))

    dealt = rows.repartition(tasks, *cell) if tasks else rows.repartition(*cell)
    return dealt.sortWithinPartitions(*cell).mapInPandas(frugal(run), schema)


def meet_here(frame: pd.DataFrame) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Whether a pair of rows is to be compared in this cell.

    In a cell of two blocks only rows of different blocks are, since each block
    also has a cell of its own.
    """
    own = frame["own"].to_numpy()
    single = frame["low"].to_numpy() == frame["high"].to_numpy()
    return lambda a, b: single[a] | (own[a] != own[b])


def numbered(
    rows: DataFrame,
    group: str,
    spread: Column,
    order: list[str],
    narrow: DataFrame | None = None,
    least: int = 250,
) -> DataFrame:
    """Number the rows of every group from 0, in ``rank``; hot groups are dealt over chunks.

    A group of n rows has n / max(least, sqrt(n)) chunks, chosen by ``spread``, a
    long that is a function of the row. The order is that of the chunks, then of
    ``order``. Counts per chunk are summed up to offsets, so no window holds more
    than one chunk, or one count for each chunk of a group. ``narrow`` may give the
    same rows with fewer columns, for counting. Nulls are a group like any other.
    """
    narrow = rows if narrow is None else narrow
    name = F.col(group)
    sizes = scratch(narrow.groupBy(name.alias("_g")).agg(F.count("*").alias("_n")))
    chunks = F.ceil(F.col("_n") / F.greatest(F.lit(float(least)), F.sqrt("_n")))

    def dealt(frame: DataFrame) -> DataFrame:
        return frame.join(sizes, name.eqNullSafe(F.col("_g"))).withColumn(
            "_chunk", F.pmod(spread, chunks.cast("long"))
        )

    before = Window.partitionBy("_g").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt(narrow).groupBy("_g", "_chunk").agg(F.count("*").alias("_c"))
    offsets = scratch(
        counts.select(
            F.col("_g").alias("_h"),
            F.col("_chunk").alias("_hunk"),
            F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"),
        )
    )
    within = F.row_number().over(Window.partitionBy("_g", "_chunk").orderBy(*order))
    return (
        dealt(rows)
        .withColumn("_within", within)
        .join(
            offsets,
            F.col("_g").eqNullSafe(F.col("_h")) & (F.col("_chunk") == F.col("_hunk")),
        )
        .withColumn("rank", F.col("_before") + F.col("_within") - 1)
        .drop("_g", "_n", "_chunk", "_within", "_h", "_hunk", "_before")
    )
