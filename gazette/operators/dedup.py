"""Three deduplication rules. They differ in what claims an id:

``label_qualifying``  the first copy that qualifies; a rejected copy claims nothing
``first_seen``        the first copy, qualifying or not, and the filter comes later
``label_inserts``     the first insertable copy that is not stored yet

All three need an order: a column, or several that count one after the other. Per
key only a minimum is computed, so copies are combined before the shuffle and no
group is ever held in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.functions.text import is_falsy, min_words
from gazette.operators.skew import ROWS_PER_SLICE, lookup_left
from gazette.schemas import MIN_WORDS

DUPLICATE, FILTERED, PUBLISHED = "duplicate", "filtered", "published"
DEAD, SKIPPED, INSERTED = "dead-letter", "skipped", "inserted"


def place(order: str | Sequence[str]) -> Column:
    """An order as one comparable column. Among several columns nulls come first."""
    names = [order] if isinstance(order, str) else list(order)
    return F.col(names[0]) if len(names) == 1 else F.struct(*names)


def _relative_to_winner(
    df: DataFrame,
    key: str,
    order: str | Sequence[str],
    qualifies: Column,
    seen: DataFrame | None,
    rows_per_slice: int,
) -> DataFrame:
    """Add ``_ok``, ``_winner`` (order of the first qualifying copy) and ``_seen``."""
    marked = df.withColumn("_ok", qualifies)
    winners = (
        marked.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(F.when(F.col("_ok"), place(order))).alias("_winner"))
    )
    if seen is None:
        winners = winners.withColumn("_seen", F.lit(False))
    else:
        # Distinct ids leave the aggregation partitioned like the winners, so
        # this join moves nothing.
        known = seen.select(key).where(F.col(key).isNotNull()).distinct()
        winners = winners.join(known.withColumn("_seen", F.lit(True)), key, "left")
    return lookup_left(marked, winners, key, place(order), rows_per_slice)


def label_qualifying(
    df: DataFrame,
    seen: DataFrame | None = None,
    key: str = "article_id",
    order: str | Sequence[str] = "seq",
    qualifies: Column | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Label every row ``duplicate``, ``filtered`` or ``published``.

    A row is a duplicate if its id is in ``seen`` or an earlier copy qualified;
    otherwise it is filtered if it does not qualify itself, else published.
    ``order`` must be unique among the rows of one key; name more columns if one
    is not.
    """
    qualifies = min_words("body", MIN_WORDS) if qualifies is None else qualifies
    placed = _relative_to_winner(df, key, order, qualifies, seen, rows_per_slice)
    earlier = F.coalesce(place(order) > F.col("_winner"), F.lit(False))
    return placed.withColumn(
        "label",
        F.when(F.coalesce(F.col("_seen"), F.lit(False)) | earlier, DUPLICATE)
        .when(F.col("_ok"), PUBLISHED)
        .otherwise(FILTERED),
    ).drop("_ok", "_winner", "_seen")


def label_inserts(
    df: DataFrame,
    stored: DataFrame | None = None,
    key: str = "article_id",
    order: str | Sequence[str] = "seq",
    usable: Column | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Label every row ``dead-letter``, ``skipped`` or ``inserted``.

    A row without an id is a dead letter. A row whose id is stored, or was
    inserted by an earlier row, is skipped even if its vector is unusable.
    Otherwise an unusable vector makes it a dead letter, else it is inserted. A
    vector is usable if it is not empty, unless ``usable`` says otherwise. ``order``
    must be unique among the rows of one key, as in ``label_qualifying``.
    """
    keyed = df.withColumn("_has_id", ~is_falsy(key)).withColumn(
        "_key", F.when(F.col("_has_id"), F.col(key))
    )
    if usable is None:
        usable = F.coalesce(F.size("embedding") > 0, F.lit(False))
    known = None if stored is None else stored.select(F.col(key).alias("_key"))
    placed = _relative_to_winner(keyed, "_key", order, usable, known, rows_per_slice)
    earlier = F.coalesce(place(order) > F.col("_winner"), F.lit(False))
    return placed.withColumn(
        "label",
        F.when(~F.col("_has_id"), DEAD)
        .when(F.coalesce(F.col("_seen"), F.lit(False)) | earlier, SKIPPED)
        .when(F.col("_ok"), INSERTED)
        .otherwise(DEAD),
    ).drop("_ok", "_winner", "_seen", "_has_id", "_key")


def first_seen(
    df: DataFrame,
    key: str = "article_id",
    order: str | Sequence[str] = "seq",
    then: Column | None = None,
    unique: bool = False,
) -> DataFrame:
    """The first copy of every id, of those the ones that satisfy ``then``.

    A first copy that fails ``then`` still claims its id. Rows without an id
    are left out. The aggregate reads narrow columns; whole rows move once, in a
    semi join on (key, order), which is nearly unique and therefore even. ``then``
    is applied before that join: the winners come from all rows.

    Of copies with the same order one comes out: of those that satisfy ``then``
    the one with the smallest hash of all its columns, so a recomputed task picks it
    again. Where the order is known to be ``unique`` the hash and its sort are spared.
    """
    placed = df.withColumn("_first", place(order))
    first = (
        placed.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("_first").alias("_first"))
    )
    candidates = placed if then is None else placed.where(then)
    found = candidates.join(first, [key, "_first"], "left_semi")
    if not unique:
        # Maps and variants have no hash; copies that differ only there are equal.
        hashed = [c for c, t in df.dtypes if "map<" not in t and "variant" not in t]
        one = F.min_by(F.struct(*df.columns), F.xxhash64(*hashed)).alias("_row")
        # Partitioned like the join, so this moves nothing.
        found = found.groupBy(key, "_first").agg(one).select("_row.*")
    return found.select(*df.columns)


def first_seen_long(df: DataFrame, n: int = MIN_WORDS, **options) -> DataFrame:
    """First copies whose body has at least ``n`` words."""
    return first_seen(df, then=min_words("body", n), **options)


def merge_ranked(
    lists: list[DataFrame], limit: int, item: str = "id", position: str = "position"
) -> DataFrame:
    """Concatenate ranked lists, keep the first occurrence of an item, cap at ``limit``.

    Each list is first cut to its own ``limit`` best positions (positions start
    at 0), so what is merged holds at most ``len(lists) * limit`` rows.
    """
    tagged = None
    for number, ranked in enumerate(lists):
        head = ranked.where((F.col(position) >= 0) & (F.col(position) < limit)).select(
            item, F.lit(number).alias("list_no"), F.col(position).alias("list_position")
        )
        tagged = head if tagged is None else tagged.unionByName(head)
    place = F.struct("list_no", "list_position")
    return (
        tagged.groupBy(item)
        .agg(F.min(place).alias("_place"))
        .select(item, "_place.*")
        .orderBy("list_no", "list_position")
        .limit(limit)
    )
