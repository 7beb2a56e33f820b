"""Topic routing and record serialisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette.functions.text import as_col, iso_time, lookup
from gazette.schemas import DEFAULT_TOPIC, SECTION_TOPICS


def route_section(section: Column | str) -> Column:
    """Topic of a section; anything unknown goes to the default topic."""
    return lookup(SECTION_TOPICS, as_col(section), DEFAULT_TOPIC)


def fan_out(df: DataFrame) -> DataFrame:
    """Tag every row with its topic: one pass, one topic per row."""
    return df.withColumn("topic", route_section("section"))


def as_json(df: DataFrame, columns: list[str] | None = None) -> Column:
    """The given columns as one JSON object, timestamps as ISO-8601 UTC text."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    return F.to_json(
        F.struct(
            *[
                iso_time(f.name).alias(f.name)
                if isinstance(f.dataType, T.TimestampType)
                else F.col(f.name)
                for f in fields
            ]
        )
    )


def keyed_messages(df: DataFrame, topic: Column, columns: list[str] | None = None) -> DataFrame:
    """Rows as messages: the id as key, the JSON record as value."""
    return df.select(
        F.col("article_id").alias("key"), as_json(df, columns).alias("value"), topic.alias("topic")
    )


def _variants(fields: dict[str, Column]) -> Column:
    """Columns as a map of JSON values."""
    values = [F.parse_json(F.to_json(F.struct(c.alias("v")))) for c in fields.values()]
    wrapped = F.map_from_arrays(F.array(*[F.lit(n) for n in fields]), F.array(*values))
    return F.transform_values(wrapped, lambda _, v: F.try_variant_get(v, "$.v", "variant"))


def dead_value(added: dict[str, Column], original: Column | str = "value") -> Column:
    """The original JSON object with further fields, whatever else it holds.

    A NULL field is left out: the stage had not got to it. An original that is
    no JSON object is kept as text under ``_raw``.
    """
    members = F.try_variant_get(F.try_parse_json(as_col(original)), "$", "map<string, variant>")
    base = F.coalesce(members, _variants({"_raw": as_col(original)}))
    new = F.map_filter(_variants(added), lambda _, v: v.isNotNull())
    kept = F.map_filter(base, lambda k, _: ~F.map_contains_key(new, k))
    return F.to_json(F.map_concat(kept, new))
