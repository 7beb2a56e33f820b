"""Linking tool calls with their results, in order, validated, as canonical JSON."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import scratch

DEEPEST = 200  # levels of lists and objects

_KINDS = {
    "string": lambda v: isinstance(v, str),
    "integer": lambda v: not isinstance(v, bool) and (isinstance(v, int) or isinstance(v, float) and v.is_integer()),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "array": lambda v: isinstance(v, list),
    "object": lambda v: isinstance(v, dict),
}


def violations(value, schema: dict, path: str = "$") -> list[str]:
    """Where ``value`` breaks a schema of types, enums, bounds, required and nested parts.

    A type that JSON Schema does not know matches nothing.
    """
    found = []
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(k in _KINDS and _KINDS[k](value) for k in kinds):
        return [f"{path}: not of type {'|'.join(kinds)}"]
    if "enum" in schema and not any(_same(value, x) for x in schema["enum"]):
        found.append(f"{path}: not an allowed value")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", -math.inf) or value > schema.get("maximum", math.inf):
            found.append(f"{path}: out of range")
    if isinstance(value, str) and len(value) < schema.get("minLength", 0):
        found.append(f"{path}: too short")
    if isinstance(value, dict):
        parts = schema.get("properties", {})
        found += [f"{path}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for name in sorted(value):
            if name in parts:
                found += violations(value[name], parts[name], f"{path}.{name}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{path}.{name}: unknown")
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            found += violations(item, schema["items"], f"{path}[{i}]")
    return found


def _same(a, b) -> bool:
    """Equal as JSON values: 1 is 1.0 but not true."""
    if isinstance(a, bool) or isinstance(b, bool):
        return a is b
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(_same, a, b))
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(_same(a[k], b[k]) for k in a)
    return a == b


def _no_constant(name: str):
    raise ValueError(name)


def _finite(text: str) -> float:
    number = float(text)
    if math.isinf(number):
        raise ValueError(f"{text} is too large")
    return number


def _depth(value) -> int:
    """Levels of lists and objects in each other."""
    levels, here = 0, [value]
    while here := [x for x in here if isinstance(x, (list, dict))]:
        levels += 1
        here = [y for x in here for y in (x.values() if isinstance(x, dict) else x)]
    return levels


def read_arguments(text: str | None):
    """The parsed arguments, or a ValueError.

    NaN, infinities and numbers beyond a double are no JSON here, and neither is what
    is nested deeper than ``DEEPEST``.
    """
    if text is None:
        raise ValueError("no arguments")
    try:
        value = json.loads(text, parse_constant=_no_constant, parse_float=_finite)
    except RecursionError:
        raise ValueError("nested too deep") from None
    if _depth(value) > DEEPEST:
        raise ValueError("nested too deep")
    return value


def _escaped(text: str) -> str:
    """Halves of surrogate pairs, which no UTF-8 text can hold, as JSON writes them."""
    return re.sub("[\ud800-\udfff]", lambda m: f"\\u{ord(m[0]):04x}", text)


def canonical(value) -> str:
    """Keys in order, no spaces, characters as they are; a NaN is an error."""
    return _escaped(
        json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    )


def depths(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth): how many calls lead to each, null within or after a cycle.

    ``calls`` has one row per (conv_id, call_id), and the call it follows as
    ``parent_id``, or null. Every round doubles the stretch a row looks back over, so
    the rounds grow with the logarithm of the longest chain. A parent that
    is not there ends the chain.
    """
    known = calls.select("conv_id", F.col("call_id").alias("_p"))
    at = scratch(
        calls.join(
            known.withColumnRenamed("conv_id", "_c"),
            (F.col("conv_id") == F.col("_c")) & (F.col("parent_id") == F.col("_p")),
            "left",
        ).select(
            "conv_id",
            "call_id",
            F.col("_p").alias("up"),
            F.when(F.col("_p").isNotNull(), 1).otherwise(0).cast("long").alias("depth"),
        )
    )
    most = at.count()
    reach = 1
    while reach <= most and at.where("up IS NOT NULL").limit(1).count():
        above = at.select(
            F.col("conv_id").alias("_c"),
            F.col("call_id").alias("_u"),
            F.col("up").alias("_up"),
            F.col("depth").alias("_d"),
        )
        at = scratch(
            at.join(above, (F.col("conv_id") == F.col("_c")) & (F.col("up") == F.col("_u")), "left")
            .select(
                "conv_id",
                "call_id",
                F.col("_up").alias("up"),
                (F.col("depth") + F.coalesce("_d", F.lit(0))).alias("depth"),
            )
        )
        reach *= 2
    return at.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row for each (conv_id, call_id) of a call or a result.

    ``calls``: conv_id, call_id, turn, name, arguments (JSON), parent_id; ``results``:
    conv_id, call_id, turn, content. They are joined by conversation and id. Of repeated calls or results
    the first by turn (then by content) stands; ``n_calls`` and ``n_results`` tell how many there were.
    (depth, turn, call_id) is a topological order: a call comes after those it follows.
    ``errors`` lists, joined by "; ", what is wrong with a row, ``valid`` is true if nothing
    is; ``json`` is the canonical form of the call with its result, or null without a call.
    Rows whose conversation or id is null are linked with nothing and returned with an error.
    """
    key = ["conv_id", "call_id"]
    absent = F.col("conv_id").isNull() | F.col("call_id").isNull()
    first_calls = (
        calls.where(~absent)
        .groupBy(*key)
        .agg(
            F.min(F.struct("turn", "name", "arguments", "parent_id")).alias("c"),
            F.count("*").alias("n_calls"),
        )
        .select(*key, "c.*", "n_calls")
    )
    first_calls = scratch(first_calls)
    first_results = (
        results.where(~absent)
        .groupBy(*key)
        .agg(F.min(F.struct("turn", "content")).alias("r"), F.count("*").alias("n_results"))
        .select(*key, F.col("r.turn").alias("result_turn"), "r.content", "n_results")
    )
    parents = first_calls.select(
        F.col("conv_id").alias("_c"), F.col("call_id").alias("_p"), F.lit(True).alias("parent_known")
    )
    ordered = (
        first_calls.join(depths(first_calls), key)
        .join(
            scratch(parents),
            (F.col("conv_id") == F.col("_c")) & (F.col("parent_id") == F.col("_p")),
            "left",
        )
        .drop("_c", "_p")
    )
    linked = ordered.join(first_results, key, "full_outer")
    loose = calls.where(absent).select(
        *key, "turn", "name", "arguments", "parent_id", F.lit(1).cast("long").alias("n_calls")
    )
    loose = loose.unionByName(
        results.where(absent).select(
            *key,
            F.col("turn").alias("result_turn"),
            "content",
            F.lit(1).cast("long").alias("n_results"),
        ),
        allowMissingColumns=True,
    )
    linked = linked.unionByName(loose, allowMissingColumns=True)

    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.itertuples():
                out.append(_checked(row, schemas))
            frame["errors"] = [e for e, _ in out]
            frame["json"] = [j for _, j in out]
            yield frame[_OUT]

    types = dict(linked.dtypes)
    # numbers that may be null keep their type as text
    text = linked.select(
        *[F.col(c).cast("string").alias(c) for c in linked.columns if c != "parent_known"], "parent_known"
    )
    checked = text.mapInPandas(check, ", ".join(f"{c} string" for c in _OUT))
    typed = checked.select(*[F.col(c).cast(types.get(c, "string")).alias(c) for c in _OUT])
    return typed.withColumn("valid", F.col("errors") == "").fillna(0, ["n_calls", "n_results"])


_OUT = ["conv_id", "call_id", "depth", "turn", "name", "n_calls", "n_results", "errors", "json"]


def _is_null(value) -> bool:
    return value is None or value != value


def _checked(row, schemas: dict[str, dict]) -> tuple[str, str | None]:
    errors = []
    if _is_null(row.conv_id) or _is_null(row.call_id):
        errors.append("no identifier")
    if _is_null(row.n_calls):
        return "; ".join([*errors, "result without call"]), None
    arguments = None if _is_null(row.arguments) else row.arguments
    if _is_null(row.name) or row.name not in schemas:
        errors.append("unknown tool")
    try:
        arguments = read_arguments(arguments)
    except ValueError:
        errors.append("arguments are not JSON")
    else:
        errors += violations(arguments, schemas.get(row.name, {}))
    if not _is_null(row.parent_id) and _is_null(row.depth):
        errors.append("follows itself")
    elif not _is_null(row.parent_id) and not row.parent_known:
        errors.append("follows an unknown call")
    if _is_null(row.n_results):
        errors.append("no result")
    elif not _is_null(row.turn) and not _is_null(row.result_turn) and int(row.result_turn) < int(row.turn):
        errors.append("result before call")
    whole = {
        "id": None if _is_null(row.call_id) else row.call_id,
        "name": None if _is_null(row.name) else row.name,
        "arguments": arguments,
        "result": None if _is_null(row.content) else row.content,
    }
    return _escaped("; ".join(errors)), canonical(whole)
