"""Model-backed enrichment: prompts, the model call, reading its replies."""

from __future__ import annotations

import queue
import threading
import time
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette.functions.rows import computed_once
from gazette.functions.text import SPACE, as_col, ellipsize, strip
from gazette.operators.validate import (
    as_of_literal,
    enriched_failures,
    first_missing,
)
from gazette.schemas import (
    BODY_CONTEXT_CHARS,
    DOMAIN_TAGS,
    MAX_ENTITIES,
    SENTIMENTS,
    SUMMARY_MAX,
)

# Called once per task; returns what turns prompts into one reply per prompt.
ModelFactory = Callable[[], Callable[[Sequence[str]], Sequence[str]]]

GIVE_UP = 8

REPLIES = T.ArrayType(
    T.StructType(
        [T.StructField("text", T.StringType()), T.StructField("error", T.StringType())]
    )
)

_TAGS = ", ".join(DOMAIN_TAGS)
PROMPTS = {
    "summary": (
        "Write a three-sentence summary of the article below. Reply with the summary only.\n\n"
        "Article:\n{article}"
    ),
    "entities": (
        "List at most five people, organisations or countries named in the article below, as "
        "a JSON array of strings, or [] if there are none. Reply with the array only.\n\n"
        "Article:\n{article}"
    ),
    "sentiment": (
        "Judge the tone of the article below. Reply only with a JSON object that has the keys "
        '"sentiment" (Positive, Negative or Neutral) and "reason" (one sentence).\n\n'
        "Article:\n{article}"
    ),
    "domain_tag": (
        f"Pick the one tag that fits the article below best: {_TAGS}. Reply with the tag "
        "only.\n\nArticle:\n{article}"
    ),
    "unified": (
        "Read the article below and reply only with a JSON object that has the keys "
        '"summary" (three sentences), "entities" (an array of at most five names of people, '
        'organisations or countries), "sentiment" (Positive, Negative or Neutral), '
        '"sentiment_reason" (one sentence) and "domain_tag" (one of '
        f"{_TAGS}).\n\n"
        "Article:\n{article}"
    ),
}
FALLBACK_KINDS = ("summary", "entities", "sentiment", "domain_tag")


def build_context(
    headline: Column | str = "headline",
    body: Column | str = "body",
    body_chars: int | None = BODY_CONTEXT_CHARS,
) -> Column:
    """What the model gets to read: the headline and the start of the body, or all of it."""
    text = F.coalesce(as_col(body), F.lit(""))
    return F.concat(
        F.coalesce(as_col(headline), F.lit("")),
        F.lit("\n\n"),
        text if body_chars is None else F.substring(text, 1, body_chars),
    )


def render_prompt(kind: str, context: Column) -> Column:
    """The prompt of one kind. Braces in the article have no meaning here."""
    before, after = PROMPTS[kind].split("{article}")
    return F.concat(F.lit(before), context, F.lit(after))


def _call(model, prompts: list[str]) -> list[dict]:
    """Replies or errors; a batch that fails is halved until the bad prompt is alone."""
    try:
        return [{"text": reply, "error": None} for reply in model(prompts)]
    except Exception as exc:
        if len(prompts) == 1:
            return [{"text": None, "error": str(exc) or type(exc).__name__}]
        half = len(prompts) // 2
        return _call(model, prompts[:half]) + _call(model, prompts[half:])


def _call_within(model, prompts: Iterable[str], seconds: float, at_once: int) -> list[dict]:
    """A call for each prompt, ``at_once`` at the same time, none waited for longer than ``seconds``.

    A call that is late is left to itself and its place is given to the next one. Once
    ``GIVE_UP`` times ``at_once`` calls hang, the model counts as gone and what is left fails at once.
    A prompt is taken when it is its turn, and one that hangs holds no other.
    """
    answers: list[dict | None] = []
    done: queue.SimpleQueue = queue.SimpleQueue()
    waiting = enumerate(prompts)
    running: dict[int, float] = {}
    late = 0

    def call(at: int, prompt: str) -> None:
        done.put((at, _call(model, [prompt])[0]))

    while True:
        gone = late >= GIVE_UP * at_once
        while len(running) < at_once and (taken := next(waiting, None)) is not None:
            if gone:
                answers.append({"text": None, "error": "the model does not answer any more"})
                continue
            at, prompt = taken
            answers.append(None)
            running[at] = time.monotonic() + seconds
            threading.Thread(target=call, args=(at, prompt), daemon=True).start()
        if not running:
            return answers
        try:
            at, answer = done.get(timeout=max(0.0, min(running.values()) - time.monotonic()))
            if running.pop(at, None) is not None:  # what comes too late is not used
                answers[at] = answer
        except queue.Empty:
            for at in [x for x, end in running.items() if end <= time.monotonic()]:
                del running[at]
                late += 1
                answers[at] = {"text": None, "error": f"no reply within {seconds:g} seconds"}


def infer(
    prompts: Column, factory: ModelFactory, seconds: float | None = None, at_once: int = 1
) -> Column:
    """Replies to an array of prompts, as ``array<struct<text, error>>``.

    The model is built once per task and gets all prompts of an Arrow batch in
    one call. With a deadline of ``seconds`` it gets every prompt in a call of its own,
    ``at_once`` of them at the same time, so it must be safe to call from several threads; a
    late call becomes an error and holds nothing up. A NULL array costs nothing and gives
    NULL. The expression counts as nondeterministic, so no rule moves a filter or a copy
    of it elsewhere and every prompt is sent once.
    """

    def replies_to(model, flat: pa.Array) -> list[dict]:
        if not len(flat):
            return []
        if seconds is None:
            return _call(model, flat.to_pylist())
        return _call_within(model, (prompt.as_py() for prompt in flat), seconds, at_once)

    @F.arrow_udf(REPLIES)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = factory()
        for batch in batches:
            sizes = pc.list_value_length(batch).to_pylist()
            replies = iter(replies_to(model, batch.flatten()))
            yield pa.array(
                [None if n is None else [next(replies) for _ in range(n)] for n in sizes],
                pa.list_(pa.struct([("text", pa.string()), ("error", pa.string())])),
            )

    return run.asNondeterministic()(prompts)


# --- reading replies ---------------------------------------------------------


def unfence(text: Column) -> Column:
    """Reply text without surrounding white space and Markdown code fence."""
    opened = F.regexp_replace(strip(text), rf"^```(?:json)?{SPACE}*", "")
    return F.regexp_replace(opened, rf"{SPACE}*```\z", "")


def read_json(text: Column) -> Column:
    """A reply's JSON as a variant; NULL if it cannot be read.

    An object or array that does not end in its bracket goes on with text and is not read.
    Of repeated keys the last counts (a setting of ``session.tune``), and NaN and
    infinities are numbers.
    """
    goes_on = (text.startswith("{") & ~text.endswith("}")) | (
        text.startswith("[") & ~text.endswith("]")
    )
    # Slower, and only worked out for what the other cannot read.
    lenient = F.from_json(text, "variant", {"allowSingleQuotes": "false"})
    return F.when(~goes_on, F.coalesce(F.try_parse_json(text), lenient))


def _described(value: Column) -> Column:
    """A JSON value's type and text, worked out once for what looks at both."""
    return F.struct(
        F.schema_of_variant(value).alias("kind"), value.cast("string").alias("text")
    )


def _plain_text(described: Column) -> Column:
    """A JSON value as text the way Python's str() shows it.

    Nested values differ: they come out as JSON instead of a Python literal.
    """
    kind, text = described["kind"], described["text"]
    return (
        F.when(kind == "VOID", F.lit("None"))
        .when(kind == "BOOLEAN", F.initcap(text))
        .when((kind == "DOUBLE") & (text == "NaN"), F.lit("nan"))
        .when(
            (kind == "DOUBLE") & text.endswith("Infinity"),
            F.replace(text, F.lit("Infinity"), F.lit("inf")),
        )
        .otherwise(text)
    )


def _is_truthy(described: Column) -> Column:
    kind, text = described["kind"], described["text"]
    return (
        F.when(kind == "STRING", text != "")
        .when(kind == "VOID", F.lit(False))
        .when(kind == "BOOLEAN", text == "true")
        .when(text.isin("[]", "{}"), F.lit(False))
        .otherwise(F.coalesce(text.try_cast("double") != 0, F.lit(True)))
    )


def coerce_summary(summary: Column) -> Column:
    """Stripped, and cut with three dots if it is too long."""
    return ellipsize(strip(summary), SUMMARY_MAX)


def coerce_entities(value: Column) -> Column:
    """A JSON array's truthy items as stripped text, the first five of them.

    Anything but an array counts as an empty one. An item of white space is
    truthy, so it stays, as an empty string.
    """
    items = F.coalesce(
        F.try_variant_get(value, "$", "array<variant>"), F.array().cast("array<variant>")
    )
    found = F.slice(F.filter(F.transform(items, _described), _is_truthy), 1, MAX_ENTITIES)
    return F.transform(found, lambda e: strip(_plain_text(e)))


def coerce_sentiment(sentiment: Column) -> Column:
    """Stripped, ``Neutral`` unless it is one of the known values."""
    value = strip(sentiment)
    return F.when(value.isin(*SENTIMENTS), value).otherwise("Neutral")


def coerce_tag(tag: Column) -> Column:
    """Stripped, ``Other`` unless it is one of the known tags."""
    value = strip(tag)
    return F.when(value.isin(*DOMAIN_TAGS), value).otherwise("Other")


ENRICHMENT_FIELDS = ("summary", "entities", "sentiment", "sentiment_reason", "domain_tag")


def _answer(summary: Column, entities: Column, sentiment: Column, reason: Column, tag: Column):
    return F.struct(
        coerce_summary(summary).alias("summary"),
        coerce_entities(entities).alias("entities"),
        coerce_sentiment(sentiment).alias("sentiment"),
        strip(reason).alias("sentiment_reason"),
        coerce_tag(tag).alias("domain_tag"),
    )


def _or_default(value: Column, default: str) -> Column:
    return F.when(value.isNull(), F.lit(default)).otherwise(_plain_text(_described(value)))


def parse_unified(df: DataFrame, reply: Column, into: str) -> DataFrame:
    """Add the unified reply as a struct of coerced fields.

    NULL unless the reply is a JSON object with the keys ``summary`` and
    ``sentiment``; a key that holds JSON null counts as there. The steps are
    columns of their own so that a reply is parsed once.
    """
    read = df.withColumn("_text", unfence(reply)).withColumn(
        "_fields",
        F.when(
            F.col("_text").startswith("{"),
            F.try_variant_get(read_json(F.col("_text")), "$", "map<string, variant>"),
        ),
    )

    def at(name: str) -> Column:
        return F.try_element_at("_fields", F.lit(name))

    answer = F.when(
        at("summary").isNotNull() & at("sentiment").isNotNull(),
        _answer(
            _plain_text(_described(at("summary"))),
            at("entities"),
            _plain_text(_described(at("sentiment"))),
            _or_default(at("sentiment_reason"), ""),
            _or_default(at("domain_tag"), "Other"),
        ),
    )
    return computed_once(read, [answer.alias(into)], *df.columns)


def parse_separate(
    df: DataFrame, summary: Column, entities: Column, sentiment: Column, tag: Column, into: str
) -> DataFrame:
    """Add four separate replies as the same struct; NULL if one is unreadable.

    A sentiment reply that is not an object is ``Neutral`` without a reason.
    """
    texts = df.withColumns({"_e": unfence(entities), "_s": unfence(sentiment)})
    read = texts.withColumns(
        {"_listed": read_json(F.col("_e")), "_judged": read_json(F.col("_s"))}
    )
    judged = F.col("_judged")
    answer = F.when(
        summary.isNotNull() & tag.isNotNull() & F.col("_listed").isNotNull() & judged.isNotNull(),
        _answer(
            summary,
            F.col("_listed"),
            _or_default(F.try_variant_get(judged, "$.sentiment", "variant"), "Neutral"),
            _or_default(F.try_variant_get(judged, "$.reason", "variant"), ""),
            tag,
        ),
    )
    return computed_once(read, [answer.alias(into)], *df.columns)


def enrich(
    df: DataFrame,
    factory: ModelFactory,
    as_of,
    body_chars: int | None = BODY_CONTEXT_CHARS,
    seconds: float | None = None,
    at_once: int = 1,
) -> DataFrame:
    """Raw articles with the enrichment columns and ``_error``.

    ``_error`` is NULL for a good article. Rows that lack a required field are
    never sent to the model, and only rows whose unified reply is unreadable
    are sent the four separate prompts. ``seconds`` and ``at_once`` are those of ``infer``: a
    unified call that is late falls back to the separate ones, and if these are late too the row
    is a dead letter.
    """
    context = build_context(body_chars=body_chars)
    asked = df.withColumn("_missing", first_missing("article_id", "headline", "body")).withColumn(
        "_unified",
        infer(
            F.when(F.col("_missing").isNull(), F.array(render_prompt("unified", context))),
            factory,
            seconds,
            at_once,
        ),
    )
    read = parse_unified(asked, F.get("_unified", 0)["text"], "_parsed")
    again = F.col("_missing").isNull() & F.col("_parsed").isNull()
    retried = read.withColumn(
        "_separate",
        infer(
            F.when(again, F.array(*[render_prompt(k, context) for k in FALLBACK_KINDS])),
            factory,
            seconds,
            at_once,
        ),
    )
    texts = [F.get("_separate", i)["text"] for i in range(len(FALLBACK_KINDS))]
    answered = parse_separate(retried, *texts, into="_second").withColumn(
        "_answer", F.coalesce("_parsed", "_second")
    )
    merged = answered.withColumns(
        {name: F.col(f"_answer.{name}") for name in ENRICHMENT_FIELDS}
        | {"enriched_at": F.when(F.col("_answer").isNotNull(), as_of_literal(as_of))}
    )
    model_error = F.when(
        F.col("_answer").isNull(),
        F.coalesce(
            *[F.get("_separate", i)["error"] for i in range(len(FALLBACK_KINDS))],
            F.lit("unreadable model reply"),
        ),
    )
    failures = enriched_failures()
    return merged.withColumn(
        "_error",
        F.coalesce(
            F.col("_missing"),
            model_error,
            F.when(F.size(failures) > 0, F.concat_ws("; ", failures)),
        ),
    ).drop("_missing", "_unified", "_parsed", "_separate", "_second", "_answer")
