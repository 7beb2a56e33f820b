"""Prompts, replies, the model hook and the gate."""

import gc
import json
import threading
import time
import weakref

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from builders import AS_OF, SUMMARY, enriched, frame, plan_of, raw
from gazette.functions.vectors import embed_text, hashing_embedder
from gazette.operators import enrich as module
from gazette.operators.enrich import (
    PROMPTS,
    build_context,
    coerce_entities,
    coerce_summary,
    coerce_tag,
    enrich,
    infer,
    parse_separate,
    parse_unified,
    render_prompt,
)
from gazette.operators.gate import quality_gate
from gazette.schemas import ARTICLE, DOMAIN_TAGS, ENRICHED, SENTIMENTS

GOOD = {
    "summary": SUMMARY,
    "entities": ["A", "B"],
    "sentiment": "Positive",
    "sentiment_reason": "Upbeat.",
    "domain_tag": "AI",
}


def parse(spark, replies):
    rows = spark.createDataFrame([(i, r) for i, r in enumerate(replies)], "i long, reply string")
    parsed = parse_unified(rows, F.col("reply"), into="p").orderBy("i").collect()
    return [r.p.asDict() if r.p is not None else None for r in parsed]


def model_of_unified(reply):
    """What a plain Python reader of a unified reply would make of it."""
    text = reply.strip()
    for fence in ("```json", "```"):
        if text.startswith(fence):
            text = text[len(fence) :].lstrip()
            break
    if text.endswith("```"):
        text = text[:-3].rstrip()
    try:
        data = json.loads(text)
    except json.JSONDecodeError:
        return None
    if not isinstance(data, dict) or not {"summary", "sentiment"} <= set(data):
        return None
    summary = str(data["summary"]).strip()
    entities = data.get("entities", [])
    entities = [str(e).strip() for e in entities if e][:5] if isinstance(entities, list) else []
    sentiment, tag = str(data["sentiment"]).strip(), str(data.get("domain_tag", "Other")).strip()
    return {
        "summary": summary[:497] + "..." if len(summary) > 500 else summary,
        "entities": entities,
        "sentiment": sentiment if sentiment in SENTIMENTS else "Neutral",
        "sentiment_reason": str(data.get("sentiment_reason", "")).strip(),
        "domain_tag": tag if tag in DOMAIN_TAGS else "Other",
    }


SCALAR = st.one_of(
    st.none(),
    st.booleans(),
    st.integers(-3, 3),
    st.sampled_from(["", " ", "0", "false", " AI\n", "Positive", "Mixed", "x" * 600, "é　", "{}"]),
)
REPLY = st.builds(
    lambda data, wrap: wrap.format(json.dumps(data)) if wrap else json.dumps(data),
    st.one_of(
        st.dictionaries(
            st.sampled_from([*GOOD, "other"]), st.one_of(SCALAR, st.lists(SCALAR, max_size=8))
            .filter(lambda v: not (isinstance(v, list) and v == [])),
        ).filter(lambda d: not any(isinstance(d.get(k), list) for k in GOOD if k != "entities")),
        st.lists(SCALAR, max_size=2),
        SCALAR,
    ),
    st.sampled_from([None, "```json\n{}\n```", "```{}```", " \n{}\t ", "Well: {}", "```json {}"]),
)


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(replies=st.lists(REPLY, min_size=60, max_size=80))
def test_unified_replies_equal_the_model(spark, replies):
    assert parse(spark, replies) == [model_of_unified(r) for r in replies]


def test_unified_reply_corner_cases(spark):
    nulls = '{"summary": null, "sentiment": null, "sentiment_reason": null, "entities": [null, 2]}'
    texts = [json.dumps(GOOD), nulls, "", "{", "[1]", '{"summary": "x"}', '{"sentiment": "x"}']
    good, empty, *rest = parse(spark, texts)
    assert good == GOOD
    assert empty == {
        "summary": "None", "entities": ["2"], "sentiment": "Neutral",
        "sentiment_reason": "None", "domain_tag": "Other",
    }
    assert rest == [None] * 5


def test_replies_read_as_python_reads_them(spark):
    """Repeated keys, numbers that are none, single quotes, text after the object."""
    replies = [
        '{"summary": "a", "sentiment": "Mixed", "summary": "b", "sentiment": "Negative"}',
        '{"summary": NaN, "sentiment": -Infinity, "entities": [NaN, 1, Infinity]}',
        '{"summary": "NaN", "sentiment": "x", "sentiment_reason": "-Infinity"}',
        "{'summary': 'a', 'sentiment': 'x'}",
        '{"summary": "a", "sentiment": "x"} and so on',
        '{"summary": "a", "sentiment": "x", "entities": [{"k": 1, "k": 1}]',
    ]
    assert parse(spark, replies) == [model_of_unified(r) for r in replies]


def test_separate_replies(spark):
    rows = spark.createDataFrame(
        [
            (1, " s ", '["A", ""]', '{"sentiment": "Negative", "reason": " r "}', "AI\n"),
            (2, "s", '{"a": 1}', '"Negative"', "x"),
            (3, "s", "[]", "{}", "Other"),
            (4, "s", "oops", "{}", "Other"),
            (5, None, "[]", "{}", "Other"),
        ],
        "i long, s string, e string, j string, t string",
    )
    cols = [F.col(c) for c in "sejt"]
    found = [r.p for r in parse_separate(rows, *cols, into="p").orderBy("i").collect()]
    assert [tuple(p) if p else None for p in found] == [
        ("s", ["A"], "Negative", "r", "AI"),
        ("s", [], "Neutral", "", "Other"),
        ("s", [], "Neutral", "", "Other"),
        None,
        None,
    ]


def test_coercions(spark):
    one = spark.range(1)
    row = one.select(
        coerce_summary(F.lit("x" * 501)).alias("long"),
        coerce_summary(F.lit(" " + "x" * 500)).alias("fits"),
        coerce_tag(F.lit("ai")).alias("tag"),
        coerce_entities(F.parse_json(F.lit('["a","b","","c",0,"d","e","f"]'))).alias("five"),
    ).first()
    assert row.long == "x" * 497 + "..." and row.fits == "x" * 500
    assert row.tag == "Other" and row.five == ["a", "b", "c", "d", "e"]


def test_prompts_take_any_text(spark):
    rows = spark.createDataFrame([("H {x}", "b" * 2000)], "headline string, body string")
    context = "H {x}\n\n" + "b" * 1500
    for kind, template in PROMPTS.items():
        got = rows.select(render_prompt(kind, build_context()).alias("p")).first().p
        assert got == template.replace("{article}", context)


# --- the model hook ---------------------------------------------------------------


def kind_of(prompt):
    return next(k for k, t in PROMPTS.items() if prompt.startswith(t.split("{article}")[0]))


def counting(calls, unified):
    """A model that counts its prompts by kind and answers with ``unified(article)``."""

    def factory():
        def model(prompts):
            out = []
            for p in prompts:
                kind = kind_of(p)
                calls.add({kind: 1})
                if "boom" in p:
                    raise RuntimeError("model is down")
                if kind == "unified":
                    out.append(unified(p))
                else:
                    out.append({
                        "summary": SUMMARY, "entities": '["E"]', "domain_tag": "Climate",
                        "sentiment": '{"sentiment": "Negative", "reason": "Gloomy."}',
                    }[kind])
            return out

        return model

    return factory


@pytest.fixture
def calls(spark):
    from pyspark.accumulators import AccumulatorParam

    class Counts(AccumulatorParam):
        def zero(self, value):
            return {}

        def addInPlace(self, a, b):
            for k, n in b.items():
                a[k] = a.get(k, 0) + n
            return a

    return spark.sparkContext.accumulator({}, Counts())


def test_enrich_calls_the_model_once_per_good_row(spark, calls):
    rows = frame(spark, ARTICLE, [raw("a/1"), raw("a/2", body=""), raw("", body="x"), raw("a/3")])
    done = enrich(rows, counting(calls, lambda p: json.dumps(GOOD)), AS_OF)
    good, bad = done.where("_error IS NULL"), done.where("_error IS NOT NULL")
    assert "BatchEvalPython" not in plan_of(done)
    found = {r.article_id: r for r in done.collect()}
    assert calls.value == {"unified": 2}
    assert found["a/1"].summary == SUMMARY and found["a/1"].enriched_at is not None
    assert found["a/2"]._error == "missing required field: body"
    assert found[""]._error == "missing required field: article_id"
    assert found["a/2"].summary is None and found["a/2"].enriched_at is None
    # A filter on the outcome neither repeats a model call nor moves before it.
    assert {r.article_id for r in good.collect()} == {"a/1", "a/3"}
    assert calls.value == {"unified": 4}
    assert plan_of(good).count("ArrowEvalPython") == 2 and len(bad.collect()) == 2


def test_unreadable_replies_fall_back_to_separate_prompts(spark, calls):
    rows = frame(spark, ARTICLE, [raw("a/1"), raw("a/2", headline="odd")])
    unified = lambda p: "no" if "odd" in p else json.dumps(GOOD)
    found = {r.article_id: r for r in enrich(rows, counting(calls, unified), AS_OF).collect()}
    assert calls.value == {
        "unified": 2, "summary": 1, "entities": 1, "sentiment": 1, "domain_tag": 1,
    }
    assert found["a/2"].entities == ["E"] and found["a/2"].sentiment == "Negative"
    assert found["a/2"]._error is None and found["a/1"].domain_tag == "AI"


def test_a_failing_prompt_does_not_spoil_its_batch(spark, calls):
    rows = frame(spark, ARTICLE, [raw(f"a/{i}", headline="boom" if i == 2 else "ok") for i in range(5)])
    model = counting(calls, lambda p: json.dumps(GOOD))
    errors = {r.article_id: r._error for r in enrich(rows, model, AS_OF).collect()}
    assert errors.pop("a/2") == "model is down"
    assert set(errors.values()) == {None}


def test_infer_sees_no_null(spark, calls):
    rows = spark.range(4).select(
        F.when(F.col("id") % 2 == 0, F.array(F.lit(PROMPTS["unified"]))).alias("p")
    )
    model = counting(calls, lambda p: "r")
    replies = [r.x for r in rows.select(infer(F.col("p"), model).alias("x")).collect()]
    assert sum(r is None for r in replies) == 2 and calls.value == {"unified": 2}


# --- embedding and gate -------------------------------------------------------------


def test_embedder_is_deterministic_and_sized(spark):
    rows = spark.createDataFrame([("a b c",), (" ",), (None,), ("a b c",)], "t string")
    found = rows.select(embed_text("t", hashing_embedder(16), 16).alias("e")).collect()
    a, blank, null, again = [r.e for r in found]
    assert a.vector == again.vector and len(a.vector) == 16
    assert sum(x * x for x in a.vector) == pytest.approx(1, abs=1e-6)
    assert blank.vector == [0.0] * 16 and null.vector is None and null.error is None


def test_wrong_dimension_is_an_error(spark):
    row = spark.createDataFrame([("a",)], "t string").select(
        embed_text("t", hashing_embedder(100), 384).alias("e")
    )
    assert row.first().e.error == "Embedding dimension mismatch: expected 384, got 100"


def test_gate_embeds_only_what_passed(spark):
    seen = spark.sparkContext.accumulator(0)

    def factory():
        embed = hashing_embedder()()

        def counted(texts):
            seen.add(len(texts))
            if any("boom" in t for t in texts):
                raise RuntimeError("embedder is down")
            return embed(texts)

        return counted

    rows = frame(spark, ENRICHED, [
        enriched("a/1"), enriched("a/2", summary="short"), enriched("a/3", sentiment="Odd"),
        enriched("a/4", published_at="2024-01-01T00:00:00Z"), enriched("a/5", published_at=None),
        enriched("a/6", summary=""), enriched("a/7", domain_tag="Sports"),
    ])
    found = {r.article_id: r for r in quality_gate(rows, factory, AS_OF).collect()}
    assert seen.value == 3
    assert found["a/1"]._error is None and len(found["a/1"].embedding) == 384
    assert found["a/2"]._error == "GX validation failed: summary_length: 5 not in [50, 500]"
    assert found["a/4"].embedding is None and "recency" in found["a/4"]._error
    assert found["a/5"]._error == "published_at: missing or unreadable"
    assert found["a/6"]._error == "missing required field: summary"
    assert found["a/7"]._error.startswith("domain_tag:")

    broken = frame(spark, ENRICHED, [enriched("a/1", headline="boom"), enriched("a/2")])
    errors = {r.article_id: r._error for r in quality_gate(broken, factory, AS_OF).collect()}
    assert errors == {"a/1": "embedder is down", "a/2": None}


def slow_model():
    def reply(prompts):
        if any("HANGS" in p for p in prompts):
            time.sleep(30)
        if any("FAILS" in p for p in prompts):
            raise RuntimeError("refused")
        time.sleep(0.05)
        return [p.upper() for p in prompts]

    return reply


def test_a_hanging_call_costs_its_own_prompt_only(spark):
    texts = [f"p{i}" for i in range(60)] + ["it HANGS", "it FAILS"] + [f"q{i}" for i in range(60)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    start = time.monotonic()
    found = rows.select("t", infer(F.array("t"), slow_model, seconds=2, at_once=8)[0].alias("r")).collect()
    assert time.monotonic() - start < 20  # neither 30 seconds, nor one after another
    for row in found:
        if "HANGS" in row.t:
            assert (row.r.text, row.r.error) == (None, "no reply within 2 seconds")
        elif "FAILS" in row.t:
            assert (row.r.text, row.r.error) == (None, "refused")
        else:
            assert (row.r.text, row.r.error) == (row.t.upper(), None)


def test_a_model_that_is_gone_fails_at_once():
    from gazette.operators import enrich as module

    start = time.monotonic()
    answers = module._call_within(slow_model(), ["HANGS"] * 500, 0.1, 2)
    assert time.monotonic() - start < 10
    assert {a["error"] for a in answers} == {"no reply within 0.1 seconds", "the model does not answer any more"}


def test_a_call_that_hangs_holds_its_own_prompt_only():
    class Prompt(str):
        pass

    over = threading.Event()

    def model(prompts):
        if prompts[0] == "HANGS":
            over.wait(60)
        return [str(prompts[0]) for _ in prompts]

    prompts = [Prompt(i) for i in range(50)] + [Prompt("HANGS"), None, Prompt("last")]
    refs = [weakref.ref(p) for p in prompts if p is not None]
    answers = module._call_within(model, prompts, 0.5, 4)
    del prompts
    time.sleep(0.2)  # threads that have answered end
    gc.collect()
    held = [str(r()) for r in refs if r() is not None]
    over.set()
    assert held == ["HANGS"]
    assert [a["text"] for a in answers] == [*map(str, range(50)), None, "None", "last"]
    assert answers[50]["error"] == "no reply within 0.5 seconds"


def test_prompts_are_taken_when_it_is_their_turn():
    answered, ahead = [], []

    def prompts():
        for i in range(200):
            ahead.append(i - len(answered))
            yield str(i)

    def model(prompts):
        answered.extend(prompts)
        return list(prompts)

    answers = module._call_within(model, prompts(), 30, 4)
    assert [a["text"] for a in answers] == [str(i) for i in range(200)]
    assert max(ahead) < 4
