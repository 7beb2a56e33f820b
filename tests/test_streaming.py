"""Batch and streaming forms agree; jobs restart from their checkpoints."""

import json

import pytest
from pyspark.sql import functions as F

from builders import AS_OF, LONG, SHORT, enriched, log, raw
from gazette.functions.vectors import hashing_embedder
from gazette.operators.dedup import label_qualifying
from gazette.plans.stages import enrich_stage, gate_stage, route_stage
from gazette.schemas import EMBEDDING_DIM, TOPIC_FAILED
from gazette.sources.store import read_store
from gazette.sources.topics import read_topics, write_topics
from gazette.streaming.dedup import first_qualifying
from gazette.streaming.jobs import start_enricher, start_gate, start_ingester, start_router

ONCE = {"availableNow": True}

RAW = [
    raw("a/1"),
    raw("a/1", section="business"),
    raw("a/2", body=SHORT),
    raw("a/2"),
    raw("a/3", section="money", note="日本語 ümlaut 🚀"),
    raw("a/4", section="sports"),
    raw("a/5", section="science"),
    "not json",
    raw("a/6", body=...),
    raw("a/7", section=""),
]


def answering_model():
    def model(prompts):
        return [
            json.dumps(
                {
                    "summary": f"A summary that is long enough, of {len(p)} characters in all.",
                    "entities": ["One", "Two"],
                    "sentiment": "Positive",
                    "sentiment_reason": "It is upbeat.",
                    "domain_tag": "Crypto",
                }
            )
            for p in prompts
        ]

    return model


def by_topic(log_df):
    return {
        (r.topic, json.loads(r.value)["article_id"] if r.topic != "news-corrupt" else r.value)
        for r in log_df.collect()
    }


def test_route_stage_keeps_fields_and_splits(spark):
    out = route_stage(log(spark, RAW))
    rows = {r.key or r.value: r for r in out.collect()}
    assert {k: r.topic for k, r in rows.items() if r.topic != "news-corrupt"} == {
        "a/1": "tech-news",
        "a/3": "finance-news",
        "a/4": "world-news",
        "a/5": "world-news",
        "a/7": "world-news",
    }
    assert json.loads(rows["a/3"].value)["note"] == "日本語 ümlaut 🚀"
    assert sum(r.topic == "news-corrupt" for r in rows.values()) == 2
    assert json.loads(rows["a/1"].value)["section"] == "technology"


def test_all_stages_as_streams_with_restart(spark, tmp_path):
    at = {name: str(tmp_path / name) for name in ("raw", "routed", "enriched", "validated")}
    store, failed = str(tmp_path / "store"), str(tmp_path / "failed")

    def checkpoint(name):
        return str(tmp_path / "checkpoints" / name)

    def run_all():
        jobs = [
            lambda: start_router(spark, at["raw"], at["routed"], checkpoint("r"), ONCE),
            lambda: start_enricher(
                spark, at["routed"], at["enriched"], checkpoint("e"), answering_model, ONCE, AS_OF
            ),
            lambda: start_gate(
                spark, at["enriched"], at["validated"], checkpoint("g"), hashing_embedder(),
                EMBEDDING_DIM, ONCE, AS_OF,
            ),
            lambda: start_ingester(spark, at["validated"], store, failed, checkpoint("i"), ONCE),
        ]
        for start in jobs:
            query = start()
            query.awaitTermination()
            assert query.exception() is None

    first, second = RAW[:5], RAW[5:] + [raw("a/1"), raw("a/3"), raw("a/8")]
    write_topics(log(spark, first), at["raw"])
    run_all()
    ids = {r.article_id for r in read_store(spark, store).collect()}
    assert ids == {"a/1", "a/3"}

    # The second round starts from the checkpoints: known ids stay known.
    write_topics(log(spark, second, start=len(first)), at["raw"])
    run_all()
    routed = read_topics(spark, at["routed"])
    batch = route_stage(log(spark, first + second))
    assert by_topic(routed) == by_topic(batch)
    assert routed.count() == batch.count()

    expected = enrich_stage(batch.where("topic != 'news-corrupt'"), answering_model, AS_OF)
    streamed = read_topics(spark, at["enriched"])
    assert by_topic(streamed) == by_topic(expected)
    validated = gate_stage(expected.where("topic = 'enriched-news'"), hashing_embedder(), AS_OF)
    assert by_topic(read_topics(spark, at["validated"])) == by_topic(validated)

    rows = read_store(spark, store).collect()
    # a/4 and a/7 have sections that break the enriched contract.
    assert sorted(r.article_id for r in rows) == ["a/1", "a/3", "a/5", "a/8"]
    assert all(len(r.embedding) == EMBEDDING_DIM for r in rows)
    dead = read_topics(spark, at["enriched"], [TOPIC_FAILED]).collect()
    assert sorted(r.key for r in dead) == ["a/4", "a/7"]
    assert all("section" in json.loads(r.value)["_error"] for r in dead)


def test_dead_letters_keep_the_original_and_what_was_added(spark):
    stale = enriched("a/9", published_at="2024-01-01T00:00:00Z", extra={"kept": [1, None]})
    out = gate_stage(log(spark, [stale, enriched("a/10")], "enriched-news"), hashing_embedder(), AS_OF)
    rows = {r.key: r for r in out.collect()}
    letter = json.loads(rows["a/9"].value)
    assert rows["a/9"].topic == "news-failed" and rows["a/10"].topic == "validated-news"
    assert letter["extra"] == {"kept": [1, None]}
    assert letter["_failed_stage"] == "quality-gate"
    assert letter["_failed_at"] == "2024-01-20T12:00:00Z"
    assert letter["_error"] == (
        "GX validation failed: recency: published_at 2024-01-01T00:00:00+00:00 older than 7 days"
    )
    assert "embedding" not in letter
    good = json.loads(rows["a/10"].value)
    assert len(good["embedding"]) == EMBEDDING_DIM and good["validated_at"] == letter["_failed_at"]


def test_enrich_dead_letter_has_no_stage_by_default(spark):
    out = enrich_stage(log(spark, [raw("b/1", body="")], "tech-news"), answering_model, AS_OF)
    letter = json.loads(out.first().value)
    assert letter["_error"] == "missing required field: body"
    assert "_failed_stage" not in letter and "summary" not in letter


def test_time_to_live_forgets_ids(spark, tmp_path):
    """After a TTL of some milliseconds a later micro-batch sees an id anew."""
    from gazette.streaming.dedup import first_seen_ttl, no_empty_batches

    for step, ttl in (("short", 1e-5), ("long", 48)):
        source, out = str(tmp_path / step / "in"), str(tmp_path / step / "out")
        for n in range(2):
            write_topics(log(spark, [raw("c/1"), raw("c/1", body=LONG + " x")], start=2 * n), source)
            rows = read_topics(spark, source, streaming=True)
            first = first_seen_ttl(rows.withColumnRenamed("key", "article_id"), ttl_hours=ttl)
            writer = first.writeStream.format("parquet").trigger(availableNow=True)
            with no_empty_batches(spark):
                query = writer.option(
                    "checkpointLocation", str(tmp_path / step / "checkpoint")
                ).start(out)
            query.awaitTermination()
        offsets = sorted(r.offset for r in spark.read.parquet(out).select(F.col("offset")).collect())
        assert offsets == ([0, 2] if step == "short" else [0])


def test_fail_fast_on_unreadable_records(spark):
    from gazette.schemas import ARTICLE
    from gazette.sources.topics import parse_records, raise_if_corrupt

    good = raise_if_corrupt(parse_records(log(spark, RAW[:3]), ARTICLE))
    assert good.count() == 3
    bad = raise_if_corrupt(parse_records(log(spark, [raw("a/1"), "not json"]), ARTICLE))
    with pytest.raises(Exception, match="unreadable record: not json"):
        bad.count()


def test_a_job_may_start_before_its_source_has_data(spark, tmp_path):
    routed, out = str(tmp_path / "routed"), str(tmp_path / "enriched")
    checkpoint = str(tmp_path / "checkpoint")
    for expected in (0, 1):
        job = start_enricher(spark, routed, out, checkpoint, answering_model, ONCE, AS_OF)
        job.awaitTermination()
        assert read_topics(spark, out).count() == expected
        write_topics(log(spark, [raw("a/1")], "tech-news"), routed)


def test_a_streaming_round_publishes_what_the_batch_does(spark, tmp_path):
    """Over two restarts; rejected copies claim nothing, ids seen before stay out."""
    rows = [(f"a/{i % 37}", i, (i * 7) % 5 < 2) for i in range(600)] + [(None, 900, True)]
    shape = "article_id string, offset long, good boolean"
    seen = spark.createDataFrame([("a/1",), ("a/2",), (None,), ("a/2",)], "article_id string")
    for part in range(3):
        some = spark.createDataFrame(rows[part * 200 : part * 200 + 200 + (part == 2)], shape)
        some.repartition(3).write.parquet(str(tmp_path / "in" / f"part={part}"))
        stream = spark.readStream.schema(shape).parquet(str(tmp_path / "in" / "part=*"))
        # what is seen counts when the query is new; afterwards its own state does
        known = seen if part == 0 else seen.where("false")
        out = first_qualifying(stream, known, qualifies=F.col("good"))
        writer = out.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        writer.option("checkpointLocation", str(tmp_path / "state")).trigger(**ONCE).start().awaitTermination()
    found = {(r.article_id, r.offset) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    labelled = label_qualifying(
        spark.createDataFrame(rows, shape).where("article_id is not null"), seen, order="offset", qualifies=F.col("good")
    )
    assert found == {(r.article_id, r.offset) for r in labelled.where("label = 'published'").collect()}
    assert len(found) == 35
