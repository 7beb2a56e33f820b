"""Jobs for spark-submit: ``python -m gazette <job> --help``.

A model or an embedder is named as ``module:factory``; the module must be
importable on the workers (``--py-files``).
"""

from __future__ import annotations

import argparse
import datetime as dt
from functools import partial, reduce
from importlib import import_module

from pyspark.sql import functions as F

from gazette import get_session
from gazette.functions.vectors import hashing_embedder
from gazette.operators.maintenance import assert_flowing, assert_not_empty, find_gaps
from gazette.operators.dedup import PUBLISHED
from gazette.operators.reports import tick_stats, weekly_report
from gazette.plans.ask import answer_prompt, find_articles
from gazette.plans.backfill import backfill_messages, missed_articles
from gazette.plans.tick import raw_messages, tick
from gazette.schemas import EMBEDDING_DIM, GAP_HOURS, LOG, MIN_WORDS, PRUNE_DAYS, TOPIC_FAILED
from gazette.session import cut_lineage, ensure_folder
from gazette.sources.normalize import NORMALIZERS, gathered_sources
from gazette.sources.daylog import drop_expired
from gazette.sources.outbox import replay_once
from gazette.sources.store import prune_store, read_store
from gazette.sources.topics import read_topics, replay_buffer, write_topics
from gazette.streaming import jobs


def factory(name: str | None):
    if name is None:
        return hashing_embedder()
    module, _, attribute = name.partition(":")
    return getattr(import_module(module), attribute)


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="gazette")
    parser.add_argument("--as-of", type=dt.datetime.fromisoformat, help="instead of now")
    actions = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *paths: str, stream: bool = False):
        action = actions.add_parser(name)
        for path in paths:
            action.add_argument(f"--{path}", required=True)
        if stream:
            action.add_argument("--checkpoint", required=True)
            action.add_argument("--once", action="store_true", help="stop when caught up")
        return action

    route = job("route", "raw", "routed", stream=True)
    route.add_argument("--min-words", type=int, default=MIN_WORDS)
    job("enrich", "routed", "enriched", stream=True).add_argument("--model", required=True)
    gate = job("gate", "enriched", "validated", stream=True)
    gate.add_argument("--embedder")
    gate.add_argument("--dim", type=int, default=EMBEDDING_DIM)
    job("ingest", "validated", "store", "failed", stream=True)
    job("prune", "store").add_argument("--days", type=int, default=PRUNE_DAYS)
    job("gaps", "store")
    job("tick", "landed", "raw", "seen").add_argument(
        "--sources", nargs="+", default=list(NORMALIZERS), choices=list(NORMALIZERS)
    )
    job("backfill", "store", "archive", "raw").add_argument("--hours", type=int, default=GAP_HOURS)
    job("replay", "buffer", "log")
    job("redeliver", "outbox")
    job("expire", "log")
    job("report", "store").add_argument("--failed", required=True, nargs="+")
    job("check", "store", "log")
    ask = job("ask", "store", "question")
    ask.add_argument("--embedder")
    ask.add_argument("--top", type=int, default=5)
    return parser.parse_args()


def run_tick(spark, args, now) -> None:
    """One polling round: landed rows of every source, one folder for each, to raw messages."""

    def load(name: str):
        rows = spark.read.parquet(f"{args.landed}/{name}")
        more = {"as_of": now} if name == "rss" else {}
        # Numbered as they are written down; a page may hold several articles.
        found = NORMALIZERS[name](rows, **more)
        return found.withColumn("seq", F.monotonically_increasing_id())

    ensure_folder(spark, args.seen)
    seen = spark.read.schema("article_id string").parquet(args.seen)
    found = gathered_sources({name: partial(load, name) for name in args.sources})
    if not found:
        raise RuntimeError("no source could be read")
    labelled = cut_lineage(tick(found, seen))
    # Messages first: a round that ends between the writes is published again, not lost.
    write_topics(raw_messages(labelled, now), args.raw)
    published = labelled.where(F.col("label") == PUBLISHED).select("article_id")
    published.write.mode("append").parquet(args.seen)
    tick_stats(labelled).show()


def main() -> None:
    args = arguments()
    spark = get_session()
    now = args.as_of or dt.datetime.now(dt.timezone.utc)
    trigger = {"availableNow": True} if getattr(args, "once", False) else jobs.EVERY_MINUTE
    query = None
    if args.job == "route":
        query = jobs.start_router(
            spark, args.raw, args.routed, args.checkpoint, trigger, args.min_words
        )
    elif args.job == "enrich":
        query = jobs.start_enricher(
            spark, args.routed, args.enriched, args.checkpoint, factory(args.model), trigger
        )
    elif args.job == "gate":
        query = jobs.start_gate(
            spark, args.enriched, args.validated, args.checkpoint, factory(args.embedder),
            args.dim, trigger,
        )
    elif args.job == "ingest":
        query = jobs.start_ingester(
            spark, args.validated, args.store, args.failed, args.checkpoint, trigger
        )
    elif args.job == "prune":
        print(prune_store(spark, args.store, now, args.days))
    elif args.job == "gaps":
        find_gaps(read_store(spark, args.store), now).orderBy("date").show(truncate=False)
    elif args.job == "tick":
        run_tick(spark, args, now)
    elif args.job == "backfill":
        missed = missed_articles(
            read_store(spark, args.store), spark.read.parquet(args.archive), now, args.hours
        )
        write_topics(backfill_messages(missed, now), args.raw)
    elif args.job == "replay":
        waiting = replay_buffer(spark, args.buffer, LOG)
        write_topics(waiting.select(*LOG.fieldNames()), args.log)
    elif args.job == "redeliver":
        print(replay_once(spark, args.outbox))
    elif args.job == "expire":
        print(drop_expired(spark, args.log, now))
    elif args.job == "report":
        logs = [read_topics(spark, root, [TOPIC_FAILED]) for root in args.failed]
        failed = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), logs)
        weekly_report(read_store(spark, args.store), failed, now).show()
    elif args.job == "check":
        assert_flowing(read_topics(spark, args.log))
        assert_not_empty(read_store(spark, args.store))
    elif args.job == "ask":
        hits = find_articles(
            read_store(spark, args.store), args.question, factory(args.embedder), args.top
        )
        hits = cut_lineage(hits)  # shown and put into the prompt: search once
        hits.orderBy("rank").select(
            "rank", F.round(F.col("similarity") * 100).alias("percent"), "headline", "source_url"
        ).show(truncate=False)
        print(answer_prompt(hits, args.question).first().prompt)
    if query is not None:
        query.awaitTermination()


if __name__ == "__main__":
    main()
