"""Vector search against brute force, and the answer context."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from builders import SUMMARY, plan_of
from gazette.functions.vectors import cosine_distance, hashing_embedder, similarity
from gazette.operators.index import add_to_index, build_index, search_index
from gazette.operators.search import knn, knn_many, rag_context, rag_contexts, with_rank
from gazette.plans.ask import answer, answer_prompt, find_articles

RNG = np.random.default_rng(3)
VECTORS = RNG.normal(size=(400, 12)).astype(np.float32)


@pytest.fixture
def store(spark):
    rows = [(f"a/{i:03}", v.tolist()) for i, v in enumerate(VECTORS)]
    rows += [("null", None), ("zero", [0.0] * 12), ("short", [1.0]), ("hole", [None] + [1.0] * 11)]
    return spark.createDataFrame(rows, "article_id string, embedding array<float>").repartition(7)


def nearest(query, k):
    v = VECTORS.astype(np.float64)
    d = 1 - v @ query / np.linalg.norm(v, axis=1) / np.linalg.norm(query)
    order = sorted(range(len(d)), key=lambda i: (d[i], i))[:k]
    return [(f"a/{i:03}", d[i]) for i in order]


def test_knn_is_exact(spark, store):
    for query in RNG.normal(size=(3, 12)):
        hits = knn(store, query, 10).collect()
        assert [h.article_id for h in hits] == [i for i, _ in nearest(query, 10)]
        assert [h.distance for h in hits] == pytest.approx([d for _, d in nearest(query, 10)])
    plan = plan_of(knn(store, VECTORS[0], 10))
    assert "TakeOrderedAndProject" in plan and "BatchEvalPython" not in plan
    assert plan.count("ArrowEvalPython [") == 1
    assert len(knn(store, VECTORS[0], 1000).collect()) == 400


def test_unusable_vectors_have_no_distance(store):
    rows = store.withColumn("d", cosine_distance("embedding", [1.0] * 12))
    assert {r.article_id for r in rows.where("d IS NULL").collect()} == {
        "null", "zero", "short", "hole",
    }


def test_knn_many_equals_knn(store):
    questions = {n: q for n, q in enumerate(RNG.normal(size=(20, 12)))}
    found = knn_many(store, questions, 7).orderBy("question", "rank").collect()
    assert len(found) == 140
    for n, q in questions.items():
        assert [r.article_id for r in found if r.question == n] == [i for i, _ in nearest(q, 7)]
    assert "CartesianProduct" not in plan_of(knn_many(store, questions, 7))
    assert "NestedLoop" not in plan_of(knn_many(store, questions, 7))


def test_knn_many_takes_any_number_of_questions(spark, store):
    rows = [(n, q.tolist()) for n, q in enumerate(RNG.normal(size=(1_500, 12)))]
    asked = spark.createDataFrame(rows, "id long, v array<double>")
    found = knn_many(store, asked, 2)
    assert found.count() == 3_000
    last = found.where("question = 1499").orderBy("rank").collect()
    assert [r.article_id for r in last] == [i for i, _ in nearest(np.array(rows[1499][1]), 2)]


def test_knn_ranks_what_it_shows(spark):
    rows = [(i, [1.0, 1e-9 * (40 - i)]) for i in range(40)]
    close = spark.createDataFrame(rows, "article_id long, embedding array<double>")
    found = knn(close, [1.0, 0.0], 5, digits=5).collect()
    assert [r.article_id for r in found] == [0, 1, 2, 3, 4]


def test_knn_many_needs_questions(store):
    with pytest.raises(ValueError):
        knn_many(store, {})


def test_similarity(spark):
    rows = spark.createDataFrame([(0.0,), (0.25,), (1.0,), (1.7,)], "d double")
    assert [r.s for r in rows.select(similarity("d").alias("s")).collect()] == [1.0, 0.75, 0.0, 0.0]


def test_context_layout(spark):
    hits = spark.createDataFrame(
        [
            (2, None, None, None, None, None, None),
            (1, "Head", SUMMARY, ["A", "B"], "Neutral", "AI", "https://e.example"),
        ],
        "rank int, headline string, summary string, entities array<string>, sentiment string, "
        "domain_tag string, source_url string",
    )
    assert rag_context(hits).first().context == (
        f"[1] Head\n    Summary: {SUMMARY}\n    Sentiment: Neutral | Tag: AI\n"
        "    Entities: A, B\n    Source: https://e.example\n\n"
        "[2] Untitled\n    Summary: N/A\n    Sentiment: N/A | Tag: N/A\n"
        "    Entities: \n    Source: N/A"
    )


def test_from_question_to_answer(spark):
    texts = ["markets fell sharply today", "a cat sat on the mat", "markets rose today"]
    embed = hashing_embedder()()
    store = spark.createDataFrame(
        [(f"a/{i}", t, t, v.tolist()) for i, (t, v) in enumerate(zip(texts, embed(texts)))],
        "article_id string, headline string, summary string, embedding array<float>",
    ).withColumns(
        {
            "entities": F.array(F.lit("X")),
            **{n: F.lit("v") for n in ("sentiment", "domain_tag", "source_url")},
        }
    )
    hits = find_articles(store, "markets today", hashing_embedder(), k=2)
    assert {r.article_id for r in hits.collect()} == {"a/0", "a/2"}
    assert [r["rank"] for r in hits.orderBy("rank").collect()] == [1, 2]
    prompt = answer_prompt(hits, "markets today").first()
    assert prompt.context in prompt.prompt and "Question:\nmarkets today" in prompt.prompt
    echo = lambda: lambda prompts: [p[-7:] for p in prompts]
    assert answer(hits, "q", echo).first().answer == "Answer:"
    assert "rank" in with_rank(hits.drop("rank")).columns


def test_knn_many_over_a_grid_of_blocks(spark, store, monkeypatch):
    monkeypatch.setattr("gazette.operators.search.STORE_BLOCK", 60)
    rows = [(n, q.tolist()) for n, q in enumerate(RNG.normal(size=(90, 12)))] + [(None, [1.0] * 12), (200, None)]
    rows += [(300, [1.0] * 5), (301, [0.0] * 12)]
    asked = spark.createDataFrame(rows, "id long, v array<double>")
    found = knn_many(store, asked, 7, block=25)
    by = {}
    for r in found.collect():
        by.setdefault(r.question, {})[r["rank"]] = (r.article_id, r.distance)
    assert set(by) == set(range(90))
    for n in range(90):
        expected = nearest(np.array(rows[n][1]), 7)
        assert [by[n][i + 1][0] for i in range(7)] == [i for i, _ in expected]
        assert [by[n][i + 1][1] for i in range(7)] == pytest.approx([d for _, d in expected])
    for block in (25, 2):  # the plan does not grow with the number of blocks
        plan = plan_of(knn_many(store, asked, 7, block=block))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        assert plan.count("FlatMapCoGroupsInArrow") == 1


def test_ties_go_to_the_smaller_key(spark):
    same = spark.createDataFrame([(f"k{i}", [1.0, 2.0]) for i in range(40)], "article_id string, embedding array<float>")
    asked = spark.createDataFrame([(1, [1.0, 2.0])], "id long, v array<double>")
    assert [r.article_id for r in knn_many(same, asked, 3).orderBy("rank").collect()] == ["k0", "k1", "k10"]


def test_the_index_finds_nine_of_ten_and_takes_more_rows(spark, store, tmp_path):
    path = str(tmp_path / "index")
    build_index(store.where("article_id < 'a/300'"), path)
    asked = spark.createDataFrame([(n, VECTORS[n].tolist()) for n in range(0, 400, 20)], "id long, v array<float>")
    early = {r.article_id for r in search_index(spark, path, asked, 10).collect()}
    assert early and max(early) < "a/300"
    before = {f: None for f in spark.read.parquet(f"{path}/lists").inputFiles()}
    add_to_index(store.where("article_id >= 'a/300'"), path)
    after = spark.read.parquet(f"{path}/lists").inputFiles()
    assert set(before) < set(after)  # what was filed stays as it is
    found = search_index(spark, path, asked, 10)
    true = {(r.question, r.article_id): r.distance for r in knn_many(store, asked, 10).collect()}
    ours = {(r.question, r.article_id): r.distance for r in found.collect()}
    assert len(true.keys() & ours.keys()) >= 0.9 * len(true)
    assert all(ours[x] == pytest.approx(true[x]) for x in true.keys() & ours.keys())
    assert spark.read.parquet(f"{path}/lists").count() == 400


def test_an_index_of_nothing(spark, store, tmp_path):
    build_index(store.where("false"), str(tmp_path / "none"))
    asked = spark.createDataFrame([(1, [1.0] * 12)], "id long, v array<double>")
    assert search_index(spark, str(tmp_path / "none"), asked).collect() == []


def test_a_context_for_each_question(spark):
    rows = [(q, r, f"h{q}{r}") for q in (1, 2) for r in (2, 1)]
    hits = spark.createDataFrame(rows, "question long, rank int, headline string")
    for name in ("summary", "sentiment", "domain_tag", "source_url"):
        hits = hits.withColumn(name, F.lit(None).cast("string"))
    hits = hits.withColumn("entities", F.array().cast("array<string>"))
    found = {r.question: r.context for r in rag_contexts(hits).collect()}
    one = rag_context(hits.where("question = 1")).first().context
    assert found[1] == one and found[2].startswith("[1] h21") and found.keys() == {1, 2}
