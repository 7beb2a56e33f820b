"""The operators of this subpackage applied to the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm import (
    alignment,
    counts,
    edits,
    lattice,
    mixing,
    negatives,
    packing,
    quality,
    suffixes,
    tools,
    toxicity,
    units,
)
from gazette.llm.registry import query, table
from gazette.llm.simhash import near_components, simhash


def word_tokenizer() -> str:
    """The place of the public word tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_tokenizer() -> str:
    """The same for the public byte-level tokenizer."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_tokenizer() -> str:
    """The same for the public tokenizer of word pieces."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query()
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints over 4-word shingles and what 4 differing bits connect."""
    found = near_components(simhash(table(spark, sf_dir, "documents"), words=4), radius=4)
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


@query(units.SQL)
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of 24 words and more that came earlier, cut out of all documents."""
    cleaned = units.drop_repeated_units(table(spark, sf_dir, "documents").select("doc_id", "text"))
    starts = F.transform("removed", lambda x: x["start"].cast("string"))
    return cleaned.select(
        "doc_id",
        "n_units",
        F.size("removed").alias("n_removed"),
        F.array_join(starts, ",").alias("removed_starts"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query(mixing.SQL)
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of each document by a mix of 150 % of all words."""
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", "source", mixing.size_in_words().alias("size"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", taken)


@query()
def op8_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), word_tokenizer()))


@query()
def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The perplexity of all documents under a model of those of good quality."""
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, table(spark, sf_dir, "labels"))


@query()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learnt outside the held-out quarter."""
    docs = table(spark, sf_dir, "documents")
    classifier = toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.score(docs, classifier)


@query()
def op9_edit_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their texts with the second half replaced, near texts."""
    return edits.near_texts(edits.edited_pairs(table(spark, sf_dir, "documents")))


@query()
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text without strings of 200 bytes that are elsewhere too."""
    left = suffixes.remove_repeats(table(spark, sf_dir, "documents"), keep=False)
    return left.drop("spans")


@query()
def op7_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings of a label with a cosine of 0.93 and more."""
    return lattice.near_vectors(table(spark, sf_dir, "embeddings"))


SEARCH = {
    "type": "object",
    "required": ["query", "limit"],
    "additionalProperties": False,
    "properties": {
        "query": {"type": "string", "minLength": 1},
        "limit": {"type": "integer", "minimum": 1, "maximum": 60},
        "lang": {"enum": ["en", "de", "fr", "es"]},
    },
}
TOOLS = {"search": SEARCH, "fetch": SEARCH, "summarise": {"type": "object", "required": ["query"]}}


def tool_messages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The conversations as calls and results.

    A user's turn calls a tool with its text, whole, as an argument; the assistant's next turn
    is the result. A call follows the one two turns before. Some calls break their schema.
    """
    turns = table(spark, sf_dir, "conversations")
    text = F.coalesce("text", F.lit(""))
    words = F.size(F.split(text, " "))
    name = F.element_at(F.array(*[F.lit(x) for x in (*TOOLS, "guess")]), (words % 4 + 1).cast("int"))
    limit = F.when(words % 7 == 0, F.lit("many")).otherwise(words.cast("string"))
    arguments = F.when(
        words % 11 == 0, F.concat(F.lit("{query:"), text)
    ).otherwise(
        F.concat(
            F.lit('{"query":'),
            F.to_json(F.array(text)).substr(F.lit(2), F.length(F.to_json(F.array(text))) - 2),
            F.lit(', "limit": '),
            F.when(words % 7 == 0, F.lit('"many"')).otherwise(limit),
            F.lit("}"),
        )
    )
    identifier = F.format_string("call_%d", F.col("turn"))
    calls = turns.where("role = 'user'").select(
        "conv_id",
        identifier.alias("call_id"),
        "turn",
        name.alias("name"),
        arguments.alias("arguments"),
        F.when(F.col("turn") >= 2, F.format_string("call_%d", F.col("turn") - 2)).alias("parent_id"),
    )
    results = turns.where("role = 'assistant'").select(
        "conv_id",
        F.format_string("call_%d", F.col("turn") - 1).alias("call_id"),
        "turn",
        F.col("text").alias("content"),
    )
    return calls, results


@query()
def op3_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tool calls of all conversations with their results."""
    return tools.link_calls(*tool_messages(spark, sf_dir), TOOLS)


@query()
def op11_galloping_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of the byte-level and the piece tokenizer that overlap, in all documents."""
    docs = table(spark, sf_dir, "documents")
    return alignment.align_documents(docs, byte_tokenizer(), piece_tokenizer())


@query()
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of word pieces of all documents."""
    return counts.count_tokens(table(spark, sf_dir, "documents"), piece_tokenizer())


@query(negatives.SQL)
def op13_kronecker_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the embeddings whose id is divisible by 50, some labels moved on."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = negatives.whole_vectors(rows).withColumn("label", moved)
    return negatives.hard_negatives(rows, F.coalesce(F.col("vec_id") % 50 == 0, F.lit(False)))
