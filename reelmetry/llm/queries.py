"""The registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reelmetry.llm import (
    chat_schema, ctph, nnls_packing, odd_dedup, piece_bpe, secret_markov, sql, token_counts, token_files, topk_segments, toxicity_chain, turn_repair, url_filter,
    word_variants,
)

#: Vocabulary files of public tokenizers; the names may be replaced by paths.
PIECES, WORDS = "piece_bpe_32k.model", "word_bpe_49k.json"

#: Rules of the URL query, given with it.
RULES = (
    url_filter.Rule("com", "/", "allow"), url_filter.Rule("example.com", "/en/", "block"), url_filter.Rule("www.example.com", "/en/", "allow"),
    url_filter.Rule("net", "/es/", "block"), url_filter.Rule("net", "/fr/", "block"),
)

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_segment_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return topk_segments.top_k(_table(spark, sf, "embeddings"))


def op2_odd_sketch_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return odd_dedup.near_duplicates(_table(spark, sf, "documents")).drop("text_hash", "component")


def op3_url_trees(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf, "pages"), RULES)


def op4_piece_backtracking(spark: SparkSession, sf: str) -> DataFrame:
    return piece_bpe.encoding_digests(_table(spark, sf, "documents"), tokenizer_path(PIECES))


def op5_markov_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secret_markov.scan(_table(spark, sf, "documents"))


def op6_nnls_packing(spark: SparkSession, sf: str) -> DataFrame:
    return nnls_packing.pack(_table(spark, sf, "documents"), tokenizer_path(WORDS))


def op7_schema_chat(spark: SparkSession, sf: str) -> DataFrame:
    own = spark.createDataFrame(
        [(-7, turn, role, r"\### Assistant: </turn> ok") for turn, role in enumerate(("user", "assistant"))],
        "conv_id long, turn long, role string, text string",
    )
    rows = _table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return chat_schema.conversation_digests(rows.unionByName(own))


def op8_toxicity_chain(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity_chain.toxicity(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op9_resynchronised_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf, "documents"), tokenizer_path(PIECES))


def op10_piecewise_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return ctph.edited_fingerprints(_table(spark, sf, "documents"))


def op11_patched_frames(spark: SparkSession, sf: str) -> DataFrame:
    return token_files.round_trip(_table(spark, sf, "documents"), tokenizer_path(WORDS))


def op12_hirschberg_repair(spark: SparkSession, sf: str) -> DataFrame:
    return turn_repair.repair(turn_repair.damaged(_table(spark, sf, "conversations")))


def op13_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return word_variants.group_variants(_table(spark, sf, "documents"))


def queries() -> dict[str, Query]:
    found = (
        op1_segment_top_k, op2_odd_sketch_dedup, op3_url_trees, op4_piece_backtracking, op5_markov_secrets, op6_nnls_packing, op7_schema_chat,
        op8_toxicity_chain, op9_resynchronised_counts, op10_piecewise_fingerprints, op11_patched_frames, op12_hirschberg_repair, op13_spelling_variants,
    )
    return {q.__name__: q for q in found}


def oracle_sql() -> dict[str, str]:
    """SQL where it can state the whole result."""
    top = """WITH good AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM good q JOIN good c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 10"""
    return {"op1_segment_top_k": top, "op12_hirschberg_repair": sql.turn_repair_sql(), "op13_spelling_variants": sql.word_variants_sql()}
