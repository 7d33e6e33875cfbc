"""The registered query of each operator, over its whole table, and its SQL twin where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetzone.llm import (bpe, chat, html_main, importance, language, mixing, near_dedup, quality, quality_rules,
                           repair, token_counts, topk, winnow)
from fleetzone.llm.common import table, work_folder

Query = Callable[[SparkSession, str], DataFrame]


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents on two-word shingles at 0.8."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html_main.main_text(table(spark, sf_dir, "pages"))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best inner products of every vector whose id is divisible by 100."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=10, every=100, scale=1024)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents from text, declared language and source."""
    return language.identify(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality and toxicity of all documents, fitted on their labels."""
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowed fingerprints of all documents and of their edited texts, rolled over runs without spaces."""
    return winnow.report(table(spark, sf_dir, "documents"), rolled=True)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to source targets (weights 5, 2, 1; 150% of all words; at most twice a source)."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents and their decoded bytes, as digests."""
    return bpe.encode(table(spark, sf_dir, "documents"), emit=bpe.emit_digests, schema=bpe.DIGESTS)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted in flat token files written from all documents."""
    folder = work_folder(spark, "tokens")
    token_counts.write_token_files(table(spark, sf_dir, "documents"), folder)
    counts = token_counts.token_counts(spark, folder, head=token_counts.ID_TOKENS)
    return counts.select(token_counts.doc_id_of(F.col("head")).alias("doc_id"),
                         (F.col("n_tokens") - token_counts.ID_TOKENS).alias("n_tokens"), "terminated")


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted into windows and read back, with one conversation of control strings."""
    extra = spark.sql(r"""SELECT -7L AS conv_id, t AS turn, r AS role, r'\### Assistant: </turn> ok' AS text
                          FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(t, r)""")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(chat.format_windows(turns))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations damaged by a checksum, then repaired with an audit of every edit."""
    turns = table(spark, sf_dir, "conversations")
    return repair.digests(turns, repair.repair(repair.damage(turns)))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents weighed towards the benchmark; a quarter of those with 20 words and more drawn and ranked."""
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by base rules and an isolation forest, its threshold calibrated on the quality labels."""
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Query]:
    """Every opN query of this subpackage by name."""
    found = {k: v for k, v in globals().items() if k.startswith("op") and k[2].isdigit()}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    return {"op3_top_k": topk.ORACLE, "op7_mixing": mixing.ORACLE, "op12_importance": importance.ORACLE}
