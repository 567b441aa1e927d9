"""Registered queries of this subpackage; digests and SQL twins live here, work in the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.llm import chosen_path, compression_bands, curriculum, decontam, feistel, line_windows, personal_data, quality_model, spelling_variants, substring, token_store, url_cascade, word_runs
from folioloom.llm.frames import bytes_of, crc_of, table
from folioloom.session import scratch_path


#: The rules, and host name parts whose addresses are listed.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
LISTED_HOST_PARTS = ["ads", "adult", "bets", "casino", "pills", "spam"]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = [url_cascade.Rule(*r) for r in URL_RULES]
    return url_cascade.judge(pages, rules, url_cascade.addresses_of_hosts(pages, LISTED_HOST_PARTS))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_windows.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model.from_labels(docs, table(spark, sf_dir, "labels"))
    scored = quality_model.score(docs.select("doc_id", "text"), model).drop("text")
    return scored.select(
        "doc_id",
        quality_model.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (bytes_of(F.col("text")) + 1).alias("size"), crc_of(F.col("text")).alias("text_crc32")
    )
    dealt = feistel.shard(docs, [F.col("doc_id").asc_nulls_last(), F.col("text_crc32"), F.col("size")])
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's share of the mix and where its copies stand in it (null: not taken), in order of training."""
    planned = curriculum.schedule(table(spark, sf_dir, "documents"))
    at = [F.round(F.get("positions", F.lit(i)), 9).alias(f"position_{i + 1}") for i in range(2)]
    return planned.select("doc_id", "size", "source_size", "target", "taken", *at)


def op6_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The copies that op6_mixing counts, one row each."""
    placed = curriculum.positions(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "source", "size", "copy", F.round("position", 9).alias("position"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("hash", "component")


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-blocks")
    token_store.write(table(spark, sf_dir, "documents"), path)
    return token_store.digest(token_store.read(spark, path))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.judge(docs, table(spark, sf_dir, "benchmark")).drop("text")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_bands.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in personal_data.KINDS]
    base, spans = (personal_data.listed(F.col(c)) for c in ("base", "spans"))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), spans.alias("spans"))


def op12_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = word_runs.collapse(table(spark, sf_dir, "documents").select("doc_id", "text"), loops=True)
    best = F.col("strongest")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[x].cast("string") for x in ("start", "length", "period"))), F.lit("\n")))
    return docs.select(
        "doc_id", "n_runs", best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"),
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.grouped(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = (
    op1_url_filter, op2_line_dedup, op3_quality, op4_shards, op5_substrings, op6_mixing, op6_positions, op7_near_duplicates, op8_tokens, op9_decontamination, op10_quality_rules,
    op11_personal_data, op12_word_runs, op13_spelling_variants)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": url_cascade.SQL, "op2_line_dedup": line_windows.SQL, "op5_substrings": substring.SQL, "op6_mixing": curriculum.SQL, "op6_positions": curriculum.POSITIONS_SQL, "op9_decontamination": decontam.SQL, "op13_spelling_variants": spelling_variants.SQL}
