"""The operators over their whole tables, with production parameters, as registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontamination,
    fill_middle,
    html_extract,
    language,
    lm_scoring,
    merkle,
    mixing,
    near_dedup,
    repetition,
    secret_scan,
    sharding,
    token_output,
    toxicity,
)
from .common import importable, read_table, remainder
from .sql import FILL_IN_MIDDLE, MERKLE_MANIFEST


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(read_table(spark, sf_dir, "documents"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )
    listed = F.array_join(F.array_sort("items"), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(listed, 256).alias("items_sha256"), "contaminated",
    )


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.fold_scores(read_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    lexicon = toxicity.fit_fold(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, lexicon)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return language.identified(docs, language.fit_fold(docs))


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return token_output.token_output(docs, tokenizer_path(), special_as_text=False)


def op8_repetition_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.quality(read_table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secrets(read_table(spark, sf_dir, "documents"))

    def number(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    def listed(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ","
        )

    base = F.filter("found", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id", number("assign").alias("n_assign"), number("access").alias("n_access"),
        number("hex").alias("n_hex"), F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
    )


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extracted(read_table(spark, sf_dir, "pages"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_in_middle(read_table(spark, sf_dir, "documents"))
    back = fill_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"),
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    fields = [lowered if c == "text" else F.col(c) for c in merkle.FIELDS]
    tampered = F.when(remainder("doc_id", 3) == 0, merkle.leaf_digest(fields))
    proven = merkle.proofs(merkle.manifest(docs, extra={"tampered": tampered}))
    folded = merkle.folded(F.coalesce("tampered", "leaf"), F.col("proof"))
    return proven.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root",
        merkle.siblings_digest(F.col("proof")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.sharded(read_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        sharding.record_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: importable(f)
    for f in (
        op1_simhash_near_dedup,
        op2_source_mixing,
        op3_benchmark_decontamination,
        op4_lm_scoring,
        op5_toxicity,
        op6_language_id,
        op7_token_output,
        op8_repetition_quality,
        op9_secret_scan,
        op10_html_extraction,
        op11_fill_in_middle,
        op12_merkle_manifest,
        op13_external_shuffle,
    )
}

_BENCH_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    f"'abcdefghijklmnopqrstuvwxyz'), '{decontamination.WORD_CLASS}')"
)

#: SQL for the queries that it can express; tests hold the others against brute force.
ORACLES: dict[str, str] = {
    "op11_fill_in_middle": FILL_IN_MIDDLE,
    "op12_merkle_manifest": MERKLE_MANIFEST,
    "op3_benchmark_decontamination": f"""
WITH item_words AS (SELECT CAST(item_id AS VARCHAR) AS item, {_BENCH_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[k:k + least(13, len(w)) - 1], ' ') AS win
  FROM item_words, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(k) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM windows),
doc_words AS (SELECT doc_id, {_BENCH_WORDS} AS w FROM documents),
places AS (
  SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS win
  FROM doc_words, lengths, unnest(range(1, len(w) - n + 2)) AS t(k)),
found AS (SELECT doc_id, n, k, item FROM places JOIN windows USING (n, win)),
hits AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + n)) AS word FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS listed
  FROM found GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)""",
}
