"""Registered queries of the training-data operators: operator calls with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reecho.llm import contamination, divergence, fingerprints, html_text, language, lines, lm, near_dup, packing, periods, pii, secrets
from reecho.llm import token_counts
from reecho.llm.common import fold, free_name, table
from reecho.operators.documents import computed_once

END_ID = 2
CONTRACT_SHINGLE = 4


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _joined(spans: Column) -> Column:
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents")).withColumn("base", F.filter("spans", lambda s: s["base"]))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), END_ID)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


LANGUAGE_FOLDS, LANGUAGE_HELD = 4, 2


def language_model(docs: DataFrame) -> language.LanguageModel:
    return language.train(docs.where(fold(F.col("doc_id"), LANGUAGE_FOLDS) != LANGUAGE_HELD))


def judging_model(docs: DataFrame) -> language.LanguageModel:
    """``language_model`` with its limits from all documents that it was not trained on."""
    return language.calibrated(language_model(docs), docs.where(fold(F.col("doc_id"), LANGUAGE_FOLDS) == LANGUAGE_HELD))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), LANGUAGE_FOLDS) == LANGUAGE_HELD
    return language.identify(docs, language_model(docs)).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("item_ids", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in secrets.BASE_KINDS],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = near_dup.NearDupParams(shingle_words=CONTRACT_SHINGLE)
    found = near_dup.near_duplicates(table(spark, sf_dir, "documents"), params)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(tokenizer_path("piece_bpe_32k.model"), "rb") as file:
        model = file.read()
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), model)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """The contract's texts: in a tenth of the documents the words from one place on repeat. A null doc_id changes nothing."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    share = F.call_function("div", crc, F.lit(10))
    found = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    words, n, first, period = (free_name(docs, c) for c in ("words", "n", "first", "period"))
    placed = computed_once(docs, words, F.when(crc % 10 == 0, found)).withColumn(n, F.size(words)).withColumn(first, share % F.col(n))
    placed = placed.withColumn(period, 1 + F.call_function("div", F.col(n) - F.col(first), 3 + share % 8))
    source = lambda i: F.col(first) + (i - F.col(first)) % F.col(period)
    repeated = F.transform(words, lambda w, i: F.when(i >= F.col(first), F.get(words, source(i).cast("int"))).otherwise(w))
    text = F.when(F.col(n) > 0, F.array_join(repeated, " ")).otherwise(F.col("text"))
    return placed.select(*[text.alias(c) if c == "text" else F.col(c) for c in docs.columns])


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periods.periodic_runs(with_repeats(docs))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *[best[c].alias(c) for c in ("start", "length", "period")],
        F.call_function("div", 1000 * best["length"], best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_packing": op2_packing,
    "op3_language": op3_language,
    "op4_contamination": op4_contamination,
    "op5_fingerprints": op5_fingerprints,
    "op6_line_dedup": op6_line_dedup,
    "op7_lm_scores": op7_lm_scores,
    "op8_secrets": op8_secrets,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_html_text": op10_html_text,
    "op11_token_counts": op11_token_counts,
    "op12_divergence": op12_divergence,
    "op13_periodic_runs": op13_periodic_runs,
}
