"""Registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm import (
    decontam, html_text, infill, jaccard, langid, neighbours, packing, passages, pii, sql_twins, token_counts, token_files,
    toxicity, vector_codes,
)
from feedlake.llm.store import new_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark, sf_dir):
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_shared_passages(spark, sf_dir):
    return passages.shared_passages(table(spark, sf_dir, "documents"))


def op3_extract_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_nearest(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op5_language_id(spark, sf_dir):
    return langid.identify_documents(table(spark, sf_dir, "documents"))


def page_languages(spark, sf_dir):
    """The same operator where there is markup and an address."""
    return langid.identify_pages(table(spark, sf_dir, "pages"))


def op6_jaccard_components(spark, sf_dir):
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark, sf_dir):
    return decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_pack_sequences(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_pii_spans(spark, sf_dir):
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op10_token_counts(spark, sf_dir):
    """Each call starts from an empty cache, so that its time is that of encoding everything."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), new_path(spark, "token-cache"))


def op11_vector_codes(spark, sf_dir):
    codes, books = vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))
    rows = vector_codes.with_label_errors(codes)
    digest = F.lit(vector_codes.books_digest(books))
    return rows.select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))


def op12_token_files(spark, sf_dir):
    """The rows come from the files that were written."""
    path = new_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path)
    ids = token_files.read_token_files(spark, path)
    return ids.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_fill_in_middle(spark, sf_dir):
    made = infill.fill_in_middle(table(spark, sf_dir, "documents"))
    text = infill.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_shared_passages,
        op3_extract_text,
        op4_nearest,
        op5_language_id,
        page_languages,
        op6_jaccard_components,
        op7_pack_sequences,
        op8_decontaminate,
        op9_pii_spans,
        op10_token_counts,
        op11_vector_codes,
        op12_token_files,
        op13_fill_in_middle,
    )
}
ORACLES = {
    "op6_jaccard_components": sql_twins.JACCARD_COMPONENTS,
    "op8_decontaminate": sql_twins.DECONTAMINATE,
    "op11_vector_codes": sql_twins.VECTOR_CODES,
    "op13_fill_in_middle": sql_twins.FILL_IN_MIDDLE,
}
