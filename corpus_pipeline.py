"""Corpus pipeline: documents through the text operators, each stage written and read again.

Stages before the last return the columns of ``documents``. A document leaves when its
language can't be told, when it is a copy or near copy of one that stays, or when it
holds a passage of the benchmark; personal data in the texts that stay is masked, and
the last stage packs them into sequences. Every row is judged for itself, by a digest of
all its columns, so rows that share an id or have none don't share a verdict; rows equal
in all columns are one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm import decontam, jaccard, langid, packing, pii
from feedlake.llm.store import settle

#: Rows of a few numbers that may be broadcast; more are joined by shuffle.
BROADCAST_ROWS = 200_000
ROW = "__row__"
#: Bytes that a Python worker gets at once, where the session sets no bound; by default it is ten thousand texts of any length.
BATCH_BYTES = 1 << 20


def _bound_batches(spark: SparkSession) -> None:
    """Batches for Python are bounded by bytes; a stage's result is computed after it returns, so the session keeps the bound."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(setting, None) is None:
        spark.conf.set(setting, str(BATCH_BYTES))


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a 64-bit digest of all columns."""
    return docs.withColumn(ROW, F.xxhash64(*docs.columns))


def _settled_small(df: DataFrame, label: str) -> DataFrame:
    """A settled table, marked for broadcast if it is counted to be small."""
    df = settle(df, label)
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _without(keyed: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """``keyed`` but the rows whose digest is in ``column``."""
    gone = _settled_small(rows.select(F.col(column).alias(ROW)).distinct(), "dropped-rows")
    return keyed.join(gone, ROW, "left_anti")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an accepted language, which replaces what they declared."""
    _bound_batches(spark)
    keyed = _keyed(docs)
    found = settle(langid.identify_documents(keyed.withColumn("doc_id", F.col(ROW))), "languages")
    # Mostly what was declared stands, so only the few others are carried over.
    other = found.where("NOT accepted OR NOT language <=> declared").groupBy(F.col("doc_id").alias(ROW))
    other = _settled_small(other.agg(F.min("accepted").alias("__kept__"), F.min("language").alias("__told__")), "relabelled")
    kept = keyed.join(other, ROW, "left").where(F.coalesce("__kept__", F.lit(True)))
    return kept.withColumn("lang", F.coalesce("__told__", "lang")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: that with the smallest id, null ids last."""
    _bound_batches(spark)
    keyed = _keyed(docs)
    groups = settle(jaccard.jaccard_components(keyed, id_col=ROW), "groups").withColumnRenamed("doc_id", ROW)
    several = groups.where(F.col("component_id") != F.col(ROW)).select("component_id").distinct()
    linked = groups.select(ROW, "component_id").distinct().join(_settled_small(several, "several"), "component_id")
    linked = _settled_small(linked, "linked")
    ids = keyed.select(ROW, "doc_id").join(linked, ROW).select("component_id", F.struct(F.isnull("doc_id").alias("none"), "doc_id", ROW).alias("at"))
    first = ids.groupBy("component_id").agg(F.min("at")[ROW].alias("first"))
    gone = linked.join(first, "component_id").where(F.col(ROW) != F.col("first"))
    kept = _without(keyed, gone, ROW)
    repeated = groups.groupBy(ROW).count().where("count > 1")
    return (kept if repeated.isEmpty() else kept.dropDuplicates([ROW])).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = _keyed(docs)
    hit = decontam.decontaminate(keyed, benchmark, id_col=ROW).where("contaminated")
    return _without(keyed, hit, "doc_id").select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked; ``n_chars`` follows the text."""
    _bound_batches(spark)
    masked = pii.mask_pii(docs)
    n_chars = F.coalesce(F.length("text"), F.col("n_chars"))
    return masked.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences."""
    _bound_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("PII", mask_personal_data),
    ("best-fit packing", pack_sequences),
]

#: Language ID, PII and packing aren't expressible in SQL; the pipeline is tested stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
