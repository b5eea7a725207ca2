"""Corpus pipeline: documents in, a cleaned and mixed corpus out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of ``documents``; its
result is written as Parquet and read again as the next stage's ``docs``.  The last stage adds how often
its mix takes each document.

Every stage takes nulls in any column, empty and very long texts, and repeated rows and ids, which are judged row
by row; an empty table gives an empty result; columns beyond those of ``documents``, whatever their names,
are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changegrid.llm import decontaminate, mixing, quality, secrets, simhash
from changegrid.llm.langid import held_out
from changegrid.sources.staging import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Bytes in one Arrow batch between Spark and a Python worker.
BATCH_BYTES = 4 << 20


def _small_batches(spark: SparkSession) -> None:
    """Hands texts to Python workers in small batches from now on, so that both sides of a task hold little of its partition.

    A stage's result is written after its function has returned, so the setting stays.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def _keyed(docs: DataFrame) -> DataFrame:
    """Adds ``row``: 128 hash bits of all columns, nulls told from values; only equal rows share it."""
    cells = [*[F.col(c).isNull() for c in COLUMNS], *COLUMNS]
    return docs.withColumn("row", F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(k), *cells)), 16, "0") for k in (1, 2)]))


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the positive-unlabelled classifier rejects (score below 0.5).

    Labels are learnt from rows whose crc32(doc_id as text) mod 3 is not 1, as in the query.
    """
    _small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels.where((F.col("quality") == 1) & ~held_out(F.col("doc_id"))))
    return quality.score(docs, model, keep=COLUMNS).where("score >= 0.5").select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of every class of near copies: that with the smallest id (null last), then hash.

    Near copies are op8's SimHash links and five-word shingle sets of Jaccard similarity 0.8 or more.

    Rows are told apart by all their columns, so null and repeated ids take no other row with them.
    """
    _small_batches(spark)
    keyed = _keyed(docs)
    name = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    found = simhash.near_copies(keyed.select(name.alias("name"), "text"), "name")
    kept = found.where(F.col("id").eqNullSafe(F.col("component"))).groupBy(F.col("id.row").alias("row")).count()
    kept = stage(kept, "pipeline-kept")
    once = keyed.join(kept.where("count = 1"), "row", "left_semi").select(COLUMNS)
    repeated = kept.where("count > 1")
    if repeated.isEmpty():
        return once
    return once.unionByName(keyed.join(repeated, "row", "left_semi").dropDuplicates(["row"]).select(COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that repeat or paraphrase a benchmark item."""
    _small_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = _keyed(docs)
    leaks = decontaminate.find_leaks(keyed.select("row", "text"), benchmark, "row").select(F.col("id").alias("row")).distinct()
    return keyed.join(stage(leaks, "pipeline-leaks"), "row", "left_anti").select(COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document; each secret in its text gives way to ``<kind>``, and n_chars follows."""
    _small_batches(spark)
    found = secrets.scan(docs, keep=("lang", "source", "n_chars"))
    hit = F.size("spans") > 0
    clean = found.withColumn("clean", secrets.redact(F.col("text"), F.col("spans")))
    n_chars = F.when(hit, F.length("clean").cast("long")).otherwise(F.col("n_chars"))
    return clean.select(F.col("id").alias("doc_id"), F.col("clean").alias("text"), "lang", "source", n_chars.alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixes sources to weights 3, 1, 2, repeating, at 150% of all words; documents not taken go.

    Adds ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` (words, repeats counted).  Rows
    that repeat an id, source and size get the same copies.
    """
    mixed = mixing.mix(docs, mixing.repeating_weights(docs), share=1.5).where("copies > 0")
    found = ["source_size", "target", "copies", "taken"]
    mixed = mixed.groupBy(F.col("id").alias("m_id"), F.col("source").alias("m_source"), "size").agg(*[F.max(c).alias(c) for c in found])
    same = F.col("doc_id").eqNullSafe(F.col("m_id")) & F.col("source").eqNullSafe(F.col("m_source")) & (mixing.word_count(F.col("text")) == F.col("size"))
    return docs.join(mixed, same).select(*COLUMNS, "size", *found)


STAGES = [
    ("quality classifier", classify_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("mixing sources", mix_sources),
]

#: Trained models and hashes are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
