"""A training corpus in five stages: toxic documents go, then exact copies, near copies and contaminated documents; the rest is packed.

Each stage takes the documents that its predecessor kept, as written to Parquet, and judges them on that input. Decisions are
about rows, not ids: a row whose id another row has too is kept or dropped for its own text. Of rows with equal or similar texts
that share the smallest id one stays; a null id comes after all others. Null texts count as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskflow.llm import decontaminate, exact_dedup, jaccard, packing, toxicity
from riskflow.llm.common import WHITE, saved, text_of

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
KEY = "__row"  # names a row by what it holds, whatever ids repeat


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key is not among ``dropped``, with the columns of documents."""
    return docs.join(dropped.select(F.col(KEY).alias("__dropped")).distinct(), F.col(KEY) == F.col("__dropped"), "left_anti")


def once(docs: DataFrame) -> DataFrame:
    """One row of each key: the smallest by its columns. Rows whose key does not repeat are not moved."""
    several = saved(docs.groupBy(KEY).count().where("count > 1").select(KEY), "repeated")
    if several.isEmpty():
        return docs
    order = Window.partitionBy(KEY).orderBy(*COLUMNS)
    first = docs.join(several, KEY, "left_semi").select(KEY, *COLUMNS).distinct().withColumn("rank", F.row_number().over(order))
    return docs.select(KEY, *COLUMNS).join(several, KEY, "left_anti").unionByName(first.where("rank = 1").drop("rank"))


def row_key(text: Column) -> Column:
    """A text that orders rows by id, null last, then by a digest of ``text``."""
    number = F.lpad(F.expr("CAST(CAST(doc_id AS DECIMAL(20, 0)) + 9223372036854775808BD AS DECIMAL(20, 0))").cast("string"), 20, "0")
    return F.concat_ws("|", F.coalesce(number, F.lit("~")), F.md5(text))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier does not call toxic; it learns from the labels of those that are here."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    keyed = docs.withColumn(KEY, row_key(text_of("text")))
    return without(keyed, toxicity.score(keyed, model, id_col=KEY).where("score >= 0.5")).select(*COLUMNS)


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of equal texts the row with the smallest id; one, if rows repeat that id."""
    found = exact_dedup.exact_dedup(docs).where("NOT kept")
    key = lambda digest: F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("~")), digest)
    keyed = docs.withColumn(KEY, key(F.sha2(F.regexp_replace(text_of("text"), WHITE, " "), 256)))
    return once(without(keyed, found.select(key(F.col("text_sha256")).alias(KEY)))).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar texts the row with the smallest id; one, if rows repeat that id."""
    keyed = docs.withColumn(KEY, row_key(text_of("text")))
    groups = jaccard.near_duplicates(keyed, id_col=KEY)
    return once(without(keyed, groups.where(F.col(KEY) != F.col("component_id")))).select(*COLUMNS)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of which less than a twentieth of the words stand in windows of the benchmark."""
    found = decontaminate.find_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where(decontaminate.contaminated())
    key = lambda version: F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("~")), version.cast("string"))
    return without(docs.withColumn(KEY, key(F.xxhash64(text_of("text")))), found.select(key(F.col("version")).alias(KEY))).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left."""
    pieces = packing.pack(docs)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source")


STAGES = [("toxicity", toxic), ("exact_dedup", copies), ("ngram_jaccard", near_copies), ("decontamination", benchmark_free), ("packing", packed)]

#: The classifier and the tokenizer have no SQL; tests/llm/test_pipeline.py compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
