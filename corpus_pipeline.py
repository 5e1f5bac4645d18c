"""A corpus from raw documents to packed training sequences, in five stages written one after another.

Stages take nulls in any column, empty and very long texts and repeated rows as they come: decisions are made row by
row or by row number, never by doc_id. Columns beyond those of documents are left out, whatever their names. Empty
documents give no rows, and without benchmark items no document is contaminated. Where rows tie, as copies do, their
place in the files decides. Each stage first deletes what earlier ones have written and nothing reads any more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.language_id import identify, train
from tallyloom.llm.minhash import near_duplicates
from tallyloom.llm.packing import pack
from tallyloom.llm.repeats import without_repeats
from tallyloom.llm.shared import sweep, written
from tallyloom.llm.winnowing import decontaminate

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _keyed(docs: DataFrame) -> DataFrame:
    """docs with a row number, so that decisions on rows find their rows whatever keys repeat.

    Rows of Parquet files, as stages get them, are numbered by file and place, the same in every job. Any other
    table is written first.
    """
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation":
        path = F.col("_metadata.file_path")
        numbers = [F.shiftrightunsigned(F.xxhash64(path), n).bitwiseAND(F.lit((1 << 31) - 1)) for n in (0, 16, 33)]
        files = docs.select(*(x.alias(f"x{i}") for i, x in enumerate([path, *numbers]))).distinct()
        total, *different = files.agg(F.count("*"), *(F.count_distinct(f"x{i}") for i in (1, 2, 3))).first()
        for number, n in zip(numbers, different):
            if n == total:  # no two files have the same number
                return docs.select(*COLUMNS, F.shiftleft(number, 32).bitwiseOR(F.col("_metadata.row_index")).alias("row"))
    return written(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents without letters, null and empty ones too, or unlike all languages learnt from the corpus
    itself. Where no row has a language, only those without letters go."""
    sweep(spark, collect=True)
    model = train(docs, F.lit(True))
    return identify(docs.select(*COLUMNS), model).where(~F.col("rejected")).select(*COLUMNS)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of each group of near copies, the first by file and place in it. Documents without words
    are near nothing and stay."""
    sweep(spark, collect=True)
    keyed = _keyed(docs)
    kept = near_duplicates(keyed, doc_id="row").where("first").select(F.col("doc_id").alias("row"))
    return keyed.join(kept, "row").select(*COLUMNS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts strings of 400 bytes that repeat out of the texts; characters that a cut goes through leave whole."""
    sweep(spark, collect=True)
    keyed = _keyed(docs)
    cut = without_repeats(keyed, doc_id="row").where("n_removed > 0").select(F.col("doc_id").alias("row"), "kept_text")
    changed = F.col("kept_text").isNotNull()
    return (
        keyed.join(cut, "row", "left")
        .withColumn("text", F.when(changed, F.col("kept_text")).otherwise(F.col("text")))
        .withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
        .select(*COLUMNS)
    )


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out contaminated documents; those without words are not."""
    sweep(spark, collect=True)
    keyed = _keyed(docs)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    kept = decontaminate(keyed, items, doc_id="row").where(~F.col("contaminated")).select(F.col("doc_id").alias("row"))
    return keyed.join(kept, "row").select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences; null texts are empty and have the end token alone."""
    sweep(spark, collect=True)
    return pack(docs)


STAGES = [
    ("language_id", language),
    ("minhash_near_dedup", near_duplicate),
    ("suffix_array_dedup", repeats),
    ("benchmark_decontamination", benchmark_free),
    ("packing", packed),
]

#: SQL can express neither the language models nor the tokenizer; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
