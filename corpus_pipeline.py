"""Documents to training sequences in five stages, each written and read again.

toxicity drops what the classifier rejects, lines takes boilerplate lines out of the rest
(copies on a host are one page there, as they are still in the table),
near_duplicates keeps one document of each group, decontamination drops documents that hold a
benchmark item, packing lays out what is left as token sequences.

Defined cases: a null text is an empty one for every stage and stays null; documents without
an id have no group and are kept; of rows with one id, one stays for each group whose smallest
id it is; a stage on an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import decontaminate, line_frequency, packing, simhash, toxicity
from tallyloom.llm.common import drop_folder, read, settle, work_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, n_chars counted anew."""
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast("long")).select(*COLUMNS)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.learn(docs, read(spark, sf_dir, "labels"), F.lit(True))
    return _documents(docs.filter(toxicity.toxicity(F.col("text"), model) < toxicity.THRESHOLD))


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _documents(line_frequency.drop_boilerplate(docs, copies_once=True))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of each group whose id is the smallest; of equal ids, the least text."""
    groups = simhash.groups(docs)
    first = groups.filter("doc_id = component_id").distinct()
    least = F.min(F.struct("text", "lang", "source")).alias("row")
    # Rows of an id meet once by the id; those of an id with several texts also by their fingerprint.
    several = groups.groupBy("doc_id").agg(F.count_distinct("fingerprint").alias("n")).filter("n > 1")
    mixed = settle(several.select("doc_id"), docs.count())
    single = first.join(mixed, "doc_id", "left_anti").select("doc_id")
    kept = docs.join(single, "doc_id", "left_semi").groupBy("doc_id").agg(least)
    if not mixed.isEmpty():
        several = docs.join(mixed, "doc_id", "left_semi").withColumn("fingerprint", simhash.hexadecimal(simhash.fingerprint(F.col("text"))))
        several = several.join(first, ["doc_id", "fingerprint"]).groupBy("doc_id", "root").agg(least)
        kept = kept.unionAll(several.select("doc_id", "row"))
    return _documents(kept.select("doc_id", "row.*").unionByName(docs.filter("doc_id is null").select("doc_id", "text", "lang", "source")))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    matched = decontaminate.with_matches(docs, read(spark, sf_dir, "benchmark"), into="__matches")
    return _documents(matched.filter(F.size("__matches") == 0))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("lines", without_boilerplate),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: Classifier, tokenizer and retrieval have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        folder = work_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if before:
            drop_folder(spark, before)
        before = folder
    return docs
