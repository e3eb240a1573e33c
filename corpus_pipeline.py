"""From documents to packed training sequences, in stages that each end in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import jaccard, packing, pii, quality_rules, suffix_dedup
from tallyworks.llm.bpe import vocabulary
from tallyworks.llm.components import stored
from tallyworks.session import work_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
VOCABULARY = "word_bpe_49k.json"
END_ID = 2
#: Near copies share this percentage of their shingles of so many words.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def _with_text(df: DataFrame, text: str) -> DataFrame:
    """The columns of documents with another text."""
    changed = {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return df.select(*[changed.get(name, F.col(name)).alias(name) for name in COLUMNS])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the quality rules keep."""
    return stored(quality_rules.judge(docs).select(*COLUMNS, "kept"), "judged").filter("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of linked documents, once; documents without an id stay."""
    found = jaccard.link_documents(docs, words=NEAR_WORDS, threshold=NEAR_PERCENT)
    linked = found.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    rest = [name for name in COLUMNS if name != "doc_id"]
    kept = docs.join(linked, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("row"))
    kept = kept.select("doc_id", *[F.col(f"row.{name}").alias(name) for name in rest])
    return kept.union(docs.filter(F.col("doc_id").isNull()).select("doc_id", *rest)).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts the characters of passages that an earlier document holds; a document of which nothing is left has an empty text."""
    return _with_text(suffix_dedup.cut_repeats(docs, characters=True), "kept")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the kind in the place of personal data."""
    return _with_text(pii.find_and_mask(docs, pii.train(docs)), "text")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    return packing.packed_documents(docs, vocabulary(VOCABULARY), END_ID)


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("personal_data", personal_data),
    ("packing", packed),
]

#: No stage but the first can be written in SQL; the tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over the documents of a folder, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES:
        place = work_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
    return docs
