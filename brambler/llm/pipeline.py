"""From raw documents to token ids in five stages, each over all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import default_path, encode
from .common import counted, own_names, read, saved, scratch
from .line_dedup import dedup_lines
from .mixing import mixed_documents
from .setsketch import drop_near_duplicates
from .toxicity import score, train


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on those of them that have labels, holds for toxic go; all stay if it learned nothing."""
    model = train(docs, read(spark, sf_dir, "labels"))
    if not len(model[0]):  # no weight: every text gets the same score, 0.5 without labelled rows, which tells nothing
        return docs.withColumn("text", F.col("text").cast("string"))
    own, back = own_names(docs)
    return score(own, model, "__score").filter("__score < 0.5").drop("__score").withColumnsRenamed(back).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in several documents stay in the one with the smallest id."""
    own, back = own_names(docs, "n_lines", "n_dropped")  # the operator's counts take these names
    return counted(dedup_lines(own).drop("n_lines", "n_dropped").withColumnsRenamed(back)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest id stays."""
    return drop_near_duplicates(docs).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each time a document is taken whole, and one for the words taken besides."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row of the mix, and digests of the ids and of what they decode to."""
    found = encode(docs, default_path(), ["n_tokens", "ids", "ids_sha256", "decoded_sha256"])
    return found.select("doc_id", "lang", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [("toxicity", toxicity), ("line dedup", lines), ("near duplicates", near_duplicates), ("mixing", mixing), ("bpe", tokens)]

#: SQL has no form for the classifier, the sketches, the seeded mix or the encoder; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Rows that share a doc_id, or have none, are rows of their own in every stage; tables that
    a stage writes for itself are removed once its result is written."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch(spark):
            found = stage(spark, docs, sf_dir)
            docs = saved(found, f"pipeline-{name.replace(' ', '-')}", keep=True)
    return docs
