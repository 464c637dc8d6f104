"""A corpus pipeline over ``documents``: each stage calls one operator of
``shelfwise.llm`` and works on all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import bpe, decontaminate, linededup, simhash, toxicity
from shelfwise.llm.common import fresh, read
from shelfwise.llm.queries import tokenizer_path
from shelfwise.session import cut_lineage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go; it learns from the labelled ones among ``docs``."""
    model = toxicity.learn(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))
    score = fresh(docs, "toxic_score")
    return docs.withColumn(score, toxicity.score_column("text", model)).where(F.col(score) < 0.5).drop(score)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; n_chars follows the text."""
    return linededup.drop_boilerplate(docs).withColumn(
        "n_chars", F.coalesce(F.length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"), short_items=True, short_edits=True)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, and digests of the ids and of the text decoded from them."""
    return bpe.encode_digests(docs, tokenizer_path())


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_lines), ("simhash near-dedup", near_dedup),
          ("decontamination", drop_leaks), ("bpe", tokenize)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: No SQL: the classifier and the fingerprints have none. Tests check that stages keep columns, take effect and
#: follow each other; each operator's own tests compare it with brute force.
ORACLE_SQL = None
