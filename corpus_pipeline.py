"""The corpus pipeline: quality rules, exact dedup, near dedup, mixing, token ids.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir), with docs the
table that the stage before wrote, and returns a DataFrame. All but the last return the
columns of ``documents``.

Defined cases, of every stage: null and empty texts are empty; nulls in other columns are values
of their own; repeated rows are handled each; further columns pass through, whatever their names;
an empty table gives an empty one. The first stage drops empty texts, as the base rules
ask for twenty words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tractlake.llm import exact_dedup, mixing, pieces, quality, simhash
from tractlake.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a certified cutoff go; a language without enough
    labels has no cutoff. Equal texts are judged alike, a null key is judged by its text."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays (a null key is below all others; of
    equal rows one stays). Null and empty texts are equal."""
    return exact_dedup.dedup_frame(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a component of near-equal fingerprints, the row with the smallest doc_id stays. Three-word
    shingles and two bits, as the operator's contract says: that finds copies that differ in
    very little, not every near copy (README)."""
    return simhash.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document comes as often as it is drawn, not at all, once or twice, in the
    files of its shards and there in the shards' shuffled order. Empty documents have size 0."""
    return mixing.in_order(mixing.mixed(docs)).select("doc.*")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and n_tokens of every row of the mix, and whether decoding gives the text
    again. An empty text has no ids."""
    return pieces.encode(docs, check=True).select(F.col("key").alias("doc_id"), "n_tokens", "ids", "round_trip")


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_copies), ("simhash_near_dedup", near_copies),
          ("source_mixing", source_mix), ("sentencepiece", token_ids)]

# The fingerprints and the piece scores have no DuckDB counterpart; the tests hold the stages of
# run() one by one against brute force on what the stage before kept.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's result is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
