"""From documents to packed sequences: quality rules, exact and near deduplication, source mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import exact_dedup, minhash, mixing, packing, quality_rules
from gridloom.llm.common import durable
from gridloom.llm.queries import MIX_POWER, MIX_SEED, read_table, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep, row by row; all columns stay.

    A null or empty text has no words and goes. Rows with a null id and repeated rows are judged like others; texts of any
    length are read whole. The model is fitted on documents, not on docs. No rows give no rows.
    """
    return quality_rules.keep_good(docs, read_table(spark, sf_dir, "labels"), training=read_table(spark, sf_dir, "documents"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that with the largest id.

    Null and empty texts are one text; a null id comes before all others; of rows equal in id and text one stays. No rows
    give no rows.
    """
    return exact_dedup.keep_one_of_each(docs, keep="largest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies by five-word shingles, that with the smallest id.

    Texts without words (null, empty, white space alone) have no copies and stay, as do rows with a null id. Rows that
    share an id stay or go together. No rows give no rows.
    """
    return minhash.keep_one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, each as often as its source's rate says, in mixed order; all columns stay as they are.

    Copies of a document are equal in every column; packing tells their pieces apart by sequence and offset. A null source
    is a source of its own; rows of equal id and source, null ids among them, get equal counts. No rows give no rows.
    """
    return mixing.mix(docs, power=MIX_POWER, seed=MIX_SEED).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in sequences of 1024 tokens.

    A null or empty text is one piece with the end token; longer texts than a sequence are cut into several. Copies and
    rows with a null id are packed each by itself. No rows give no rows.
    """
    return packing.pack_documents(docs, tokenizer_path(), end_id=2, capacity=1024)


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("MinHash near-dedup", near),
    ("mixing sources to target weights", mixed),
    ("sum-of-squares packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written to the shared folder and read back."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = durable(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs


#: The model, the sketches and the tokenizer can't be expressed in SQL; the stages are tested against brute force.
ORACLE_SQL = None
