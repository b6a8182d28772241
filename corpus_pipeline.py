"""From raw documents to token files: quality, near-duplicates, decontamination, mixing, tokens.

Each stage but the last returns rows of its input with all their columns, also columns that are named
like one of its own. NULL texts count as empty, and no rows give no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from auditlens.llm import decontaminate, mixing, quality, simhash, tokens
from auditlens.llm.common import read_table
from auditlens.llm.queries import TOKENIZER
from auditlens.session import settle


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers. Texts with few or no words go; NULL
    languages and sources are groups of their own; each of repeated rows is judged."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class that fingerprints of four words at up to four bits link: the one
    with the least doc_id. Texts without words are a class. Rows without doc_id stay."""
    return simhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark. Texts without words hold none."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them. Texts without words stay once."""
    return mixing.mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: where each document stands in them, also an empty one, and
    each of repeated rows."""
    return tokens.tokenized(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixture),
    ("token files", token_files),
]

# Fingerprints, shuffled order and tokens are beyond SQL. Tests hold the operators of the stages against
# brute force or their laws, and the tokens of the whole pipeline against the library.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`, each on what the one before has written."""
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = settle(docs, f"stage-{number}")
    return docs
