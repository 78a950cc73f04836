"""The corpus pipeline: stages over documents, each written and reread by the next.

Every stage works on all rows its predecessor kept. The first four return the columns of
documents as they are; the last returns the packed pieces.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tokenloom.llm.frames import drop_stash, stash
from tokenloom.llm.language_id import keep_known, learn_languages, training_rows
from tokenloom.llm.mixing import repeat_to_mix
from tokenloom.llm.packing import pack_documents
from tokenloom.llm.simhash_dedup import keep_one
from tokenloom.llm.toxicity import keep_harmless, learn_severity, severity_grades

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without any identifiable language go (null, no letter).

    Where no document brings a language, none is told apart and those without a letter go.
    """
    return keep_known(docs, learn_languages(training_rows(docs)))


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents more likely toxic than not go; learned from the labels table."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return keep_harmless(docs, learn_severity(docs, severity_grades(labels)), least=0.5)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near copies, 3-word shingles, 3 bits: of each group the least id stays."""
    return keep_one(docs, width=3, seed=42, most=3)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: documents of sources below their target repeat, others go, by seeded choice."""
    return repeat_to_mix(docs, weights=(5, 2, 1), most=3)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of what is left into sequences of 1024 tokens."""
    return pack_documents(docs, TOKENIZER, end_id=2, most=1024)


STAGES = [
    ("language", known_language),
    ("toxicity", harmless),
    ("near_copies", one_of_near_copies),
    ("mixing", mixed_sources),
    ("packing", packed),
]

#: No SQL expresses the learned stages; tests/llm compares run() with the stages by hand.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, one after the other."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name)
        if before is not None:
            drop_stash(spark, before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
