"""Training-corpus pipeline: language ID, near-dedup, secret redaction, source mixing, packing.

``STAGES`` lists the steps in order; each takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read back as the next step's ``docs``. All but
the last return the columns of ``documents``. No step samples or caps its input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimlens.llm.common import stored
from claimlens.llm.langid import keep_identified
from claimlens.llm.mixing import mix_sources, repeat_copies
from claimlens.llm.packing import pack_documents
from claimlens.llm.queries import MIX_WEIGHTS, mix_levels, table, tokenizer
from claimlens.llm.secret_scan import redact_secrets
from claimlens.llm.simhash import keep_one_per_group

#: Share of the tokens that reach the mix, which the weights divide; no document twice.
MIX_PERCENT, MIX_EPOCHS, MIX_SEED = 80, 1, 17
CAPACITY = 2048


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or whose language the calibrated model rejects, go."""
    return keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the least id."""
    return keep_one_per_group(docs, words_per_shingle=4, max_bits=4)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is replaced by a mark; all documents stay."""
    return redact_secrets(docs, length_col="n_chars")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that fill the budget of the domain-language-source tree."""
    mixed = mix_sources(docs, mix_levels(), MIX_WEIGHTS, MIX_PERCENT, MIX_EPOCHS, MIX_SEED)
    return repeat_copies(mixed).select(*[f"`{c}`" for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of at most CAPACITY tokens."""
    # the workers serve the other stages too, so none of their memory stays with the words of this one
    return pack_documents(docs, tokenizer("word_bpe_49k.json"), CAPACITY, end_id=0, keep_words=0)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL cannot express the learned, hashed and evolved steps; tests/llm/test_pipeline.py has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; every stage is a stored table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = stored(stage(spark, docs, sf_dir), name)
    return docs
