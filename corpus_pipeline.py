"""A training-data pipeline over documents: toxicity, quality, line dedup, near-dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and read again as the next one's
docs; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rootline.llm import linededup, near, packing, quality, toxicity
from rootline.llm.common import keep, scratch, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
THRESHOLD = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches the threshold go.

    Null and empty texts are scored like texts without words; repeated rows and ids are scored each; without labels
    every score is 0.5, so all go; an empty table stays empty; other columns are left out.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select(*COLUMNS), model).where(F.col("score") < THRESHOLD).select(*COLUMNS)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is below the threshold go.

    Null and empty texts get the score of the bias; repeated rows and ids are scored each; without labels every score is
    0.5, so all stay; an empty table stays empty; other columns are left out.
    """
    weights = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs.select(*COLUMNS), weights).where(F.col("score") >= THRESHOLD).select(*COLUMNS)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in 10 documents or more go; n_chars follows the kept text.

    A null text becomes the empty text; a document that loses all lines stays, empty; each row counts as a document,
    repeated ids included; lines of white space alone stay; an empty table stays empty; other columns are left out.
    """
    kept = linededup.drop_common_lines(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that with the smallest id. Documents link by SimHash as in op 5
    (fingerprints of three-word shingles, 3 bits or fewer apart) and by similarity (five-word shingles, 0.8).

    Nulls come after ids; of rows that share an id the lesser text mark stays; rows that repeat id and text count once;
    null texts and texts without words are one group; an empty table stays empty; other columns are left out.
    """
    return near.one_of_each(docs.select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 2048 tokens.

    A null or empty text is one piece, the end token; long texts are cut into pieces; repeated rows are packed each; a
    null id is kept; an empty table gives no pieces; other columns are not read.
    """
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("line_dedup", drop_common_lines),
    ("near_dedup", drop_near_duplicates),
    ("packing", pack),
]

#: SQL has no trees, sketches or tokenizers; tests/llm/test_pipeline.py compares each stage with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each written and read again; what a stage stored for itself, and its input, are then deleted."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with scratch():
            out = stage(spark, docs, sf_dir)
            after = stored(out, f"stage-{name}")
            keep(after)
        if before:
            before.drop()
        docs, before = after.df, after
    return docs
