"""The corpus pipeline: language ID, line dedup, near-duplicate removal, packing.

``STAGES`` lists the stages; each takes (spark, docs, sf_dir) and gives the next one's docs.
All but the last return the columns of the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airstrata.llm import langid, line_dedup, packing, simhash
from airstrata.llm.common import id_remainder, read_table, unused
from airstrata.session import stored

# How well the best profile must fit: a text whose n-grams are, on average, three quarters of
# a profile out of place is in none of the languages.
MIN_LANGUAGE_SCORE = 0.25


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; rejects texts without letters or that fit no profile.

    NULL, empty and other texts without letters go; profiles are learned from documents with a
    doc_id and a language, and without any, all documents go. Long texts count whole, repeated
    rows fare alike, columns of any name stay, an empty table stays empty.
    """
    names = unused(docs.columns, "lang_pred", "score")
    found = langid.identify(docs, docs.filter(id_remainder("doc_id", 4) != 2), names=tuple(names))
    lang, score = (F.col(name) for name in names)
    fits = (lang != langid.UNDETERMINED) & (score >= MIN_LANGUAGE_SCORE)
    return found.filter(fits).select(docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that others share; ``n_chars`` follows the text.

    NULL text becomes an empty one. A line stays in the largest doc_id that holds it, and where
    only rows without a doc_id do; repeated rows fare alike. Columns of any name stay, an empty
    table stays empty.
    """
    names = unused(docs.columns, "n_lines", "n_dropped")
    kept = line_dedup.dedup_lines(docs, names=tuple(names))
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        changed = F.when(F.col(names[1]) > 0, length).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", changed)
    return kept.select(docs.columns)


def dedup_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies, the one with the smallest doc_id.

    NULL and empty texts are near-copies of each other. Of rows that share that doc_id, or of a
    group without any, one stays. Columns of any name stay, an empty table stays empty.
    """
    return simhash.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences.

    A NULL or empty text is one piece with the closing id, a long text several; repeated rows
    and ids are packed each. Columns besides doc_id and text play no part; an empty table gives
    no pieces.
    """
    pieces = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_near_copies),
    ("packing", pack),
]

# Profiles, XXH64 fingerprints and token ids are beyond SQL; tests hold the rows against a
# brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
