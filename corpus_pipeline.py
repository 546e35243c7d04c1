"""Corpus pipeline: filter toxic documents, deduplicate, mix sources, encode.

Stages take ``(spark, docs, sf_dir)`` and return a DataFrame, written as Parquet and read
again as the next stage's ``docs``; all but the last return the columns of documents."""
from __future__ import annotations

from prepwise.llm import exact, mixing, pieces, simhash, toxicity
from prepwise.llm.common import Scratch


def drop_toxic(spark, docs, sf_dir):
    """Documents that the classifier rejects go."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark, docs, sf_dir):
    """Of equal texts (white space aside) the longest, then the smallest id stays."""
    return exact.drop_exact_duplicates(docs)


def drop_near_copies(spark, docs, sf_dir):
    """Of documents linked by their fingerprints the smallest id stays."""
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark, docs, sf_dir):
    """Documents as many times as the mix takes them."""
    return mixing.mixed_rows(docs)


def encode(spark, docs, sf_dir):
    """Piece ids and further segmentations of every text; smaller bounds than alone, since the workers are not new."""
    return pieces.encode_documents(docs, cache_units=150_000, chunk_chars=500_000, solve_units=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: Fitting a classifier and random rounding have no SQL form; tested against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over documents."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = scratch.save(docs)
    return docs
