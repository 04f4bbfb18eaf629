"""The corpus pipeline: ``documents`` without toxic texts and near-duplicates, with secrets masked, mixed to target weights, and
encoded. Every stage is written as Parquet to the shared folder and read again by the next, so a lost executor costs a task, not
the stages before. Stages but the last return the columns of ``documents``; any further columns of the input pass through them."""

from __future__ import annotations

from pyspark.sql import functions as F

from vicinal.llm import mixing, pieces, secrets, simhash, toxicity
from vicinal.llm.common import cut


def toxic_texts(spark, docs, sf_dir):
    """Documents scored 0.5 or more by a model learnt from the labelled ones go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels))


def near_duplicates(spark, docs, sf_dir):
    """One document of each component of near copies stays, the one with the smallest id; near are fingerprints of three-word shingles at most three bits apart, found by BK-trees."""
    return simhash.keep_one(docs, radius=3, width=3, seed=42)


def secret_spans(spark, docs, sf_dir):
    """Secrets become a mark; every document stays."""
    return secrets.redact(docs)


def source_mix(spark, docs, sf_dir):
    """Sources are mixed to weights 1, 2, 3 in turn; a document appears as often as the mix takes it."""
    return mixing.mix(docs)


def piece_numbers(spark, docs, sf_dir):
    """The mix as piece numbers, with the text they decode to."""
    coded = pieces.encode(docs, pieces.load(), keep=["doc_id", "source"], decoded="decoded")
    return coded.select("doc_id", "source", F.size("ids").alias("n_pieces"), "ids", F.col("decoded").alias("text"))


STAGES = [
    ("toxicity", toxic_texts),
    ("simhash near-dedup", near_duplicates),
    ("secret scan", secret_spans),
    ("mixing", source_mix),
    ("sentencepiece", piece_numbers),
]

# Learnt scores, BK-trees and piece numbers have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The last stage's rows for ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
