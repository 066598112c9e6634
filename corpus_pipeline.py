"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir); its rows are written as Parquet in the shared folder and
read again as the next stage's ``docs``.  All stages but the last return the columns of
``documents``; the last returns the SentencePiece ids of every document left.

Defined results, the same in every stage: a null text counts as empty, a null id stays a document of its own, and rows that
repeat an id and its text are one document to the dedup stages and rows of their own to the others; columns of any other
name pass through; an empty table gives an empty table with the columns of ``documents``.  No stage drops a row for its length.
"""

from __future__ import annotations

from tessera.llm import exact_dedup, mixing, near_dup, pieces, toxicity
from tessera.llm.common import Stage, table


def _toxicity(spark, docs, sf_dir):
    """Documents with a score of 0.7 or more go."""
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def _exact(spark, docs, sf_dir):
    """Of documents equal but for white space, the longest stays."""
    return exact_dedup.dedup_documents(docs)


def _near(spark, docs, sf_dir):
    """Of documents linked by a similarity of 0.8 over five-word shingles, the smallest id stays."""
    return near_dup.dedup_documents(docs, words=5, limit=0.8)


def _mix(spark, docs, sf_dir):
    """Every document, in the order of the mix: its files and rows interleave the sources by weight."""
    return mixing.mixed_documents(docs)


def _encode(spark, docs, sf_dir):
    """The pieces of each document: doc_id, n_pieces, ids, round_trip."""
    import public_tokenizers

    return pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("toxicity", _toxicity), ("exact_dedup", _exact), ("near_dedup", _near), ("mixing", _mix), ("sentencepiece", _encode)]

#: The trees of the first stage are not SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    stage = Stage(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage.keep(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
