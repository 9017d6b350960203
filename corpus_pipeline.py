"""The corpus pipeline: documents through five operators; each stage's result is the next one's input."""

from __future__ import annotations

import public_tokenizers

from skein.llm import bpe, exact_dedup, jaccard_join, mixing, toxicity
from skein.llm.common import discard, stored, table
from skein.session import ship


def drop_toxic(spark, docs, sf_dir):
    """Documents that the toxicity classifier rejects go; it learns from the labelled rows of the same input.

    Null and empty texts are judged by the bias alone (and stay while few rows are toxic); repeated rows stay or go
    together; without labels every row stays; an empty table stays empty. Extra columns are kept.
    """
    return toxicity.drop_toxic(docs, table(ship(spark), sf_dir, "labels"))


def drop_copies(spark, docs, sf_dir):
    """Of documents with equal texts the one with the largest id stays, as one row even if that id repeats.

    Null counts as the empty text; a group without any id keeps one row; an empty table stays empty.
    """
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark, docs, sf_dir):
    """Of documents that five-word shingles link (similarity 0.75 or more), directly or not, the smallest id stays.

    Documents without words, and rows without an id, stay; an empty table stays empty.
    """
    ship(spark)
    return jaccard_join.keep_one(docs)


def mix_sources(spark, docs, sf_dir):
    """A sample whose expected tokens follow the target weights of source, language and topic, at the most tokens that these allow, less a tenth.

    A null source or language is a label of its own; rows without tokens have their labels' probability; a null id is
    drawn only at probability 1; an empty table, or one without any words, gives an empty one.
    """
    return mixing.sample(docs)


def encode(spark, docs, sf_dir):
    """Token ids of each text, with digests of the ids and of the decoded bytes; null counts as empty, repeated rows are rows of their own."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_documents(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: A trained classifier has no SQL; tests/llm/test_pipeline.py compares with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; what a stage keeps is written to the shared folder and read again.

    A stage's table is removed once the next one is written; the last of them, which the result reads, when Python ends.
    """
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
            discard(before)
    return docs
