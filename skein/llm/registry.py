"""The corpus operators' queries and their SQL, as ``__spark_entry__`` registers them."""

from __future__ import annotations

import public_tokenizers

from skein.llm import bpe, exact_dedup, histogram_shards, jaccard_join, language_id, mixing, mpeg_audio, secrets, tool_calls, toxicity
from skein.llm.common import table


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op2_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_jaccard_join(spark, sf_dir):
    return jaccard_join.link_documents(table(spark, sf_dir, "documents"))


def op4_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_histogram_shards(spark, sf_dir):
    return histogram_shards.shard_documents(table(spark, sf_dir, "documents"))


def op6_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, ids=False)


def op7_secrets(spark, sf_dir):
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op8_language_id(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op9_mpeg_audio(spark, sf_dir):
    return mpeg_audio.store_texts(table(spark, sf_dir, "documents"), media=False)


def op10_tool_calls(spark, sf_dir):
    return tool_calls.link_tool_calls(*tool_calls.calls_of(table(spark, sf_dir, "conversations")))


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_toxicity, op3_jaccard_join, op4_mixing, op5_histogram_shards, op6_bpe, op7_secrets, op8_language_id, op9_mpeg_audio, op10_tool_calls)}

ORACLE = {"op1_exact_dedup": exact_dedup.SQL, "op4_mixing": mixing.SQL, "op7_secrets": secrets.SQL, "op10_tool_calls": tool_calls.SQL}
