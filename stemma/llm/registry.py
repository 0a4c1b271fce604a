"""Queries and DuckDB SQL of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stemma.llm import audit, chunkdedup, embeddings, neighbours, packing, phrases, pieces, quality, sharding, simhash, suffixes, warc, wavelet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": pieces.op1_sentencepiece,
    "op2_substring_dedup": chunkdedup.op2_substring_dedup,
    "op3_sharding": sharding.op3_sharding,
    "op4_packing": packing.op4_packing,
    "op5_token_output": wavelet.op5_token_output,
    "op6_suffix_dedup": suffixes.op6_suffix_dedup,
    "op7_embedding_dedup": embeddings.op7_embedding_dedup,
    "op8_quality_classifier": quality.op8_quality_classifier,
    "op9_simhash": simhash.op9_simhash,
    "op10_ann": neighbours.op10_ann,
    "op11_warc": warc.op11_warc,
    "op12_filter_audit": audit.op12_filter_audit,
    "op13_collocations": phrases.op13_collocations,
}

ORACLES: dict[str, str] = {"op11_warc": warc.OP11_SQL, "op12_filter_audit": audit.OP12_SQL, "op13_collocations": phrases.OP13_SQL}
