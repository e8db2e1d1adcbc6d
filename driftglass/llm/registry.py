"""Queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from driftglass.llm import bitplanes, decontaminate, jaccard, katz, language, neighbours, oracles, packing, quality, suffix, toxicity
from driftglass.llm.shared import read_table


def op1_pattern_packing(spark, sf_dir):
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op2_line_quality(spark, sf_dir):
    return quality.judge(read_table(spark, sf_dir, "documents")).select(quality.OP2_COLUMNS)


def op3_ngram_jaccard_join(spark, sf_dir):
    return jaccard.jaccard_components(read_table(spark, sf_dir, "documents"), words=4, percent=85)


def op4_toxicity(spark, sf_dir):
    return toxicity.predict(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_decontamination(spark, sf_dir):
    return decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("items")


def op6_katz_lm(spark, sf_dir):
    return katz.score_documents(read_table(spark, sf_dir, "documents"))


def op7_quality_neighbours(spark, sf_dir):
    return neighbours.predict(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_bit_planes(spark, sf_dir):
    return bitplanes.round_trip(read_table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark, sf_dir):
    return suffix.remove_repeats(read_table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_language_id(spark, sf_dir):
    return language.predict(read_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pattern_packing,
        op2_line_quality,
        op3_ngram_jaccard_join,
        op4_toxicity,
        op5_decontamination,
        op6_katz_lm,
        op7_quality_neighbours,
        op8_bit_planes,
        op9_suffix_dedup,
        op10_language_id,
    )
}
ORACLES: dict[str, str] = {"op2_line_quality": oracles.OP2, "op3_ngram_jaccard_join": oracles.OP3, "op5_decontamination": oracles.OP5}
