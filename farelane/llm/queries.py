"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

from farelane.llm import context_mixing, embedding_whitening, filter_audit, language_filters, learned_partitions, length_histogram, line_quality, secret_scan, simhash_golay, source_mix, suffix_dedup, warc_archive, window_packing

QUERIES = {
    "op1_length_histogram": length_histogram.query,
    "op2_context_mixing": context_mixing.query,
    "op3_bucket_pointer_dedup": suffix_dedup.query,
    "op4_differencing_windows": window_packing.query,
    "op5_content_addressed_warc": warc_archive.query,
    "op6_source_mix": source_mix.query,
    "op7_line_quality": line_quality.query,
    "op8_learned_partitions": learned_partitions.query,
    "op9_secret_scan": secret_scan.query,
    "op10_simhash_golay": simhash_golay.query,
    "op11_language_filters": language_filters.query,
    "op12_filter_interactions": filter_audit.query,
    "op13_cholesky_whitening": embedding_whitening.query,
}

ORACLE = {
    "op5_content_addressed_warc": warc_archive.ORACLE,
    "op6_source_mix": source_mix.ORACLE,
    "op7_line_quality": line_quality.ORACLE,
    "op12_filter_interactions": filter_audit.ORACLE,
}
