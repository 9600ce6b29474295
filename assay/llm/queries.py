"""Registered queries of the training-data operators, and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assay.llm.alignment import op12_cross_tokenizer_alignment
from assay.llm.chat import OP10_SQL, op10_chat_formatting
from assay.llm.decontaminate import op3_benchmark_decontamination
from assay.llm.extraction import op13_html_extraction
from assay.llm.jaccard_join import op4_ngram_jaccard_join
from assay.llm.oracle import OP1_SQL, OP3_SQL, OP4_SQL
from assay.llm.packing import op8_best_fit_packing
from assay.llm.prefix_trie import OP11_SQL, op11_conversation_prefix_trie
from assay.llm.quality import op9_quality_rules
from assay.llm.secrets import op7_secret_scans
from assay.llm.substring_dedup import op1_substring_dedup
from assay.llm.token_store import op2_token_output
from assay.llm.toxicity import op5_toxicity
from assay.llm.warc import OP6_SQL, op6_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_token_output": op2_token_output,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_toxicity": op5_toxicity,
    "op6_warc": op6_warc,
    "op7_secret_scans": op7_secret_scans,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_quality_rules": op9_quality_rules,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_conversation_prefix_trie": op11_conversation_prefix_trie,
    "op12_cross_tokenizer_alignment": op12_cross_tokenizer_alignment,
    "op13_html_extraction": op13_html_extraction,
}

ORACLE: dict[str, str] = {
    "op1_substring_dedup": OP1_SQL,
    "op3_benchmark_decontamination": OP3_SQL,
    "op4_ngram_jaccard_join": OP4_SQL,
    "op6_warc": OP6_SQL,
    "op10_chat_formatting": OP10_SQL,
    "op11_conversation_prefix_trie": OP11_SQL,
}
