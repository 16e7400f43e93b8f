"""The registered queries of the operators, and DuckDB SQL where it can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from prefspark.llm import decontaminate, html_extract, licenses, lm_score, minhash_dedup, pii, prefix_trie, quality, sentencepiece, sharding, simhash_dedup, spelling, substring_dedup


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_lm_score": lm_score.query,
        "op2_html_extract": html_extract.query,
        "op3_sentencepiece": sentencepiece.query,
        "op4_pii": pii.query,
        "op5_decontaminate": decontaminate.query,
        "op6_licenses": licenses.query,
        "op7_quality": quality.query,
        "op8_substring_dedup": substring_dedup.query,
        "op9_sharding": sharding.query,
        "op10_simhash_dedup": simhash_dedup.query,
        "op11_spelling": spelling.query,
        "op12_prefix_trie": prefix_trie.query,
        "op13_minhash_dedup": minhash_dedup.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op6_licenses": licenses.oracle(),
        "op7_quality": quality.oracle(),
        "op8_substring_dedup": substring_dedup.oracle(),
        "op11_spelling": spelling.oracle(),
        "op12_prefix_trie": prefix_trie.oracle(),
        "op13_minhash_dedup": minhash_dedup.oracle(),
    }
