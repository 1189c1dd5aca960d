"""Queries and oracle texts of the corpus operators."""

from __future__ import annotations

from . import decontam, langid, linededup, mixing, neardup, quality, suffix, tokencount, topk, toxicity


def queries() -> dict:
    ops = (
        langid.op1_kneser_ney_langid,
        quality.op2_random_indexing_quality,
        linededup.op3_template_line_dedup,
        tokencount.op4_trie_token_counts,
        toxicity.op5_segment_toxicity,
        mixing.op6_sainte_lague_mix,
        topk.op7_bit_sliced_topk,
        neardup.op8_setsketch_near_dup,
        decontam.op9_positional_decontamination,
        suffix.op10_suffix_dedup,
    )
    return {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_template_line_dedup": linededup.ORACLE_SQL.format(docs="documents"),
        "op6_sainte_lague_mix": mixing.ORACLE_SQL.format(docs="documents"),
        "op7_bit_sliced_topk": topk.ORACLE_SQL,
        "op9_positional_decontamination": decontam.ORACLE_SQL.format(docs="documents"),
    }
