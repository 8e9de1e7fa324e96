"""The registered queries of this subpackage and their SQL where SQL can express them."""

from __future__ import annotations

from threatsieve.llm import (
    decontamination, divergence, embeddings, html, lines, pieces, quality, records, resampling, simhash, spans, suffixes, surrogates,
)

QUERIES = {
    "op1_embeddings": embeddings.op1_embeddings,
    "op2_decontamination": decontamination.op2_decontamination,
    "op3_sentencepiece": pieces.op3_sentencepiece,
    "op4_spans": spans.op4_spans,
    "op5_simhash": simhash.op5_simhash,
    "op6_records": records.op6_records,
    "op7_html": html.op7_html,
    "op8_surrogates": surrogates.op8_surrogates,
    "op9_suffixes": suffixes.op9_suffixes,
    "op10_quality": quality.op10_quality,
    "op11_lines": lines.op11_lines,
    "op12_resampling": resampling.op12_resampling,
    "op13_divergence": divergence.op13_divergence,
}
ORACLE_SQL: dict[str, str] = {
    "op1_embeddings": embeddings.ORACLE_SQL,
    "op2_decontamination": decontamination.ORACLE_SQL,
    "op11_lines": lines.ORACLE_SQL,
    "op12_resampling": resampling.ORACLE_SQL,
    "op13_divergence": divergence.ORACLE_SQL,
}
