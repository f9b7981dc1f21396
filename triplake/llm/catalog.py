"""Registered corpus queries and their DuckDB statements (where SQL expresses the operator)."""

from __future__ import annotations

from triplake.llm import (
    bpe, cap_dedupe, dual_tree, importance, langid, mixing, pieces, ppm, shingle_join, spelling, surrogates, url_filter,
    warc)

QUERIES = {
    "op1_cap_dedupe": cap_dedupe.op1_cap_dedupe,
    "op2_mix_sources": mixing.op2_mix_sources,
    "op3_ppm": ppm.op3_ppm,
    "op4_dual_tree": dual_tree.op4_dual_tree,
    "op5_surrogates": surrogates.op5_surrogates,
    "op6_url_filter": url_filter.op6_url_filter,
    "op7_warc": warc.op7_warc,
    "op8_language_id": langid.op8_language_id,
    "op9_bpe": bpe.op9_bpe,
    "op10_shingle_join": shingle_join.op10_shingle_join,
    "op11_resample": importance.op11_resample,
    "op12_spelling": spelling.op12_spelling,
    "op13_pieces": pieces.op13_pieces,
}

ORACLE_SQL = {
    "op2_mix_sources": mixing.ORACLE_SQL,
    "op4_dual_tree": dual_tree.ORACLE_SQL,
    "op6_url_filter": url_filter.ORACLE_SQL,
    "op7_warc": warc.ORACLE_SQL,
    "op11_resample": importance.ORACLE_SQL,
    "op12_spelling": spelling.ORACLE_SQL,
}
