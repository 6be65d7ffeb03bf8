"""Queries of this subpackage over the given tables, and their SQL."""

from __future__ import annotations

from . import ann, bpe, hardneg, importance, itq, jaccard, langid, licenses, lines, mixing, quality, syncmers, tokencounts

QUERIES = {
    "op1_line_dedup": lines.op1_line_dedup,
    "op2_bpe": bpe.op2_bpe,
    "op3_mixing": mixing.op3_mixing,
    "op4_language_id": langid.op4_language_id,
    "op5_quality": quality.op5_quality,
    "op6_license_scan": licenses.op6_license_scan,
    "op7_embedding_dedup": itq.op7_embedding_dedup,
    "op8_token_counts": tokencounts.op8_token_counts,
    "op9_jaccard_join": jaccard.op9_jaccard_join,
    "op10_nearest_neighbours": ann.op10_nearest_neighbours,
    "op11_hard_negatives": hardneg.op11_hard_negatives,
    "op12_importance_resampling": importance.op12_importance_resampling,
    "op13_fingerprints": syncmers.op13_fingerprints,
}

SQL = {
    "op1_line_dedup": lines.SQL,
    "op3_mixing": mixing.SQL,
    "op7_embedding_dedup": itq.SQL,
    "op8_token_counts": tokencounts.SQL,
    "op9_jaccard_join": jaccard.SQL,
    "op11_hard_negatives": hardneg.SQL,
    "op12_importance_resampling": importance.SQL,
    "op13_fingerprints": syncmers.SQL,
}
