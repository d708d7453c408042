"""The training-data queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import decontaminate, langid, licenses, linededup, lm, mixing, neardup, quality, runs, substrings, tokens, warc, whitening

QUERIES = {
    "op1_licenses": licenses.op1_licenses,
    "op2_quality": quality.op2_quality,
    "op3_suffix_dedup": substrings.op3_suffix_dedup,
    "op4_decontamination": decontaminate.op4_decontamination,
    "op5_token_counts": tokens.op5_token_counts,
    "op6_line_dedup": linededup.op6_line_dedup,
    "op7_language": langid.op7_language,
    "op8_near_duplicates": neardup.op8_near_duplicates,
    "op9_mixing": mixing.op9_mixing,
    "op10_warc": warc.op10_warc,
    "op11_runs": runs.op11_runs,
    "op12_lm_scores": lm.op12_lm_scores,
    "op13_whitening": whitening.op13_whitening,
}

SQL = {
    "op9_mixing": mixing.sql(),
    "op10_warc": warc.SQL,
    "op11_runs": runs.sql(),
}
