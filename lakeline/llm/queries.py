"""The queries of this subpackage and the SQL twins of those that have one."""

from __future__ import annotations

from lakeline.llm import (
    bpe, languages, leaks, licenses, near_copies, near_vectors, negatives, personal,
    quality, repair, repeats, warc, wavelet,
)

QUERIES = {
    "op1_licenses": licenses.op1_licenses,
    "op2_bpe": bpe.op2_bpe,
    "op3_languages": languages.op3_languages,
    "op4_near_copies": near_copies.op4_near_copies,
    "op5_wavelet": wavelet.op5_wavelet,
    "op6_leaks": leaks.op6_leaks,
    "op7_warc": warc.op7_warc,
    "op8_personal": personal.op8_personal,
    "op9_repeats": repeats.op9_repeats,
    "op10_quality": quality.op10_quality,
    "op11_hard_negatives": negatives.op11_hard_negatives,
    "op12_conversations": repair.op12_conversations,
    "op13_near_vectors": near_vectors.op13_near_vectors,
}
ORACLES = {"op7_warc": warc.OP7_SQL, "op9_repeats": repeats.OP9_SQL, "op11_hard_negatives": negatives.OP11_SQL}
