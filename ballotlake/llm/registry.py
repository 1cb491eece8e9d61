"""The text operators as queries, by name."""

from __future__ import annotations

from ballotlake.llm import (
    ball_tree,
    byte_bpe,
    decontaminate,
    html_text,
    language_ppm,
    licenses,
    line_spread,
    mixing,
    pii,
    quality_rules,
    simhash_pivots,
    suffix_dedup,
    whitening,
)

QUERIES = {
    "op1_simhash_pivots": simhash_pivots.query,
    "op2_quality_rules": quality_rules.query,
    "op3_prefix_decontamination": decontaminate.query,
    "op4_suffix_dedup": suffix_dedup.query,
    "op5_html_density": html_text.query,
    "op6_pii_disclosure": pii.query,
    "op7_license_rules": licenses.query,
    "op8_language_ppm": language_ppm.query,
    "op9_golden_mix": mixing.query,
    "op10_line_spread": line_spread.query,
    "op11_ball_tree_search": ball_tree.query,
    "op12_byte_bpe": byte_bpe.query,
    "op13_whitening": whitening.query,
}
