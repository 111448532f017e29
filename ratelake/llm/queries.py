"""The queries of this subpackage and the SQL of those that have one."""

from __future__ import annotations

from ratelake.llm import (
    alignment,
    entropy,
    fingerprints,
    html,
    licenses,
    mixing,
    neighbours,
    packing,
    pii,
    resampling,
    secrets,
    simhash,
    toxicity,
)

QUERIES = {
    "op1_licenses": licenses.op1_licenses,
    "op2_neighbours": neighbours.op2_neighbours,
    "op3_simhash": simhash.op3_simhash,
    "op4_mixing": mixing.op4_mixing,
    "op5_pii": pii.op5_pii,
    "op6_packing": packing.op6_packing,
    "op7_html": html.op7_html,
    "op8_fingerprints": fingerprints.op8_fingerprints,
    "op9_secrets": secrets.op9_secrets,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_resampling": resampling.op11_resampling,
    "op12_alignment": alignment.op12_alignment,
    "op13_scoring": entropy.op13_scoring,
}

ORACLE = {"op4_mixing": mixing.OP4_SQL, "op11_resampling": resampling.OP11_SQL}
