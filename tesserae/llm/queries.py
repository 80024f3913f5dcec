"""The registry of this subpackage's queries and their SQL."""

from __future__ import annotations

from .centroids import op12_centroids, op12_sql
from .cohorts import op11_cohorts, op11_sql
from .idfiles import op4_token_ids
from .licenses import op5_licenses, op5_sql
from .lines import op1_line_dedup
from .mixing import op7_mixing
from .neighbours import op10_neighbours
from .packing import op2_packing
from .pii import op13_pii
from .simhash import op8_simhash
from .substrings import op3_substring_dedup
from .syncmers import op9_fingerprints
from .toxicity import op6_toxicity

QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_packing": op2_packing,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_token_ids": op4_token_ids,
    "op5_licenses": op5_licenses,
    "op6_toxicity": op6_toxicity,
    "op7_mixing": op7_mixing,
    "op8_simhash": op8_simhash,
    "op9_fingerprints": op9_fingerprints,
    "op10_neighbours": op10_neighbours,
    "op11_cohorts": op11_cohorts,
    "op12_centroids": op12_centroids,
    "op13_pii": op13_pii,
}
ORACLE: dict[str, str] = {"op5_licenses": op5_sql(), "op11_cohorts": op11_sql(), "op12_centroids": op12_sql()}
