"""Query bindings of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from .alignment import op13_alignment
from .chosen_path import OP5_SQL, op5_chosen_path
from .kmeans_tree import op10_kmeans_tree
from .licenses import op7_licenses
from .mixing import OP4_SQL, op4_mixing
from .packing import op9_packing
from .preference import OP2_SQL, op2_preference
from .pseudonyms import op6_pseudonyms
from .spelling import op12_spelling
from .spotsigs import OP8_SQL, op8_spotsigs
from .suffix_dedup import op11_suffix_dedup
from .toxicity import op1_toxicity
from .url_filter import OP3_SQL, op3_url_filter

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_preference": op2_preference,
    "op3_url_filter": op3_url_filter,
    "op4_mixing": op4_mixing,
    "op5_chosen_path": op5_chosen_path,
    "op6_pseudonyms": op6_pseudonyms,
    "op7_licenses": op7_licenses,
    "op8_spotsigs": op8_spotsigs,
    "op9_packing": op9_packing,
    "op10_kmeans_tree": op10_kmeans_tree,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_spelling": op12_spelling,
    "op13_alignment": op13_alignment,
}

#: operators 1, 6, 7, 9, 10, 11, 12 and 13 are not SQL; tests/llm holds them against brute force
ORACLE = {"op2_preference": OP2_SQL, "op3_url_filter": OP3_SQL, "op4_mixing": OP4_SQL, "op5_chosen_path": OP5_SQL,
          "op8_spotsigs": OP8_SQL}
