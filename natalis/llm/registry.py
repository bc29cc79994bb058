"""The subpackage's queries by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from natalis.llm.alignment import op11_alignment
from natalis.llm.curriculum import OP8_SQL, op8_curriculum
from natalis.llm.jaccard import OP2_SQL, OP12_SQL, op12_size_aware
from natalis.llm.language import op1_language_mixture
from natalis.llm.licences import op9_licences
from natalis.llm.near import op2_lsh_forest
from natalis.llm.postings import OP5_SQL, op5_positional_index
from natalis.llm.repeats import OP3_SQL, op3_repeated_windows
from natalis.llm.rtree import OP13_SQL, op13_rtree
from natalis.llm.suffixes import op6_suffix_columns
from natalis.llm.urls import OP4_SQL, op4_url_list
from natalis.llm.weaklabels import op10_weak_labels
from natalis.llm.winnowing import op7_winnowing

QUERIES = {
    "op1_language_mixture": op1_language_mixture,
    "op2_lsh_forest": op2_lsh_forest,
    "op3_repeated_windows": op3_repeated_windows,
    "op4_url_list": op4_url_list,
    "op5_positional_index": op5_positional_index,
    "op6_suffix_columns": op6_suffix_columns,
    "op7_winnowing": op7_winnowing,
    "op8_curriculum": op8_curriculum,
    "op9_licences": op9_licences,
    "op10_weak_labels": op10_weak_labels,
    "op11_alignment": op11_alignment,
    "op12_size_aware": op12_size_aware,
    "op13_rtree": op13_rtree,
}
ORACLES = {
    "op2_lsh_forest": OP2_SQL,
    "op3_repeated_windows": OP3_SQL,
    "op4_url_list": OP4_SQL,
    "op5_positional_index": OP5_SQL,
    "op8_curriculum": OP8_SQL,
    "op12_size_aware": OP12_SQL,
    "op13_rtree": OP13_SQL,
}
