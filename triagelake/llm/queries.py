"""The queries of this folder and their SQL, by name."""

from triagelake.llm.collocations import OP12_SQL, op12_dynamic_collocations
from triagelake.llm.decontaminate import OP6_SQL, op6_suffix_automaton
from triagelake.llm.embeddings import op2_pruned_graph
from triagelake.llm.html import op5_style_tree
from triagelake.llm.langid import op4_kneser_ney
from triagelake.llm.packing import op8_exact_complement
from triagelake.llm.periods import op13_tree_runs
from triagelake.llm.pii import op1_field_pii
from triagelake.llm.repeats import OP11_SQL, op11_radix_repeats
from triagelake.llm.shards import op3_training_order
from triagelake.llm.simhash import op10_simhash_pivots
from triagelake.llm.toxicity import op9_weak_supervision
from triagelake.llm.urlfilter import OP7_SQL, op7_digest_array

QUERIES = {
    "op1_field_pii": op1_field_pii,
    "op2_pruned_graph": op2_pruned_graph,
    "op3_training_order": op3_training_order,
    "op4_kneser_ney": op4_kneser_ney,
    "op5_style_tree": op5_style_tree,
    "op6_suffix_automaton": op6_suffix_automaton,
    "op7_digest_array": op7_digest_array,
    "op8_exact_complement": op8_exact_complement,
    "op9_weak_supervision": op9_weak_supervision,
    "op10_simhash_pivots": op10_simhash_pivots,
    "op11_radix_repeats": op11_radix_repeats,
    "op12_dynamic_collocations": op12_dynamic_collocations,
    "op13_tree_runs": op13_tree_runs,
}
ORACLE: dict[str, str] = {
    "op6_suffix_automaton": OP6_SQL,
    "op7_digest_array": OP7_SQL,
    "op11_radix_repeats": OP11_SQL,
    "op12_dynamic_collocations": OP12_SQL,
}
