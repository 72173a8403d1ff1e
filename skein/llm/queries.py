"""Registered queries of this subpackage, and the SQL of those SQL can express."""

from __future__ import annotations

from skein.llm.decontaminate import OP1_SQL, op1_decontamination
from skein.llm.language import op7_language_id, pages_language_id
from skein.llm.packing import op5_best_fit_packing
from skein.llm.passages import op2_near_passages
from skein.llm.prefix_trie import OP13_SQL, op13_prefix_trie
from skein.llm.resample import OP12_SQL, op12_importance_resample
from skein.llm.secrets import op6_secrets
from skein.llm.simhash import op9_simhash
from skein.llm.token_files import op10_token_files
from skein.llm.toxicity import op11_toxicity
from skein.llm.url_filter import OP3_SQL, op3_url_filter
from skein.llm.vector_graph import OP8_SQL, op8_vector_graph
from skein.llm.warc import OP4_SQL, op4_warc

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_near_passages": op2_near_passages,
    "op3_url_filter": op3_url_filter,
    "op4_warc": op4_warc,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_secrets": op6_secrets,
    "op7_language_id": op7_language_id,
    "op8_vector_graph": op8_vector_graph,
    "op9_simhash": op9_simhash,
    "op10_token_files": op10_token_files,
    "op11_toxicity": op11_toxicity,
    "op12_importance_resample": op12_importance_resample,
    "op13_prefix_trie": op13_prefix_trie,
    "pages_language_id": pages_language_id,
}

ORACLE: dict[str, str] = {
    "op1_decontamination": OP1_SQL,
    "op8_vector_graph": OP8_SQL,
    "op3_url_filter": OP3_SQL,
    "op4_warc": OP4_SQL,
    "op12_importance_resample": OP12_SQL,
    "op13_prefix_trie": OP13_SQL,
}
