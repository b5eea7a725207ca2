"""Queries of this subpackage, with SQL where DuckDB can express them."""

from __future__ import annotations

from changegrid.llm.bpe import op12_byte_bpe
from changegrid.llm.chat import OP3_SQL, op3_chat_format
from changegrid.llm.decontaminate import op9_decontamination
from changegrid.llm.langid import op4_language_id
from changegrid.llm.mixing import op5_pareto_mixing
from changegrid.llm.periodic import op11_periodic_runs
from changegrid.llm.quality import op10_quality
from changegrid.llm.resample import OP13_SQL, op13_importance_resampling
from changegrid.llm.secrets import op7_secret_scan
from changegrid.llm.simhash import op8_simhash_near_dup
from changegrid.llm.substring import OP1_SQL, op1_substring_dedup
from changegrid.llm.topk import OP2_SQL, op2_exact_topk
from changegrid.llm.toxicity import op6_toxicity

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_exact_topk": op2_exact_topk,
    "op3_chat_format": op3_chat_format,
    "op4_language_id": op4_language_id,
    "op5_pareto_mixing": op5_pareto_mixing,
    "op6_toxicity": op6_toxicity,
    "op7_secret_scan": op7_secret_scan,
    "op8_simhash_near_dup": op8_simhash_near_dup,
    "op9_decontamination": op9_decontamination,
    "op10_quality": op10_quality,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_importance_resampling": op13_importance_resampling,
}

ORACLE_SQL = {"op1_substring_dedup": OP1_SQL, "op2_exact_topk": OP2_SQL, "op3_chat_format": OP3_SQL, "op13_importance_resampling": OP13_SQL}
