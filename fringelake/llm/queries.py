"""The queries of the corpus operators, with their SQL where SQL can express them."""

from __future__ import annotations

from fringelake.llm.bpe import op9_byte_bpe
from fringelake.llm.chat import OP10_SQL, op10_chat_format
from fringelake.llm.exact_dedup import OP8_SQL, op8_exact_dedup
from fringelake.llm.html_extract import op2_html_extract
from fringelake.llm.lm import op5_lm_score
from fringelake.llm.packing import op6_best_fit_packing
from fringelake.llm.quality_model import op7_quality_classifier
from fringelake.llm.quality_rules import OP4_SQL, op4_quality_rules
from fringelake.llm.simhash import op3_simhash
from fringelake.llm.toxicity import op1_toxicity

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_html_extract": op2_html_extract,
    "op3_simhash": op3_simhash,
    "op4_quality_rules": op4_quality_rules,
    "op5_lm_score": op5_lm_score,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_chat_format": op10_chat_format,
}

ORACLE_SQL = {
    "op4_quality_rules": OP4_SQL,
    "op8_exact_dedup": OP8_SQL,
    "op10_chat_format": OP10_SQL,
}
