"""The registered queries of this package and the SQL they are compared with."""

from __future__ import annotations

from salesmart.llm.bm25 import op4_search
from salesmart.llm.bpe import op2_bpe
from salesmart.llm.chat import OP11_SQL, op11_chat
from salesmart.llm.collocations import OP13_SQL, op13_collocations
from salesmart.llm.language import op6_language
from salesmart.llm.near_dedup import op8_near_dedup
from salesmart.llm.packing import op5_packing
from salesmart.llm.quality_model import op9_quality_model
from salesmart.llm.quality_rules import OP10_SQL, op10_quality_rules
from salesmart.llm.sharding import op1_sharding
from salesmart.llm.suffix_dedup import op3_suffix_dedup
from salesmart.llm.token_files import op7_token_files
from salesmart.llm.whitening import op12_whitening

QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_bpe": op2_bpe,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_search": op4_search,
    "op5_packing": op5_packing,
    "op6_language": op6_language,
    "op7_token_files": op7_token_files,
    "op8_near_dedup": op8_near_dedup,
    "op9_quality_model": op9_quality_model,
    "op10_quality_rules": op10_quality_rules,
    "op11_chat": op11_chat,
    "op12_whitening": op12_whitening,
    "op13_collocations": op13_collocations,
}

ORACLE = {
    "op10_quality_rules": OP10_SQL,
    "op11_chat": OP11_SQL,
    "op13_collocations": OP13_SQL,
}
