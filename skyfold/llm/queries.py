"""Registry of this package's queries and their DuckDB equivalents."""

from __future__ import annotations

from skyfold.llm.bpe import op4_byte_bpe
from skyfold.llm.collocations import ORACLE_OP11, op11_phrase_collocations
from skyfold.llm.credentials import op2_secret_scan
from skyfold.llm.hard_negatives import ORACLE_OP13, op13_hard_negatives
from skyfold.llm.langid import op1_language_id
from skyfold.llm.minhash import op12_minhash_near_dedup
from skyfold.llm.neighbours import op6_learned_partitions
from skyfold.llm.packing import op7_curve_packing
from skyfold.llm.quality import ORACLE_OP5, op5_quality_rules
from skyfold.llm.simhash import op9_simhash_near_dedup
from skyfold.llm.substrings import ORACLE_OP3, op3_substring_dedup
from skyfold.llm.toolcalls import ORACLE_OP10, op10_tool_call_linking
from skyfold.llm.warc import ORACLE_OP8, op8_warc_fixity

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_secret_scan": op2_secret_scan,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_quality_rules": op5_quality_rules,
    "op6_learned_partitions": op6_learned_partitions,
    "op7_curve_packing": op7_curve_packing,
    "op8_warc_fixity": op8_warc_fixity,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_tool_call_linking": op10_tool_call_linking,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_minhash_near_dedup": op12_minhash_near_dedup,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES = {
    "op3_substring_dedup": ORACLE_OP3,
    "op5_quality_rules": ORACLE_OP5,
    "op8_warc_fixity": ORACLE_OP8,
    "op10_tool_call_linking": ORACLE_OP10,
    "op11_phrase_collocations": ORACLE_OP11,
    "op13_hard_negatives": ORACLE_OP13,
}
