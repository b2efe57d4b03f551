"""The subpackage's queries and, where SQL can express them, their DuckDB forms."""

from __future__ import annotations

from .ann import op1_ann
from .byte_bpe import op2_byte_bpe
from .exact_topk import OP6_SQL, op6_exact_topk
from .hard_negatives import OP11_SQL, op11_hard_negatives
from .language_model import op5_language_model
from .near_dedup import OP3_SQL, op3_near_dedup
from .packing import op8_packing
from .pii import op12_pii
from .quality import op4_quality
from .spelling_variants import OP13_SQL, op13_spelling_variants
from .substring_dedup import OP10_SQL, op10_substring_dedup
from .token_files import op7_token_files
from .toxicity import op9_toxicity

QUERIES = {
    "op1_ann": op1_ann,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_near_dedup": op3_near_dedup,
    "op4_quality": op4_quality,
    "op5_language_model": op5_language_model,
    "op6_exact_topk": op6_exact_topk,
    "op7_token_files": op7_token_files,
    "op8_packing": op8_packing,
    "op9_toxicity": op9_toxicity,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_pii": op12_pii,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE = {
    "op3_near_dedup": OP3_SQL,
    "op6_exact_topk": OP6_SQL,
    "op10_substring_dedup": OP10_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op13_spelling_variants": OP13_SQL,
}
