"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from .bpe import op5_byte_bpe
from .jaccard import op2_ngram_jaccard
from .langid import op7_language_id
from .licences import op8_license_scan
from .media import op9_progressive_jpeg
from .oracles import ORACLE_SQL
from .order_minhash import op3_order_minhash
from .packing import op6_best_fit_packing
from .quality import op10_quality
from .repeats import op1_suffix_repeats
from .secrets import op4_secret_scan

__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES = {
    "op1_suffix_repeats": op1_suffix_repeats,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_order_minhash": op3_order_minhash,
    "op4_secret_scan": op4_secret_scan,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_language_id": op7_language_id,
    "op8_license_scan": op8_license_scan,
    "op9_progressive_jpeg": op9_progressive_jpeg,
    "op10_quality": op10_quality,
}
