"""The registered queries of this subpackage and their SQL; what has no SQL is held against brute force in tests/llm."""

from __future__ import annotations

from ledgerlake.llm.alignment import op12_token_alignment
from ledgerlake.llm.byte_bpe import op2_byte_bpe
from ledgerlake.llm.embedding_dedup import op10_embedding_dedup
from ledgerlake.llm.fingerprints import op5_fingerprints
from ledgerlake.llm.html_extract import op3_html_extract
from ledgerlake.llm.jaccard_join import op4_jaccard_join
from ledgerlake.llm.language_id import op8_language_id
from ledgerlake.llm.oracles import ORACLES as ORACLES
from ledgerlake.llm.packing import op1_packing
from ledgerlake.llm.pii import op9_pii
from ledgerlake.llm.quality import op6_quality
from ledgerlake.llm.suffix_dedup import op7_suffix_dedup
from ledgerlake.llm.toxicity import op13_toxicity
from ledgerlake.llm.whitening import op11_whitening

QUERIES = {
    "op1_packing": op1_packing,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_html_extract": op3_html_extract,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_fingerprints": op5_fingerprints,
    "op6_quality": op6_quality,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_language_id": op8_language_id,
    "op9_pii": op9_pii,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_whitening": op11_whitening,
    "op12_token_alignment": op12_token_alignment,
    "op13_toxicity": op13_toxicity,
}
