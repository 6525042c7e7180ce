"""The named queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from .brown import op10_brown_scores
from .chat import OP4_SQL, op4_chat_formatting
from .jaccard import op9_jaccard_join
from .leaks import op1_decontamination
from .licenses import op3_license_scan
from .packing import op11_sum_of_squares_packing
from .pieces import op2_sentencepiece
from .prefix_trie import OP12_SQL, op12_prefix_trie
from .quality import op8_quality_rules
from .secrets import op5_secret_scan
from .substrings import op6_substring_dedup
from .warc import OP7_SQL, op7_warc_segments
from .whitening import op13_feast_whitening

QUERIES = {f.__name__: f for f in (
    op1_decontamination,
    op2_sentencepiece,
    op3_license_scan,
    op4_chat_formatting,
    op5_secret_scan,
    op6_substring_dedup,
    op7_warc_segments,
    op8_quality_rules,
    op9_jaccard_join,
    op10_brown_scores,
    op11_sum_of_squares_packing,
    op12_prefix_trie,
    op13_feast_whitening,
)}

ORACLE_SQL: dict[str, str] = {
    "op4_chat_formatting": OP4_SQL, "op7_warc_segments": OP7_SQL, "op12_prefix_trie": OP12_SQL}
