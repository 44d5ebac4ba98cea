"""The queries of this package and their SQL."""

from __future__ import annotations

from docloom.llm.decontamination import op8_decontamination
from docloom.llm.fill_in_middle import OP12_SQL, op12_fill_in_middle
from docloom.llm.filter_audit import OP13_SQL, op13_filter_audit
from docloom.llm.html_text import op3_html_text
from docloom.llm.language import language_id_pages, op9_language_id
from docloom.llm.language_model import op6_language_model
from docloom.llm.lines import OP5_SQL, op5_line_dedup
from docloom.llm.mixing import OP7_SQL, op7_mixing
from docloom.llm.quality import OP10_SQL, op10_quality_rules
from docloom.llm.sentencepieces import op11_sentencepiece
from docloom.llm.simhash import op4_simhash
from docloom.llm.token_counts import op1_token_counts
from docloom.llm.token_ids import op2_token_ids

QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_token_ids": op2_token_ids,
    "op3_html_text": op3_html_text,
    "op4_simhash": op4_simhash,
    "op5_line_dedup": op5_line_dedup,
    "op6_language_model": op6_language_model,
    "op7_mixing": op7_mixing,
    "op8_decontamination": op8_decontamination,
    "op9_language_id": op9_language_id,
    "op10_quality_rules": op10_quality_rules,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_filter_audit": op13_filter_audit,
    "language_id_pages": language_id_pages,
}

ORACLE_SQL = {
    "op5_line_dedup": OP5_SQL,
    "op7_mixing": OP7_SQL,
    "op10_quality_rules": OP10_SQL,
    "op12_fill_in_middle": OP12_SQL,
    "op13_filter_audit": OP13_SQL,
}
