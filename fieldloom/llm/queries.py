"""The registered queries of this package and their SQL statements."""

from __future__ import annotations

from fieldloom.llm.chat import OP13_SQL, op13_chat_format
from fieldloom.llm.decontamination import OP3_SQL, op3_decontamination
from fieldloom.llm.language_id import op5_language_id
from fieldloom.llm.line_dedup import OP10_SQL, op10_line_dedup
from fieldloom.llm.near_dedup import op4_near_dedup
from fieldloom.llm.packing import op9_packing
from fieldloom.llm.resampling import op12_resampling
from fieldloom.llm.substring_dedup import OP8_SQL, op8_substring_dedup
from fieldloom.llm.top_k import OP6_SQL, op6_top_k
from fieldloom.llm.toxicity import op2_toxicity
from fieldloom.llm.url_filters import OP1_SQL, op1_url_filters
from fieldloom.llm.warc import OP7_SQL, op7_warc
from fieldloom.llm.whitening import op11_whitening

QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_toxicity": op2_toxicity,
    "op3_decontamination": op3_decontamination,
    "op4_near_dedup": op4_near_dedup,
    "op5_language_id": op5_language_id,
    "op6_top_k": op6_top_k,
    "op7_warc": op7_warc,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_packing": op9_packing,
    "op10_line_dedup": op10_line_dedup,
    "op11_whitening": op11_whitening,
    "op12_resampling": op12_resampling,
    "op13_chat_format": op13_chat_format,
}

ORACLE = {
    "op1_url_filters": OP1_SQL,
    "op3_decontamination": OP3_SQL,
    "op6_top_k": OP6_SQL,
    "op7_warc": OP7_SQL,
    "op8_substring_dedup": OP8_SQL,
    "op10_line_dedup": OP10_SQL,
    "op13_chat_format": OP13_SQL,
}
