"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from lettermill.llm import chat, filter_audit, licences, mixing, negatives, passages, quantised, simhash, token_files, tokens, toxicity, warc, winnow

QUERIES = {
    "op1_warc": warc.op1_warc,
    "op2_chat": chat.op2_chat,
    "op3_quantised": quantised.op3_quantised,
    "op4_winnow": winnow.op4_winnow,
    "op5_tokens": tokens.op5_tokens,
    "op6_licences": licences.op6_licences,
    "op7_passages": passages.op7_passages,
    "op8_simhash": simhash.op8_simhash,
    "op9_mixing": mixing.op9_mixing,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_token_files": token_files.op11_token_files,
    "op12_negatives": negatives.op12_negatives,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}
ORACLES = {
    "op1_warc": warc.OP1_SQL,
    "op2_chat": chat.OP2_SQL,
    "op3_quantised": quantised.OP3_SQL,
    "op4_winnow": winnow.OP4_SQL,
    "op7_passages": passages.OP7_SQL,
    "op9_mixing": mixing.OP9_SQL,
    "op12_negatives": negatives.OP12_SQL,
    "op13_filter_audit": filter_audit.OP13_SQL,
}
