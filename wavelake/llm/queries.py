"""Registered queries of the training-data operators, and the SQL of those that SQL can express on whole tables."""

from __future__ import annotations

from . import chat, langid, lmscore, mixing, neardup, packing, phrases, quality, secrets, topk

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_secrets": secrets.op2_secrets,
    "op3_lmscore": lmscore.op3_lmscore,
    "op4_chat": chat.op4_chat,
    "op5_neardup": neardup.op5_neardup,
    "op6_topk": topk.op6_topk,
    "op7_quality": quality.op7_quality,
    "op8_phrases": phrases.op8_phrases,
    "op9_mixing": mixing.op9_mixing,
    "op10_langid": langid.op10_langid,
}

ORACLES = {"op3_lmscore": lmscore.oracle, "op4_chat": chat.oracle, "op5_neardup": neardup.oracle, "op6_topk": topk.oracle, "op8_phrases": phrases.oracle, "op9_mixing": mixing.oracle}
