"""The registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from tidemill.llm import chat, merkle, neardup, neighbours, packing, pieces, pii, runs, simhash, threshold, token_counts, toxicity, warc

QUERIES = {
    "op1_token_counts": token_counts.op1_token_counts,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_chat": chat.op3_chat,
    "op4_packing": packing.op4_packing,
    "op5_surrogates": pii.op5_surrogates,
    "op6_threshold_topk": threshold.op6_threshold_topk,
    "op7_neighbours": neighbours.op7_neighbours,
    "op8_pieces": pieces.op8_pieces,
    "op9_near_copies": neardup.op9_near_copies,
    "op10_warc": warc.op10_warc,
    "op11_runs": runs.op11_runs,
    "op12_simhash": simhash.op12_simhash,
    "op13_merkle": merkle.op13_merkle,
}

ORACLES = {
    "op3_chat": chat.SQL,
    "op6_threshold_topk": threshold.SQL,
    "op9_near_copies": neardup.SQL,
    "op10_warc": warc.SQL,
    "op11_runs": runs.SQL,
    "op13_merkle": merkle.SQL,
}
