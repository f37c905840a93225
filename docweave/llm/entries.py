"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from docweave.llm import ball_kmeans, chat, decontaminate, html_text, language, oracles, order_packing, packing, quality, repair, simhash, suffix_dedup, toxicity, whitening

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_html_text": html_text.op3_html_text,
    "op4_language": language.op4_language,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_quality": quality.op6_quality,
    "op7_repair": repair.op7_repair,
    "op8_packing": packing.op8_packing,
    "op9_chat": chat.op9_chat,
    "op10_simhash": simhash.op10_simhash,
    "op11_ball_kmeans": ball_kmeans.op11_ball_kmeans,
    "op12_order_packing": order_packing.op12_order_packing,
    "op13_whitening": whitening.op13_whitening,
}
ORACLES = {"op1_suffix_dedup": oracles.SUFFIX_DEDUP, "op6_quality": oracles.quality(), "op11_ball_kmeans": oracles.ball_kmeans()}
