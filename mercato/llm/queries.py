"""Queries of the corpus operators, and SQL where it can express them."""

from __future__ import annotations

from mercato.llm.decontaminate import OP10_SQL, op10_decontamination
from mercato.llm.hmm import op5_hmm_score
from mercato.llm.html_text import op8_html_text
from mercato.llm.langid import op2_language_id
from mercato.llm.near_dup import op3_near_dup
from mercato.llm.packing import op4_packing
from mercato.llm.sharding import op6_sharding
from mercato.llm.simhash import op9_fingerprints
from mercato.llm.tokens import op7_token_ids
from mercato.llm.url_filter import op1_url_filter

QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filter,
        op2_language_id,
        op3_near_dup,
        op4_packing,
        op5_hmm_score,
        op6_sharding,
        op7_token_ids,
        op8_html_text,
        op9_fingerprints,
        op10_decontamination,
    )
}
ORACLES: dict[str, str] = {"op10_decontamination": OP10_SQL}
