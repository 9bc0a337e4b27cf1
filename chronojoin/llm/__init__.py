"""Operators of a training-data pipeline, and their registered queries."""

from __future__ import annotations

from .bagminhash import op6_bagminhash
from .bpe_words import op4_bpe_words
from .cross_parsing import op7_cross_parsing
from .license_scan import OP11_SQL, op11_license_scan
from .multi_index import op10_multi_index
from .ordinal_toxicity import op3_ordinal_toxicity
from .pfair_mix import op9_pfair_mix
from .pq_dedup import op1_pq_dedup
from .quality_rda import op8_quality_rda
from .secret_forest import op5_secret_forest
from .source_divergence import OP12_SQL, op12_source_divergence
from .token_alignment import op13_token_alignment
from .url_alias import OP2_SQL, op2_url_alias


def queries() -> dict:
    return {
        "op1_pq_dedup": op1_pq_dedup,
        "op2_url_alias": op2_url_alias,
        "op3_ordinal_toxicity": op3_ordinal_toxicity,
        "op4_bpe_words": op4_bpe_words,
        "op5_secret_forest": op5_secret_forest,
        "op6_bagminhash": op6_bagminhash,
        "op7_cross_parsing": op7_cross_parsing,
        "op8_quality_rda": op8_quality_rda,
        "op9_pfair_mix": op9_pfair_mix,
        "op10_multi_index": op10_multi_index,
        "op11_license_scan": op11_license_scan,
        "op12_source_divergence": op12_source_divergence,
        "op13_token_alignment": op13_token_alignment,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL where it can express the result; the other operators are tested against brute force."""
    return {
        "op2_url_alias": OP2_SQL,
        "op11_license_scan": OP11_SQL,
        "op12_source_divergence": OP12_SQL,
    }
