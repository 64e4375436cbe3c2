"""All queries of the subpackage: importing the operators registers them."""

from __future__ import annotations

from stayline.llm import (  # noqa: F401
    conversations, hard_negatives, hilbert_search, html_text, order_minhash, packing, pieces, quality, secret_scan,
    sharding, simhash, suffix_arrays, toxicity,
)
from stayline.llm.registry import ORACLES, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
