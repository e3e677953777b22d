"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import decontaminate, exact_dedup, hmm_scoring, mixing, near_dedup, quality, secret_scan, token_blocks, toxicity, url_filter

MODULES = (exact_dedup, near_dedup, token_blocks, quality, toxicity, hmm_scoring, url_filter, secret_scan, decontaminate, mixing)


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracles() -> dict:
    return {k: f for m in MODULES for k, f in m.ORACLES.items()}
