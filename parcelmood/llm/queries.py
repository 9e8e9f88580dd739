"""All registered queries of the subpackage and their SQL."""

from __future__ import annotations

from parcelmood.llm import (  # noqa: F401
    decontaminate,
    exact_dedup,
    hard_negatives,
    html_text,
    language_id,
    licenses,
    near_dedup,
    packing,
    piece_codec,
    quality,
    token_counts,
    token_files,
    whitening,
)
from parcelmood.llm.base import ORACLES, QUERIES, Job


def llm_queries() -> tuple[dict[str, Job], dict[str, str]]:
    return dict(QUERIES), dict(ORACLES)
