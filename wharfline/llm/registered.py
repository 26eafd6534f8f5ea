"""All queries of this subpackage; importing the modules fills the registry."""

from __future__ import annotations

from wharfline.llm import (  # noqa: F401
    byte_bpe,
    chat_formatting,
    mixing,
    quality_gam,
    recompression,
    simhash,
    spelling,
    subspace_join,
    token_counts,
    token_files,
    toxicity_fm,
    whitening,
    winnowing,
)
from wharfline.llm.common import QUERIES, SQL


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)
