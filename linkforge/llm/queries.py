"""The registered queries and SQL of this subpackage."""

from __future__ import annotations

from linkforge.llm import (
    bpe_prefix,
    chat_perspectives,
    embedding_codes,
    lang_zstd,
    license_scan,
    line_winnow,
    near_minhash,
    pack_binary,
    paragraph_minhash,
    quality_mcd,
)

MODULES = [quality_mcd, near_minhash, chat_perspectives, lang_zstd, license_scan, bpe_prefix, pack_binary, embedding_codes, line_winnow, paragraph_minhash]
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
SQL = {k: s for m in MODULES for k, s in m.SQL.items()}
