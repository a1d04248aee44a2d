"""The queries of this subpackage and their DuckDB SQL, by name."""

from __future__ import annotations

from nightaudit.llm import (bpe, chat, decontamination, html_text, langid, near_dup, personal_data, prefix_trie, quality,
                            resampling, secrets, token_counts, token_output)

MODULES = [token_output, secrets, token_counts, near_dup, chat, html_text, quality, bpe, decontamination, langid,
           resampling, prefix_trie, personal_data]

QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLE_SQL = {name: sql for m in MODULES for name, sql in getattr(m, "ORACLE_SQL", {}).items()}
