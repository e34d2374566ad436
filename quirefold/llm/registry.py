"""All queries of the subpackage, with their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from quirefold.llm import queries_boilerplate, queries_leaks, queries_mixing, queries_ocr, queries_sentences, queries_split, queries_splits

_MODULES = [queries_boilerplate, queries_leaks, queries_mixing, queries_ocr, queries_sentences, queries_split, queries_splits]
QUERIES: dict[str, Callable] = {k: f for m in _MODULES for k, f in m.QUERIES.items()}
SQL: dict[str, str] = {k: v for m in _MODULES for k, v in m.SQL.items()}
