"""Importing this module registers the queries of all operators."""

from rollcall.llm import queries_audit, queries_pages, queries_text, queries_vectors  # noqa: F401
