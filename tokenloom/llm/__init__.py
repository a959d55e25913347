"""Operators for preparing large text corpora, with their registered queries."""

from __future__ import annotations

from tokenloom.llm.queries import QUERIES, SQL  # noqa: F401
