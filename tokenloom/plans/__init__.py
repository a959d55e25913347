"""Whole jobs over the test tables, registered under the names the driver runs."""

from __future__ import annotations

from tokenloom.plans import corpus, language_model, logs, pairs, streams, vectors  # noqa: F401
from tokenloom.plans.registry import ORACLES, QUERIES


def all_queries():
    return dict(QUERIES)


def all_oracles():
    return dict(ORACLES)
