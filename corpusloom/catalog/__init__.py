"""Named queries over the test tables, each with the SQL that states its result independently."""

from __future__ import annotations

from corpusloom.catalog import corpora, evaluation, logs, ordering, qa, rows, tokens
from corpusloom.catalog.registry import QUERIES

__all__ = ["QUERIES", "corpora", "evaluation", "logs", "ordering", "qa", "rows", "tokens"]
