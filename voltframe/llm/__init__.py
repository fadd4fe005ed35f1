"""Operators of a training-data pipeline and their queries.

`queries()` and `oracle_sql()` are all that the entry points take from here; nothing else in the library imports this
subpackage.
"""

from __future__ import annotations

from voltframe.llm.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
