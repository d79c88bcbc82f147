"""Registry of named queries and their DuckDB oracle SQL.

Each query is ``(spark, sf_dir) -> DataFrame``. The oracle text is the test-data
derivation (``testdata.ORACLE_PREFIX``) followed by the query in DuckDB SQL, with
the same column names.
"""

from __future__ import annotations

from collections.abc import Callable

from tillcast.sources.testdata import ORACLE_PREFIX

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = ORACLE_PREFIX + sql
        return fn
    return deco


def load_all() -> None:
    # Importing the modules registers their queries.
    from tillcast.plans import q_catalog, q_core, q_forecast, q_more, q_recovery, q_report, q_sources, q_stream, q_tables  # noqa: F401,E501
