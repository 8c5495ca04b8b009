"""SQL counterparts of the registered queries, for DuckDB."""
from __future__ import annotations


def oracle_sql() -> dict[str, str]:
    from . import base_sql, model_sql, profile_sql, report_sql
    from .ctes import with_blocks

    found = {}
    for module in (base_sql, profile_sql, report_sql, model_sql):
        for name, sql in module.SQL.items():
            found[name] = with_blocks(sql, getattr(module, "EXTRA", None))
    return found
