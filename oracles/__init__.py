"""DuckDB SQL for each registered query."""

from oracles.sql import oracle_sql

__all__ = ["oracle_sql"]
