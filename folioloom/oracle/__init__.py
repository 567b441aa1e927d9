"""SQL twins of the registered queries, for DuckDB over the same Parquet tables."""

from folioloom.oracle.statements import statements

__all__ = ["statements"]
