"""Inputs, query catalog and reference SQL for checking the library against DuckDB."""
