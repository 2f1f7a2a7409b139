"""Registry of checked queries: a Spark query and, where SQL can say it, the DuckDB statement."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.ctes import with_ctes

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, needs: str = "", sql: str | None = None):
    """Register the decorated function under ``name``; ``sql`` may use the building blocks in ``needs``."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_ctes(needs, sql)
        return fn

    return register


def rounded(df, columns, digits: int = 6):
    """Doubles to a fixed number of digits (no negative zero), so that both engines agree."""
    return df.select(
        *[(F.round(c, digits) + F.lit(0.0)).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def sql_rounded(columns, rounded_columns, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) + 0e0 AS {c}" if c in rounded_columns else c for c in columns)
