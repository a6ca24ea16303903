"""Registry of named queries and their equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlane.workbench.views import LAPS_SQL, TEL_SQL, TRACKS_SQL

Query = Callable[[SparkSession, str], DataFrame]
VIEWS = {"tel": TEL_SQL.strip(), "laps": LAPS_SQL.strip(), "tracks": TRACKS_SQL}
DIGITS = 7

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to 7 digits, so that summation order does not matter; no negative zero."""
    return df.select(
        *[
            F.expr(f"rint(`{f.name}` * 1e{DIGITS}D) / 1e{DIGITS}D + 0D").alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = lambda spark, folder: rounded(function(spark, folder))
        return function

    return register


def sql(name: str, views: str, body: str, doubles: str = "", ctes: list[str] | None = None) -> None:
    """Register the SQL twin of a query; `doubles` names the columns to round."""
    parts = [VIEWS[v] for v in views.split()] + (ctes or [])
    head = "WITH " + ("RECURSIVE " if any("UNION ALL SELECT" in c for c in parts) else "")
    head = head + ",\n".join(parts) + "\n" if parts else ""
    swaps = ", ".join(f"round_even({c} * 1e{DIGITS}, 0) / 1e{DIGITS} + 0e0 AS {c}" for c in doubles.split())
    replace = f" REPLACE ({swaps})" if swaps else ""
    ORACLES[name] = f"{head}SELECT *{replace} FROM (\n{body.strip()}\n) q"
