"""Query registry: each entry is a Spark builder plus (optionally) its DuckDB SQL."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _split_round(sql: str, start: int) -> tuple[str, str, int]:
    """Parse ``round(a, n)`` starting at the open paren; return (a, n, end index)."""
    depth, i, comma = 0, start, None
    while i < len(sql):
        ch = sql[i]
        if ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
            if depth == 0:
                break
        elif ch == "," and depth == 1:
            comma = i
        elif ch == "'":
            i = sql.index("'", i + 1)
        i += 1
    return sql[start + 1:comma], sql[comma + 1:i], i


def decimal_rounding(sql: str) -> str:
    """``round(a, n)`` of doubles as decimal rounding with a double result.

    The reference's ``numeric`` rounds quotients as decimals; DuckDB divides to doubles and rounds those in binary.
    """
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        a, n, end = _split_round(sql, j + 5)
        out.append(f"{sql[i:j]}CAST(round(TRY_CAST({decimal_rounding(a)} AS DECIMAL(38,10)),{n}) AS DOUBLE)")
        i = end + 1


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with its oracle SQL."""
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = fn
        if sql is not None:
            SQL[name] = decimal_rounding(sql)
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Every fractional column half up to ``digits``, as a double (``functions.clean.round_to`` in one SQL expression)."""
    from ..functions.clean import QUOTIENT
    cols = []
    for f in df.schema.fields:
        q = f"`{f.name}`"
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            cols.append(F.expr(f"double(round(try_cast({q} AS {QUOTIENT}), {digits}))").alias(f.name))
        else:
            cols.append(F.col(q))
    return df.select(*cols)
