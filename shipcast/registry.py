"""Registered queries: name -> Spark callable (spark, sf_dir) -> DataFrame,
and, where SQL can express it, the DuckDB oracle SQL for the same result.

Every query reads the input tables (through the derived layers), over the
whole tables. Double outputs are rounded to 6 decimals on both sides
because float sums and transcendental functions differ in the last bits
between engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, Callable[[], str]] = {}


def register(name: str, sql: Callable[[], str] | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def round_half_away(c, digits: int = 6):
    """round(x · 10^d) / 10^d with halves away from zero, evaluated on the
    binary product (so 4258.5484375 → 4258.548437 in every engine).

    Computed with exact floating-point steps instead of ``round`` (which
    goes through BigDecimal per value): ``rint`` differs only where the
    fraction is exactly a half and the even neighbour lies towards zero, and
    there the other neighbour is 2y − rint(y). NULL / NaN pass through; a
    zero result is +0.0 as in ``round``. The expression is kept short: it is
    generated once for every double column of a query."""
    y = c * F.lit(float(10 ** digits))
    r = F.rint(y)
    away = F.when(F.abs(y) - F.abs(r) == F.lit(0.5), y + y - r).otherwise(r)
    return away / F.lit(float(10 ** digits)) + F.lit(0.0)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (output normalisation for the oracle)."""
    return df.select(*[round_half_away(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def sql_rounded(cols: list[str], digits: int = 6) -> str:
    """DuckDB ``* REPLACE`` list rounding the given double columns
    (``+ 0.0`` turns a rounded -0.0 into 0.0, as Spark's round does)."""
    return ", ".join(f"{rnd(c, digits)} AS {c}" for c in cols)


def rnd(expr: str, digits: int = 6) -> str:
    """DuckDB rounding matching Spark's (no negative zero)."""
    return f"(round({expr}, {digits}) + 0.0)"


def xsum(expr: str, scale: int) -> str:
    """DuckDB form of ``expr.exact_sum``: an exact DECIMAL sum, as double."""
    return f"CAST(sum(CAST({expr} AS DECIMAL(38,{scale}))) AS DOUBLE)"


def xavg(expr: str, scale: int) -> str:
    """DuckDB form of ``expr.exact_avg``."""
    return f"(CASE WHEN count({expr}) > 0 THEN {xsum(expr, scale)} / count({expr}) END)"


def load_all() -> None:
    """Import the modules that register queries."""
    from shipcast.plans import catalog, queries_features, queries_monitor, queries_ops  # noqa: F401
