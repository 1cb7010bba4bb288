"""Library functions under SQL names, and any Python function as a vectorised column function."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .arithmetic import _evaluator

# --- fixed values -----------------------------------------------------------
#: Name, arguments, result, expression: functions that SQL itself can say.
SQL_FUNCTIONS = (
    ("fl_local_name", "concept STRING", "STRING", "element_at(split(concept, ':'), -1)"),
    ("fl_ten_digit_cik", "cik STRING", "STRING", "lpad(trim(cik), 10, '0')"),
    ("fl_usd_safe", "currency STRING", "BOOLEAN", "coalesce(currency = 'USD', false)"),
    ("fl_period_end", "period STRING", "DATE", "try_cast(substring(element_at(split(period, ' to '), -1), 1, 10) AS DATE)"),
)


def register(spark: SparkSession) -> list[str]:
    """Make the functions callable from this session's SQL; their names."""
    for name, arguments, result, expression in SQL_FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {expression}")
    spark.udf.register("fl_arithmetic", _evaluator())
    return [f[0] for f in SQL_FUNCTIONS] + ["fl_arithmetic"]


def wrapped(f: Callable, result: str) -> Callable[..., Column]:
    """A function of plain values as a column function; it runs on Arrow batches, and a value that it fails on is NULL."""

    def one(*values):
        try:
            return f(*values)
        except Exception:  # noqa: BLE001 - any failure of a foreign function is a missing value
            return None

    def call(*columns: Column) -> Column:
        import pandas as pd

        def run(*series: pd.Series) -> pd.Series:
            return pd.Series([one(*v) for v in zip(*series, strict=True)], dtype=object)

        run.__annotations__ = {"series": pd.Series, "return": pd.Series}
        return F.pandas_udf(run, result)(*columns)

    return call
