"""Arithmetic in text: numbers, + - * /, unary signs and parentheses, nothing else."""

from __future__ import annotations

import ast
import operator
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_OPS = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv, ast.USub: operator.neg, ast.UAdd: operator.pos}


def value_of(text: str | None) -> float | None:
    """The value, or None where the text is anything else (names, calls, powers, division by zero, nesting beyond what the parser takes)."""

    def walk(n: ast.AST) -> float:
        if isinstance(n, ast.Expression):
            return walk(n.body)
        if isinstance(n, ast.Constant) and type(n.value) in (int, float):
            return n.value
        if isinstance(n, ast.BinOp) and type(n.op) in _OPS:
            return _OPS[type(n.op)](walk(n.left), walk(n.right))
        if isinstance(n, ast.UnaryOp) and type(n.op) in _OPS:
            return _OPS[type(n.op)](walk(n.operand))
        raise ValueError("not arithmetic")

    if text is None:
        return None
    try:
        return float(walk(ast.parse(text.replace(",", "").strip(), mode="eval")))
    except (ValueError, SyntaxError, ZeroDivisionError, OverflowError, RecursionError, MemoryError, TypeError):
        return None


@cache
def _evaluator():
    import pandas as pd

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(value_of).astype("float64")

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, DoubleType())


def evaluate(text: Column) -> Column:
    return _evaluator()(text)
