"""Array expressions for model outputs: softmax, argmax, fixed-length
encodings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def softmax(c) -> Column:
    """H2: exp(x - max) / sum, on an array column (max bound once)."""
    arr = _as_col(c)

    def body(x):
        m = F.array_max(x)
        e = F.transform(x, lambda v: F.exp(v - m))
        s = F.aggregate(e, F.lit(0.0), lambda a, v: a + v)
        return F.transform(e, lambda v: v / s)

    return F.element_at(F.transform(F.array(arr), body), 1)


def argmax(c) -> Column:
    """H3: 0-based position of the first maximum."""
    arr = _as_col(c)
    return F.element_at(F.transform(F.array(arr), lambda x: F.array_position(x, F.array_max(x)) - 1), 1).cast("int")


def dot(a, b) -> Column:
    """Inner product of two numeric arrays of equal length."""
    return F.aggregate(F.zip_with(_as_col(a), _as_col(b), lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)
