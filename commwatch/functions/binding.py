"""Helpers to compose column expressions."""

from pyspark.sql import functions as F


def bind(value, body):
    """``body(value)`` with ``value`` computed once per row.

    A plain Python variable holding a Column would repeat the expression at each use, and inside a
    lambda once per array element, which makes linear work quadratic. Passing it as the argument
    of a one-element ``transform`` hands the computed value to ``body`` instead.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_list(values):
    """SQL text literals, comma-separated.

    Long word lists go to the parser as text: a Column per word would cost a gateway call each.
    """
    escaped = (v.replace("\\", "\\\\").replace("'", "\\'") for v in values)
    return ", ".join(f"'{v}'" for v in escaped)
