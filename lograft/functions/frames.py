"""Small DataFrame helpers shared by operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a lambda binding).

    Inside generator and lambda expressions Spark does not eliminate common
    subexpressions, so an expression referenced three times is computed
    three times; binding it through a one-element ``transform`` avoids that.
    """
    return F.get(F.transform(F.array(value), body), 0)


def with_computed(df: DataFrame, cols: dict[str, Column], drop: list[str] | None = None) -> DataFrame:
    """Add ``cols`` evaluated exactly once per row.

    The values are emitted by a one-element ``inline`` generator.  A filter
    on them then stays above the generator; after a plain projection Catalyst
    would push the filter below it and re-evaluate the (costly) expressions
    once inside the filter and again in the projection.
    """
    keep = [F.col(c) for c in df.columns if c not in set(drop or [])]
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))
