"""Cutting rows into ordered ranges by literal bounds.

The bounds come from a bounded sample and are literals of the plan, so every
branch of a query, and every retry of a task, sees the same ranges.  They set
how evenly rows spread, never a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sampled rows per range that the driver sees.
PER_RANGE = 50


def range_of(df: DataFrame, order: list[Column], ranges: int) -> Column:
    """Number of the range, from 0, that a row is in by ``order`` ascending
    (nulls first).  Rows equal in all of ``order`` share a range."""
    named = [c.alias(f"k{i}") for i, c in enumerate(order)]
    keys = df.select(*named)
    n = keys.count()
    if ranges < 2 or n <= ranges:
        return F.lit(0)
    share = min(1.0, ranges * PER_RANGE / n)
    seen = sorted(keys.sample(share, 42).limit(4 * ranges * PER_RANGE).collect(), key=lambda r: [(x is not None, x) for x in r])
    cuts = [seen[len(seen) * i // ranges] for i in range(1, ranges)] if seen else []
    kinds = dict(keys.dtypes)
    bounds = [F.struct(*(F.lit(v).cast(kinds[c]).alias(c) for c, v in r.asDict().items())) for r in dict.fromkeys(cuts)]
    if not bounds:
        return F.lit(0)
    here = F.struct(*named)
    return F.size(F.filter(F.array(*bounds), lambda b: b <= here))
