"""Small statistics over bounded arrays (D sketch rows, R runs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _trunc_half(s: Column) -> Column:
    """s div 2, truncated toward zero, exact for every BIGINT."""
    return F.when(s >= 0, F.shiftright(s, 1)).otherwise(-F.shiftright(-s, 1))


def _trunc_half_wide(s: Column) -> Column:
    """s div 2 toward zero for DECIMAL(38,0) values (floor/ceil are exact)."""
    half = s / F.lit(2)
    return F.when(s >= 0, F.floor(half)).otherwise(F.ceil(half)).cast(WIDE)


# Exact integers past BIGINT (squares of large counts): 38 decimal digits.
WIDE = "decimal(38,0)"


def int_median(values, wide: bool = False) -> Column:
    """Median of an integer array; an even count gives the integer mean of
    the middle two, truncated toward zero.  NULL for an empty array.

    ``wide=True`` for DECIMAL(38,0) arrays (sums of squares), else BIGINT.
    Meant for arrays whose size is a parameter (D rows, R runs), built with
    ``collect_list`` inside a group of that size.
    """
    arr = F.col(values) if isinstance(values, str) else values
    s = F.sort_array(arr)
    n = F.size(s)
    half = F.shiftright(n, 1)
    upper = F.element_at(s, half + 1)
    lower = F.element_at(s, F.greatest(half, F.lit(1)))
    kind = WIDE if wide else "bigint"
    mean = (_trunc_half_wide(lower.cast(WIDE) + upper.cast(WIDE)) if wide
            else _trunc_half(lower.cast("bigint") + upper.cast("bigint")))
    return (F.when(n == 0, F.lit(None).cast(kind))
            .when(n % 2 == 1, upper.cast(kind))
            .otherwise(mean))
