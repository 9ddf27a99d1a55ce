"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def space_tokens(text) -> Column:
    """Tokens of a line split on single spaces, as Java ``split(" ")`` does.

    Leading and inner empty tokens are kept, trailing ones dropped; an empty
    line gives ``[""]`` and an all-blank line gives ``[]``.  ``rtrim``
    strips spaces only, so tabs stay inside tokens.
    """
    t = _c(text)
    return (F.when(t == "", F.array(F.lit("")))
            .when(F.rtrim(t) == "", F.array().cast("array<string>"))
            .otherwise(F.split(F.rtrim(t), " ")))


def lines_of(text) -> Column:
    """The lines of a text: split on newline, trailing empty line kept."""
    return F.split(_c(text), "\n")
