"""Display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# The report's currency label is "R$ " + thousands separator "," + 2 decimals.
CURRENCY_SYMBOL = "R$ "
CURRENCY_DIGITS = 2


def currency_label(c, symbol: str = CURRENCY_SYMBOL, digits: int = CURRENCY_DIGITS) -> Column:
    """``R$ 1,234.57``: thousands separator, fixed decimals."""
    col = c if isinstance(c, Column) else F.col(c)
    return F.concat(F.lit(symbol), F.format_number(col, digits))
