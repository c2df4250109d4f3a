"""Fixed-point rounding that agrees with Python's ``round`` and ``'%.nf'``.

Both work on the exact binary value of a double and send exact ties to the even
digit. Spark's ``round`` and ``bround`` start from the shortest decimal text of
the double instead, which differs near ties.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, as_column

# Veltkamp's constant 2**27 + 1 splits a double into two halves of 26 bits.
_SPLIT = 134217729.0


# From here on a double has no more than one decimal to round, and products overflow.
_LARGEST = float(2**52)


def _scaled(c: Column, digits: int) -> Column:
    """``|c| * 10**digits`` rounded to a whole BIGINT, for ``c`` within the range."""
    c = F.abs(c)
    scale = F.lit(float(10**digits))
    product = c * scale
    carried = c * F.lit(_SPLIT)
    high = carried - (carried - c)
    # What the multiplication rounded away, exactly (Dekker's product).
    lost = (high * scale - product) + (c - high) * scale
    whole = F.floor(product)
    from_tie = (product - whole) - F.lit(0.5)
    up = (
        (from_tie > 0)
        | ((from_tie == 0) & (lost > 0))
        | ((from_tie == 0) & (lost == 0) & (whole % 2 == 1))
    )
    return whole + F.when(up, F.lit(1)).otherwise(F.lit(0))


def _in_range(c: Column, digits: int, value: Column) -> Column:
    """``value``, or an error where ``c`` is too large to be scaled (or is no number)."""
    limit = _LARGEST / 10**digits
    error = F.raise_error(F.format_string(f"%s is not within {limit:g} of zero", c.cast("string")))
    return F.when(c.isNull() | (F.abs(c) <= F.lit(limit)), value).otherwise(error.cast("double"))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def round_exact(c: ColumnOrName, digits: int) -> Column:
    """DOUBLE rounded to ``digits`` decimals.

    Values beyond 2**52 / 10**digits, infinities and NaN fail the query.
    """

    def rounded(c: Column) -> Column:
        size = _scaled(c, digits).cast("double") / F.lit(float(10**digits))
        return _in_range(c, digits, F.when(c < 0, -size).otherwise(size))

    return _bound(as_column(c), rounded)


def fixed_text(c: ColumnOrName, digits: int) -> Column:
    """STRING with exactly ``digits`` decimals; as in Python, -0.004 at two is '-0.00'.

    Values beyond 2**52 / 10**digits, infinities and NaN fail the query.
    """
    scale = 10**digits

    def shown(c: Column) -> Column:
        def joined(scaled: Column) -> Column:
            return F.concat(
                F.when(c < 0, F.lit("-")).otherwise(F.lit("")),
                ((scaled - scaled % scale) / scale).cast("bigint").cast("string"),
                F.lit("."),
                F.lpad((scaled % scale).cast("string"), digits, "0"),
            )

        return _bound(_scaled(c, digits), joined)

    c = as_column(c)
    # The checked value, so that what follows only meets numbers in range.
    return _bound(_in_range(c, digits, c), shown)
