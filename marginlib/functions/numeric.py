"""Exact decimal arithmetic for money.

Rules (each one fixes a real mismatch seen against an exact oracle):

* Money never goes through DOUBLE.  JSON numbers are parsed to DECIMAL.
* Spark sizes a decimal result from its operand types and, past 38 digits,
  silently drops scale.  So operands are narrowed to explicit types before
  ``/``, ``*`` and long ``+``/``-`` chains, and every intermediate has a
  declared type.  All casts round HALF_UP, like ``round``.
* Divisors are guarded (ANSI mode fails on ``/ 0``).
* Published values are ``round(x, 2)`` as DECIMAL(18,2) and ratios
  ``round(x, 4)`` as DECIMAL(18,4).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Parsed JSON numerics (unconstrained ``numeric`` at the source).
NUM = DecimalType(18, 4)
# qty * unit cost and similar products of two NUM values.
PRODUCT = DecimalType(22, 8)
# Revenue share of a line within its order, and amounts allocated with it.
RATIO = DecimalType(24, 12)
ALLOC = DecimalType(26, 12)
# Sum of line revenue within one order.
ORDER_SUM = DecimalType(22, 4)
# Published money / ratio columns.
MONEY_OUT = DecimalType(18, 2)
PCT_OUT = DecimalType(18, 4)
# Quantities summed over a group.
QTY_SUM = DecimalType(28, 4)


def dec(p: int, s: int) -> DecimalType:
    return DecimalType(p, s)


def zero(t: DecimalType = NUM) -> Column:
    return F.lit(0).cast(t)


def qdiv(a: Column, b: Column, in_type: DecimalType = DecimalType(16, 4),
         out_type: DecimalType = RATIO) -> Column:
    """``a / b`` with both sides narrowed to ``in_type``; NULL when b is 0/NULL.

    With DECIMAL(16,s) operands the quotient keeps 21 fractional digits,
    so the final cast to ``out_type`` is a single HALF_UP rounding of the
    true quotient for any realistic data.
    """
    bb = b.cast(in_type)
    return F.when(bb != 0, (a.cast(in_type) / bb).cast(out_type))


def round_money(x: Column) -> Column:
    return F.round(x, 2).cast(MONEY_OUT)


def round_pct(x: Column) -> Column:
    return F.round(x, 4).cast(PCT_OUT)
