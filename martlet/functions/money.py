"""Exact decimal measures of a fact line.

Money stays decimal end to end; every measure is rounded HALF_UP to cents
when it is cast to its column type.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Flat rates of the sales fact.
TAX_RATE = Decimal("0.10")
TOTAL_RATE = Decimal("1.10")
COST_RATE = Decimal("0.60")
PROFIT_RATE = Decimal("0.40")

LINE_MONEY = "decimal(12,2)"
UNIT_MONEY = "decimal(10,2)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def gross(quantity: Column | str, unit_price: Column | str) -> Column:
    """quantity x unit price, in full precision (not yet cast)."""
    return _c(quantity).cast("decimal(10,0)") * _c(unit_price)


def at_rate(amount: Column | str, rate: Decimal) -> Column:
    return (_c(amount) * F.lit(rate)).cast(LINE_MONEY)


def line_measures(quantity: str = "quantity", unit_price: str = "unit_price") -> dict[str, Column]:
    """The seven derived measures of a line, keyed by output column."""
    g = gross(quantity, unit_price).cast(LINE_MONEY)
    return {
        "gross_amount": g,
        "net_amount": g,
        "tax_amount": at_rate(g, TAX_RATE),
        "total_amount": at_rate(g, TOTAL_RATE),
        "cost_amount": at_rate(g, COST_RATE),
        "profit_amount": at_rate(g, PROFIT_RATE),
    }


def cents(amount: Column | str) -> Column:
    """Exact integer cents of a 2-decimal amount."""
    return (_c(amount) * 100).cast("long")


def mean_from_cents(sum_cents: str, n: str) -> Column:
    """Mean of ``n`` amounts whose cents add up to ``sum_cents`` (both column
    names), rounded half up to cents, as decimal(10,2). Integer division
    only, so there is no double rounding through an intermediate scale."""
    half_up = F.expr(f"(`{sum_cents}` * 2 + `{n}`) div (`{n}` * 2)")
    return (half_up.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast(UNIT_MONEY)
