"""Exact sums of money, tax and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
TAX_FACTOR = 1.18
TAX_EXEMPT_TYPES = (0, 3, 4, 5)


def minor(c: Column, scale: int = 2) -> Column:
    """Amount in hundredths (or ``10**-scale``) as a whole number.

    Whole numbers add up to the same total in any order, so results do not
    depend on how rows are spread over tasks.
    """
    return F.floor(c * (10**scale) + 0.5)


def exact_sum(whole: Column) -> Column:
    """Sum of whole numbers that cannot overflow 64 bits."""
    return F.sum(whole.cast("decimal(18,0)"))


def major(total: Column, scale: int = 2) -> Column:
    return total.cast("double") / F.lit(float(10**scale))


def is_exempt(tax_type: Column, exempt: tuple[int, ...] = TAX_EXEMPT_TYPES) -> Column:
    return tax_type.isin(list(exempt))


def net_of_tax(gross: Column, tax_type: Column, factor: float = TAX_FACTOR, exempt=TAX_EXEMPT_TYPES) -> Column:
    return F.when(is_exempt(tax_type, exempt), gross).otherwise(gross / F.lit(factor))


def net_from_parts(exempt_total: Column, taxed_total: Column, factor: float = TAX_FACTOR) -> Column:
    """Net amount from the two exact totals: one division per group, not per row."""
    return exempt_total + taxed_total / F.lit(factor)


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient as double; null when the divisor is zero or null."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))
