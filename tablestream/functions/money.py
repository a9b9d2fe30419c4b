"""Exact money: decimal inside, double at the edges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(amount: Column | str) -> Column:
    c = F.col(amount) if isinstance(amount, str) else amount
    return c.cast(MONEY)


#: Doubles below this hold whole cents exactly.
MOST = 9e13


def is_countable(amount: Column | str) -> Column:
    """Whether an amount can be summed to the cent; false for NaN and infinity."""
    c = F.col(amount) if isinstance(amount, str) else amount
    return F.abs(c) < F.lit(MOST)


def exact_sum(amount: Column | str) -> Column:
    """A sum to the cent that does not depend on the order in which tasks finish.

    Whole cents in a long stay in generated code at the cost of a double sum; a
    decimal sum takes about three times as long. An amount that cannot be
    counted in cents, or a sum beyond a long, is an error and never a wrong sum.
    """
    c = F.col(amount) if isinstance(amount, str) else amount
    cents = F.when(is_countable(c), F.rint(c * 100).cast("long")).when(
        c.isNotNull(), F.raise_error(F.lit("amount cannot be counted in cents"))
    )
    total = F.try_sum(cents)
    beyond = total.isNull() & (F.count(cents) > 0)
    checked = F.when(beyond, F.raise_error(F.lit("sum of money out of range"))).otherwise(total)
    return (checked.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(28,2)")


def discounted(base: Column | str, discount: Column | str) -> Column:
    """Unrounded price after discount, exact to six decimals."""
    d = F.col(discount) if isinstance(discount, str) else discount
    return money(base) * (F.lit(1).cast("decimal(5,4)") - d.cast("decimal(5,4)"))


def unit_price(base: Column | str, discount: Column | str) -> Column:
    return F.round(discounted(base, discount), 2)


def line_total(unit: Column | str, quantity: Column | str) -> Column:
    q = F.col(quantity) if isinstance(quantity, str) else quantity
    return F.round(money(unit) * q.cast("decimal(10,0)"), 2)
