"""Tax-substitution formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def adjusted_mva(
    flag: Column,
    mva: Column,
    internal_rate: Column,
    interstate_rate: Column,
    issuer_state: Column,
    recipient_state: Column,
    home_state: str = "RO",
) -> Column:
    """((1+mva)(1-interstate)/(1-internal))-1 for flag ``S`` on sales into the home state.

    Rates and margin are percentages, the result is a fraction.  Flag ``N`` and
    every other case give null.
    """
    fraction = lambda c: c.cast("double") / 100.0
    formula = (
        F.try_divide(
            (1.0 + fraction(mva)) * (1.0 - fraction(interstate_rate)), 1.0 - fraction(internal_rate)
        )
        - 1.0
    )
    applies = (
        (F.trim(flag.cast("string")) == "S")
        & (F.trim(issuer_state.cast("string")) != home_state)
        & (F.trim(recipient_state.cast("string")) == home_state)
    )
    return F.when(applies, formula)


def st_base(
    product: Column,
    freight: Column,
    insurance: Column,
    other: Column,
    discount: Column,
    ipi: Column,
    mva: Column,
    adjusted: Column,
) -> Column:
    """Tax-substitution base: net value plus IPI, raised by the margin."""
    amount = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    margin = F.coalesce(adjusted.cast("double"), amount(mva) / 100.0)
    net = (
        amount(product) + amount(freight) + amount(insurance) + amount(other) - amount(discount) + amount(ipi)
    )
    return net * (1.0 + margin)
