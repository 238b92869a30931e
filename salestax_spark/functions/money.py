"""Money arithmetic.

Amounts are doubles at the edges, as in the source data. Totals are summed as whole ten-thousandths
of a unit, so a total does not depend on the order in which tasks deliver their partial sums: a retried
stage or another partition count gives the same bits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIXED_POINT = 10_000


def cents_to_units(cents: Column) -> Column:
    return cents / F.lit(100.0)


def exact_total(amount: Column) -> Column:
    """Aggregate: order-independent sum of a double amount."""
    return F.sum(F.round(amount * FIXED_POINT).cast("long")) / F.lit(float(FIXED_POINT))
