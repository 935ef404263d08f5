"""Rounding of binary fractions."""

from pyspark.sql import Column, functions as F

# Splits a double into two halves whose products with small integers are exact.
SPLIT = float(2**27 + 1)


def round_exact(x: Column, digits: int) -> Column:
    """Round by the exact binary value, true ties to even, so 0.00015 (stored slightly
    below) becomes 0.0001. SQL round goes by the printed decimals instead.

    `x` should be a plain column: it is used several times.
    """
    scale = float(10**digits)
    high = x * SPLIT - (x * SPLIT - x)
    floor = F.floor(x * scale).cast("double")
    # Exact distance of x * scale from the midpoint above its floor.
    past = (high * scale - (floor + 0.5)) + (x - high) * scale
    up = (past > 0) | ((past == 0) & (F.pmod(floor, F.lit(2.0)) == 1.0))
    return (floor + F.when(up, 1.0).otherwise(0.0)) / scale
