"""Rounding to decimal places, and search in sorted arrays, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Splits a double into two halves of 26 bits, whose products are exact.
SPLIT = float((1 << 27) + 1)


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it appears there."""
    return F.element_at(F.transform(F.array(value), use), 1)


def rounded(x: Column, digits: int) -> Column:
    """Rounding of the exact binary value, half to even, so 2.675 to two places is 2.67. Large and non-finite values stay as they are.

    x times a power of ten is taken as a rounded product and its exact error; both decide on which side of a half the value lies.
    """
    power = float(10**digits)

    def scaled(v: Column) -> Column:
        wide = v * SPLIT
        high = wide - (wide - v)
        product = v * power
        error = (high * power - product) + (v - high) * power
        return F.struct(v.alias("v"), product.alias("product"), error.alias("error"), F.rint(product - 0.25).alias("near"))

    def settled(p: Column) -> Column:
        # of the whole numbers around the product, the last not above it, and how far the exact value is past the half after it
        floor = F.when(p["near"] > p["product"], p["near"] - 1).when(p["near"] + 1 <= p["product"], p["near"] + 1).otherwise(p["near"])
        past = (p["product"] - floor - 0.5) + p["error"]
        whole = floor + F.when((past > 0) | ((past == 0) & (F.pmod(floor, F.lit(2.0)) == 1)), 1.0).otherwise(0.0)
        return F.when((F.abs(p["product"]) < float(1 << 52)) & ~F.isnan(p["v"]), whole / power).otherwise(p["v"])

    return let(x.cast("double"), lambda v: let(scaled(v), settled))


def place(sorted_bounds: Column, x: Column, most: int) -> Column:
    """How many of the sorted bounds (``most`` at most) are not above x, by binary search."""
    steps = [1 << k for k in reversed(range(max(1, most).bit_length()))]

    def step(have: Column, size: Column) -> Column:
        return F.when(F.get(sorted_bounds, have + size - 1) <= x, have + size).otherwise(have)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)
