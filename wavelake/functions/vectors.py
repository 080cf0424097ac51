"""Array arithmetic as column expressions; vectors are arrays of doubles."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .numbers import let


def doubles(x: Column) -> Column:
    return x.cast("array<double>")


def total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda s, v: s + v)


def dot(x: Column, y: Column) -> Column:
    return total(F.zip_with(x, y, lambda a, b: a * b))


def norm(x: Column) -> Column:
    return F.sqrt(dot(x, x))


def normalised(x: Column) -> Column:
    """Unit vector; a zero vector gives NaN, as it has no direction."""
    length = norm(x)
    return F.transform(x, lambda v: F.when(length == 0, F.lit(float("nan"))).otherwise(v / F.nullif(length, F.lit(0.0))))


def cosine(x: Column, y: Column) -> Column:
    return dot(normalised(x), normalised(y))


def downmix(left: Column, right: Column) -> Column:
    """Mean of two channels; the shorter one counts as silent past its end."""
    return F.zip_with(left, right, lambda a, b: (F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0))) / 2)


def rms_norm(x: Column, eps: float = 1e-5) -> Column:
    scale = F.sqrt(dot(x, x) / F.size(x) + eps)
    return F.transform(x, lambda v: v / scale)


def layer_norm(x: Column, eps: float = 1e-5) -> Column:
    return let(x, lambda x: let(total(x) / F.size(x), lambda mean: let(F.sqrt(total(F.transform(x, lambda v: (v - mean) * (v - mean))) / F.size(x) + eps), lambda spread: F.transform(x, lambda v: (v - mean) / spread))))


def projected(x: Column, weight: list[list[float]]) -> Column:
    """Product with a matrix, by its rows: a convolution of width one at one place."""
    rows = F.array(*[F.array(*map(F.lit, row)) for row in weight])
    return F.transform(rows, lambda row: dot(row, x))


def fused(anchor: Column, other: Column, weight: list[list[float]], gate: Column) -> Column:
    """``anchor`` plus the other modality: projected, normalised, and let through by the tangent of the gate."""
    return F.zip_with(anchor, layer_norm(projected(other, weight)), lambda a, y: a + F.tanh(gate) * y)


def modulated(x: Column, scale: Column, shift: Column) -> Column:
    return F.transform(x, lambda v: v * (1 + scale) + shift)


def gated(x: Column, gate: Column) -> Column:
    return F.transform(x, lambda v: v * gate)


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def approximate_gelu(x: Column) -> Column:
    return 0.5 * x * (1 + F.tanh(F.lit(math.sqrt(2 / math.pi)) * (x + 0.044715 * x * x * x)))


def erf(x: np.ndarray) -> np.ndarray:
    """The error function of whole arrays, to the last digits: a series of positive terms; 1 beyond 6."""
    z = np.minimum(np.abs(x), 6.0)
    term = total = z * np.exp(-z * z) * (2 / math.sqrt(math.pi))
    for n in range(1, 130):
        term = term * (2 * z * z) / (2 * n + 1)
        total = total + term
    return np.copysign(np.minimum(total, 1.0), x)


@F.pandas_udf(DoubleType())
def gelu(x: pd.Series) -> pd.Series:
    """Exact; Spark has no erf."""
    v = x.to_numpy(float)
    return pd.Series(0.5 * v * (1 + erf(v / math.sqrt(2))), x.index)


ACTIVATIONS = {
    "relu": lambda x: F.greatest(x, F.lit(0.0)),
    "gelu": gelu,
    "approx_gelu": approximate_gelu,
    "srelu": lambda x: F.pow(F.greatest(x, F.lit(0.0)), F.lit(2)),
    "silu": lambda x: x * sigmoid(x),
}


def feed_forward_width(width: Column, gated_unit: bool, multiple: int) -> Column:
    """Hidden width: two thirds for a gated unit, rounded up to a multiple."""
    hidden = F.floor(2 * width / 3) if gated_unit else width
    return (F.ceil(hidden / multiple) * multiple).cast("long")


def timestep_embedding(t: Column, width: int, period: float = 10000.0) -> Column:
    """Cosines, then sines, of t at geometrically spaced rates."""
    rates = [math.exp(-math.log(period) * k / (width // 2)) for k in range(width // 2)]
    return F.array(*[F.cos(t * r) for r in rates], *[F.sin(t * r) for r in rates])


def rotated(x: Column, position: Column, theta: float = 10000.0, stretch: float = 1.0, low: float = 1.0, high: float = 32.0, span: float = 8192.0) -> Column:
    """Rotary position: neighbours (x0, x1), (x2, x3), ... turn by position times their rate.

    With ``stretch`` over 1, rates that turn less than ``low`` times in ``span`` positions are slowed by it, those that turn more than ``high``
    times are not, and those between are mixed in proportion.
    """
    def turned(i: Column) -> Column:
        pair = F.floor(i / 2).cast("int")
        rate = F.exp(-2.0 * pair / F.size(x) * math.log(theta))
        if stretch != 1.0:
            keep = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (span / (2 * math.pi) * rate - low) / (high - low)))
            rate = rate * (keep + (1 - keep) / stretch)
        angle = position * rate
        even, odd = F.get(x, pair * 2), F.get(x, pair * 2 + 1)
        return F.when(i % 2 == 0, even * F.cos(angle) - odd * F.sin(angle)).otherwise(even * F.sin(angle) + odd * F.cos(angle))

    return F.transform(F.sequence(F.lit(0), F.size(x) - 1), turned)


def masked_product(x: Column, mask: Column) -> Column:
    """Values where the mask is 0, else 0."""
    return F.zip_with(x, mask, lambda v, m: F.when(m == 0, v).otherwise(v * 0))


def quantised(x: Column) -> Column:
    """Round trip through 16-bit integers: clipped to [-1, 1], cut off toward zero."""
    return F.transform(x, lambda v: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), v)).cast("double") * 32767).cast("array<int>")


def dequantised(x: Column) -> Column:
    return F.transform(x, lambda v: v / 32767.0)


def repeat_padded(x: Column, length: int) -> Column:
    """Whole repeats, then zeros, up to ``length``; longer arrays are cut."""
    times = F.greatest(F.lit(1), F.floor(F.lit(length) / F.size(x)).cast("int"))
    repeated = F.flatten(F.array_repeat(x, times))
    return F.slice(F.concat(repeated, F.array_repeat(F.lit(0.0), F.greatest(F.lit(length) - F.size(repeated), F.lit(0)))), 1, length)


def split_blocks(x: Column, *sizes: int) -> list[Column]:
    """Consecutive slices of an array."""
    return [F.slice(x, 1 + sum(sizes[:k]), n) for k, n in enumerate(sizes)]


def live_blocks(x: Column, *sizes: int) -> Column:
    """Concatenation of the blocks that are not all zero."""
    return F.concat(*[F.when(F.exists(b, lambda v: v != 0), b).otherwise(F.array().cast("array<double>")) for b in split_blocks(x, *sizes)])
