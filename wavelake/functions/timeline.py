"""Sample and frame arithmetic as column expressions. A frame has ``hop`` samples."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOP, RATE = 1920, 48000


def sample_to_frame(samples: Column, hop: int = HOP) -> Column:
    """Frames that cover this many samples."""
    return F.ceil(samples / hop).cast("long")


def frame_to_sample(frames: Column, hop: int = HOP) -> Column:
    return (frames * hop).cast("long")


def frame_to_sample_at(frames: Column, rate: int, to_rate: int, hop: int = HOP) -> Column:
    """Samples at another rate, cut off toward zero."""
    return (frames.cast("double") * hop * to_rate / rate).cast("long")


def sample_to_frame_at(samples: Column, rate: int, to_rate: int, hop: int = HOP) -> Column:
    """Frames after resampling; both steps round up."""
    return F.ceil(F.ceil(samples.cast("double") * to_rate / rate) / hop).cast("long")


def reflect_padded(x: Column, pad: Column) -> Column:
    """Array with ``pad`` more items that mirror those before the last one. A shorter array is first extended with zeros to ``pad + 1``."""
    short = F.greatest(pad + 1 - F.size(x), F.lit(0))
    wide = F.concat(x, F.array_repeat(F.lit(0).cast("double"), short))
    mirrored = F.reverse(F.slice(wide, F.size(wide) - pad, pad))
    return F.when(pad > 0, F.slice(F.concat(wide, mirrored), F.lit(1), F.size(x) + pad)).otherwise(x)


def conv_padding(length: Column, kernel: int, stride: int, total: int) -> Column:
    """Padding on the right that lets a strided convolution use each item."""
    frames = (length - kernel + total).cast("double") / stride + 1
    return ((F.ceil(frames) - 1) * stride + (kernel - total) - length).cast("long")


def resampled_index(i: Column, n: Column, m: Column) -> Column:
    """Place of the i-th of m evenly spaced picks from n items, rounded half to even."""
    return F.when(m <= 1, F.lit(0)).otherwise(F.rint(i * (n - 1) / F.nullif(m - 1, F.lit(0)).cast("double"))).cast("long")


def padded_ms(seconds: Column, width: int = 8) -> Column:
    """Whole milliseconds with leading zeros; longer numbers stay whole."""
    text = (seconds * 1000).cast("long").cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def whole_seconds(seconds: Column) -> Column:
    """Seconds cut off toward zero."""
    return seconds.cast("long")


def run_seed(seed: int, index: Column, stage: int = 0, per_run: int = 1) -> Column:
    return (F.lit(seed) + index * per_run + stage).cast("long")


def seconds(ms: Column) -> Column:
    return ms / 1000.0


def gibibytes(n: Column) -> Column:
    return n.cast("double") / float(1 << 30)


def pad_mask(size: Column, longest: Column) -> Column:
    """Array of ``longest`` flags, true below ``size``."""
    return F.when(longest > 0, F.transform(F.sequence(F.lit(0).cast("long"), longest.cast("long") - 1), lambda i: i < size)).otherwise(F.array().cast("array<boolean>"))
