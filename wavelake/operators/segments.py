"""Windows and segments over time-ordered rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def window_rms(rows: DataFrame, keys: list[str], at: str, value: str, width: float, hop: float) -> DataFrame:
    """Root mean square of each full window of ``width`` that starts a multiple of ``hop`` after the group's first row.

    A row adds its square to the windows it lies in (width / hop of them), so the windows are one aggregate.
    """
    bounds = rows.groupBy(*keys).agg(F.min(at).alias("_lo"), F.max(at).alias("_hi"))
    rows = rows.join(bounds, keys)
    offset = F.col(at) - F.col("_lo")
    last = F.least(F.floor(offset / hop), F.floor((F.col("_hi") - F.col("_lo") - width) / hop))
    first = F.greatest(F.floor((offset - width) / hop) + 1, F.lit(0))
    hits = rows.withColumns({"_first": first, "_last": last}).where("_first <= _last").select(*keys, F.explode(F.sequence("_first", "_last")).alias("window_no"), F.col(value).alias("_v"))
    return hits.groupBy(*keys, "window_no").agg(F.sqrt(F.avg(F.col("_v") * F.col("_v"))).alias("rms"))


def peak(windows: DataFrame, keys: list[str]) -> DataFrame:
    """Largest window value, 0 at least."""
    return windows.groupBy(*keys).agg(F.greatest(F.max("rms"), F.lit(0.0)).alias("peak"))


def sounding(rows: DataFrame, keys: list[str], at: str, loud: Column, gap: float) -> DataFrame:
    """Segments of loud rows; silence of more than ``gap`` parts two of them. (keys, segment, start_at, end_at, hits)"""
    order = Window.partitionBy(*keys).orderBy(at)
    rows = rows.where(loud).withColumn("_new", F.when(F.col(at) - F.lag(at).over(order) <= gap, 0).otherwise(1))
    rows = rows.withColumn("segment", F.sum("_new").over(order))
    return rows.groupBy(*keys, "segment").agg(F.min(at).alias("start_at"), F.max(at).alias("end_at"), F.count(F.lit(1)).alias("hits"))


def relative_threshold(value: Column, peak: Column, decibels: float = -40.0) -> Column:
    """Whether a level is within ``decibels`` of the peak."""
    return value >= peak * 10 ** (decibels / 20)


def spans_to_anchors(spans: Column, supplied: Column) -> Column:
    """Anchors ("+", start, end) from spans, unless some are supplied."""
    return F.when(supplied.isNull(), F.transform(spans, lambda s: F.struct(F.lit("+").alias("token"), s["start_s"].alias("start_s"), s["end_s"].alias("end_s")))).otherwise(supplied)


def clip_frames(frames: Column, rate: float, clips: int = 5, seconds: float = 2.0, per_clip: int = 2) -> Column:
    """Frame numbers to decode for evenly placed clips, clamped to the last frame."""
    length = frames / rate
    step = F.greatest(length - seconds, F.lit(0.0)) / (clips - 1)
    picks = [F.least(F.floor((step * c + seconds * p / per_clip) * rate), frames - 1).cast("long") for c in range(clips) for p in range(per_clip)]
    return F.array(*picks)


def concatenated(*lists: Column | str) -> Column:
    """Lists of spans one after another; null lists are empty, duplicates stay."""
    each = [F.col(x) if isinstance(x, str) else x for x in lists]
    return F.flatten(F.filter(F.array(*each), lambda x: x.isNotNull()))


def clip_spans(duration_s: Column, clips: int, length_s: float) -> Column:
    """Start and end of ``clips`` spans of ``length_s`` seconds at even distances from a medium's start to its end; a shorter medium gives whole spans from 0."""
    free = F.greatest(duration_s - length_s, F.lit(0.0))
    starts = F.transform(F.sequence(F.lit(0), F.lit(clips - 1)), lambda k: free * k / max(1, clips - 1))
    return F.transform(starts, lambda s: F.struct(s.alias("start_s"), (s + length_s).alias("end_s")))


def frame_chunks(frames: Column, size: int = 300) -> Column:
    """First frame and number of frames of each chunk that an encoder takes at once."""
    chunks = F.ceil(frames / size).cast("int")
    each = F.transform(F.sequence(F.lit(0), F.greatest(chunks - 1, F.lit(0))), lambda k: F.struct((k * size).alias("first"), F.least(F.lit(size), frames - k * size).cast("int").alias("frames")))
    return F.when(frames > 0, each).otherwise(F.filter(each, lambda x: F.lit(False)))
