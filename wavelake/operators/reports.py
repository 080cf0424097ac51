"""Run summaries: counts, means, floor-rank percentiles, shares and throughput."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import rounded

#: Of the quantile sketches: a value's rank is off by one in so many at most.
ACCURACY = 10_000


def mean(x: Column) -> Column:
    """Mean without nulls and NaN."""
    return F.avg(F.nanvl(x, F.lit(None).cast("double")))


def mean_of_rows(x: Column) -> Column:
    """Sum without NaN over the number of all rows, as partial sums and counts give it."""
    return F.sum(F.nanvl(x, F.lit(None).cast("double"))) / F.count(F.lit(1))


def ranked(rows: DataFrame, keys: list[str], value: str, places: dict[str, tuple[float, Callable[[Column], Column]]]) -> DataFrame:
    """For each group its sorted values at given places, without interpolation: by name, the place's share of the group and its rank as a
    function of the group's size. Nulls and NaN don't count.

    A quantile sketch of each group gives two values that the place lies between; its error is bounded, and small groups are taken whole. Then
    values below them are counted, and only those between are counted one by one: 6 in ACCURACY of a group, wherever outliers lie.
    """
    v = F.col(value).cast("double")
    rows = rows.where(v.isNotNull() & ~F.isnan(v)).select(F.struct(*keys, F.lit(0)).alias("_k"), F.col(value).alias("_v"))
    v, margin = F.col("_v").cast("double"), 3 / ACCURACY
    cuts = sorted({min(1.0, max(0.0, share + side)) for share, _ in places.values() for side in (-margin, margin)})
    sketch = rows.groupBy("_k").agg(F.percentile_approx(v, cuts, ACCURACY).alias("_cuts"), F.min(v).alias("_lo"), F.max(v).alias("_hi"), F.count(F.lit(1)).alias("_n"))

    def bound(share: float, edge: Column) -> Column:
        inside = 0.0 < share < 1.0
        return F.when((F.col("_n") > 4 * ACCURACY) & F.lit(inside), F.get("_cuts", F.lit(cuts.index(min(1.0, max(0.0, share)))))).otherwise(edge)

    each = [
        F.struct(F.lit(name).alias("name"), bound(share - margin, F.col("_lo")).alias("lo"), bound(share + margin, F.col("_hi")).alias("hi"), rank(F.col("_n")).cast("long").alias("at"))
        for name, (share, rank) in places.items()
    ]
    wanted = sketch.select("_k", F.array(*each).alias("_w"))
    near = rows.join(wanted, "_k").select("_k", "_v", F.explode("_w").alias("_w")).where(v <= F.col("_w.hi"))
    near = near.select("_k", F.col("_w.name").alias("_name"), F.col("_w.at").alias("_at"), F.when(v >= F.col("_w.lo"), F.col("_v")).alias("_v"))
    values = near.groupBy("_k", "_name", "_at", "_v").agg(F.count(F.lit(1)).alias("_c"))
    upto = F.sum("_c").over(Window.partitionBy("_k", "_name").orderBy(F.asc_nulls_first("_v")))  # those below come first, as one null
    found = values.withColumn("_upto", upto).where((F.col("_upto") > F.col("_at")) & (F.col("_upto") - F.col("_c") <= F.col("_at")))
    return found.groupBy("_k").agg(*[F.max(F.when(F.col("_name") == name, F.col("_v"))).alias(name) for name in places]).select(*[F.col("_k")[k].alias(k) for k in keys], *places)


def floor_rank(rows: DataFrame, keys: list[str], value: str, share: float = 0.95, name: str = "p95") -> DataFrame:
    """For each group the sorted value at place floor(share * (n - 1))."""
    return ranked(rows, keys, value, {name: (share, lambda n: F.floor(F.lit(share) * (n - 1)))})


def summary(rows: DataFrame, keys: list[str], value: str, more: dict[str, Column] | None = None) -> DataFrame:
    """Count, mean, median, p95 and max of a value for each group, and further aggregates."""
    v = F.col(value)
    sums = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("runs"), F.avg(v).alias("mean"), F.max(v).alias("longest"), *[c.alias(n) for n, c in (more or {}).items()])
    tops = ranked(rows, keys, value, {"_low": (0.5, lambda n: F.floor((n - 1) / 2)), "_high": (0.5, lambda n: F.ceil((n - 1) / 2)), "p95": (0.95, lambda n: F.floor(F.lit(0.95) * (n - 1)))})
    joined = sums.join(tops, keys, "left") if keys else sums.join(tops, F.lit(True), "left")  # one row each without keys
    return joined.withColumn("median", (F.col("_low") + F.col("_high")) / 2).drop("_low", "_high")


def finished(rows: DataFrame, status: Column, phase: Column | None = None) -> DataFrame:
    """Rows of status ok (and phase benchmark)."""
    return rows.where((status == "ok") & (F.lit(True) if phase is None else phase == "benchmark"))


def per_second(count: Column, ms: Column) -> Column:
    """Null when no time passed."""
    return F.try_divide(count.cast("double"), ms / 1000.0)


def key_mean(map_column: Column, key: str) -> Column:
    """Mean over a map's key; rows without it don't count."""
    return F.avg(F.try_element_at(map_column, F.lit(key)))


def accumulated(left: Column, right: Column, digits: int = 3) -> Column:
    """Key-wise sums of two maps, rounded."""
    return F.map_zip_with(left, right, lambda k, a, b: rounded(F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0)), digits))


def shares(rows: DataFrame, keys: list[str], value: str, digits: int = 1) -> DataFrame:
    """Each row's part of its group's total in percent, rounded; null when the total is not positive. Totals are summed before they are joined."""
    totals = rows.groupBy(*keys).agg(F.sum(value).alias("_total"))
    percent = F.when(F.col("_total") > 0, rounded(F.col(value) * 100 / F.nullif(F.col("_total"), F.lit(0.0)), digits))
    return rows.join(totals, keys).withColumn("percent", percent).drop("_total")


def map_shares(stages: Column, digits: int = 1) -> Column:
    """As ``shares``, for the values of a map; empty when the total is not positive."""
    total = F.aggregate(F.map_values(stages), F.lit(0.0), lambda s, v: s + v)
    return F.when(total > 0, F.transform_values(stages, lambda k, v: rounded(v * 100 / total, digits))).otherwise(F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>")))


def judged(frames: list[Column], live: Column, spread: list[float], centre: list[float]) -> list[Column]:
    """Aggregates: each channel's mean over the live frames, times its spread, plus its centre."""
    return [F.avg(F.when(live, x)) * s + c for x, s, c in zip(frames, spread, centre, strict=True)]


def stacked(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames; columns that one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def classified(error: Column) -> Column:
    """Status of a run from its error text (null: none): ok, oom or error."""
    return F.when(error.isNull(), "ok").when(F.lower(error).contains("out of memory"), "oom").otherwise("error")


def failure_reason(kind: Column, message: Column) -> Column:
    """First line of a memory error's message, else type and message."""
    return F.when(message.isNull(), None).when(F.lower(message).contains("out of memory"), F.element_at(F.split(message, "\n"), 1)).otherwise(F.concat_ws(": ", kind, message))


def deduplicated(rows: DataFrame, content: Column) -> DataFrame:
    """One row for each content, with the number of rows that share it: compute on these, then join back by ``content_key``."""
    return rows.withColumn("content_key", F.sha2(content.cast("binary"), 256)).groupBy("content_key").agg(F.count(F.lit(1)).alias("copies"))
