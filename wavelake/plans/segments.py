"""Windows and segments of events."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import ranking, segments
from ..sources.files import parquet
from . import E_SQL, events, query

HOUR = 3_600_000_000
_RMS = f"""with b as (select user_id, min(us) lo, max(us) hi from {E_SQL} group by 1),
w as (select user_id, unnest(range(0, ((hi - lo - {2 * HOUR}) // {HOUR}) + 1)) window_no, lo from b where hi - lo >= {2 * HOUR}),
r as (select w.user_id, w.window_no, sqrt(avg(e.value * e.value)) rms from w join {E_SQL} e on e.user_id = w.user_id and e.us >= lo + window_no * {HOUR} and e.us < lo + window_no * {HOUR} + {2 * HOUR} group by 1, 2)"""


def _rms(spark, d):
    return segments.window_rms(events(spark, d), ["user_id"], "at", "value", 2 * HOUR, HOUR)


@query("win1_sliding_rms", f"{_RMS} select user_id, window_no::bigint window_no, round(rms, 6) rms from r")
def win1(spark, d):
    return _rms(spark, d).select("user_id", "window_no", F.round("rms", 6).alias("rms"))


@query("agg17_peak_rms", f"{_RMS} select user_id, round(greatest(max(rms), 0), 6) as peak from r group by 1")
def agg17(spark, d):
    return segments.peak(_rms(spark, d), ["user_id"]).select("user_id", F.round("peak", 6).alias("peak"))


@query("win2_sounding_segments", f"""
with p as (select user_id, max(value) peak from events group by 1), e as (select e.user_id, e.us from {E_SQL} e join p using (user_id) where value >= peak * pow(10, -40 / 20.0) ),
n as (select *, case when us - lag(us) over (partition by user_id order by us) <= {6 * HOUR} then 0 else 1 end fresh from e), s as (select *, sum(fresh) over (partition by user_id order by us) segment from n)
select user_id, segment::bigint segment, min(us) start_at, max(us) end_at, count(*)::bigint hits from s group by 1, 2""")
def win2(spark, d):
    rows = events(spark, d)
    rows = rows.join(rows.groupBy("user_id").agg(F.max("value").alias("peak")), "user_id")
    return segments.sounding(rows, ["user_id"], "at", segments.relative_threshold(F.col("value"), F.col("peak")), 6 * HOUR)


@query("win5_fixed_chunks", "select user_id, event_id, ((row_number() over (partition by user_id order by event_id) - 1) // 8)::bigint as chunk, ((row_number() over (partition by user_id order by event_id) - 1) % 8)::bigint as place from events")
def win5(spark, d):
    return ranking.in_chunks(parquet(spark, d, "events"), F.col("event_id"), 8, "user_id").select("user_id", "event_id", "chunk", "place")


@query("agg15_mask_down_sample", "select user_id, event_id from events qualify (row_number() over (partition by user_id order by event_id) - 1) % 12 = 0")
def agg15(spark, d):
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    return parquet(spark, d, "events").withColumn("place", place).where("place % 12 = 0").select("user_id", "event_id")
