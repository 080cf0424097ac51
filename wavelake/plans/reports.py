"""Run summaries over line items and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import rounded
from ..operators import reports
from ..sources.files import parquet
from . import query

_STATS = "count(*)::bigint as runs, round(avg({v}), 4) as mean, round(median({v}), 4) as median, list_sort(list({v}))[floor(0.95 * (count(*) - 1))::int + 1] as p95, max({v}) as longest"


def _rounded(df):
    return df.withColumns({"mean": F.round("mean", 4), "median": F.round("median", 4)})


@query("agg1_column_means", "select user_id, round(avg(value) filter (where event_id % 10 <> 0), 6) as mean_value from events group by user_id")
def agg1(spark, d):
    value = F.when(F.col("event_id") % 10 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return parquet(spark, d, "events").groupBy("user_id").agg(F.round(reports.mean(value), 6).alias("mean_value"))


@query("agg2_partial_mean", "select user_id, round(sum(value) filter (where event_id % 10 <> 0) / count(*), 6) as mean_value from events group by user_id")
def agg2(spark, d):
    value = F.when(F.col("event_id") % 10 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return parquet(spark, d, "events").groupBy("user_id").agg(F.round(reports.mean_of_rows(value), 6).alias("mean_value"))


@query("agg3_run_summary", f"select l_returnflag as run_name, l_linestatus as phase, {_STATS.format(v='l_extendedprice')}, round(avg(l_quantity), 4) as stage_mean from lineitem where l_discount < 0.09 group by 1, 2")
def agg3(spark, d):
    rows = parquet(spark, d, "lineitem").withColumnsRenamed({"l_returnflag": "run_name", "l_linestatus": "phase"})
    rows = reports.finished(rows, F.when(F.col("l_discount") < 0.09, "ok").otherwise("error"))
    return _rounded(reports.summary(rows, ["run_name", "phase"], "l_extendedprice", {"stage_mean": F.round(F.avg("l_quantity"), 4)}))


@query("agg4_phase_summary", f"select case event_type when 'click' then 'cold' else 'warm' end as phase, {_STATS.format(v='value')} from events where event_type in ('click', 'view') group by 1")
def agg4(spark, d):
    rows = parquet(spark, d, "events").where(F.col("event_type").isin("click", "view")).withColumn("phase", F.when(F.col("event_type") == "click", "cold").otherwise("warm"))
    return _rounded(reports.summary(rows, ["phase"], "value"))


@query("agg5_global_summary", f"select {_STATS.format(v='value')}, round(count(*) / (sum(value) / 1000.0), 4) as per_s, round(60 * count(*) / (sum(value) / 1000.0), 4) as per_min from events where event_type = 'view'")
def agg5(spark, d):
    rows = parquet(spark, d, "events").where("event_type = 'view'")
    rate = reports.per_second(F.count(F.lit(1)), F.sum("value"))
    return _rounded(reports.summary(rows, [], "value", {"per_s": F.round(rate, 4), "per_min": F.round(60 * rate, 4)}))


@query("agg6_pool_summary", f"select user_id % 8 as worker, {_STATS.format(v='value')}, sum((event_type = 'error')::int)::bigint as failed from events group by 1")
def agg6(spark, d):
    rows = parquet(spark, d, "events").withColumn("worker", F.col("user_id") % 8)
    return _rounded(reports.summary(rows, ["worker"], "value", {"failed": F.count_if(F.col("event_type") == "error")}))


@query("agg7_ladder_summary", f"select l_linenumber as lane, {_STATS.format(v='l_quantity')}, count(distinct l_suppkey)::bigint as workers, sum((l_tax > 0.05)::int)::bigint as expanded from lineitem group by 1")
def agg7(spark, d):
    rows = parquet(spark, d, "lineitem").withColumnRenamed("l_linenumber", "lane")
    return _rounded(reports.summary(rows, ["lane"], "l_quantity", {"workers": F.count_distinct("l_suppkey"), "expanded": F.count_if(F.col("l_tax") > 0.05)}))


@query("agg8_floor_rank", "select o_orderpriority, list_sort(list(o_totalprice))[floor(0.95 * (count(*) - 1))::int + 1] as p95 from orders group by 1")
def agg8(spark, d):
    return reports.floor_rank(parquet(spark, d, "orders"), ["o_orderpriority"], "o_totalprice")


@query("agg9_map_key_mean", """
with m as (select user_id, event_type, sum(value) v from events group by 1, 2)
select user_id % 10 as bucket, round(avg(v) filter (where event_type = 'purchase'), 6) as purchase_mean from m group by 1""")
def agg9(spark, d):
    maps = parquet(spark, d, "events").groupBy("user_id", "event_type").agg(F.sum("value").alias("v")).groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "v"))).alias("stage_ms"))
    return maps.groupBy((F.col("user_id") % 10).alias("bucket")).agg(F.round(reports.key_mean(F.col("stage_ms"), "purchase"), 6).alias("purchase_mean"))


@query("agg10_map_accumulate", """
select s_suppkey, round(coalesce(a.v, 0) + s_acctbal, 2) as quantity, round(s_acctbal * 2, 2) as balance from supplier left join (select l_suppkey, sum(l_quantity) v from lineitem group by 1) a on l_suppkey = s_suppkey""")
def agg10(spark, d):
    sums = parquet(spark, d, "lineitem").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("v"))
    rows = parquet(spark, d, "supplier").join(sums, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    left = F.when(F.col("v").isNotNull(), F.create_map(F.lit("quantity"), F.col("v"), F.lit("balance"), F.col("s_acctbal"))).otherwise(F.create_map(F.lit("balance"), F.col("s_acctbal")))
    got = reports.accumulated(left, F.create_map(F.lit("quantity"), F.col("s_acctbal"), F.lit("balance"), F.col("s_acctbal")), 6)
    return rows.select("s_suppkey", F.round(F.element_at(got, "quantity"), 2).alias("quantity"), F.round(F.element_at(got, "balance"), 2).alias("balance"))


@query("agg11_share_of_total", "select event_type, user_id, round(100 * v / sum(v) over (partition by event_type), 1) as percent from (select event_type, user_id, sum(value) v from events group by 1, 2)")
def agg11(spark, d):
    sums = parquet(spark, d, "events").groupBy("event_type", "user_id").agg(F.sum("value").alias("v"))
    return reports.shares(sums, ["event_type"], "v").select("event_type", "user_id", "percent")


@query("agg14_masked_mean", """
select user_id, round(avg(value) filter (live) * 1.7 + 0.3, 6) as overall, round(avg(value * 2) filter (live) * 0.5 + 0.1, 6) as faithfulness, round(avg(value - user_id) filter (live) * 1.1, 6) as recall,
  round(avg(event_id) filter (live) * 0.001 - 1, 6) as "precision" from (select *, event_type <> 'error' live from events) group by 1""")
def agg14(spark, d):
    frames = [F.col("value"), F.col("value") * 2, F.col("value") - F.col("user_id"), F.col("event_id")]
    scores = reports.judged(frames, F.col("event_type") != "error", [1.7, 0.5, 1.1, 0.001], [0.3, 0.1, 0.0, -1.0])
    return parquet(spark, d, "events").groupBy("user_id").agg(*[F.round(c, 6).alias(n) for c, n in zip(scores, ("overall", "faithfulness", "recall", "precision"), strict=True)])


@query("fn11_rounding", """
with k as (select o_orderkey, 625 * (o_custkey * 7 + o_orderkey % 16) as n, case when o_orderkey % 2 = 0 then 1 else -1 end as s from orders)
select o_orderkey, (s * (n // 10 + (n % 10 > 5 or (n % 10 = 5 and (n // 10) % 2 = 1))::int)) / 1000.0::double as rounded from k""")
def fn11(spark, d):
    """Sixteenths to three places: every fourth is a tie."""
    sixteenths = (F.col("o_custkey") * 7 + F.col("o_orderkey") % 16) * F.when(F.col("o_orderkey") % 2 == 0, 1).otherwise(-1)
    return parquet(spark, d, "orders").select("o_orderkey", rounded(sixteenths / 16, 3).alias("rounded"))


@query("agg21_throughput", "select l_shipmonth, count(*)::bigint as chunks, round(count(*) / (sum(l_quantity) / 1000.0), 6) as per_s from (select month(l_shipdate)::int l_shipmonth, l_quantity from lineitem) group by 1")
def agg21(spark, d):
    rows = parquet(spark, d, "lineitem").withColumn("l_shipmonth", F.month("l_shipdate"))
    return rows.groupBy("l_shipmonth").agg(F.count(F.lit(1)).alias("chunks"), F.round(reports.per_second(F.count(F.lit(1)), F.sum("l_quantity")), 6).alias("per_s"))


@query("top5_sorted_groups", "select l_returnflag, l_linestatus, count(*)::bigint as n from lineitem group by 1, 2")
def top5(spark, d):
    return parquet(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n")).orderBy("l_returnflag", "l_linestatus")
