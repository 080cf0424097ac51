"""Scheduling as tables: orders are active requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import scheduling
from ..sources.files import parquet
from . import query

_R = "(select o_orderkey request, o_orderstatus stage, (1 + o_custkey % 3)::int candidates, 8 max_candidates, 4 steps, (o_custkey % 4)::int step_index, (o_orderkey % 5)::int shape, o_orderkey::double admitted_ms from orders)"
_G = f"(select *, concat_ws('|', stage, candidates, max_candidates, steps, step_index, shape) grp from {_R})"


def _active(spark, d):
    return parquet(spark, d, "orders").select(
        F.col("o_orderkey").alias("request"), F.col("o_orderstatus").alias("stage"), (1 + F.col("o_custkey") % 3).cast("int").alias("candidates"), F.lit(8).alias("max_candidates"), F.lit(4).alias("steps"),
        (F.col("o_custkey") % 4).cast("int").alias("step_index"), (F.col("o_orderkey") % 5).cast("int").alias("shape"), F.col("o_orderkey").cast("double").alias("admitted_ms"),
    )


@query("agg20_compatibility_groups", f'select grp as "group", count(*)::bigint as n, min(admitted_ms) as since from {_G} group by grp')
def agg20(spark, d):
    return scheduling.with_group(_active(spark, d)).groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.min("admitted_ms").alias("since"))


@query("top2_next_batch", f"""
with g as (select grp, min(step_index) s, min(admitted_ms) a, count(*) n from {_G} group by grp order by s, a, n desc, grp limit 1)
select request, grp as "group" from {_G} semi join g using (grp) order by admitted_ms, request limit 16""")
def top2(spark, d):
    return scheduling.next_batch(_active(spark, d), 16).select("request", "group")


@query("str6_step", f"""
with g as (select grp, min(step_index) s, min(admitted_ms) a, count(*) n from {_G} group by grp order by s, a, n desc, grp limit 1), b as (select request from {_G} semi join g using (grp) order by admitted_ms, request limit 16)
select r.request, (step_index + (b.request is not null)::int)::int as step_index from {_R} r left join b on b.request = r.request""")
def str6(spark, d):
    active = _active(spark, d)
    return scheduling.advanced(active, scheduling.next_batch(active, 16)).select("request", "step_index")


@query("str4_admission", """
select o_orderkey as request from orders where o_custkey % 7 <> 0 and o_orderkey % 5 <> 0 order by o_orderdate, o_orderkey
limit (select greatest(0, 4096 - count(*)) from orders where o_orderkey % 5 = 0 and o_custkey % 3 = 0)""")
def str4(spark, d):
    rows = parquet(spark, d, "orders").select(F.col("o_orderkey").alias("request"), F.col("o_orderdate").alias("arrived_ms"), "o_custkey")
    active, waiting = rows.where("request % 5 = 0 and o_custkey % 3 = 0"), rows.where("request % 5 <> 0")
    return scheduling.admitted(waiting, active, waiting.where("o_custkey % 7 = 0"), 4096).select("request")


@query("set3_merge_and_part", "select l_orderkey as request, count(*)::bigint as n, sum(l_linenumber)::bigint as total from lineitem group by 1")
def set3(spark, d):
    rows = parquet(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("request")).agg(F.collect_list("l_linenumber").alias("payload"))
    # one group has a third of the requests
    group = F.when(F.col("request") % 3 == 0, 0).otherwise(1 + F.col("request") % 50)
    batch = scheduling.batched(rows.select("request", group.alias("group"), F.col("request").alias("admitted_ms"), "payload"), 64)
    back = scheduling.parted(scheduling.merged(batch, "payload"), "payload")
    return back.select("request", F.size("payload").cast("long").alias("n"), F.aggregate("payload", F.lit(0).cast("long"), lambda s, x: s + x).alias("total"))
