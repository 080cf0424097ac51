"""Alignment and similarity joins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import timeline as T
from ..functions import vectors as X
from ..operators import alignment, ranking
from ..sources.files import parquet
from . import E_SQL, V_SQL, events, query, vectors

@query("join1_nearest_time", f"""
with f as (select us, min(event_id) frame_id from {E_SQL} where event_type = 'view' group by us), p as (select event_id probe_id, us from {E_SQL} where event_type = 'error'),
c as (select probe_id, p.us, a.frame_id l, a.us la from p asof left join f a on p.us >= a.us),
b as (select probe_id, c.us, l, la, z.frame_id r, z.us ra from c asof left join f z on c.us <= z.us)
select probe_id, case when l is null then r when r is null then l when us - la < ra - us or (us - la = ra - us and l < r) then l else r end frame_id from b""")
def join1(spark, d):
    rows = events(spark, d)
    probes = rows.where("event_type = 'error'").select(F.col("event_id").alias("probe_id"), "at")
    frames = rows.where("event_type = 'view'").select(F.col("event_id").alias("frame_id"), "at")
    return alignment.nearest(probes, frames, 1 << 13).select("probe_id", "frame_id")


@query("join2_uniform_resample", """
select vec_id, (16 + vec_id % 49)::bigint n, i::bigint place, (case when i * ((16 + vec_id % 49) - 1) / 7.0 - floor(i * ((16 + vec_id % 49) - 1) / 7.0) = 0.5 then 2 * round(i * ((16 + vec_id % 49) - 1) / 14.0) else round(i * ((16 + vec_id % 49) - 1) / 7.0) end)::bigint picked
from embeddings, range(8) r(i)""")
def join2(spark, d):
    rows = parquet(spark, d, "embeddings").select("vec_id", (16 + F.col("vec_id") % 49).alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long"))).alias("place"))
    return rows.withColumn("picked", T.resampled_index(F.col("place"), F.col("n"), F.lit(8)))


@query("join3_interval_overlap", f"""
with c as (select user_id request, us / 1e6 s, us / 1e6 + value * 60 e from {E_SQL} where event_type = 'click'), p as (select user_id request, us / 1e6 s, us / 1e6 + value * 60 e from {E_SQL} where event_type = 'purchase')
select c.request, round(sum(least(c.e, p.e) - greatest(c.s, p.s)), 3) overlap from c join p on c.request = p.request and c.s < p.e and p.s < c.e group by 1""")
def join3(spark, d):
    got = alignment.overlaps(_spans(spark, d, "click"), _spans(spark, d, "purchase"), 3600.0)
    return got.groupBy("request").agg(F.round(F.sum("overlap"), 3).alias("overlap"))


def _spans(spark, d, kind):
    return events(spark, d).where(F.col("event_type") == kind).select(F.col("user_id").alias("request"), (F.col("at") / 1e6).alias("start_s"), (F.col("at") / 1e6 + F.col("value") * 60).alias("end_s"))


@query("agg16_span_scores", f"""
with c as (select user_id request, us / 1e6 s, us / 1e6 + value * 60 e from {E_SQL} where event_type = 'click'), p as (select user_id request, us / 1e6 s, us / 1e6 + value * 60 e from {E_SQL} where event_type = 'purchase'),
i as (select c.request, sum(least(c.e, p.e) - greatest(c.s, p.s)) both_s from c join p on c.request = p.request and c.s < p.e and p.s < c.e group by 1),
a as (select request, sum(e - s) found from c group by 1), b as (select request, sum(e - s) wanted from p group by 1),
j as (select coalesce(a.request, b.request) request, coalesce(found, 0) f, coalesce(wanted, 0) w from a full join b on a.request = b.request)
select j.request, round(case when f + w - coalesce(both_s, 0) > 0 then coalesce(both_s, 0) / (f + w - coalesce(both_s, 0)) else 0 end, 5) iou,
  round(case when w > 0 then coalesce(both_s, 0) / w else 0 end, 5) recall, round(case when f > 0 then coalesce(both_s, 0) / f else 0 end, 5) as "precision" from j left join i on i.request = j.request""")
def agg16(spark, d):
    got = alignment.span_scores(_spans(spark, d, "click"), _spans(spark, d, "purchase"))
    return got.select("request", *[F.round(c, 5).alias(c) for c in ("iou", "recall", "precision")])


@query("join4_span_frames", """
with q as (select user_id request, event_id, row_number() over (partition by user_id order by event_id) - 1 ordinal, value from events where event_type = 'click'),
s as (select request, ordinal, value start_s, value + 0.5 end_s from q), z as (select user_id request, (500 + user_id % 40)::bigint size, 560::bigint longest from events group by 1, 2),
b as (select s.request, ordinal, ceil(start_s * 48000 / 1920)::bigint a, least(ceil(end_s * 48000 / 1920)::bigint, 560) e from s),
c as (select request, f frame, max(ordinal) + 2 slot from (select request, ordinal, unnest(range(a, e)) f from b where a < e) group by 1, 2)
select z.request, g.f::bigint frame, coalesce(c.slot, case when g.f >= size then 1 else 0 end)::bigint slot from z, range(560) g(f) left join c on c.request = z.request and c.frame = g.f""")
def join4(spark, d):
    rows = parquet(spark, d, "events")
    clicks = rows.where("event_type = 'click'").withColumn("ordinal", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1)
    spans = clicks.select(F.col("user_id").alias("request"), "ordinal", F.col("value").alias("start_s"), (F.col("value") + 0.5).alias("end_s"))
    sizes = rows.select(F.col("user_id").alias("request")).distinct().select("request", (500 + F.col("request") % 40).alias("size"), F.lit(560).cast("long").alias("longest"))
    return alignment.spans_on_frames(spans, sizes)


@query("join5_token_lookup", """
with t(token, id) as (values ('<null>', 0), ('+', 1), ('-', 2), ('<pad>', 3)),
e as (select *, case event_type when 'view' then '+' when 'click' then '-' when 'error' then '<pad>' else '<null>' end token from events)
select event_id, id::int id, round(value + tanh(0.25) * (id * 0.1 + 0.05 * id * id), 6) fused from e join t using (token)""")
def join5(spark, d):
    token = F.when(F.col("event_type") == "view", "+").when(F.col("event_type") == "click", "-").when(F.col("event_type") == "error", "<pad>").otherwise("<null>")
    rows = parquet(spark, d, "events").withColumn("id", alignment.token_id(token))
    table = F.array(*[F.array(F.lit(k * 0.1), F.lit(0.05 * k * k)) for k in range(len(alignment.TOKENS))])
    return rows.select("event_id", "id", F.round(F.col("value") + F.tanh(F.lit(0.25)) * X.total(F.get(table, F.col("id"))), 6).alias("fused"))


@query("join6_positional_zip", f"select vec_id, i::bigint place, round(v[i + 1] * v[i + 33], 9) product from {V_SQL}, range(32) r(i) where i < 8 + vec_id % 16")
def join6(spark, d):
    size = (8 + F.col("vec_id") % 16).cast("int")
    left, right = F.slice("v", F.lit(1), size), F.slice("v", 33, 32)
    zipped = F.slice(F.arrays_zip(left.alias("a"), right.alias("b")), F.lit(1), F.least(size, F.lit(32)))
    return vectors(spark, d).select("vec_id", F.posexplode(zipped).alias("place", "z")).select("vec_id", F.col("place").cast("long").alias("place"), F.round(F.col("z.a") * F.col("z.b"), 9).alias("product"))


@query("join7_candidate_fan_out", "select item_id as request, c::int as cand_idx from benchmark, range(3) r(c)")
def join7(spark, d):
    return ranking.fan_out(parquet(spark, d, "benchmark").select(F.col("item_id").alias("request")), 3)


@query("join8_prompt_chunks", "select item_id, p::int as prompt_no, (p // 4)::bigint as chunk, (p % 4)::bigint as place from benchmark, range(10) r(p)")
def join8(spark, d):
    rows = ranking.fan_out(parquet(spark, d, "benchmark").select("item_id"), 10)
    return ranking.in_chunks(rows, F.col("cand_idx"), 4, "item_id").select("item_id", F.col("cand_idx").alias("prompt_no"), "chunk", "place")


@query("join9_description_fan_out", "select item_id as request, c::int as cand_idx, text as description from benchmark, range(2) r(c)")
def join9(spark, d):
    return ranking.fan_out(parquet(spark, d, "benchmark").select(F.col("item_id").alias("request"), F.col("text").alias("description")), 2).select("request", "cand_idx", "description")


_PAIR = "(select a.vec_id, a.v x, b.v y from {v} a join (select label, arg_min(v, vec_id) v from {v} group by label) b using (label))".format(v=V_SQL)


def _with_query(spark, d):
    rows = vectors(spark, d)
    first = rows.groupBy("label").agg(F.min_by("v", "vec_id").alias("q"))
    return ranking.paired(rows, first, "label")


@query("join10_batched_similarity", f"select vec_id, round(list_dot_product(x, y), 9) score from {_PAIR}")
def join10(spark, d):
    return _with_query(spark, d).select("vec_id", F.round(X.dot(F.col("v"), F.col("q")), 9).alias("score"))


@query("join11_batched_cosine", f"select vec_id, round(list_cosine_similarity(x, y), 9) score from {_PAIR}")
def join11(spark, d):
    return _with_query(spark, d).select("vec_id", F.round(X.cosine(F.col("v"), F.col("q")), 9).alias("score"))


@query("join12_diagonal_similarity", f"select vec_id, round(list_dot_product(v[1:32], v[33:64]), 9) score from {V_SQL}")
def join12(spark, d):
    return vectors(spark, d).select("vec_id", F.round(X.dot(F.slice("v", 1, 32), F.slice("v", 33, 32)), 9).alias("score"))


@query("join13_setting_lookup", "select c_custkey, n_name, r_name from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey")
def join13(spark, d):
    nation, region = parquet(spark, d, "nation"), parquet(spark, d, "region")  # Spark broadcasts dimensions under its size limit
    return parquet(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "n_name", "r_name")


@query("join14_gated_fuse", f"""
with p as (select vec_id, v, list_transform(range(8), lambda i: 0.5 * v[33 + i] - 0.25 * v[41 + i] + 0.125 * v[49 + i]) y from {V_SQL}),
m as (select *, list_avg(y) mean from p), n as (select *, list_avg(list_transform(y, lambda x: (x - mean) * (x - mean))) var from m)
select vec_id, round(list_sum(list_transform(range(1, 9), lambda i: i * (v[i] + tanh(0.5) * (y[i] - mean) / sqrt(var + 1e-5)))), 7) fused from n""")
def join14(spark, d):
    # eight outputs of sixteen inputs and eight more: a convolution of width one, normalised, gated and added
    weight = [[0.5 if j == i else -0.25 if j == i + 8 else 0.125 if j == i + 16 else 0.0 for j in range(24)] for i in range(8)]
    fused = X.fused(F.slice("v", 1, 8), F.slice("v", 33, 24), weight, F.lit(0.5))
    place = F.transform(fused, lambda x, i: x * (i + 1))
    return vectors(spark, d).select("vec_id", F.round(X.total(place), 7).alias("fused"))
