"""Candidates: a label is a request, its vectors by vec_id are the candidates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import vectors as X
from ..operators import prepared, ranking
from ..sources.files import parquet
from . import V_SQL, query, vectors

# two labels are one request each, with a tenth of the vectors; the others are cut into groups of a hundred ids; the first vector asks
_C_SQL = f"""(select request, vec_id::int cand_idx, vec_id, v, first(v) over w q, first(vec_id) over w asker from (select case when label < 2 then label::bigint else label * 100000 + vec_id // 100 end request, vec_id, v from {V_SQL})
  window w as (partition by request order by vec_id))"""
_S_SQL = f"(select request, cand_idx, round(list_dot_product(v, q), 9) score from {_C_SQL} where vec_id > asker)"


def _candidates(spark, d):
    request = F.when(F.col("label") < 2, F.col("label").cast("long")).otherwise(F.col("label") * F.lit(100000).cast("long") + F.floor(F.col("vec_id") / 100))
    rows = vectors(spark, d).select(request.alias("request"), F.col("vec_id").cast("int").alias("cand_idx"), "vec_id", "v")
    asking = rows.groupBy("request").agg(F.min_by("v", "vec_id").alias("q"), F.min("vec_id").alias("asker"))
    return ranking.paired(rows, asking, "request")


def _scores(spark, d):
    return _candidates(spark, d).where("vec_id > asker").select("request", "cand_idx", F.round(X.dot(F.col("v"), F.col("q")), 9).alias("score"))


@query("agg13_arg_max_candidate", f"select request, cand_idx, score from {_S_SQL} qualify row_number() over (partition by request order by score desc, cand_idx) = 1")
def agg13(spark, d):
    """Flagship: scores candidates against their request's first vector and picks the best, the first on ties."""
    return ranking.selected(_scores(spark, d))


@query("agg12_ensemble", f"select request, cand_idx, round(0.7 * list_dot_product(v[1:32], q[1:32]) + 0.3 * list_dot_product(v[33:64], q[33:64]), 8) score from {_C_SQL}")
def agg12(spark, d):
    parts = F.array(*[F.struct(F.lit(n).alias("ranker"), X.dot(F.slice("v", a, 32), F.slice("q", a, 32)).alias("score")) for n, a in (("text", 1), ("visual", 33))])
    rows = _candidates(spark, d).select("request", "cand_idx", F.explode(parts).alias("r")).select("request", "cand_idx", "r.*")
    return ranking.ensemble(rows, {"text": 0.7, "visual": 0.3}).select("request", "cand_idx", F.round("score", 8).alias("score"))


@query("top1_margin", f"select request, max(score) filter (where n = 1) as first, max(score) filter (where n = 2) as second, round(max(score) filter (where n = 1) - max(score) filter (where n = 2), 8) margin from (select *, row_number() over (partition by request order by score desc, cand_idx) n from {_S_SQL}) where n <= 2 group by request")
def top1(spark, d):
    return ranking.top_two(_scores(spark, d)).withColumn("margin", F.round("margin", 8))


@query("flt4_unconfident", f"select request from (select request, max(score) filter (where n = 1) - max(score) filter (where n = 2) m from (select *, row_number() over (partition by request order by score desc, cand_idx) n from {_S_SQL}) group by request) where m < 0.05")
def flt4(spark, d):
    return ranking.unconfident(_scores(spark, d))


# candidate k of part p scores sin(p * 13 + k * 7), rounded: any deterministic scorer will do
_P = "round(sin(p_partkey * 13 + c * 7), 9)"


def _sines(fanned):
    return fanned.select("request", "cand_idx", F.round(F.sin(F.col("request") * 13 + F.col("cand_idx") * 7), 9).alias("score"))


@query("gen5_adaptive_per_request", f"""
with s as (select p_partkey request, c::int cand_idx, {_P} score from part, range(8) r(c)),
t as (select request, max(score) filter (where n = 1) - max(score) filter (where n = 2) m from (select *, row_number() over (partition by request order by score desc, cand_idx) n from s where cand_idx < 4) group by 1)
select request, cand_idx, score from s join t using (request) where cand_idx < 4 or m < 0.05 qualify row_number() over (partition by request order by score desc, cand_idx) = 1""")
def gen5(spark, d):
    return ranking.adaptive(parquet(spark, d, "part").select(F.col("p_partkey").alias("request")), _sines)


@query("gen4_adaptive_all", f"""
with s as (select p_partkey request, c::int cand_idx, {_P} score from part, range(8) r(c)),
t as (select request, max(score) filter (where n = 1) - max(score) filter (where n = 2) m from (select *, row_number() over (partition by request order by score desc, cand_idx) n from s where cand_idx < 4) group by 1)
select request, cand_idx, score from s where cand_idx < 4 or (select bool_or(m < 0.05) from t) qualify row_number() over (partition by request order by score desc, cand_idx) = 1""")
def gen4(spark, d):
    return ranking.adaptive(parquet(spark, d, "part").select(F.col("p_partkey").alias("request")), _sines, per_request=False)


@query("set2_rerank_union", f"select p_partkey request, count(*)::bigint candidates, max({_P}) best from part, range(8) r(c) group by 1")
def set2(spark, d):
    requests = parquet(spark, d, "part").select(F.col("p_partkey").alias("request"))
    every = _sines(ranking.fan_out(requests, 4)).unionByName(_sines(ranking.fan_out(requests, 4, 4)))
    return every.groupBy("request").agg(F.count(F.lit(1)).alias("candidates"), F.max("score").alias("best"))


@query("gen6_score_dispatch", "select p_partkey, case when p_size % 5 <= 1 then null when p_size % 2 = 0 and p_size % 3 > 0 then p_size * 2.0 else p_size * 1.0 end::double as score from part")
def gen6(spark, d):
    size = F.col("p_size")
    return parquet(spark, d, "part").select("p_partkey", ranking.dispatched(size % 2 == 0, F.when(size % 3 > 0, size * 2.0), size * 1.0, size % 5).alias("score"))


@query("gen7_cascade", """
with s as (select o_orderkey request, coalesce(q, 0)::double signal from orders left join (select l_orderkey, sum(l_quantity) q from lineitem group by 1) on l_orderkey = o_orderkey)
select request, floor(signal * 0.6) target_1, signal - floor(signal * 0.6) residual_1, floor((signal - floor(signal * 0.6)) * 0.5) target_2, (signal - floor(signal * 0.6)) - floor((signal - floor(signal * 0.6)) * 0.5) residual_2 from s""")
def gen7(spark, d):
    sums = parquet(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q"))
    requests = parquet(spark, d, "orders").join(sums, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(F.col("o_orderkey").alias("request"), F.coalesce("q", F.lit(0.0)).alias("signal"))

    def stage(rows, seed):
        target = F.floor(F.col("signal") * (0.6 if seed == 0 else 0.5)).cast("double")
        return rows.select("request", target.alias("target"), (F.col("signal") - target).alias("residual"))

    return ranking.cascade(requests, stage)


@query("gen1_separate_and_pick", f"""
with c as (select p_partkey request, c::int cand_idx, {_P} score from part, range(4) r(c)), b as (select request, cand_idx from c qualify row_number() over (partition by request order by score desc, cand_idx) = 1)
select request, cand_idx, round(p_retailprice / (cand_idx + 2), 6) target, round(p_retailprice - p_retailprice / (cand_idx + 2), 6) residual from b join part on p_partkey = request""")
def gen1(spark, d):
    requests = parquet(spark, d, "part").select(F.col("p_partkey").alias("request"), F.col("p_retailprice").alias("signal"))
    target = F.col("signal") / (F.col("cand_idx") + 2)
    made = ranking.fan_out(requests, 4).withColumns({"target": target, "residual": F.col("signal") - target})
    best = ranking.selected(_sines(made))
    return made.join(best.select("request", "cand_idx"), ["request", "cand_idx"], "left_semi").select("request", "cand_idx", F.round("target", 6).alias("target"), F.round("residual", 6).alias("residual"))


@query("top3_saved_rows", "select o_custkey, o_orderkey from orders qualify row_number() over (partition by o_custkey order by o_orderkey) <= 3")
def top3(spark, d):
    return parquet(spark, d, "orders").withColumn("n", F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))).where("n <= 3").select("o_custkey", "o_orderkey")


@query("top4_sorted_limit", "select page_id, url from pages order by url, page_id limit 100")
def top4(spark, d):
    return parquet(spark, d, "pages").orderBy("url", "page_id").limit(100).select("page_id", "url")


@query("gen2_prepare", """
select p_partkey request, p_brand, 3 as candidates, length(p_brand) * 1.5::double as brand_figure, p_size % 7 as type_figure from part""")
def gen2(spark, d):
    """The brand is encoded once for each distinct brand, the size's remainder once for each remainder."""
    requests = parquet(spark, d, "part").select(F.col("p_partkey").alias("request"), "p_brand", F.col("p_brand").alias("brand_figure"), (F.col("p_size") % 7).alias("type_figure"))
    brand = lambda rows: rows.withColumn("brand_figure", F.length("brand_figure") * 1.5)
    same = lambda rows: rows
    return prepared.prepare(requests, 3, {"brand_figure": brand, "type_figure": same})


@query("gen3_separate_prepared", """
select p_partkey request, c::int cand_idx, round(p_size + (c + 1 - p_size) * pow(1 - 0.125 + 0.125 * 0.125 / 2, 8), 7) as latent from part, range(3) r(c)""")
def gen3(spark, d):
    """The field draws the noise (candidate + 1) to the prepared figure."""
    ready = prepared.prepare(parquet(spark, d, "part").select(F.col("p_partkey").alias("request"), F.col("p_size").alias("figure")), 3)
    made = prepared.separate(ready, F.col("cand_idx") + 1, lambda t, y: F.col("figure") - y, 8, 3)
    return made.select("request", "cand_idx", F.round("latent", 7).alias("latent"))
