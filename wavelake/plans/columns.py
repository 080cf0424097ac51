"""Column functions over vectors, events and parts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import solver
from ..functions import timeline as T
from ..functions import vectors as X
from ..models import hooks, layers
from ..operators import filters, segments
from ..sources.files import parquet
from . import V_SQL, query, vectors


def _sum(x):
    """One figure that depends on each item and its place."""
    return F.round(F.aggregate(F.transform(x, lambda v, i: v * (i + 1)), F.lit(0.0), lambda s, v: s + v), 7)


_W = "round(coalesce(list_sum(list_transform({x}, lambda z, i: z * i)), 0), 7)"


@query("fn1_4_time_base", """
select event_id, ceil((value * 48000)::bigint / 1920)::bigint frames, ceil((value * 48000)::bigint / 1920)::bigint * 1920 samples,
  floor(ceil((value * 48000)::bigint / 1920) * 1920 * 16000 / 48000)::bigint at_16k, ceil(ceil((value * 44100)::bigint * 48000 / 44100) / 1920)::bigint from_44k from events""")
def fn1(spark, d):
    samples = (F.col("value") * 48000 + 0.0).cast("double")
    whole = F.rint(samples).cast("long")
    frames = T.sample_to_frame(whole)
    return parquet(spark, d, "events").select("event_id", frames.alias("frames"), T.frame_to_sample(frames).alias("samples"), T.frame_to_sample_at(frames, 48000, 16000).alias("at_16k"), T.sample_to_frame_at(F.rint(F.col("value") * 44100).cast("long"), 44100, 48000).alias("from_44k"))


@query("fn5_reflect_pad", f"select vec_id, {_W.format(x='list_concat(v, list_reverse(v[64 - p:63]))')} figure from (select vec_id, v, 1 + vec_id % 20 p from {V_SQL})")
def fn5(spark, d):
    return vectors(spark, d).select("vec_id", _sum(T.reflect_padded(F.col("v"), (1 + F.col("vec_id") % 20).cast("int"))).alias("figure"))


@query("fn6_conv_padding", "select p_partkey, ((ceil((p_size + 100 - 7 + 4) / 3 + 1) - 1) * 3 + (7 - 4) - (p_size + 100))::bigint pad from part")
def fn6(spark, d):
    return parquet(spark, d, "part").select("p_partkey", T.conv_padding(F.col("p_size") + 100, 7, 3, 4).alias("pad"))


@query("fn7_downmix", f"select vec_id, {_W.format(x='list_transform(range(1, 33), lambda i: (v[i] + v[i + 32]) / 2)')} figure from {V_SQL}")
def fn7(spark, d):
    return vectors(spark, d).select("vec_id", _sum(X.downmix(F.slice("v", 1, 32), F.slice("v", 33, 32))).alias("figure"))


@query("fn8_normalise", f"select vec_id, {_W.format(x='list_transform(v, lambda x: x / n)')} figure from (select vec_id, v, sqrt(list_dot_product(v, v)) n from {V_SQL})")
def fn8(spark, d):
    return vectors(spark, d).select("vec_id", _sum(X.normalised(F.col("v"))).alias("figure"))


@query("fn12_padded_ms", "select event_id, lpad((value * 1000)::bigint::varchar, 8, '0') as ms from (select event_id, floor(value) as value from events)")
def fn12(spark, d):
    return parquet(spark, d, "events").select("event_id", T.padded_ms(F.floor("value")).alias("ms"))


@query("fn13_truncated_seconds", "select event_id, trunc(value)::bigint as s, trunc(-value)::bigint as negative from events")
def fn13(spark, d):
    return parquet(spark, d, "events").select("event_id", T.whole_seconds(F.col("value")).alias("s"), T.whole_seconds(-F.col("value")).alias("negative"))


@query("fn15_16_seeds_units", "select event_id, 1234 + 10 * event_id + 1 as seed, round(value / 1000.0, 9) as s, round(event_id / 1073741824.0, 12) as gib from events")
def fn15(spark, d):
    return parquet(spark, d, "events").select("event_id", T.run_seed(1234, F.col("event_id"), 1, 10).alias("seed"), F.round(T.seconds(F.col("value")), 9).alias("s"), F.round(T.gibibytes(F.col("event_id")), 12).alias("gib"))


@query("fn19_quantise_repeat", f"select vec_id, round(list_sum(list_transform(range(0, 150), lambda i: (case when i < 128 then trunc(greatest(-1, least(1, v[i % 64 + 1])) * 32767) / 32767 else 0 end) * (i + 1))), 6) figure from {V_SQL}")
def fn19(spark, d):
    whole = F.transform("v", lambda v: (F.greatest(F.lit(-1.0), F.least(F.lit(1.0), v)) * 32767).cast("int"))
    return vectors(spark, d).select("vec_id", F.round(F.aggregate(F.transform(X.repeat_padded(X.dequantised(whole), 150), lambda v, i: v * (i + 1)), F.lit(0.0), lambda s, v: s + v), 6).alias("figure"))


@query("fn20_rms_norm", f"select vec_id, {_W.format(x='list_transform(v, lambda x: x / n)')} figure from (select vec_id, v, sqrt(list_dot_product(v, v) / 64 + 1e-5) n from {V_SQL})")
def fn20(spark, d):
    return vectors(spark, d).select("vec_id", _sum(X.rms_norm(F.col("v"))).alias("figure"))


@query("fn21_modulate", f"select vec_id, {_W.format(x='list_transform(v, lambda x: x * 1.5 + 0.25)')} figure from {V_SQL}")
def fn21(spark, d):
    return vectors(spark, d).select("vec_id", _sum(X.modulated(F.col("v"), F.lit(0.5), F.lit(0.25))).alias("figure"))


@query("fn22_activations", """
select event_id, greatest(x, 0) as relu, round(0.5 * x * (1 + tanh(u)), 7) as approx_gelu, round(greatest(x, 0) * greatest(x, 0), 7) as srelu, round(x / (1 + exp(-x)), 7) as silu
from (select event_id, x, sqrt(2 / pi()) * (x + 0.044715 * x * x * x) as u from (select event_id, value / 10 - 2 as x from events))""")
def fn22(spark, d):
    rows = parquet(spark, d, "events").select("event_id", (F.col("value") / 10 - 2).alias("x"))
    return rows.select("event_id", X.ACTIVATIONS["relu"](F.col("x")).alias("relu"), *[F.round(X.ACTIVATIONS[k](F.col("x")), 7).alias(k) for k in ("approx_gelu", "srelu", "silu")])


@query("fn25_width_rule", "select p_partkey, (ceil(floor(2 * p_size * 64 / 3) / 32) * 32)::bigint as gated, (ceil(p_size * 64 / 32) * 32)::bigint as plain from part")
def fn25(spark, d):
    width = F.col("p_size") * 64
    return parquet(spark, d, "part").select("p_partkey", X.feed_forward_width(width, True, 32).alias("gated"), X.feed_forward_width(width, False, 32).alias("plain"))


@query("fn26_timestep_embedding", f"select p_partkey, {_W.format(x='list_concat(list_transform(range(0, 8), lambda k: cos(t * exp(-ln(10000) * k / 8))), list_transform(range(0, 8), lambda k: sin(t * exp(-ln(10000) * k / 8))))')} figure from (select p_partkey, p_size / 50 as t from part)")
def fn26(spark, d):
    return parquet(spark, d, "part").select("p_partkey", _sum(X.timestep_embedding(F.col("p_size") / 50, 16)).alias("figure"))


@query("fn23_gated_projection", f"""
select vec_id, {_W.format(x="list_transform(range(1, 17), lambda i: 3 * (2 * v[i] / (1 + exp(-2 * v[i]))) * (0.5 * v[i] - v[i % 16 + 1]))")} figure from {V_SQL}""")
def fn23(spark, d):
    """A gate of twice the input, a projection that mixes neighbours, and three times the product."""
    eye = np.eye(16)
    rows = vectors(spark, d).select("vec_id", F.slice("v", 1, 16).alias("x"))
    got = hooks.layered(rows, layers.swiglu, ["x"], "y", 16, {"gate": 2 * eye, "up": 0.5 * eye - np.roll(eye, 1, 1), "down": 3 * eye})
    return got.select("vec_id", _sum(F.col("y")).alias("figure"))


@query("fn24_attention", f"""
with x as (select vec_id, 1 + vec_id % 4 n, list_transform(range(4), lambda t: v[2 * t + 1:2 * t + 2]) x from {V_SQL}),
s as (select *, list_transform(x, lambda q: list_transform(x[1:n], lambda k: exp(list_dot_product(q, k) / sqrt(2)))) e from x),
y as (select vec_id, flatten(list_transform(e, lambda w: list_transform([1, 2], lambda c: list_sum(list_transform(range(1, n + 1), lambda k: w[k] * x[k][c])) / list_sum(w)))) y from s)
select vec_id, {_W.format(x="y")} figure from y""")
def fn24(spark, d):
    """Four places of two channels attend to the first 1 to 4 of them."""
    rows = vectors(spark, d).select("vec_id", F.slice("v", 1, 8).alias("x"), F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: (F.floor(i / 2) < 1 + F.col("vec_id") % 4).cast("double")).alias("mask"))
    got = hooks.layered(rows, lambda x, mask: layers.attention(x, x, x, 1, mask[:, 0] > 0), ["x", "mask"], "y", 2)
    return got.select("vec_id", _sum(F.col("y")).alias("figure"))


@query("fn29_rotary", f"""select vec_id, {_W.format(x='''list_transform(range(0, 64), lambda i: case when i % 2 = 0 then v[i + 1] * cos(p * exp(-2.0 * (i // 2) / 64 * ln(10000))) - v[i + 2] * sin(p * exp(-2.0 * (i // 2) / 64 * ln(10000)))
  else v[i] * sin(p * exp(-2.0 * (i // 2) / 64 * ln(10000))) + v[i + 1] * cos(p * exp(-2.0 * (i // 2) / 64 * ln(10000))) end)''')} figure from (select vec_id, v, vec_id % 50 p from {V_SQL})""")
def fn29(spark, d):
    return vectors(spark, d).select("vec_id", _sum(X.rotated(F.col("v"), F.col("vec_id") % 50)).alias("figure"))


@query("fn29_rotary_stretched", f"""
with r as (select vec_id, v, vec_id % 50 p, list_transform(range(32), lambda k: exp(-2.0 * k / 64 * ln(10000))) f from {V_SQL}),
s as (select vec_id, v, p, list_transform(f, lambda x: x * (greatest(0, least(1, (8192 / (2 * pi()) * x - 1) / 31)) + (1 - greatest(0, least(1, (8192 / (2 * pi()) * x - 1) / 31))) / 8)) f from r)
select vec_id, {_W.format(x='''list_transform(range(0, 64), lambda i: case when i % 2 = 0 then v[i + 1] * cos(p * f[i // 2 + 1]) - v[i + 2] * sin(p * f[i // 2 + 1]) else v[i] * sin(p * f[i // 2 + 1]) + v[i + 1] * cos(p * f[i // 2 + 1]) end)''')} figure from s""")
def fn29_stretched(spark, d):
    return vectors(spark, d).select("vec_id", _sum(X.rotated(F.col("v"), F.col("vec_id") % 50, stretch=8.0)).alias("figure"))


@query("fn31_midpoint", "select p_partkey, round(p_retailprice * pow(1 + h + h * h / 2, p_size), 3) as y from (select *, 1.0::double / p_size as h from part where p_size > 0)")
def fn31(spark, d):
    return parquet(spark, d, "part").where("p_size > 0").select("p_partkey", F.round(solver.midpoint(lambda t, y: y, F.col("p_retailprice"), F.col("p_size")), 3).alias("y"))


@query("fn32_midpoint_step", "select p_partkey, round(y + 0.1 * ((t + 0.05) - (y + 0.05 * (t - y))), 7) as y from (select p_partkey, p_retailprice as y, p_size / 50.0::double as t from part)")
def fn32(spark, d):
    return parquet(spark, d, "part").select("p_partkey", F.round(solver.midpoint_step(lambda t, y: t - y, F.col("p_size") / 50, F.col("p_retailprice"), F.lit(0.1)), 7).alias("y"))


@query("fn33_step_size", "select p_partkey, round(p_retailprice * pow(1 + 0.0625 + 0.0625 * 0.0625 / 2, 16), 5) as y from part")
def fn33(spark, d):
    return parquet(spark, d, "part").select("p_partkey", F.round(solver.midpoint_by_size(lambda t, y: y, F.col("p_retailprice"), 2 / 32), 5).alias("y"))


@query("flt7_pad_mask", "select vec_id, (16 + vec_id % 49)::bigint as live, (64 - (16 + vec_id % 49))::bigint as padded from embeddings")
def flt7(spark, d):
    mask = T.pad_mask(16 + F.col("vec_id") % 49, F.lit(64))
    rows = parquet(spark, d, "embeddings").select("vec_id", mask.alias("m"))
    return rows.select("vec_id", F.size(F.filter("m", lambda x: x)).cast("long").alias("live"), F.size(F.filter("m", lambda x: ~x)).cast("long").alias("padded"))


@query("flt8_masked_frames", f"select vec_id, {_W.format(x='list_transform(range(1, 33), lambda i: case when v[i + 32] > 0 then 0 else v[i] end)')} figure from {V_SQL}")
def flt8(spark, d):
    mask = F.transform(F.slice("v", 33, 32), lambda m: F.when(m > 0, 1).otherwise(0))
    return vectors(spark, d).select("vec_id", _sum(X.masked_product(F.slice("v", 1, 32), mask)).alias("figure"))


@query("flt11_row_trim", f"select vec_id, {_W.format(x='v[1:least(64, (1 + vec_id % 9) * 7)]')} figure from {V_SQL}")
def flt11(spark, d):
    return vectors(spark, d).select("vec_id", _sum(filters.trimmed(F.col("v"), 1 + F.col("vec_id") % 9, 7)).alias("figure"))


@query("flt13_block_slice", f"select vec_id, {_W.format(x='case when vec_id % 2 = 0 then list_concat(v[1:16], v[33:64]) else v end')} figure from {V_SQL}")
def flt13(spark, d):
    zeroed = F.transform("v", lambda x, i: F.when((F.col("vec_id") % 2 == 0) & (i >= 16) & (i < 32), 0.0).otherwise(x))
    return vectors(spark, d).select("vec_id", _sum(X.live_blocks(zeroed, 16, 16, 32)).alias("figure"))


@query("set5_channel_concat", f"select vec_id, {_W.format(x='list_concat(v[1:16], list_concat(list_transform(range(16), lambda i: 0.0::double), v[17:32]))')} figure from {V_SQL}")
def set5(spark, d):
    return vectors(spark, d).select("vec_id", _sum(F.concat(F.slice("v", 1, 16), F.array_repeat(F.lit(0.0), 16), F.slice("v", 17, 16))).alias("figure"))


@query("win4_clip_frames", """
select p_partkey, list_transform(range(10), lambda i: least(floor(((greatest(n / 25.0 - 2, 0) / 4) * (i // 2) + (i % 2)) * 25), n - 1)::bigint)::varchar as picks from (select p_partkey, p_size * 10 + 1 as n from part)""")
def win4(spark, d):
    picks = segments.clip_frames(F.col("p_size") * 10 + 1, 25.0)
    return parquet(spark, d, "part").select("p_partkey", F.concat(F.lit("["), F.array_join(picks.cast("array<string>"), ", "), F.lit("]")).alias("picks"))


@query("win7_predicted_anchors", "select event_id, case when event_id % 3 = 0 then '-' else '+' end as token, round(value, 6) as start_s from events")
def win7(spark, d):
    span = lambda token: F.struct(F.lit(token).alias("token"), F.col("value").alias("start_s"), (F.col("value") + 1).alias("end_s"))
    found = F.array(F.struct(F.col("value").alias("start_s"), (F.col("value") + 1).alias("end_s")))
    anchors = segments.spans_to_anchors(found, F.when(F.col("event_id") % 3 == 0, F.array(span("-"))))
    return parquet(spark, d, "events").select("event_id", anchors.alias("a")).select("event_id", F.col("a")[0]["token"].alias("token"), F.round(F.col("a")[0]["start_s"], 6).alias("start_s"))


@query("win3_clip_spans", "select p_partkey, i::int as clip, round(greatest(p_size / 4.0 - 2, 0) * i / 2, 6) as start_s, round(greatest(p_size / 4.0 - 2, 0) * i / 2 + 2, 6) as end_s from part, range(3) r(i)")
def win3(spark, d):
    spans = segments.clip_spans(F.col("p_size") / 4.0, 3, 2.0)
    rows = parquet(spark, d, "part").select("p_partkey", F.posexplode(spans).alias("clip", "s"))
    return rows.select("p_partkey", "clip", F.round("s.start_s", 6).alias("start_s"), F.round("s.end_s", 6).alias("end_s"))


@query("win6_frame_chunks", "select p_partkey, (i * 300)::int as \"first\", least(300, p_size * 20 - i * 300)::int as frames from part, range(4) r(i) where i * 300 < p_size * 20")
def win6(spark, d):
    return parquet(spark, d, "part").select("p_partkey", F.explode(segments.frame_chunks(F.col("p_size") * 20)).alias("c")).select("p_partkey", "c.first", "c.frames")
