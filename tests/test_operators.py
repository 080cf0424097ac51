"""Hand-made cases of the operators: ties, empty inputs, traps of rounding and padding."""

import io
import math
import random
import wave

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wavelake.functions import names, numbers, solver, timeline, vectors
from wavelake.models import hooks, layers
from wavelake.operators import alignment, filters, ranking, reports, scheduling, segments
from wavelake.sources import audio, files


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_nearest_takes_the_lower_index_on_ties(spark):
    probes = spark.createDataFrame([(i, float(i)) for i in range(5)], "probe_id long, at double")
    frames = spark.createDataFrame([(0, 0.4), (1, 1.5), (2, 2.5)], "frame_id long, at double")
    for bucket_rows in (100, 2):
        got = dict(alignment.nearest(probes, frames, bucket_rows).select("probe_id", "frame_id").collect())
        assert got == {0: 0, 1: 0 if abs(1 - 0.4) < abs(1.5 - 1) else 1, 2: 1, 3: 2, 4: 2}


@pytest.mark.parametrize("seed", range(3))
def test_nearest_against_brute_force(spark, seed):
    draw = random.Random(seed)
    frames = [(i, draw.randrange(60) / 2) for i in range(25)]
    probes = [(i, draw.randrange(-10, 80) / 2) for i in range(60)]
    got = dict(alignment.nearest(spark.createDataFrame(probes, "probe_id long, at double"), spark.createDataFrame(frames, "frame_id long, at double"), 20).select("probe_id", "frame_id").collect())
    for i, t in probes:
        best = min(abs(a - t) for _, a in frames)
        assert abs(dict(frames)[got[i]] - t) == best


def test_spans_on_frames(spark):
    sizes = spark.createDataFrame([(1, 170, 180)], "request long, size long, longest long")
    spans = spark.createDataFrame([(1, 0, 6.3, 7.0), (1, 1, 6.9, 7.5), (1, 2, 5.0, 5.0), (1, 3, 9.0, 3.0)], "request long, ordinal int, start_s double, end_s double")
    got = {r.frame: r.slot for r in alignment.spans_on_frames(spans, sizes).collect()}
    assert len(got) == 180 and got[157] == 0 and got[158] == 2 and got[172] == 2 and got[173] == 3 and got[179] == 3
    plain = {r.frame: r.slot for r in alignment.spans_on_frames(spans.limit(0), sizes).collect()}
    assert plain[169] == 0 and plain[170] == 1


def test_span_scores(spark):
    make = lambda rows: spark.createDataFrame(rows, "request long, start_s double, end_s double")
    found = make([(1, 0.0, 2.0), (2, 0.0, 2.0), (2, 0.0, 2.0), (4, 0.0, 1.0)])
    wanted = make([(1, 1.0, 3.0), (2, 0.0, 2.0), (3, 0.0, 1.0)])
    for width in (0.7, 100.0):
        got = {r.request: (round(r.iou, 9), round(r.recall, 9), round(r.precision, 9)) for r in alignment.span_scores(found, wanted, width).collect()}
        assert got == {1: (round(1 / 3, 9), 0.5, 0.5), 2: (2.0, 2.0, 1.0), 3: (0, 0, 0), 4: (0, 0, 0)}


def test_token_ids(spark):
    assert one(spark, alignment.token_id(F.lit("-"))) == 2
    with pytest.raises(Exception, match="unknown token"):
        one(spark, alignment.token_id(F.lit("?")))


def test_floor_rank_and_means(spark):
    rows = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    got = reports.summary(rows, [], "v").first()
    assert (got.p95, got.median, got.runs, got.longest) == (3.0, 2.5, 4, 10.0)
    odd = spark.createDataFrame([(1.0,), (math.nan,), (3.0,)], "v double")
    assert tuple(odd.select(reports.mean(F.col("v")), reports.mean_of_rows(F.col("v"))).first()) == (2.0, pytest.approx(4 / 3))


@pytest.mark.parametrize("seed", range(5))
def test_floor_rank_against_sorting(spark, seed):
    draw = random.Random(seed)
    rows = [(draw.randrange(3), float(draw.randrange(12))) for _ in range(80)]
    got = {r.k: r.p95 for r in reports.floor_rank(spark.createDataFrame(rows, "k int, v double"), ["k"], "v").collect()}
    for k in {k for k, _ in rows}:
        v = sorted(x for q, x in rows if q == k)
        assert got[k] == v[max(0, int(0.95 * (len(v) - 1)))]


def test_maps(spark):
    m = F.create_map(F.lit("a"), F.lit(1.0), F.lit("b"), F.lit(3.0))
    assert one(spark, reports.map_shares(m)) == {"a": 25.0, "b": 75.0} and one(spark, reports.map_shares(F.map_filter(m, lambda k, v: v > 9))) == {}
    assert one(spark, reports.accumulated(m, F.create_map(F.lit("b"), F.lit(0.0004)))) == {"a": 1.0, "b": 3.0}
    assert one(spark, filters.overridden(m, F.create_map(F.lit("b"), F.lit(9.0), F.lit("z"), F.lit(1.0)))) == {"a": 1.0, "b": 9.0}


def test_selected_takes_the_first_of_ties(spark):
    scores = spark.createDataFrame([(1, 0, 5.0), (1, 1, 7.0), (1, 2, 7.0), (2, 0, None), (2, 1, None)], "request long, cand_idx int, score double")
    assert {r.request: r.cand_idx for r in ranking.selected(scores).collect()} == {1: 1, 2: 0}


def test_confidence(spark):
    scores = spark.createDataFrame([(1, 0, 0.90), (1, 1, 0.86), (2, 0, 0.9), (2, 1, 0.8), (3, 0, 0.9)], "request long, cand_idx int, score double")
    assert [r.request for r in ranking.unconfident(scores).collect()] == [1]


def test_dispatch(spark):
    got = [one(spark, ranking.dispatched(F.lit(v), F.lit(s).cast("double"), F.lit(1.0), F.lit(n))) for v, s, n in ((True, 2.0, 3), (True, None, 3), (False, 2.0, 3), (True, 2.0, 1))]
    assert got == [2.0, 1.0, 1.0, None]


def test_reflect_pad(spark):
    x = F.array(*map(F.lit, (1.0, 2.0, 3.0, 4.0)))
    assert one(spark, timeline.reflect_padded(x, F.lit(2))) == [1, 2, 3, 4, 3, 2]
    assert one(spark, timeline.reflect_padded(x, F.lit(0))) == [1, 2, 3, 4]
    assert one(spark, timeline.reflect_padded(F.array(F.lit(1.0)), F.lit(2))) == [1, 0, 0]


def test_time_base(spark):
    assert one(spark, timeline.sample_to_frame(F.lit(1921))) == 2 and one(spark, timeline.padded_ms(F.lit(1.25))) == "00001250"
    assert [one(spark, timeline.resampled_index(F.lit(i), F.lit(4), F.lit(3))) for i in range(3)] == [0, 2, 3]
    assert one(spark, timeline.resampled_index(F.lit(0), F.lit(4), F.lit(1))) == 0
    assert one(spark, timeline.pad_mask(F.lit(2), F.lit(3))) == [True, True, False] and one(spark, timeline.pad_mask(F.lit(0), F.lit(0))) == []


def test_names(spark):
    assert one(spark, names.short_hash(F.lit("music"))) == "80f189984e5c"
    assert one(spark, names.safe_stem(F.lit("/a/b c/né!e.x.wav"))) == "né_e.x"


def test_solver(spark):
    assert one(spark, solver.midpoint(lambda t, y: y, F.lit(1.0), F.lit(16))) == pytest.approx(2.7165935224747666)
    assert one(spark, solver.midpoint_by_size(lambda t, y: y, F.lit(1.0), 1 / 16)) == pytest.approx(2.7165935224747666)
    assert one(spark, solver.midpoint_by_size(lambda t, y: t * 2, F.lit(0.0), 0.3)) == pytest.approx(1.0)
    assert one(spark, solver.midpoint(lambda t, y: y, F.lit(1.0), F.lit(0))) == 1.0


def test_vectors(spark):
    x = F.array(F.lit(3.0), F.lit(4.0))
    assert one(spark, vectors.normalised(x)) == [0.6, 0.8] and all(map(math.isnan, one(spark, vectors.normalised(F.array(F.lit(0.0))))))
    assert one(spark, vectors.gelu(F.lit(1.0))) == pytest.approx(0.8413447460685429)
    assert one(spark, vectors.repeat_padded(x, 5)) == [3, 4, 3, 4, 0] and one(spark, vectors.repeat_padded(x, 1)) == [3]
    assert one(spark, vectors.quantised(F.array(F.lit(2.0), F.lit(-0.5)))) == [32767, -16383]


def test_rotary_agrees_with_numpy(spark):
    x = np.arange(8.0)[None] + np.zeros((3, 1))
    assert one(spark, vectors.rotated(F.array(*map(F.lit, x[0].tolist())), F.lit(2))) == pytest.approx(layers.rotate(x)[2].tolist())


def test_layers():
    draw = np.random.default_rng(0)
    q, k, v = draw.normal(size=(3, 5, 8))
    mask = np.array([True, True, False, True, False])
    got = layers.attention(q, k, v, 2, mask)
    for h in range(2):
        s = q[:, h::2] @ k[mask][:, h::2].T / 2
        w = np.exp(s) / np.exp(s).sum(1, keepdims=True)
        assert np.allclose(got[:, h::2], w @ v[mask][:, h::2])
    assert np.allclose(layers.attention(q, k, v, 2, np.zeros(5, bool)), 0)
    assert np.allclose(layers.join_heads(layers.split_heads(q, 4)), q)
    assert layers.convolve(np.ones((5, 1)), np.ones((1, 1, 3)), 2)[:, 0].tolist() == [2, 3, 2]
    w = {n: draw.normal(size=(8, 8)) * 0.1 for n in ("q", "k", "v", "o", "cq", "ck", "cv", "co", "gate", "up", "down")} | {"modulation": np.zeros(48)}
    assert layers.block(q, k, w, 2).shape == (5, 8)
    assert layers.judge_scores(np.ones((4, 4)), np.array([True, False, True, True]), np.zeros(4), np.full(4, 2.0)).tolist() == [2] * 4


def test_rankers(spark):
    rows = pd.DataFrame({"request": [1, 1], "cand_idx": [0, 1], "embedding": [[1.0, 0.0], [0.0, 2.0]], "query": [[1.0, 1.0]] * 2})
    rank = hooks.create({"kind": "ensemble", "rankers": {"a": {"weight": 2, "ranker": {"kind": "dot"}}, "b": {"weight": 1, "ranker": {"kind": "cosine"}}}})
    assert rank(rows).tolist() == pytest.approx([2 + 0.5**0.5, 4 + 0.5**0.5])
    assert hooks.ranked(spark.createDataFrame(rows), {"kind": "dot"}).orderBy("cand_idx").collect()[1].score == 2.0
    assert hooks.create(None) is None
    with pytest.raises(ValueError, match="unknown kind"):
        hooks.create({"kind": "none such"})
    spans = pd.DataFrame({"found": [[{"start_s": 0.0, "end_s": 2.0}]], "wanted": [[{"start_s": 1.0, "end_s": 3.0, "token": "-"}]]})
    assert hooks.create({"kind": "sound_activity"})(spans)[0] == pytest.approx(1 / 3) and hooks.create({"kind": "sound_activity", "ignore_negative": True})(spans)[0] == 0


def test_separation_and_metrics(spark):
    requests = spark.createDataFrame([(1, "x", [1.0, 2.0]), (2, "y", [4.0])], "request long, description string, signal array<double>")
    model = lambda: lambda x, text, seed: (x / 2, x - x / 2)
    score = lambda made: made.select("request", "cand_idx", F.col("cand_idx").cast("double").alias("score"))
    got = {r.request: (r.cand_idx, r.target) for r in hooks.separate(requests, model, score, 3).collect()}
    assert got == {1: (2, [0.5, 1.0]), 2: (2, [2.0])}
    rows = hooks.measured(requests.select("request"), {"m": lambda p: {"double_id": p.request * 2.0}}, ["double_id"]).orderBy("request").collect()
    assert [r.double_id for r in rows] == [2.0, 4.0]


def test_audio(spark, tmp_path):
    x = np.sin(np.arange(4800) / 20)
    (tmp_path / "a.wav").write_bytes(audio.encode_wav(x, 48000))
    (tmp_path / "bad.wav").write_bytes(b"nothing")
    stereo = io.BytesIO()
    with wave.open(stereo, "wb") as f:
        f.setparams((2, 2, 24000, 0, "NONE", ""))
        f.writeframes(np.array([[16384, 0]] * 240, "<i2").tobytes())
    (tmp_path / "s.wav").write_bytes(stereo.getvalue())
    got = {r.path.rsplit("/", 1)[1]: r for r in audio.waveforms(spark, str(tmp_path)).collect()}
    assert got["a.wav"].n_samples == 4800 and np.abs(np.array(got["a.wav"].samples) - x).max() < 1e-3
    assert got["s.wav"].n_samples == 480 and got["s.wav"].samples[7] == pytest.approx(0.25) and "Error" in got["bad.wav"].error
    out = audio.write_wavs(spark.createDataFrame([("t", [0.5, -0.5])], "name string, samples array<double>"), str(tmp_path / "out"))
    assert audio.decode_wav(bytes(out.first().wav))[0][0].tolist() == pytest.approx([0.5, -0.5], abs=1e-4)
    with pytest.raises(Exception, match="48000 samples"):
        audio.require_rate(spark.createDataFrame([(44100,)], "rate int"), 48000).collect()


def test_files(spark, tmp_path):
    for n in ("b.MP3", "a.mp3", "sub/c.wav", "d.txt"):
        (tmp_path / n).parent.mkdir(exist_ok=True)
        (tmp_path / n).write_bytes(b"x")
    rows = files.listing(spark, str(tmp_path))
    assert [r.path.rsplit("/", 1)[1] for r in files.first_files(rows, 2).collect()] == ["a.mp3", "b.MP3"]
    assert {r.path.rsplit("/", 1)[1]: r.phase for r in files.warm_up_split(rows).collect()} == {"a.mp3": "warmup", "b.MP3": "benchmark", "c.wav": "benchmark"}
    with pytest.raises(FileNotFoundError):
        files.first_files(rows.where("false"))
    with pytest.raises(ValueError):
        files.warm_up_split(rows.limit(1))
    texts = ['["a", "", {"text": "t"}]', '{"items": [{"prompt": "", "description": "d"}]}', '{"prompts": ["p"]}']
    got = files.prompts(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string"), F.col("t")).orderBy("i", "place").collect()
    assert [(r.i, r.place, r.prompt) for r in got] == [(0, 0, "a"), (0, 2, "t"), (1, 0, "d"), (2, 0, "p")]
    data = spark.createDataFrame([(1, "x"), (2, "y")], "n long, a string")
    for _ in range(2):
        files.write_rows(data, str(tmp_path / "rows"))
    assert files.read_rows(spark, str(tmp_path / "rows"), "n long, a string").count() == 4
    for run in ("r1", "r2"):
        files.write_summary(data, str(tmp_path / "runs" / run))
    assert files.read_summaries(spark, str(tmp_path / "runs" / "*")).select("source_path").distinct().count() >= 2


def test_validation(spark):
    good = spark.createDataFrame([(4, 2, 4, 0.1)], "steps int, candidates int, max_candidates int, margin double")
    assert filters.valid_settings(good).count() == 1
    with pytest.raises(Exception, match="bad max_candidates"):
        filters.valid_settings(good.withColumn("max_candidates", F.lit(1))).collect()
    with pytest.raises(Exception, match="unexpected key"):
        filters.none_left(spark.createDataFrame([("x",)], "k string"), "k", "^y").collect()


def test_segments(spark):
    rows = spark.createDataFrame([(1, float(t), float(v)) for t, v in ((0, 1), (1, 1), (5, 1), (6, 0), (6.5, 1))], "k long, at double, value double")
    got = sorted(map(tuple, segments.sounding(rows, ["k"], "at", F.col("value") > 0, 2.0).collect()))
    assert got == [(1, 1, 0.0, 1.0, 2), (1, 2, 5.0, 6.5, 2)]
    few = segments.window_rms(spark.createDataFrame([(1, 0.0, 1.0), (1, 0.5, 2.0)], "k long, at double, value double"), ["k"], "at", "value", 1.0, 0.5)
    assert few.count() == 0  # no full window


def test_schedule(spark):
    rows = [(i, "s", 1, 1, n, 0, n, float(i)) for i, n in ((1, 2), (2, 8), (3, 2))]
    requests = spark.createDataFrame(rows, "request long, stage string, candidates int, max_candidates int, steps int, step_index int, shape int, admitted_ms double")
    log = scheduling.simulate(requests, 2, 4)
    started = next(k for k, x in enumerate(log) if 3 in x["batch"])
    assert started < next(k for k, x in enumerate(log) if 2 in x["finished"]) and {r for x in log for r in x["finished"]} == {1, 2, 3}
    assert scheduling.next_batch(requests, 4).select("request").collect()[0].request == 1


def test_rounding_is_that_of_the_binary_value(spark):
    draw = random.Random(3)
    values = [2.675, 1.005, 0.5, 1.5, 2.5, -0.5, -2.5, 0.125, 0.375, -1.0005, 0.0, -0.0, 1e15 + 0.3, 1e300, 4503599627370497.5, float("inf"), 0.0005, 0.0015, 5e-324]
    values += [draw.uniform(-1000, 1000) for _ in range(500)] + [k / 16 for k in range(-100, 100)] + [draw.randint(0, 10**7) / 1000 + 0.0005 for _ in range(300)]
    for digits in (0, 1, 3, 4):
        got = spark.createDataFrame([(v,) for v in values], "v double").select("v", numbers.rounded(F.col("v"), digits).alias("r")).collect()
        assert [(r.v, r.r) for r in got if r.r != (round(r.v, digits) if abs(r.v) < 1e16 else r.v)] == []
    assert spark.range(1).select(numbers.rounded(F.lit(float("nan")), 3), numbers.rounded(F.lit(None).cast("double"), 3)).first()[1] is None


def test_error_function():
    x = np.array([0.0, -0.0, 1e-9, 0.1, -0.5, 1.0, 2.0, -3.0, 4.5, 5.9, 6.5, -40.0, np.inf])
    assert vectors.erf(x) == pytest.approx([math.erf(v) for v in x], rel=1e-13, abs=1e-16)
    assert np.isnan(vectors.erf(np.array([np.nan])))[0]


def test_stretched_rates():
    plain, slow = layers.rates(64), layers.rates(64, stretch=8.0)
    assert slow[0] == plain[0] and slow[-1] == pytest.approx(plain[-1] / 8) and (np.diff(slow / plain) <= 1e-12).all()


def test_place_in_bounds(spark):
    bounds = [1, 3, 3, 7, 20]
    got = spark.range(25).select("id", numbers.place(F.array(*map(F.lit, bounds)), F.col("id"), len(bounds)).alias("p")).collect()
    assert all(r.p == sum(b <= r.id for b in bounds) for r in got)


@pytest.mark.parametrize("accuracy", [10_000, 50])
def test_percentiles_of_skewed_groups(spark, monkeypatch, accuracy):
    """An outlier, many equal values, a hot group: exact places; with a coarse sketch most values are counted, not sorted."""
    monkeypatch.setattr(reports, "ACCURACY", accuracy)
    draw = random.Random(1)
    groups = {"hot": [draw.random() for _ in range(5000)] + [1e18, -1e18], "same": [2.0] * 700 + [3.0], "one": [5.0], "few": [3.0, 1.0, 2.0], "ties": [float(draw.randrange(5)) for _ in range(900)]}
    rows = [(k, v) for k, x in groups.items() for v in x] + [("few", None), ("few", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r for r in reports.ranked(df, ["g"], "v", {"lo": (0.0, lambda n: F.lit(0)), "mid": (0.5, lambda n: F.floor((n - 1) / 2)), "p95": (0.95, lambda n: F.floor(F.lit(0.95) * (n - 1))), "hi": (1.0, lambda n: n - 1)}).collect()}
    for k, x in groups.items():
        x = sorted(x)
        assert (got[k].lo, got[k].mid, got[k].p95, got[k].hi) == (x[0], x[(len(x) - 1) // 2], x[int(0.95 * (len(x) - 1))], x[-1])
    assert set(got) == set(groups)


def test_batches_of_a_hot_group(spark):
    rows = [(i, "a" if i % 3 else "b", float(i % 7), [i] * (i % 4)) for i in range(500)]
    df = spark.createDataFrame(rows, "request long, group string, admitted_ms double, payload array<long>")
    dealt = scheduling.batched(df, 16)
    sizes = dealt.groupBy("group", "batch").count().collect()
    assert max(r["count"] for r in sizes) <= 16 and sum(r["count"] for r in sizes) == 500
    back = scheduling.parted(scheduling.merged(dealt, "payload"), "payload").collect()
    assert {r.request: r.payload for r in back} == {i: p for i, _, _, p in rows}


@pytest.mark.parametrize("bucket_rows", [1 << 18, 40])
def test_nearest_in_buckets(spark, bucket_rows):
    """Many frames and probes at one time, and far outliers."""
    draw = random.Random(2)
    frames = [(i, draw.choice([draw.randrange(1000), 500, 10**12])) for i in range(300)]
    probes = [(i, draw.choice([draw.randrange(-5, 1100), 500, -(10**12)])) for i in range(400)]
    got = alignment.nearest(spark.createDataFrame(probes, "probe_id long, at long"), spark.createDataFrame(frames, "frame_id long, at long"), bucket_rows).collect()
    want = {p: min((abs(a - t), f) for f, a in frames) for p, t in probes}
    assert {r.probe_id: (r.gap, r.frame_id) for r in got} == want


def test_overlaps_of_moments(spark):
    draw = random.Random(3)
    some = lambda n: [(draw.randrange(40), float(s), s + draw.choice([-2.0, 0.0, 0.0, 1.0, 25.0])) for s in (draw.randrange(0, 60) / 2 for _ in range(n))]
    a, b = some(150), some(150)
    make = lambda rows: spark.createDataFrame(rows, "request long, start_s double, end_s double")
    got = {}
    for r in alignment.overlaps(make(a), make(b), 7.0).collect():
        got[r.request] = got.get(r.request, 0.0) + r.overlap
    want = {}
    for q, s, e in a:
        for _, t, f in (x for x in b if x[0] == q and s < x[2] and x[1] < e):
            want[q] = want.get(q, 0.0) + min(e, f) - max(s, t)
    assert got == want
    one = alignment.overlaps(make([(1, 5.0, 5.0)]), make([(1, 0.0, 9.0)]), 3.0).collect()
    assert [r.overlap for r in one] == [0.0]


def test_shared_time_of_many_overlaps(spark):
    draw = random.Random(5)
    some = lambda n: [(draw.randrange(3), s, s + draw.choice([0, 1, 5, 40])) for s in (draw.randrange(0, 100) / 2 for _ in range(n))]
    a, b = some(80), some(60)
    make = lambda rows: spark.createDataFrame(rows, "request long, start_s double, end_s double")
    a, b = [(r, float(s), float(e)) for r, s, e in a], [(r, float(s), float(e)) for r, s, e in b]
    got = {r.request: r.both for r in alignment.shared_time(make(a), make(b), 7.0).collect()}
    for q in range(3):
        want = sum(max(0.0, min(x[2], y[2]) - max(x[1], y[1])) for x in a for y in b if x[0] == y[0] == q)
        assert got[q] == pytest.approx(want)


@pytest.mark.parametrize("few", [100, 0])
def test_paired(spark, few):
    rows, single = spark.createDataFrame([(i, i % 3) for i in range(200)], "id long, k long"), spark.createDataFrame([(0, "a"), (1, "b")], "k long, v string")
    got = sorted((r.id, r.v) for r in ranking.paired(rows, single, "k", few).collect())
    assert got == [(i, "ab"[i % 3]) for i in range(200) if i % 3 < 2]


def test_clip_spans_and_chunks(spark):
    rows = spark.createDataFrame([(1.0, 0), (2.0, 1), (10.0, 300), (10.0, 601)], "duration double, frames int")
    got = rows.select(segments.clip_spans(F.col("duration"), 3, 2.0).alias("s"), segments.frame_chunks(F.col("frames")).alias("c")).collect()
    assert [[(x.start_s, x.end_s) for x in r.s] for r in got[:3]] == [[(0.0, 2.0)] * 3, [(0.0, 2.0)] * 3, [(0.0, 2.0), (4.0, 6.0), (8.0, 10.0)]]
    assert [[(x.first, x.frames) for x in r.c] for r in got] == [[], [(0, 1)], [(0, 300)], [(0, 300), (300, 300), (600, 1)]]
