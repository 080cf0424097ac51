"""Media, downloads, checkpoints and prepared separations, on files made here."""

import io
import json
import wave
import zipfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wavelake.models import batch, checkpoints, hooks, judge, layers
from wavelake.operators import alignment, prepared
from wavelake.sources import audio, download, video


@pytest.fixture
def media(spark, tmp_path):
    for name, seconds in (("a", 1.0), ("b", 2.0)):
        (tmp_path / f"{name}.wav").write_bytes(audio.encode_wav(np.linspace(-0.5, 0.5, int(8000 * seconds)), 8000))
    (tmp_path / "bad.wav").write_bytes(b"no header")
    return spark.read.format("binaryFile").load(str(tmp_path)).select(F.element_at(F.split("path", "/"), -1).alias("path"), "content")


def test_slices_and_durations(spark, media, tmp_path):
    rows = spark.createDataFrame([(0, "a.wav", 0.25, 0.5), (1, "a.wav", 0.5, None), (2, "b.wav", None, None), (3, "bad.wav", 0.0, 1.0), (4, "lost.wav", 0.0, 1.0), (5, "b.wav", 5.0, 6.0)], "id int, path string, start_s double, end_s double")
    got = {r.id: r for r in audio.sliced(rows, media, 8000).collect()}
    assert [len(got[i].samples) for i in (0, 1, 2, 5)] == [2000, 4000, 16000, 0] and got[0].samples[0] == pytest.approx(-0.25, abs=1e-3)
    assert got[3].samples is None and got[3].error and got[4].error.startswith("FileNotFoundError")
    found = {r.path.rsplit("/", 1)[1]: r.duration_s for r in audio.durations(spark, str(tmp_path)).collect()}
    assert found == {"a.wav": 1.0, "b.wav": 2.0, "bad.wav": None}


def test_batches_are_padded_to_frames():
    batch, mask = audio.padded_batch([np.ones(5), np.ones(8), np.ones(0)], 4)
    assert batch.shape == (3, 8) and batch.sum() == 13 and mask.tolist() == [[True, True], [True, True], [False, False]]


def test_results_are_saved(spark, tmp_path):
    rows = spark.createDataFrame([(n, [0.5, -0.5], [0.0]) for n in "cab"], "name string, target array<double>, residual array<double>")
    saved = audio.save_results(rows, str(tmp_path / "out"), 2, 8000)
    assert [p.rsplit("/", 1)[1] for p in saved] == ["a_target.wav", "a_residual.wav", "b_target.wav", "b_residual.wav"]
    with wave.open(saved[0]) as f:
        assert (f.getnframes(), f.getframerate()) == (2, 8000)


def test_video_frames_follow_audio_frames(spark):
    content = json.dumps({"pts": [0.0, 0.1, 0.1, 0.25], "frames": [[1], [2], [3], [4]]}).encode()

    def decode(data, start, end):
        x = json.loads(data)
        return np.array(x["pts"]), np.array(x["frames"])

    files = spark.createDataFrame([("v", bytearray(content)), ("w", bytearray(b"?"))], "path string, content binary")
    rows = spark.createDataFrame([("v", 0.0, None, 7), ("w", 0.0, 1.0, 2)], "path string, start_s double, end_s double, size int")
    got = {r.path: r for r in video.aligned(rows, files, decode).collect()}
    times = np.arange(7) * 1920 / 48000
    assert [x[0] for x in got["v"].frames] == [[1, 2, 3, 4][int(np.abs(np.array([0.0, 0.1, 0.1, 0.25]) - t).argmin())] for t in times]
    assert got["w"].frames is None and got["w"].error
    assert video.resampled_mask(np.arange(5), 3).tolist() == [0, 2, 4]


def test_downloads_are_whole_or_absent(tmp_path):
    source, archive = tmp_path / "x.bin", tmp_path / "z.zip"
    source.write_bytes(b"abc")
    with zipfile.ZipFile(archive, "w") as z:
        z.writestr("in/file.txt", "hello")
    path = download.fetched(source.as_uri(), str(tmp_path / "cache" / "y.bin"))
    source.unlink()
    assert open(download.fetched(source.as_uri(), path), "rb").read() == b"abc"  # not fetched again
    with pytest.raises(OSError):
        download.fetched(source.as_uri(), str(tmp_path / "cache" / "other.bin"))
    folder = download.unzipped(str(archive), str(tmp_path / "cache" / "un"))
    assert (tmp_path / "cache" / "un" / "in" / "file.txt").read_text() == "hello" and download.unzipped("gone.zip", folder) == folder
    assert sorted(p.name for p in (tmp_path / "cache").iterdir()) == ["un", "y.bin"]


def test_checkpoints(tmp_path):
    (tmp_path / "config.json").write_text(json.dumps({"width": 4, "heads": 2}))
    np.savez(tmp_path / "weights.npz", q=np.ones(2), k=np.zeros(2))
    assert checkpoints.config(str(tmp_path), {"width": 8, "other": 1}) == {"width": 8, "heads": 2}
    assert checkpoints.config("name", fetch=lambda name: str(tmp_path))["heads"] == 2
    assert set(checkpoints.weights(str(tmp_path), {"q", "k", "text.proj"}, r"^text[.]")) == {"q", "k"}
    with pytest.raises(KeyError, match="missing"):
        checkpoints.weights(str(tmp_path), {"q"})
    assert set(checkpoints.weights(str(tmp_path), {"q", "v"}, strict=False)) == {"q"}


def test_prepared(spark):
    rows = spark.createDataFrame([(i, "ab"[i % 2], None if i % 3 else [1.0]) for i in range(6)], "request long, text string, anchors array<double>")
    seen = spark.sparkContext.accumulator(0)

    def encode(once):
        def count(batches):
            for b in batches:
                seen.add(len(b))
                yield b.assign(text=b.text + "!")

        return once.mapInPandas(count, once.schema)

    ready = prepared.prepare(rows, 2, {"text": encode}, lambda some: some.withColumn("anchors", F.array(F.lit(9.0))))
    got = {r.request: r for r in ready.collect()}
    assert seen.value == 2 and all(got[i].text == "ab"[i % 2] + "!" and got[i].anchors == ([9.0] if i % 3 else [1.0]) for i in range(6))
    made = prepared.separate(ready, F.lit(0.0), lambda t, y: F.lit(1.0), 4, 2)
    assert made.count() == 12 and made.select("latent").distinct().first().latent == 1.0
    with pytest.raises(Exception, match="candidates must be"):
        prepared.separate(ready, F.lit(0.0), lambda t, y: y, 1, 3).collect()


def test_encoders_and_judges(spark):
    rows = spark.createDataFrame([(i, 0, f"t{i}", [float(i)]) for i in range(5)], "request long, cand_idx int, text string, embedding array<double>")
    got = hooks.encoded(rows, lambda: lambda part: [np.array([len(t), len(part)]) for t in part.text], ["text"], "embedding", 2).collect()
    assert all(r.embedding[0] == 2 and r.embedding[1] <= 2 for r in got) and len(got) == 5
    judge = lambda part: {"JudgeOverall": part.request * 2.0, "JudgeRecall": part.request * 3.0}
    assert [r.score for r in hooks.ranked(rows, {"kind": "judge", "model": judge, "column": "JudgeRecall"}).orderBy("request").collect()] == [0, 3, 6, 9, 12]
    assert hooks.create({"kind": "judge", "model": judge})(rows.toPandas()).tolist() == [0, 2, 4, 6, 8]


def test_models_are_made_once(tmp_path):
    made = []
    shared = hooks.Shared(lambda: made.append(1) or "model")
    assert [shared(), shared()] == ["model"] * 2 and made == [1] and hooks.shared(shared) is shared
    assert io.BytesIO(audio.encode_wav(np.zeros(3), 8000)).read(4) == b"RIFF"


def test_evaluation_reads_media_ranges(spark, media, tmp_path):
    from wavelake import evaluate

    rows = spark.createDataFrame([(0, "a.wav", 0.25, 0.5), (1, "b.wav", 0.0, None)], "request long, path string, start_s double, end_s double")
    got = {r.request: len(r.signal) for r in evaluate.with_signals(rows, str(tmp_path), 8000).collect()}
    assert got == {0: 2000, 1: 16000}
    with pytest.raises(Exception, match="bad.wav"):
        evaluate.with_signals(spark.createDataFrame([(0, "bad.wav", 0.0, 1.0)], rows.schema), str(tmp_path)).collect()


def test_judges_take_paths_and_arrays(tmp_path):
    (tmp_path / "a.wav").write_bytes(audio.encode_wav(np.linspace(0, 0.5, 10), 8000))
    batch, mask = judge.ingested([str(tmp_path / "a.wav"), np.arange(4.0), np.arange(3.0)[None]], 8000, 4)
    assert batch.shape == (3, 12) and mask.sum(1).tolist() == [12, 4, 4] and batch[2, :4].tolist() == [0.0, 1.0, 2.0, 1.0]
    assert batch[0, 10] == pytest.approx(batch[0, 8]) and judge.ingested(str(tmp_path / "a.wav"), 8000, 5)[0].shape == (1, 10)
    with pytest.raises(ValueError, match="8000"):
        judge.ingested([np.zeros(4)], 8000, 4, given_rate=44100)
    with pytest.raises(ValueError, match="one channel"):
        judge.ingested([np.zeros((2, 4))], 8000, 4)
    tokens = lambda texts: {"ids": np.array([[len(t)] * 600 for t in texts])}
    model = judge.ranker_model(judge.processor(8000, 4, tokens), lambda b: {"JudgeOverall": b["ids"].sum(1) + b["separated_values"].sum(1)})
    rows = pd.DataFrame({"description": ["ab", "c"], "input": [np.zeros(4), np.zeros(8)], "separated": [np.ones(4), np.ones(8)]})
    assert hooks.create({"kind": "judge", "model": model})(rows).tolist() == [512 * 2 + 4, 512 + 8]


def test_patches_and_context():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(6, 3))
    w = {"norm1": np.ones(3), "norm1_bias": np.zeros(3), "conv1": draw.normal(size=(4, 3, 3)), "conv1_bias": np.ones(4), "norm2": np.ones(4), "norm2_bias": np.zeros(4), "conv2": draw.normal(size=(4, 4, 3)), "conv2_bias": np.zeros(4), "skip": draw.normal(size=(4, 3)), "skip_bias": np.zeros(4)}
    y = layers.centred(x, w["conv1"], w["conv1_bias"])
    at = lambda t: x[t] if 0 <= t < 6 else np.zeros(3)
    assert y[0] == pytest.approx(sum(w["conv1"][:, :, k] @ at(k - 1) for k in range(3)) + 1)
    got = layers.patch(x, w, 2)
    assert got.shape == (3, 8) and layers.patch(x, w, 1)[3].tolist() == pytest.approx(got[1].reshape(4, 2)[:, 1].tolist())
    assert layers.context(x, w["skip"], w["skip"], np.eye(4)[:2], np.ones(3)).shape == (6, 2)


def test_batches_have_anchors_like_the_join(spark):
    anchors = [[{"token": "+", "start_s": 0.1, "end_s": 0.3}, {"token": "-", "start_s": 0.2, "end_s": 9.0}], None]
    rows = pd.DataFrame({"signal": [np.ones(1920 * 9 + 1), np.ones(1920 * 4)], "description": ["a", "b"], "anchors": anchors})
    got = batch.collated(rows)
    assert got["sizes"].tolist() == [10, 4] and got["anchor_ids"].tolist() == [[0, 3, 1, 2], [0, 3, 3, 3]] and got["samples"].shape == (2, 19200)
    spans = spark.createDataFrame([(0, k, a["start_s"], a["end_s"]) for k, a in enumerate(anchors[0])], "request long, ordinal long, start_s double, end_s double")
    sizes = spark.createDataFrame([(0, 10, 10), (1, 4, 10)], "request long, size long, longest long")
    for r in alignment.spans_on_frames(spans, sizes).collect():
        assert got["alignment"][r.request, r.frame] == r.slot


def test_rankers_from_plain_configurations():
    config = hooks.parse({"kind": "ensemble", "rankers": {"text": [{"kind": "clap", "left": "a", "right": "b"}, 0.25], "sound": {"ranker": {"kind": "sound_activity", "metric": "recall"}, "weight": 2}}})
    assert {k: (c.kind, w) for k, (c, w) in config.parts.items()} == {"text": ("clap", 0.25), "sound": ("sound_activity", 2.0)}
    rows = pd.DataFrame({"a": [[1.0, 2.0]], "b": [[3.0, 4.0]], "found": [[{"start_s": 0.0, "end_s": 1.0}]], "wanted": [[{"start_s": 0.0, "end_s": 2.0, "token": "+"}]]})
    assert hooks.create(config)(rows).tolist() == [0.25 * 11 + 2 * 0.5]
    assert hooks.create({"kind": "visual", "left": "a", "right": "a"})(rows)[0] == pytest.approx(1.0) and hooks.create(None) is None
    with pytest.raises(ValueError, match="unknown kind"):
        hooks.parse({"kind": "ensemble", "rankers": {"x": [{"kind": "y"}, 1]}})


def test_layers_over_rows(spark):
    draw = np.random.default_rng(1)
    w = {k: draw.normal(size=(4, 4)) for k in ("q", "k", "v", "o", "cq", "ck", "cv", "co", "gate", "up", "down")} | {"modulation": draw.normal(size=24)}
    x, c = draw.normal(size=(3, 4)), draw.normal(size=(2, 4))
    rows = spark.createDataFrame([(1, x.ravel().tolist(), c.ravel().tolist())], "id int, x array<double>, c array<double>")
    got = hooks.layered(rows, layers.block, ["x", "c"], "y", 4, {"w": w}, heads=2).first().y
    assert got == pytest.approx(layers.block(x, c, w, 2).ravel().tolist())
