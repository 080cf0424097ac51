"""Measured runs and the evaluation command."""

import json
import sys
import types

from pyspark.sql import functions as F

from wavelake import evaluate, runs


def test_run_until(spark):
    def action(stages):
        with stages.timed("work"):
            sum(range(1000))

    rows = runs.run_until(action, "r", least_runs=4, least_seconds=0)
    assert [r["phase"] for r in rows] == ["cold"] + ["warm"] * 4 and all(r["stage_ms"]["work"] >= 0 for r in rows)
    got = {r.phase: r.runs for r in runs.summary(spark, rows).collect()}
    assert got == {"cold": 1, "warm": 4}
    failed = runs.run_until(lambda s: 1 / 0, "r")
    assert [(r["phase"], r["status"]) for r in failed] == [("cold", "error")]


def test_stages_have_their_own_times(spark, tmp_path):
    steps = {"encoding": lambda rows: rows.withColumn("x", F.col("signal") * 2), "reranking": lambda rows: rows.where("x > 2")}

    def action(stages):
        rows = spark.createDataFrame([(1, 1.0), (2, 2.0)], "request long, signal double")
        assert [r.request for r in runs.in_stages(rows, steps, stages, str(tmp_path)).collect()] == [2]

    got = runs.summary(spark, runs.run_until(action, "r", least_runs=1, least_seconds=0)).where("phase = 'warm'").first()
    assert got.mean_encoding_ms > 0 and got.mean_reranking_ms > 0 and got.mean_audio_decoding_ms is None


def test_file_cascade(spark, tmp_path):
    stage = lambda rows, seed: rows.select("request", (F.col("signal") / 2 + seed).alias("target"), (F.col("signal") / 2 - seed).alias("residual"))
    got = runs.file_cascade(spark.createDataFrame([(1, 8.0)], "request long, signal double"), stage, str(tmp_path / "one")).first()
    assert tuple(got) == (1, 4.0, 4.0, 3.0, 1.0)


def test_evaluate(spark, tmp_path, monkeypatch):
    rows = [(1, "x", [2.0, 2.0], ["others-50:text-only"]), (2, "y", [9.0], ["instr-50:text-only"])]
    spark.createDataFrame(rows, "request long, description string, signal array<double>, paper_eval_sets array<string>").write.parquet(str(tmp_path / "bench.parquet"))
    fake = types.ModuleType("fake_models")

    def make():
        return lambda x, text, seed: (x * 2, x)

    make.__module__ = "__main__"  # travels by value
    fake.make = make
    monkeypatch.setitem(sys.modules, "fake_models", fake)
    monkeypatch.chdir(tmp_path)
    assert evaluate.main(["-s", "sfx", "-p", "fake_models:make", "--cache-path", str(tmp_path), "-c", "1"], spark) == {"sfx": {"level": "4.000"}}
    assert json.loads((tmp_path / "results/sfx.json").read_text()) == {"level": "4.000"}
    assert evaluate.settings(spark).count() == 14 and len(runs.MATRIX) == 11
