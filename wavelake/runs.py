"""Measured runs: stage times, phases, and loops that go on until they have enough runs and time."""

from __future__ import annotations

import itertools
import time
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from .functions.numbers import rounded
from .operators import reports

ROW = "run_name string, phase string, status string, reason string, total_ms double, stage_ms map<string,double>"

#: Cases of the standard matrix; fixed values. Device settings are kept as labels: Spark has no use for them.
MATRIX = {
    "baseline-fp32": {"dtype_policy": "fp32", "reranking": "4", "predict_spans": True},
    "tf32": {"dtype_policy": "tf32", "reranking": "4", "predict_spans": True},
    "rerank-1": {"dtype_policy": "fp32", "reranking": "1", "predict_spans": True},
    "rerank-8": {"dtype_policy": "fp32", "reranking": "8", "predict_spans": True},
    "fixed-midpoint": {"dtype_policy": "fp32", "reranking": "4", "predict_spans": True, "fixed_midpoint": True},
    "fixed-midpoint-cache": {"dtype_policy": "fp32", "reranking": "4", "predict_spans": True, "fixed_midpoint": True, "cache_conditioning": True},
    "compile-default": {"dtype_policy": "fp32", "reranking": "4", "predict_spans": True, "compile_transformer": "default"},
    "compile-reduce-overhead": {"dtype_policy": "fp32", "reranking": "4", "predict_spans": True, "compile_transformer": "reduce-overhead"},
    "compile-max-autotune": {"dtype_policy": "fp32", "reranking": "4", "predict_spans": True, "compile_transformer": "max-autotune"},
    "sdpa-flash": {"dtype_policy": "fp32", "reranking": "4", "predict_spans": True, "sdpa_backend": "flash"},
    "adaptive-rerank": {"dtype_policy": "fp32", "reranking": "adaptive", "predict_spans": True},
}


class Stages:
    """Milliseconds by stage, added up."""

    def __init__(self):
        self.ms: dict[str, float] = {}

    @contextmanager
    def timed(self, name: str) -> Iterator[None]:
        began = time.perf_counter()
        try:
            yield
        finally:
            self.ms[name] = round(self.ms.get(name, 0.0) + (time.perf_counter() - began) * 1000, 3)


#: Stages of a separation, in order; fixed values.
STAGES = ("encoding", "span_prediction", "ode_generation", "audio_decoding", "reranking")


def in_stages(rows: DataFrame, steps: Mapping[str, Callable[[DataFrame], DataFrame]], stages: Stages, folder: str) -> DataFrame:
    """Runs steps one after another, each written under its name in ``folder`` and read again, so that its time is its own."""
    for name, step in steps.items():
        with stages.timed(name):
            step(rows).write.mode("overwrite").parquet(f"{folder}/{name}")
        rows = rows.sparkSession.read.parquet(f"{folder}/{name}")
    return rows


def run_until(action: Callable[[Stages], None], run_name: str, least_runs: int = 3, least_seconds: float = 60.0, record_warm_up: bool = False) -> list[dict]:
    """Rows of a cold run, a warm-up (recorded if asked) and warm runs until there are enough of both runs and seconds. An error is a row and ends it."""
    rows, began, warm = [], 0.0, 0
    for phase in itertools.chain(("cold", "warmup"), itertools.repeat("warm")):
        if phase == "warm" and not warm:
            began = time.perf_counter()
        stages, since, reason = Stages(), time.perf_counter(), None
        try:
            action(stages)
        except Exception as e:  # noqa: BLE001  a failed run is reported
            reason = f"{type(e).__name__}: {e}"
        total = round((time.perf_counter() - since) * 1000, 3)
        if phase != "warmup" or record_warm_up or reason:
            status = "ok" if reason is None else "oom" if "out of memory" in reason.lower() else "error"
            rows.append({"run_name": run_name, "phase": phase, "status": status, "reason": reason, "total_ms": total, "stage_ms": stages.ms})
        warm += phase == "warm"
        if reason or (warm >= least_runs and time.perf_counter() - began >= least_seconds):
            return rows


def summary(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """The good runs of each name and phase, with the mean of each stage over the runs that have it."""
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(rows, ROW)
    means = {f"mean_{k}_ms": rounded(reports.key_mean(F.col("stage_ms"), k), 3) for k in STAGES}
    return reports.summary(reports.finished(frame, F.col("status")), ["run_name", "phase"], "total_ms", means)


def file_cascade(requests: DataFrame, stage: Callable[[DataFrame, int], DataFrame], folder: str, seed: int = 0) -> DataFrame:
    """A cascade whose first stage goes through files in ``folder``, so the second can be run again alone."""
    from pyspark.sql import functions as F

    stage(requests, seed).write.mode("overwrite").parquet(folder)
    one = requests.sparkSession.read.parquet(folder)
    two = stage(one.select("request", F.col("residual").alias("signal")), seed + 1)
    named = lambda df, n: df.select("request", F.col("target").alias(f"target_{n}"), F.col("residual").alias(f"residual_{n}"))
    return named(one, 1).join(named(two, 2), "request")
