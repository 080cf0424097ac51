"""Evaluation of an injected model over a benchmark table: ``python -m wavelake.evaluate -s sfx -p my_models:make``.

The table under --cache-path is ``<dataset>.parquet`` with request, description, signal, paper_eval_sets and whatever the metrics read; or,
in place of signal, the path of a media file under --cache-path with start_s and end_s, of which only that range is decoded. The
checkpoint names a Python function that makes the model; an optional second one, after a comma, makes the metrics (name to function).
"""

from __future__ import annotations

import argparse
import importlib
import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .models import hooks
from .operators import filters, reports
from .sources import audio

#: Settings: dataset, span prompts, visual prompts, subset; fixed values.
SETTINGS = {
    "sfx": ("bench", False, False, "others-50:text-only"),
    "speech": ("bench", False, False, "speech-clean-50:text-only"),
    "speaker": ("bench", False, False, "spk-50:text-only"),
    "music": ("bench", False, False, "music-clean-50:text-only"),
    "instr-wild": ("bench", False, False, "instr-50:text-only"),
    "instr-pro": ("mixtures", None, None, None),
    "sfx-span": ("bench", True, False, "others-50:text+span"),
    "speech-span": ("bench", True, False, "speech-clean-50:text+span"),
    "speaker-span": ("bench", True, False, "spk-50:text+span"),
    "music-span": ("bench", True, False, "music-clean-50:text+span"),
    "instr-wild-span": ("bench", True, False, "instr-50:text+span"),
    "sfx-visual": ("bench", False, True, "others-onscreen-50:visual-only"),
    "speaker-visual": ("bench", False, True, "spk-onscreen-50:visual-only"),
    "instr-wild-visual": ("bench", False, True, "instr-onscreen-50:visual-only"),
}


def settings(spark: SparkSession) -> DataFrame:
    """The settings as a dimension table."""
    return spark.createDataFrame([(k, *v) for k, v in SETTINGS.items()], "setting string, dataset string, span boolean, visual boolean, subset string")


def rows_of(table: DataFrame, setting: str) -> DataFrame:
    """The rows of a setting's subset."""
    subset = SETTINGS[setting][3]
    is_list = dict(table.dtypes).get("paper_eval_sets", "").startswith("array")
    return table if subset is None else table.where(filters.in_subset(F.col("paper_eval_sets"), subset, is_list))


def with_signals(rows: DataFrame, folder: str, rate: int = 48000, decode: audio.Decoder = audio.decode_wav) -> DataFrame:
    """The rows with mono samples of their media ranges; an unreadable one is an error."""
    if "signal" in rows.columns:
        return rows
    # only files that the rows name are read
    files = rows.sparkSession.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.wav").load(folder)
    files = files.withColumn("path", F.substring_index("path", "/", -1))
    got = audio.sliced(rows.withColumn("path", F.substring_index("path", "/", -1)), files, rate, decode)
    sound = F.assert_true(F.col("error").isNull(), F.concat(F.col("path"), F.lit(": "), F.col("error")))
    return got.where(sound.isNull()).drop("error").withColumnRenamed("samples", "signal")


def evaluated(rows: DataFrame, factory, metrics: dict, columns: list[str], candidates: int = 8, scorer=None) -> DataFrame:
    """One row: the mean of each figure over the setting's rows."""
    results = rows.join(hooks.separate(rows.select("request", "description", "signal"), factory, scorer, candidates), "request")
    measured = hooks.measured(results, metrics, columns)
    return measured.agg(*[reports.mean(F.col(c)).alias(c) for c in columns])


def _named(path: str):
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


def _level() -> dict:
    """A metric that needs no model: root mean square of the target."""
    import numpy as np
    import pandas as pd

    return {"level": lambda p: {"level": pd.Series([float(np.sqrt(np.mean(np.square(t)))) if len(t) else 0.0 for t in p.target], p.index)}}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--setting", "-s", nargs="+", choices=list(SETTINGS), default=["instr-pro"])
    p.add_argument("--cache-path", default=os.path.expanduser("~/.cache/wavelake"))
    p.add_argument("--checkpoint-path", "-p", required=True, help="module:function[,module:function]")
    p.add_argument("--batch-size", "-b", type=int, default=1, help="rows of an Arrow batch")
    p.add_argument("--num-workers", "-w", type=int, default=4, help="partitions")
    p.add_argument("--candidates", "-c", type=int, default=8)
    return p


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> dict[str, dict[str, str]]:
    opt = parser().parse_args(args)
    spark = spark or SparkSession.builder.getOrCreate()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(max(1, opt.batch_size)))
    model, _, metrics = opt.checkpoint_path.partition(",")
    metrics = _named(metrics)() if metrics else _level()
    out = {}
    for setting in opt.setting:
        table = spark.read.parquet(f"{opt.cache_path}/{SETTINGS[setting][0]}.parquet").repartition(max(1, opt.num_workers))
        got = evaluated(with_signals(rows_of(table, setting), opt.cache_path), _named(model), metrics, list(metrics), opt.candidates).first().asDict()
        out[setting] = {k: f"{v:.3f}" if v is not None else "" for k, v in got.items()}
        os.makedirs("results", exist_ok=True)
        with open(f"results/{setting}.json", "w") as f:
            print(json.dumps(out[setting]), file=f)
    return out


if __name__ == "__main__":
    main()
