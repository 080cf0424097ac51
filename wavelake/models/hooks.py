"""Extension points: rankers, metrics and separation models as vectorised functions.

A ranker maps a pandas frame with (request, cand_idx, ...) to one score a row, a metric maps rows to named columns, a model maps waveforms
to target and residual. They run in Arrow batches on the executors; a factory makes each worker's own instance, once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from typing import Any, Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import alignment, ranking


class Ranker(Protocol):
    def __call__(self, rows: pd.DataFrame) -> pd.Series: ...


class Model(Protocol):
    def __call__(self, signal: np.ndarray, description: str, seed: int) -> tuple[np.ndarray, np.ndarray]: ...


class StepModel(Protocol):
    """A model whose work is done in steps: states are arrays of floats, and a step takes a whole batch."""

    def begin(self, signal: np.ndarray, description: str, seed: int) -> np.ndarray: ...

    def step(self, states: list[np.ndarray], signals: list[np.ndarray], descriptions: list[str], index: int, steps: int) -> list[np.ndarray]: ...

    def end(self, state: np.ndarray, signal: np.ndarray, description: str) -> tuple[np.ndarray, np.ndarray]: ...


class Encoder(Protocol):
    """Text, vision or audio encoder: one array of floats for each row of a frame."""

    def __call__(self, rows: pd.DataFrame) -> list[np.ndarray]: ...


class Codec(Protocol):
    def encode(self, samples: np.ndarray) -> np.ndarray: ...

    def decode(self, frames: np.ndarray) -> np.ndarray: ...


RANKERS: dict[str, Callable[[Mapping[str, Any]], Any]] = {}
_LIVE: dict[Any, Any] = {}


def ranker(kind: str):
    """Registers a factory for configurations of this kind."""
    def add(factory):
        RANKERS[kind] = factory
        return factory

    return add


@dataclass(frozen=True)
class RankerConfig:
    """A kind with its settings; an ensemble has parts with weights."""

    kind: str
    settings: Mapping[str, Any] = field(default_factory=dict)
    parts: Mapping[str, tuple[RankerConfig, float]] = field(default_factory=dict)


def parse(config: Mapping[str, Any]) -> RankerConfig:
    """A configuration from plain values: ``kind`` and its settings; an unknown kind is an error. An ensemble's rankers are pairs of
    configuration and weight, or objects of ``ranker`` and ``weight``."""
    kind = config.get("kind")
    if kind not in RANKERS:
        raise ValueError(f"unknown kind of ranker: {kind}")
    settings = {k: v for k, v in config.items() if k != "kind"}
    pairs = {name: (p["ranker"], p["weight"]) if isinstance(p, Mapping) else p for name, p in settings.pop("rankers", {}).items()} if kind == "ensemble" else {}
    return RankerConfig(kind, settings, {name: (parse(c), float(w)) for name, (c, w) in pairs.items()})


def create(config: Mapping[str, Any] | RankerConfig | None):
    """The ranker of a configuration, or None for none."""
    if config is None:
        return None
    config = config if isinstance(config, RankerConfig) else parse(config)
    return RANKERS[config.kind](config.settings if config.kind != "ensemble" else config)


@ranker("ensemble")
def _ensemble(config: RankerConfig):
    parts = {name: (create(c), w) for name, (c, w) in config.parts.items()}
    return lambda rows: sum(w * r(rows) for r, w in parts.values())


@ranker("clap")  # text and audio embeddings, which the encoders have normalised
@ranker("dot")
def _dot(config: Mapping[str, Any]):
    left, right = config.get("left", "embedding"), config.get("right", "query")
    return lambda rows: pd.Series([float(np.dot(a, b)) for a, b in zip(rows[left], rows[right], strict=True)], rows.index, float)


@ranker("visual")  # video and audio embeddings
@ranker("cosine")
def _cosine(config: Mapping[str, Any]):
    left, right = config.get("left", "embedding"), config.get("right", "query")
    return lambda rows: pd.Series([float(np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b))) for a, b in zip(rows[left], rows[right], strict=True)], rows.index, float)


@ranker("sound_activity")
def _sound_activity(config: Mapping[str, Any]):
    """IoU of found and wanted spans of each candidate; ``ignore_negative`` leaves out wanted spans of sign -."""
    metric, positive = config.get("metric", "iou"), config.get("ignore_negative", False)

    def score(rows: pd.DataFrame) -> pd.Series:
        out = []
        for found, wanted in zip(rows.found, rows.wanted, strict=True):
            wanted = [w for w in wanted if not (positive and w["token"] == "-")]
            both = sum(max(0.0, min(f["end_s"], w["end_s"]) - max(f["start_s"], w["start_s"])) for f in found for w in wanted)
            a, b = (sum(s["end_s"] - s["start_s"] for s in x) for x in (found, wanted))
            under = {"iou": a + b - both, "recall": b, "precision": a}[metric]
            out.append(both / under if under > 0 else 0.0)
        return pd.Series(out, rows.index, float)

    return score


@ranker("judge")
def _judge(config: Mapping[str, Any]):
    """A figure of an injected judge, which maps a frame to named columns; the overall one unless another is asked for."""
    model, column = config["model"], config.get("column", "JudgeOverall")
    return lambda rows: pd.Series(model(rows)[column], rows.index, float)


class Shared:
    """A factory whose product each worker makes once and keeps for later tasks, such as a model with its weights."""

    def __init__(self, factory: Callable[[], Any]):
        self.factory, self.key = factory, uuid.uuid4().hex

    def __call__(self) -> Any:
        if self.key not in _LIVE:
            _LIVE[self.key] = self.factory()
        return _LIVE[self.key]


def shared(factory: Callable[[], Any]) -> Shared:
    return factory if isinstance(factory, Shared) else Shared(factory)


def ranked(candidates: DataFrame, config: Mapping[str, Any]) -> DataFrame:
    """(request, cand_idx, score) by the configured ranker."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = create(config)
        for rows in batches:
            yield pd.DataFrame({"request": rows.request, "cand_idx": rows.cand_idx, "score": score(rows)})

    return candidates.mapInPandas(run, "request long, cand_idx int, score double")


def measured(rows: DataFrame, metrics: Mapping[str, Callable[[pd.DataFrame], Mapping[str, pd.Series]]], columns: list[str]) -> DataFrame:
    """The rows with a column for each figure of the metrics."""
    schema = ", ".join([f"`{n}` {t}" for n, t in rows.dtypes] + [f"`{c}` double" for c in columns])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in batches:
            figures = {k: v for m in metrics.values() for k, v in m(some).items()}
            yield some.assign(**{c: figures[c] for c in columns})

    return rows.mapInPandas(run, schema)


def encoded(rows: DataFrame, factory: Callable[[], Encoder], inputs: list[str], output: str, chunk: int = 0) -> DataFrame:
    """The rows with an encoder's array as column ``output``; it sees ``inputs``, ``chunk`` rows at a time (0: an Arrow batch)."""
    make = shared(factory)
    schema = ", ".join([f"`{n}` {t}" for n, t in rows.dtypes if n != output] + [f"`{output}` array<double>"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = make()
        for some in batches:
            for at in range(0, len(some), chunk or max(1, len(some))):
                part = some.iloc[at : at + (chunk or len(some))]
                yield part.drop(columns=output, errors="ignore").assign(**{output: [np.asarray(x, float) for x in encoder(part[inputs])]})

    return rows.mapInPandas(run, schema)


def layered(rows: DataFrame, layer: Callable[..., np.ndarray], inputs: list[str], output: str, width: int, weights: Mapping[str, np.ndarray] | None = None, **settings) -> DataFrame:
    """The rows with a layer's result as column ``output``: ``inputs`` are flat (time, width) arrays, of which the layer takes one each.

    The weights travel once to each executor; their size is the layer's, whatever the rows.
    """
    shipped = rows.sparkSession.sparkContext.broadcast(dict(weights or {}))

    def make() -> Encoder:
        return lambda part: [layer(*(np.asarray(x, float).reshape(-1, width) for x in row), **shipped.value, **settings).ravel() for row in part[inputs].itertuples(index=False)]

    return encoded(rows, make, inputs, output)


STEP = "request long, cand_idx int, description string, signal array<double>, seed long, state array<double>, index int, steps int"


def advanced(rows: DataFrame, factory: Callable[[], Model | StepModel]) -> DataFrame:
    """One step of each row of STEP: its next state and, after the last step, target and residual. A model without steps does all in the last."""
    make = shared(factory)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for some in batches:
            out: list[list] = [[None] * len(some) for _ in range(3)]
            signals = [np.asarray(x, float) for x in some.signal]
            last = [i + 1 >= n for i, n in zip(some["index"], some.steps, strict=True)]
            if hasattr(model, "step"):
                states = [model.begin(x, d, int(s)) if i == 0 else np.asarray(old, float) for x, d, s, i, old in zip(signals, some.description, some.seed, some["index"], some.state, strict=True)]
                for (index, steps), part in some.reset_index(drop=True).groupby(["index", "steps"]):
                    at = part.index.tolist()
                    for k, state in zip(at, model.step([states[k] for k in at], [signals[k] for k in at], part.description.tolist(), int(index), int(steps)), strict=True):
                        out[0][k] = np.asarray(state, float)
                        if last[k]:
                            out[1][k], out[2][k] = (np.asarray(y, float) for y in model.end(out[0][k], signals[k], some.description.iloc[k]))
            else:
                for k in np.flatnonzero(last):
                    out[1][k], out[2][k] = (np.asarray(y, float) for y in model(signals[k], some.description.iloc[k], int(some.seed.iloc[k])))
            yield pd.DataFrame({"request": some.request.to_numpy(), "cand_idx": some.cand_idx.to_numpy(), "state": out[0], "target": out[1], "residual": out[2]})

    return rows.mapInPandas(run, "request long, cand_idx int, state array<double>, target array<double>, residual array<double>")


def separated(requests: DataFrame, factory: Callable[[], Model]) -> DataFrame:
    """Target and residual of each (request, cand_idx, description, signal, seed), by the injected model."""
    make = shared(factory)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for rows in batches:
            both = [model(np.asarray(x, float), d, int(s)) for x, d, s in zip(rows.signal, rows.description, rows.seed, strict=True)]
            yield pd.DataFrame({"request": rows.request, "cand_idx": rows.cand_idx, "target": [np.asarray(t, float) for t, _ in both], "residual": [np.asarray(r, float) for _, r in both]})

    return requests.select("request", "cand_idx", "description", "signal", "seed").mapInPandas(run, "request long, cand_idx int, target array<double>, residual array<double>")


def separate(requests: DataFrame, factory: Callable[[], Model], scorer: Callable[[DataFrame], DataFrame] | None = None, candidates: int = 1, seed: int = 0) -> DataFrame:
    """Fan-out, separation, ranking and choice: (request, cand_idx, target, residual). Seeds are a hash of request and candidate, whatever the order."""
    fanned = ranking.fan_out(requests, candidates).withColumn("seed", F.pmod(F.xxhash64(F.lit(seed), "request", "cand_idx"), F.lit(1 << 31)))
    made = separated(fanned, factory)
    if scorer is None or candidates <= 1:
        return made.where("cand_idx = 0")
    return made.join(ranking.selected(scorer(made)).select("request", "cand_idx"), ["request", "cand_idx"], "left_semi")


def activity_scores(found: DataFrame, wanted: DataFrame) -> DataFrame:
    """Interval scores of requests as a table; see ``alignment.span_scores``."""
    return alignment.span_scores(found, wanted)
