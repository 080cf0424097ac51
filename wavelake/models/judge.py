"""What a judge model takes: texts, recordings and separated tracks as one batch, from files or from arrays."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from pathlib import Path

import numpy as np
import pandas as pd

from ..sources import audio

Loader = Callable[[str, int], np.ndarray]


def load_wav(path: str, rate: int) -> np.ndarray:
    """Mono samples of a file at ``rate``."""
    samples, own = audio.decode_wav(Path(path).read_bytes())
    return audio.resampled(samples.mean(0), own, rate)


def ingested(tracks: str | Sequence, rate: int, hop: int, given_rate: int | None = None, load: Loader = load_wav) -> tuple[np.ndarray, np.ndarray]:
    """Tracks as (track, sample) with zeros after each, and the mask of its samples. Paths are loaded at ``rate``; arrays must have it.

    Each track is first reflected at its end to whole frames.
    """
    if given_rate is not None and given_rate != rate:
        raise ValueError(f"tracks must have {rate} samples a second, not {given_rate}")
    each = [tracks] if isinstance(tracks, str) or (isinstance(tracks, np.ndarray) and tracks.ndim == 1) else list(tracks)
    signals = []
    for x in each:
        x = load(x, rate) if isinstance(x, str) else np.asarray(x, float)
        x = x[0] if x.ndim == 2 and len(x) == 1 else x
        if x.ndim != 1:
            raise ValueError(f"a track has one channel, not the shape {x.shape}")
        signals.append(np.pad(x, (0, -len(x) % hop), "reflect") if len(x) else x)
    most = max(map(len, signals), default=0)
    batch = np.stack([np.pad(x, (0, most - len(x))) for x in signals]) if signals else np.zeros((0, 0))
    return batch, np.arange(most)[None] < np.array([len(x) for x in signals], int)[:, None]


def processor(rate: int, hop: int, tokens: Callable[[list[str]], dict[str, np.ndarray]], most_tokens: int = 512, load: Loader = load_wav) -> Callable[[pd.DataFrame], dict[str, np.ndarray]]:
    """A function from a frame with description, input and separated to a judge's batch; ``tokens`` maps texts to arrays of one row each."""
    def process(rows: pd.DataFrame) -> dict[str, np.ndarray]:
        batch = {k: v[:, :most_tokens] for k, v in tokens(rows.description.tolist()).items()}
        batch["input_values"], batch["padding_mask"] = ingested(rows["input"].tolist(), rate, hop, load=load)
        batch["separated_values"] = ingested(rows.separated.tolist(), rate, hop, load=load)[0]
        return batch

    return process


def ranker_model(process: Callable[[pd.DataFrame], dict], model: Callable[[dict], dict[str, np.ndarray]]) -> Callable[[pd.DataFrame], dict[str, np.ndarray]]:
    """What the ``judge`` ranker and the metrics take: a frame's rows (a candidate each) to the judge's named figures."""
    return lambda rows: model(process(rows))
