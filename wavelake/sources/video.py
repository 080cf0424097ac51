"""Video as rows: frames nearest to the times of audio frames. A decoder is injected; times, resampling and masks are done here."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: Bytes and a time range to the frames' times in seconds, and the frames as rows of figures.
Decoder = Callable[[bytes, float, float | None], tuple[np.ndarray, np.ndarray]]


def nearest_frames(times: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of the frame nearest to each wanted time, the first of equally near ones; ``times`` need no order."""
    order = np.argsort(times, kind="stable")
    at = np.searchsorted(times[order], wanted)
    left, right = order[np.maximum(at - 1, 0)], order[np.minimum(at, len(times) - 1)]
    gap_left, gap_right = np.abs(times[left] - wanted), np.abs(times[right] - wanted)
    best = np.where((gap_left < gap_right) | ((gap_left == gap_right) & (left < right)), left, right)
    first: dict[float, int] = {}
    for i, t in enumerate(times.tolist()):  # of several frames at one time the first
        first.setdefault(t, i)
    return np.array([first[t] for t in times[best].tolist()], int)


def resampled_mask(mask: np.ndarray, frames: int) -> np.ndarray:
    """A mask's frames spread evenly over another number of frames."""
    return mask if len(mask) == frames else mask[np.rint(np.linspace(0, len(mask) - 1, frames)).astype(int)]


def aligned(rows: DataFrame, media: DataFrame, decode: Decoder, hop: int = 1920, rate: int = 48000) -> DataFrame:
    """Rows with path, start_s, end_s and size (audio frames), and ``frames``: for each audio frame the nearest video frame in time.

    ``media`` has path and content. A file that can't be decoded gives null and its error.
    """
    schema = ", ".join([f"`{n}` {t}" for n, t in rows.dtypes] + ["frames array<array<double>>", "error string"])
    names = rows.columns

    def one(content, start, end, size):
        try:
            times, frames = decode(bytes(content), 0.0 if pd.isna(start) else start, None if end is None or pd.isna(end) else end)
            picked = nearest_frames(np.asarray(times, float), np.arange(size) * hop / rate)
            return [x.astype(float).tolist() for x in np.asarray(frames).reshape(len(times), -1)[picked]], None
        except Exception as e:  # noqa: BLE001  any broken file is reported in its row
            return None, f"{type(e).__name__}: {e}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in batches:
            out = [one(*x) for x in zip(some.content, some.start_s, some.end_s, some["size"], strict=True)]
            yield some[names].assign(frames=[f for f, _ in out], error=[e for _, e in out])

    return rows.join(media.select("path", "content"), "path", "left").mapInPandas(run, schema)
