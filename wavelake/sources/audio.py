"""Audio as rows: PCM WAV files in, waveforms as arrays of floats; and back. Other codecs plug in as a decoder."""

from __future__ import annotations

import io
import threading
import wave
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes and a time range (the end None: to the end) to samples by channel and their rate.
Decoder = Callable[[bytes, float, float | None], tuple[np.ndarray, int]]


def decode_wav(content: bytes, start_s: float = 0.0, end_s: float | None = None) -> tuple[np.ndarray, int]:
    """Samples in [-1, 1] by channel, and the rate; 8, 16 and 32 bits. Only the time range is read."""
    with wave.open(io.BytesIO(content)) as f:
        width, channels, rate, n = f.getsampwidth(), f.getnchannels(), f.getframerate(), f.getnframes()
        first = min(n, max(0, int(start_s * rate)))
        last = n if end_s is None else min(n, max(first, int(end_s * rate)))
        f.setpos(first)
        data = f.readframes(last - first)
    if width == 1:
        x = (np.frombuffer(data, np.uint8).astype(np.float32) - 128) / 128
    else:
        x = np.frombuffer(data, {2: np.int16, 4: np.int32}[width]).astype(np.float32) / float(1 << (8 * width - 1))
    return x.reshape(-1, channels).T, rate


def encode_wav(samples: np.ndarray, rate: int) -> bytes:
    """16-bit mono WAV."""
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes((np.clip(samples, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def resampled(x: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Linear interpolation; a better filter can be plugged in with the decoder."""
    if rate == to or not len(x):
        return x
    n = -(-len(x) * to // rate)
    return np.interp(np.arange(n) * rate / to, np.arange(len(x)), x).astype(np.float32)


def wav_duration(content: bytes) -> float | None:
    """Seconds by the header alone; None if it says nothing."""
    try:
        with wave.open(io.BytesIO(content)) as f:
            return f.getnframes() / f.getframerate() or None
    except Exception:  # noqa: BLE001  an unreadable file has no duration
        return None


def durations(spark: SparkSession, path: str, duration: Callable[[bytes], float | None] = wav_duration) -> DataFrame:
    """Path and seconds of each file, null where it can't be told; nothing is decoded."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield pd.DataFrame({"path": rows.path, "duration_s": [duration(bytes(c)) for c in rows.content]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, duration_s double")


def sliced(rows: DataFrame, media: DataFrame, rate: int = 48000, decode: Decoder = decode_wav) -> DataFrame:
    """Rows with path, start_s and end_s (null: to the end) and mono ``samples`` at ``rate`` of that range, from ``media`` (path, content).

    A file is decoded for each of its ranges, and only there. A path without a file, or one that can't be decoded, gives null and its error.
    """
    names = rows.columns
    schema = ", ".join([f"`{n}` {t}" for n, t in rows.dtypes] + ["samples array<float>", "error string"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in batches:
            out = [_mono(c, decode, s, e, rate) for c, s, e in zip(some.content, some.start_s, some.end_s, strict=True)]
            yield some[names].assign(samples=[x for x, _ in out], error=[e for _, e in out])

    return rows.join(media.select("path", "content"), "path", "left").mapInPandas(run, schema)


def _mono(content, decode: Decoder, start_s: float, end_s: float | None, rate: int) -> tuple[np.ndarray | None, str | None]:
    if content is None:
        return None, "FileNotFoundError: no such file"
    try:
        x, own = decode(bytes(content), 0.0 if pd.isna(start_s) else start_s, None if end_s is None or pd.isna(end_s) else end_s)
        return resampled(x.mean(0), own, rate).astype(float), None
    except Exception as e:  # noqa: BLE001  any broken file is reported in its row
        return None, f"{type(e).__name__}: {e}"


def padded_batch(signals: list[np.ndarray], hop: int) -> tuple[np.ndarray, np.ndarray]:
    """Signals of one batch with zeros up to whole frames of the longest, and the mask of frames that each has."""
    frames = [-(-len(x) // hop) for x in signals]
    most = max(frames, default=0)
    batch = np.stack([np.pad(np.asarray(x, float), (0, most * hop - len(x))) for x in signals]) if signals else np.zeros((0, 0))
    return batch, np.arange(most)[None] < np.array(frames, int)[:, None]


def waveforms(spark: SparkSession, path: str, rate: int = 48000, decode: Decoder = decode_wav, start_s: float = 0.0, end_s: float | None = None) -> DataFrame:
    """One row for each file: mono samples at ``rate`` (channel mean) of a time range. A file that can't be decoded gives a null and its error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for path, content in zip(rows.path, rows.content, strict=True):
                x, error = _mono(content, decode, start_s, end_s, rate)
                out.append((path, x, None if x is None else len(x), None if x is None else len(x) / rate, error))
            yield pd.DataFrame(out, columns=["path", "samples", "n_samples", "duration_s", "error"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(run, "path string, samples array<float>, n_samples long, duration_s double, error string")


def require_rate(rows: DataFrame, rate: int) -> DataFrame:
    """The rows; another sampling rate is an error."""
    return rows.where(F.assert_true(F.col("rate") == rate, F.lit(f"audio must have {rate} samples a second")).isNull())


class ArtifactWriter:
    """Writes results as WAV files in a local folder, in the background: name_target.wav and name_residual.wav for the first ``most``.

    Its ``save`` can be a batcher's completion callback. ``close`` waits for all files and raises the first error.
    """

    def __init__(self, folder: str, most: int, rate: int = 48000, workers: int = 2):
        self.folder, self.most, self.rate = Path(folder), most, rate
        self.folder.mkdir(parents=True, exist_ok=True)
        self._pool, self._files, self._lock = ThreadPoolExecutor(workers), [], threading.Lock()

    def save(self, name: str, target: np.ndarray, residual: np.ndarray) -> bool:
        """False if there are ``most`` already."""
        with self._lock:
            if len(self._files) >= 2 * self.most:
                return False
            for kind, samples in (("target", target), ("residual", residual)):
                path = self.folder / f"{name}_{kind}.wav"
                self._files.append((path, self._pool.submit(path.write_bytes, encode_wav(np.asarray(samples, np.float32), self.rate))))
        return True

    def close(self) -> list[str]:
        self._pool.shutdown()
        for _, done in self._files:
            done.result()
        return [str(path) for path, _ in self._files]


def save_results(results: DataFrame, folder: str, most: int, rate: int = 48000) -> list[str]:
    """WAV files of the first ``most`` results (name, target, residual) by name."""
    writer = ArtifactWriter(folder, most, rate)
    for r in results.orderBy("name").limit(most).collect():
        writer.save(r["name"], r["target"], r["residual"])
    return writer.close()


def write_wavs(rows: DataFrame, folder: str, rate: int = 48000) -> DataFrame:
    """Encodes (name, samples) to WAV and writes (name, wav) rows as Parquet, which every executor can; returns what was written."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in batches:
            yield pd.DataFrame({"name": some.name, "wav": [encode_wav(np.asarray(x, np.float32), rate) for x in some.samples]})

    rows.select("name", "samples").mapInPandas(run, "name string, wav binary").write.mode("overwrite").parquet(folder)
    return rows.sparkSession.read.parquet(folder)
