"""Shared pieces of the training-data operators: tables, stage files, word hashing."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MULT = np.uint64(0x9E3779B97F4A7C15)
MIX1, MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
SHIFT = np.uint64(33)
CACHED_WORDS = 300_000
#: Settings of a staged write.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table. Python workers find the package where the driver has it, unless the session names a path or it was shipped."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. Only a local session may do without: it gets a temporary folder, removed at exit."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        at = spark.conf.get("spark.checkpoint.dir", None)
        if at is None:
            if not re.match(r"local(\[|$)", sc.master):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            at = tempfile.mkdtemp(prefix="wavelake-")
            atexit.register(shutil.rmtree, at, ignore_errors=True)
        sc.setCheckpointDir(at)
    return sc.getCheckpointDir()


def staged(df: DataFrame, *over: DataFrame, codec: str | None = None) -> DataFrame:
    """Writes ``df`` as Parquet in the shared folder and reads it back: later steps don't recompute it, and lost executors don't either.

    The write's shuffle files go when it ends, and Python gets small batches in it, by settings that hold for this write only. The tables in
    ``over`` are no longer needed then, so they go too.
    """
    path = _written(df, WRITING, codec)
    drop(*over)
    return _stage(df.sparkSession, df.schema, path)


def dealt(df: DataFrame, by: str, parts: list[int], codec: str | None = None) -> list[DataFrame]:
    """As ``staged``, with a table for each value of the column ``by``, which they don't have any more. Each can be dropped by itself."""
    spark = df.sparkSession
    # a writer for each part is open at a time, so rows need not be sorted by part
    path = _written(df, WRITING | {"spark.sql.maxConcurrentOutputFileWriters": str(len(parts))}, codec, by)
    there = {x.getPath().getName() for x in _files(spark, path).listStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path))}
    schema = df.drop(by).schema
    return [_stage(spark, schema, f"{path}/{by}={k}", f"{by}={k}" in there) for k in parts]


def _written(df: DataFrame, settings: dict[str, str], codec: str | None, by: str | None = None) -> str:
    spark = df.sparkSession
    path, before = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}", {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        # hashes don't repeat enough for a dictionary
        df.write.option("parquet.enable.dictionary#gram", "false").parquet(path, compression=codec, partitionBy=by)
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    return path


def _stage(spark: SparkSession, schema, path: str, there: bool = True) -> DataFrame:
    out = spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)
    out._stage = path
    return out


def drop(*tables: DataFrame) -> None:
    """Removes staged tables that no result needs any more."""
    for df in tables:
        _remove(df.sparkSession, df._stage)


def clear(spark: SparkSession) -> None:
    """Removes all staged tables of the session; results that were not written by then can't be computed any more."""
    _remove(spark, shared_dir(spark))


def _remove(spark: SparkSession, path: str) -> None:
    _files(spark, path).delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path), True)


def _files(spark: SparkSession, path: str):
    """The file system that has the path."""
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it appears there."""
    return F.element_at(F.transform(F.array(value), use), 1)


def free(df: DataFrame, name: str) -> str:
    """The name, with underscores after it while ``df`` has a column called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of a few rows, so that what Python makes of long texts stays small in memory."""
    for b in batches:
        for at in range(0, len(b), rows):
            yield b.slice(at, rows)


def text_bytes(df: DataFrame) -> int:
    """Bytes of all texts, by one narrow scan."""
    return int(df.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


class WordHashes(dict):
    """64-bit hash of a word (bytes); keeps the recent ones, forgets all when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
GROUP = 1 << 19
_draw = np.random.default_rng(7)
#: Figures of bytes, and of places in a word; a later place repeats an earlier one with another odd factor.
BYTES, PLACES = (_draw.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1) for n in (256, 1024))


def word_hashes(texts: list[str | None]) -> list[np.ndarray]:
    """64-bit hashes of each text's words, in order, all texts at once: sums over a word's bytes of a figure of the byte times one of its place."""
    raw = [(t or "").encode() for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    space = SPACE[data]
    edges = np.flatnonzero(np.diff(space, prepend=True))
    first, size = edges[0::2], edges[1::2] - edges[0::2]
    if not len(first):
        return [np.empty(0, np.uint64)] * len(raw)
    upto = np.cumsum(size)
    # some hundred thousand bytes at a time, whole words, so a long text takes little more memory than its bytes
    groups = [0, *np.unique(np.searchsorted(upto, np.arange(GROUP, int(upto[-1]), GROUP)) + 1).tolist()]
    groups = [*(g for g in groups if g < len(size)), len(size)]
    sums = []
    for i, j in zip(groups, groups[1:], strict=False):
        own = size[i:j]
        begin, lo, hi = np.cumsum(own) - own, int(first[i]), int(first[j - 1] + size[j - 1])
        place = np.arange(int(own.sum())) - np.repeat(begin, own)
        figure = BYTES[data[lo:hi][~space[lo:hi]]] * PLACES[place & 1023]
        if own.max() > 1024:
            figure *= (place >> 10).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        sums.append(np.add.reduceat(figure, begin))
    out = mixed(np.concatenate(sums) + size.astype(np.uint64) * MULT)
    return np.split(out, np.searchsorted(first, np.cumsum([len(x) + 1 for x in raw])[:-1]))


#: Masks that leave so many bytes of eight.
FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def flat_word_hashes(texts: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, in order, and each text's number of words.

    A word is read eight bytes at a time, all words at once; those of more than 64 bytes are hashed one by one. Other hashes than ``word_hashes`` gives.
    """
    hashes, counts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for some in texts:
        for k in range(0, len(some), 500):
            few = some.slice(k, 500).fill_null("").cast(pa.large_binary())
            bounds = np.frombuffer(few.buffers()[1], np.int64)[few.offset : few.offset + len(few) + 1]
            raw = np.frombuffer(few.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
            bounds = bounds - bounds[0]
            data = np.zeros(len(raw) + 8, np.uint8)
            data[:-8] = raw
            word = (raw != 0x20) & (raw - np.uint8(0x09) > 4)
            # a word ends before white space and at its text's end
            cut = np.zeros(len(raw) + 1, bool)
            cut[bounds] = True
            first = np.flatnonzero(word & (cut[:-1] | ~np.concatenate([[False], word[:-1]])))
            size = np.flatnonzero(word & (cut[1:] | ~np.concatenate([word[1:], [False]]))) + 1 - first
            counts.append(np.diff(np.searchsorted(first, bounds)))
            eight = np.ndarray(len(raw) + 1, "<u8", data, strides=(1,))
            h = mixed((eight[first] & FIRST_BYTES[np.minimum(size, 8)]) + size.astype(np.uint64) * MULT)
            more, at = np.flatnonzero(size > 8), 8
            while len(more) and at < 64:
                h[more] = mixed(h[more] * MULT + (eight[first[more] + at] & FIRST_BYTES[np.minimum(size[more] - at, 8)]))
                at += 8
                more = more[size[more] > at]
            for i in more.tolist():
                h[i] = xxhash.xxh3_64_intdigest(data[first[i] : first[i] + size[i]])
            hashes.append(h)
    return np.concatenate(hashes), np.concatenate(counts)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly."""
    x = x ^ (x >> SHIFT)
    x = x * MIX1
    x ^= x >> SHIFT
    x *= MIX2
    x ^= x >> SHIFT
    return x


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` words, by each run's start; none if there are fewer words."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    acc = h[:m].copy()
    for i in range(1, n):
        acc *= MULT
        acc += h[i : i + m]
    return mixed(acc)


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 15)
        inverse = np.uint64(pow(int(MULT), -1, 1 << 64))
        up, down = np.full(size, MULT), np.full(size, inverse)
        up[0] = down[0] = 1
        _POWERS[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _POWERS[0][:n], _POWERS[1][:n]


def long_grams(h: np.ndarray, n: int) -> np.ndarray:
    """As ``grams``, for long runs: differences of prefix sums modulo 2**64."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    up, down = _powers(len(h))
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up, out=total[1:])
    return mixed((total[n:] - total[:m]) * down[:m])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of ``w`` values, by doubling."""
    have, out = 1, x
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows of Arrow batches as Python values, column by column."""
    for b in small(batches):
        yield from zip(*(b.column(b.schema.get_field_index(n)).to_pylist() for n in names), strict=True)


def by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Slices of the sorted batches with one block and kind."""
    for b in batches:
        if len(b):
            block, kind = np.asarray(b.column("block")), np.asarray(b.column("kind"))
            edge = np.flatnonzero((np.diff(block) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip([0, *edge], [*edge, len(b)], strict=True):
                yield int(block[lo]), int(kind[lo]), b.slice(lo, hi - lo)
