"""Quality rules: base word rules, then a calibrated logistic regression over hashed n-grams.

Nulls and empty texts have no words, so the base rule rejects them; the model sees only texts with words. Texts are read whole, one at a time.
Repeated rows are judged one by one and alike; of a doc_id's several labels the worst counts, and null labels and doc_ids teach nothing. Extra
columns of the input are ignored (``kept`` keeps them), and an empty table gives no rows.

The driver holds the features of the sample: SAMPLE_PER_CLASS rows of each class, none with more than DIM figures (2 MB).
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import MULT, WordHashes, mixed, small, table

DIM = 1 << 18
#: Labelled rows of each class that the model is fitted on at most, the smallest hashes of doc_id.
SAMPLE_PER_CLASS = 1500
#: Rejecting a clean text costs more than keeping a poor one.
THRESHOLD = 0.3
EPOCHS, RATE, SCALE = 40, 0.5, 20.0
MIN_WORDS, MAX_REPEAT = 50, 50

FEATURES = pa.schema([("label", pa.int32()), ("fold", pa.int32()), ("index", pa.binary()), ("weight", pa.binary())])
RESULT = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("p_good", pa.float64())])

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
START = (np.arange(256) & 0xC0) != 0x80


def repeat_words(words: list[bytes]) -> int:
    """Words covered by three-word windows that the text has twice or more."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    pairs = ids[:-1] * len(known) + ids[1:]
    if len(known) >= 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(known) + ids[2:]
    _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
    hit = times[which] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : k + n - 2] |= hit
    return int(covered.sum())


def dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    if b"\n" not in text:
        return 0
    lines = [x for x in text.split(b"\n") if x.split(None, 1)]
    return len(lines) - len(set(lines))


def n_grams(text: bytes, words: list[bytes], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashed word 1- and 2-grams, and hashed 4-byte runs."""
    h = hashes.of(words)
    word = np.concatenate([mixed(h), mixed(h[:-1] * MULT + h[1:])])
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    code = (b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:]) if len(b) >= 4 else b[:0]
    return (word >> np.uint64(46)).astype(np.int32), ((code * np.uint32(0x9E3779B1)) >> np.uint32(14)).astype(np.int32)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for b in small(batches):
        out: list[list] = [[], [], [], []]
        for text, label, fold in zip(*(b.column(n).to_pylist() for n in ("text", "label", "fold")), strict=True):
            raw = (text or "").encode()
            if words := raw.split():
                word, char = n_grams(raw, words, hashes)
                index, which = np.unique(np.concatenate([word, char]), return_inverse=True)
                weight = np.bincount(which, np.concatenate([np.full(len(word), 1 / len(word)), np.full(len(char), 1 / max(1, len(char)))]))
                for column, x in zip(out, (label, fold, index.astype(np.int32).tobytes(), weight.astype(np.float32).tobytes()), strict=True):
                    column.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, FEATURES.types, strict=True)], schema=FEATURES)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> dict | None:
    """Weights and calibration from at most ``per_class`` rows of each class; None unless both classes are there.

    Four fifths of the sample fit the weights, the rest the calibration, which counts rows by their class's share of all labels.
    """
    labels = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min(F.when(F.col("quality") > 0, 1).otherwise(0)).alias("label"))
    counts = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    order = F.xxhash64("doc_id", F.lit(7))
    some = functools.reduce(DataFrame.unionByName, [labels.where(F.col("label") == y).orderBy(order, "doc_id").limit(per_class) for y in (0, 1)])
    # at most 2 * per_class ids: a proven bound
    rows = docs.select("doc_id", "text").join(F.broadcast(some.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(5)).cast("int"))), "doc_id")
    rows = rows.select("text", "label", "fold").mapInArrow(_features, "label int, fold int, index binary, weight binary").collect()
    if {r["label"] for r in rows} != {0, 1}:
        return None
    rows.sort(key=lambda r: (r["label"], bytes(r["index"])))
    size = np.array([len(r["index"]) // 4 for r in rows])
    starts = np.concatenate([[0], np.cumsum(size)])
    y, held = np.array([r["label"] for r in rows], float), np.array([r["fold"] == 0 for r in rows])
    index, weight = np.empty(starts[-1], np.int32), np.empty(starts[-1], np.float32)
    for k in range(len(rows) - 1, -1, -1):  # each row goes as soon as it is copied: the driver's memory is small
        r = rows.pop()
        index[starts[k] : starts[k + 1]] = np.frombuffer(r["index"], np.int32)
        weight[starts[k] : starts[k + 1]] = np.frombuffer(r["weight"], np.float32) * np.float32(SCALE)
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held[:] = False
    share = np.array([np.sum((y == k) & ~held) for k in (0, 1)], float)
    pull = np.where(held, 0, 0.5 / share[y.astype(int)])
    w, b, speed, b_speed = np.zeros(DIM, np.float32), 0.0, np.full(DIM, 1e-8, np.float32), 1e-8
    z = np.zeros(len(y))
    for epoch in range(EPOCHS + 1):
        g, b_g = np.float32(1e-7) * w, 0.0
        for lo in range(0, len(y), 100):  # a hundred texts at a time
            hi = min(lo + 100, len(y))
            part = slice(starts[lo], starts[hi])
            z[lo:hi] = np.add.reduceat(w[index[part]] * weight[part], starts[lo:hi] - starts[lo]) + b
            gap = ((1 / (1 + np.exp(-z[lo:hi])) - y[lo:hi]) * pull[lo:hi]).astype(np.float32)
            g += np.bincount(index[part], np.repeat(gap, size[lo:hi]) * weight[part], DIM).astype(np.float32)
            b_g += float(gap.sum())
        if epoch < EPOCHS:  # the last round only scores
            speed += g * g
            w -= np.float32(RATE) * g / np.sqrt(speed)
            b_speed += b_g**2
            b -= RATE * b_g / b_speed**0.5
    at = held if held.any() else ~held
    total = sum(counts.values())
    pull = np.array([counts[0] / total, counts[1] / total])[y.astype(int)] / np.array([np.sum(at & (y == k)) for k in (0, 1)])[y.astype(int)] * at
    slope, shift = 1.0, 0.0
    for _ in range(200):  # damped Newton steps of Platt's fit
        p = 1 / (1 + np.exp(-(slope * z + shift)))
        g, h = pull * (p - y), pull * p * (1 - p) + 1e-6 * pull
        grad = np.array([(g * z).sum() + 1e-3 * (slope - 1), g.sum()])
        hess = np.array([[(h * z * z).sum() + 1e-3, (h * z).sum()], [(h * z).sum(), h.sum() + 1e-9]])
        step = np.clip(np.linalg.solve(hess, grad), -1, 1)
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return {"w": w.astype(np.float32), "b": float(b), "slope": float(slope), "shift": float(shift)}


def verdicts(docs: pa.RecordBatch, m: dict | None, threshold: float, hashes: WordHashes) -> list[list]:
    """The columns of RESULT after doc_id for the rows of a batch."""
    out: list[list] = [[] for _ in RESULT.names[1:]]
    for text in docs.column("text").to_pylist():
        raw = (text or "").encode()
        words, b = raw.split(), np.frombuffer(raw, np.uint8)
        n, repeats = len(words), repeat_words(words)
        failed, p = n < MIN_WORDS or 100 * repeats > MAX_REPEAT * n, None
        if m and n:
            word, char = n_grams(raw, words, hashes)
            z = m["b"] + SCALE * (float(m["w"][word].mean(dtype=np.float64)) + (float(m["w"][char].mean(dtype=np.float64)) if len(char) else 0.0))
            p = 1 / (1 + np.exp(-np.clip(m["slope"] * z + m["shift"], -60, 60)))
        row = (n, int((START & ~SPACE)[b].sum()), int(SYMBOL[b].sum()), dup_lines(raw), repeats, failed, not failed and (p is None or p >= threshold), p)
        for column, x in zip(out, row, strict=True):
            column.append(x)
    return out


def judge(docs: DataFrame, model: dict | None, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each document: the base figures, ``base_failed``, ``p_good`` (null without words or model) and ``kept``."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in small(batches):
            out = verdicts(b, shipped.value, threshold, hashes)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, t) for c, t in zip(out, RESULT.types[1:], strict=True))], schema=RESULT)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, p_good double")


def kept(docs: DataFrame, model: dict | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    shipped, at = docs.sparkSession.sparkContext.broadcast(model), RESULT.names.index("kept") - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in small(batches):
            yield b.filter(pa.array(verdicts(b, shipped.value, threshold, hashes)[at], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge(docs, fit(docs, table(spark, sf_dir, "labels")))
