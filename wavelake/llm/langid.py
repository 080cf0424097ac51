"""Language identification by prediction by partial matching over bytes.

Each language has a byte context tree of order three, with escapes (method C, with exclusions) to shorter contexts and at last to even
chances of the 256 bytes. A text begins in a context of zero bytes. Statistics are frozen after training, so a text's code length is a sum of
the same figures wherever it is scored. The trees are sparse: they hold what training saw, all of it, and nothing else, so their size is
bounded by the training texts, of which each language has DOCS_PER_LANG at most, whatever the alphabets.

The language with the shortest code wins, of equal ones the first by name; its score is its share of the probabilities at equal priors.
Null and empty texts, and texts without a letter, get ``und`` with score 0. Without training rows every text gets ``und``. Texts of any length
are scored whole, CHUNK bytes at a time. Rows are predicted one by one, repeated ones alike; rows with a null doc_id are predicted and train
nothing. Extra columns are ignored, and an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small, table

UNKNOWN = "und"
#: Training texts of each language at most, the smallest hashes of doc_id.
DOCS_PER_LANG = 1500
#: Bytes of a text that are scored together, and figures that a worker remembers.
CHUNK, REMEMBERED = 1 << 19, 1 << 22
ORDER = 3
RESULT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their offsets; a null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def contexts(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The three bytes before each byte, nearest first; 0 before a text's start."""
    out, x = [], data
    starts = offsets[:-1]
    for k in range(3):
        x = np.concatenate([np.zeros(1, x.dtype), x[:-1]])[: len(data)]
        for d in range(k + 1):
            at = starts + d
            x[at[at < len(data)]] = 0
        out.append(x)
    return out


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in small(batches):
        for lang in b.column("lang").unique().to_pylist():
            data, offsets = raw(b.filter(pa.compute.equal(b.column("lang"), lang)).column("text"))
            c1, c2, c3 = (c.astype(np.int64) for c in contexts(data, offsets))
            code, times = np.unique(c3 << 24 | c2 << 16 | c1 << 8 | data, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code), pa.string()), pa.array(code), pa.array(times.astype(np.int64))], names=["lang", "code", "times"])


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows with text and language outside the held-out fifth."""
    return docs.where("text is not null and lang is not null and doc_id is not null").where(~held_out()).select("doc_id", "text", "lang")


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(rows: DataFrame, docs_per_lang: int = DOCS_PER_LANG) -> dict | None:
    """Frozen counts from at most ``docs_per_lang`` texts of each language; None without rows."""
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return None
    order = F.xxhash64("doc_id", F.lit(3))
    # a share that holds docs_per_lang rows of each language almost surely, then the smallest hashes of it
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, (2 * docs_per_lang + 100) / n))) for k, n in sorted(sizes.items())])
    some = None
    for lang in sorted(sizes):
        few = rows.where((F.col("lang") == lang) & (F.pmod(order, F.lit(1 << 20)) < share * (1 << 20))).select("doc_id", "lang").orderBy(order, "doc_id").limit(docs_per_lang)
        some = few if some is None else some.unionByName(few)
    some = some.distinct()  # docs_per_lang rows of each language at most: a proven bound
    got = rows.join(F.broadcast(some), ["doc_id", "lang"]).select("lang", "text").mapInArrow(_counts, "lang string, code long, times long").groupBy("lang", "code").agg(F.sum("times").alias("times")).collect()
    langs = sorted({r["lang"] for r in got})
    code, times = np.array([r["code"] for r in got], np.int64), np.array([r["times"] for r in got], np.int64)
    which = np.array([langs.index(r["lang"]) for r in got], np.int64)
    order = np.lexsort((code, which))
    return {"langs": langs, "which": which[order].astype(np.int32), "code": code[order].astype(np.uint32), "times": times[order]}


class Tree:
    """One language's tree: for each length of context the seen (context, byte) codes with their probabilities, and the contexts with the
    factor by which the shorter context's probability of an unseen byte is multiplied."""

    def __init__(self, code: np.ndarray, times: np.ndarray):
        self.levels: list[tuple[np.ndarray, ...]] = []
        for k in range(ORDER + 1):
            seen, which = np.unique(code & ((1 << 8 * (k + 1)) - 1), return_inverse=True)
            count = np.bincount(which, times)
            shorter = self.probabilities(seen)
            context, of = np.unique(seen >> 8, return_inverse=True)
            total, kinds = np.bincount(of, count), np.bincount(of).astype(float)
            left = np.maximum(1 - np.bincount(of, shorter), 0)
            escape = np.where((kinds < 256) & (left > 1e-12), kinds / (total + kinds), 0)
            self.levels.append((seen, count / total[of] * (1 - escape[of]), context, escape / np.maximum(left, 1e-12)))

    def probabilities(self, code: np.ndarray) -> np.ndarray:
        """Probability of the last byte of each code after the bytes before it, by the levels there are."""
        p = np.full(len(code), 1 / 256)
        for k, (seen, known, context, factor) in enumerate(self.levels):
            part = code & ((1 << 8 * (k + 1)) - 1)
            at = np.minimum(np.searchsorted(seen, part), len(seen) - 1)
            over = np.minimum(np.searchsorted(context, part >> 8), len(context) - 1)
            p = np.where(seen[at] == part, known[at], np.where(context[over] == part >> 8, factor[over] * p, p))
        return p


class Trees:
    """The trees of all languages."""

    def __init__(self, model: dict):
        code = model["code"].astype(np.int64)
        self.trees = [Tree(code[model["which"] == k], model["times"][model["which"] == k]) for k in range(len(model["langs"]))]
        self._forget()

    def _forget(self) -> None:
        self.codes, self.bits = np.empty(0, np.uint32), np.empty((len(self.trees), 0))

    def _remember(self, codes: np.ndarray) -> None:
        """Adds the figures of codes that are not yet known."""
        new = np.setdiff1d(codes, self.codes, assume_unique=True)
        if len(new):
            if (len(self.codes) + len(new)) * len(self.trees) > REMEMBERED:
                self._forget()
                new = codes
            bits = np.stack([-np.log2(t.probabilities(new.astype(np.int64))) for t in self.trees])
            both = np.concatenate([self.codes, new])
            order = np.argsort(both)
            self.codes, self.bits = both[order], np.concatenate([self.bits, bits], 1)[:, order]

    def lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length in bits of each text under each language."""
        out = np.zeros((len(offsets) - 1, len(self.trees)))
        c1, c2, c3 = contexts(data, offsets)
        for lo in range(0, len(data), CHUNK):
            hi = min(len(data), lo + CHUNK)
            s, x1, x2, x3 = (x[lo:hi].astype(np.uint32) for x in (data, c1, c2, c3))
            code = x3 << np.uint32(24) | x2 << np.uint32(16) | x1 << np.uint32(8) | s
            self._remember(np.unique(code))
            at = np.searchsorted(self.codes, code)
            first, last = np.searchsorted(offsets, lo, "right") - 1, np.searchsorted(offsets, hi)  # the texts of this chunk
            edges = np.clip(offsets[first : last + 1], lo, hi) - lo
            for k in range(len(self.trees)):
                out[first:last, k] += np.diff(np.concatenate([[0.0], np.cumsum(self.bits[k][at])])[edges])
        return out


def predict(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, held_out, lang_pred and the posterior share of that language (equal priors)."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, trees = shipped.value, None
        for b in small(batches):
            texts = b.column("text")
            lang, score = np.full(len(b), UNKNOWN, object), np.zeros(len(b))
            if model and len(b):
                trees = trees or Trees(model)
                data, offsets = raw(texts)
                marks = np.concatenate([[0], np.cumsum(LETTER[data])])
                spoken = np.diff(marks[offsets]) > 0
                for i in np.flatnonzero(~spoken & (np.diff(offsets) > 0)):
                    spoken[i] = any(map(str.isalpha, texts[int(i)].as_py() or ""))
                bits = trees.lengths(data, offsets)
                best = bits.argmin(1)  # languages are in the order of their names
                share = 1 / np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000)).sum(1)
                lang[spoken], score[spoken] = np.array(model["langs"], object)[best][spoken], share[spoken]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(lang.tolist(), pa.string()), pa.array(score)], schema=RESULT)

    return docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, learn(training_rows(docs)))
