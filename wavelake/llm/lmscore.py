"""Language-model scores by stupid backoff, from count tables of word n-grams over all documents.

A document is scored by the other documents: its own n-grams are taken out of the counts, else every n-gram would have been seen. ``order``
is the most words of an n-gram. A word starts at the longest n-gram that ends with it and has ``order`` words or, near the start of a text,
all words so far. It scores c(n-gram) / c(n-gram without the word) if that n-gram occurs elsewhere, else 0.4 times its score with one word
of context less; without context it scores its share of all other words. A word that no other document has counts as one occurrence more.
Logs are summed per document.

Documents next to each other make a block of about BLOCK bytes of text. Lengths are done one after another from single words up. For each of them:

1. The blocks are exploded to rows, one for each distinct n-gram of a block: a 64-bit hash, how often the block has it, and whether several of
   its documents do. An n-gram that other documents have has both its parts of one word less there too, so only those whose two parts are known
   elsewhere are exploded, and none is lost.
2. The rows are dealt by hash, once. The count table sums them there and keeps the n-grams of two and more documents: what only one document
   has is not there when that document is scored.
3. The dealt rows are joined to the count table by hash, which leaves those that other documents have, with what other blocks have of them.
4. These go to their block and its texts, where each document's own occurrences are taken out of the block's, logs are summed by document, and the
   next length is exploded.

Exploded rows are stored in slices by hash and known n-grams in groups by block, each gone as soon as the next step has it, which bounds what is on
disk at a time. A frequent n-gram has one row for each block at most, so no step needs many rows of one n-gram together. A task that sums holds one
block and its n-grams at a time.

Words are taken unchanged. Null and empty texts have no words and score 0. Rows that repeat a doc_id are documents of their own, and so are
rows with a null one: inside, a document is known by its place in the input. Equal texts score alike. Extra columns are ignored, and an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dealt, drop, flat_word_hashes, grams, mixed, staged, table

BACKOFF, ORDER, SLICES, GROUPS = 0.4, 3, 4, 3
#: Bytes of a block's texts, if it has more than one text.
BLOCK = 8 << 20
#: Bytes of texts in one row, if it has more than one text: the JVM holds larger rows badly.
BUNDLE = 400_000
ONE = np.uint64(0xA0761D6478BD642F)
PLACED = pa.schema([("block", pa.int64()), ("row", pa.int64()), ("text", pa.string())])
TEXTS = pa.schema([("row", pa.int64()), ("text", pa.string())])
#: Some of a block's texts, from a row on.
BUNDLED = pa.schema([("block", pa.int64()), ("row", pa.int64()), ("texts", pa.binary())])
#: n is negative if several documents of the block have the n-gram.
EXPLODED = pa.schema([("block", pa.int64()), ("gram", pa.int64()), ("n", pa.int64())])
#: What is known of a document so far: logs; its words; those scored by more than one and by two and more words, counted once for each further
#: word; those scored at their longest n-gram.
SUMS = pa.schema([("row", pa.int64()), ("score", pa.float64()), ("words", pa.int64()), ("pairs", pa.int64()), ("levels", pa.int64()), ("longest", pa.int64())])
#: As a state begins: the bytes of what other documents have of its n-grams, by start. After those are counts of the contexts that go if a word takes one word more.
HEAD = np.dtype([*((f.name, "<f8" if f.name == "score" else "<i8") for f in SUMS), ("rest", "<i8")])
#: Next n-grams with their slice, and states of documents as slice -1.
STEP = pa.schema([("part", pa.int32()), *EXPLODED, ("state", pa.binary())])


def release() -> None:
    """Gives freed memory back, which Python workers would keep for as long as they wait for the next task."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()


def ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.int32(): "int", pa.float64(): "double", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def keys(h: np.ndarray, length: int) -> np.ndarray:
    """Keys of the runs of ``length`` words, by their start, from the words' hashes."""
    return mixed(h ^ ONE) if length == 1 else grams(h, length)


def placed(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows in the input's order with their block, the row that it starts with; depends on rows and sizes only, not on batches."""
    block, size = None, 0
    for b in batches:
        blocks = []
        lengths = np.diff(offsets(b.column("text")))
        for row, length in zip(b.column("row").to_pylist(), lengths.tolist(), strict=True):
            if block is None or size + length > most:
                block, size = row, 0
            size += length
            blocks.append(block)
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), b.column("row"), b.column("text")], schema=PLACED)


def in_group(block, groups: int):
    """The group of a block, a column or an array: blocks are rows by ``monotonically_increasing_id``, with the partition in the high bits."""
    high = F.shiftright(block, 33) if isinstance(block, Column) else block >> 33
    return (high + block) % groups


def bundled(batches: Iterator[pa.RecordBatch], most: int, groups: int, group: int) -> Iterator[pa.RecordBatch]:
    """The rows and texts of the blocks of a group, compressed, some at a time."""
    for b in placed(batches, most):
        blocks = np.asarray(b.column("block"))
        edges = np.flatnonzero(np.diff(blocks) + np.diff(offsets(b.column("text"))[:-1] // BUNDLE)) + 1 if len(b) else []
        edges = [0, *edges, len(b)]
        for lo, hi in zip(edges, edges[1:], strict=False):
            if hi > lo and in_group(blocks[lo], groups) == group:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, TEXTS, options=pa.ipc.IpcWriteOptions(compression="zstd")) as to:
                    to.write_batch(b.slice(lo, hi - lo).select(TEXTS.names))
                yield pa.RecordBatch.from_arrays([b.column("block").slice(lo, 1), b.column("row").slice(lo, 1), pa.array([sink.getvalue().to_pybytes()], pa.binary())], schema=BUNDLED)


def offsets(texts: pa.Array) -> np.ndarray:
    lengths = np.asarray(pa.compute.binary_length(texts).fill_null(0))
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def ordered(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the keys by size, equal ones as they stand; the keys in that order; whether each is the first of its equals.

    The lowest bits give way to places, as sorting figures is several times faster than sorting places; it is done again if that puts keys wrong.
    """
    low = (np.uint64(1) << np.uint64(max(1, len(key).bit_length()))) - np.uint64(1)
    by = key & ~low
    by |= np.arange(len(key), dtype=np.uint64)
    by.sort()
    by &= low
    by = by.view(np.int64)
    some = key[by]
    if (some[1:] < some[:-1]).any():
        by = np.argsort(key, kind="stable")
        some = key[by]
    new = np.ones(len(key), bool)
    np.not_equal(some[1:], some[:-1], out=new[1:])
    return by, some, new


def counted(block: int, key: np.ndarray, doc: np.ndarray) -> list[pa.Array]:
    """The columns of EXPLODED for a block: its distinct n-grams by hash, from the key and document of each occurrence."""
    by, key, new = ordered(key)
    doc = doc[by]
    first = np.flatnonzero(new)
    n = np.diff(first, append=len(key))
    # documents don't fall
    n[doc[first + n - 1] != doc[first]] *= -1
    del doc, by, new
    return [pa.array(np.full(len(first), block, np.int64)), pa.array(key[first].view(np.int64)), pa.array(n)]


def exploded(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The distinct words of each block."""

    def of_block(block: int, texts: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        h, n = flat_word_hashes(texts)
        out = pa.RecordBatch.from_arrays(counted(block, keys(h, 1), np.repeat(np.arange(len(n), dtype=np.int32), n)), schema=EXPLODED)
        for at in range(0, len(out), 1 << 16):
            yield out.slice(at, 1 << 16)
        release()

    block, texts = None, []
    for b in placed(batches, most):
        blocks = np.asarray(b.column("block"))
        edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(b)]
        for lo, hi in zip(edges, edges[1:], strict=False):
            if hi > lo:
                if block is not None and block != blocks[lo]:
                    yield from of_block(block, texts)
                    texts = []
                block = int(blocks[lo])
                texts.append(b.column("text").slice(lo, hi - lo))
    if block is not None:
        yield from of_block(block, texts)


def count_table(grams: DataFrame) -> DataFrame:
    """gram and total of the n-grams that more than one document has."""
    found = grams.groupBy("gram").agg(F.sum(F.abs("n")).alias("total"), F.min("n").alias("least"), F.count("block").alias("blocks"))
    return found.where("blocks > 1 or least < 0").select("gram", "total")


def elsewhere(found: DataFrame) -> DataFrame:
    """block, gram and what other blocks have of it, of the exploded n-grams that several documents have."""
    # both sides read the same rows as they are dealt, so these are dealt once
    by_gram = found.repartition("gram")
    counts = count_table(by_gram)
    # the count table has an n-gram once, so its hash table is even and the exploded side needs no sort
    return by_gram.join(counts.hint("shuffle_hash"), "gram").select("block", "gram", (F.col("total") - F.abs("n")).alias("others"))


def packed(rest: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest one needs."""
    most = int(rest.max()) if len(rest) else 0
    return rest.astype(f"u{next(k for k in (1, 2, 4, 8) if most < 1 << 8 * k)}").tobytes()


def _known(known: pa.Table, key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """What other documents have of each occurrence's n-gram, by its key and document; 0 if they don't."""
    by, key, new = ordered(key)
    first = np.flatnonzero(new)
    n = np.diff(first, append=len(key))
    order, gram, _ = ordered(np.asarray(known.column("gram")).view(np.uint64))
    # all are there: the block had exploded them
    at = np.searchsorted(key[first], gram)
    rest = np.zeros(len(first), np.int64)
    rest[at] = np.asarray(known.column("others"))[order] + n[at]
    doc = doc[by]
    new[1:] |= doc[1:] != doc[:-1]
    own = np.diff(np.flatnonzero(new), append=len(key))
    rest = np.repeat(rest, n)
    out = np.zeros_like(rest)
    out[by] = np.where(rest > 0, rest - np.repeat(own, own), 0)
    return out


def _step(length: int, order: int, slices: int):
    """A block's n-grams that others have; its texts and its documents' states: gives their states after this length and the next n-grams."""

    def run(known: pa.Table, rows: pa.Table) -> pa.Table:
        # the JVM takes a batch whole, so batches are small
        out = pa.Table.from_batches(b for t in after(known, rows) for b in t.to_batches(1 << 15))
        del known, rows
        release()
        return out

    def after(known: pa.Table, rows: pa.Table) -> list[pa.Table]:
        states = rows.filter(rows.column("row").is_null()).column("state").to_pylist()
        rows = rows.filter(rows.column("row").is_valid()).sort_by("row")
        block = rows.column("block")[0].as_py()
        texts = pa.concat_tables(pa.ipc.open_stream(x).read_all() for x in rows.column("texts").to_pylist())
        ids = np.array(texts.column("row"))
        h, n = flat_word_hashes(texts.column("text").chunks)
        del rows, texts
        many, words = len(n), len(h)
        doc, start = np.repeat(np.arange(many, dtype=np.int32), n), np.cumsum(n) - n
        # words from here to the text's end
        left = (start + n).astype(np.int32)[doc] - np.arange(words, dtype=np.int32)
        sums = lambda at, values=None: np.bincount(doc[at], values, many)
        head = np.zeros(many, HEAD)
        head["row"], head["words"] = ids, n
        # counts of the n-grams of one word less, by their start
        before = np.zeros(words + 1, np.int64)
        contexts = np.zeros(0, np.int64)
        starts = left >= length
        if length > 1:
            old = np.frombuffer(b"".join(x[: HEAD.itemsize] for x in states), HEAD)
            by = np.argsort(old["row"])
            head = old[by]
            states = [states[i] for i in by.tolist()]
            for x, at, size, wide in zip(states, start.tolist(), (n - length + 2).tolist(), head["rest"].tolist(), strict=True):
                if size > 0:
                    before[at : at + size] = np.frombuffer(x, f"u{wide // size}", size, HEAD.itemsize)
            starts &= (before[:-1] > 0) & (before[1:] > 0)
        at = np.flatnonzero(starts)
        if length > 2:
            ends = (head["rest"] + HEAD.itemsize).tolist()
            contexts = np.concatenate([np.frombuffer(x, f"u{(len(x) - end) // size}", size, end).astype(np.int64) for x, end, size in zip(states, ends, sums(at).tolist(), strict=True) if size] or [contexts])
        del states, starts
        rest = np.zeros(words + 1, np.int64)
        if len(known) and len(at):
            rest[at] = _known(known, keys(h, length)[at], doc[at])
            contexts = contexts[rest[at] > 0] if length > 2 else contexts
        at = np.flatnonzero(rest)
        if length > 1:
            # words that stay at one word less, and the contexts of the others
            stay = before > 0
            stay[at + 1] = False
            stay = np.flatnonzero(stay)
            head["score"] += sums(stay, np.log(before[stay])) - sums(at, np.log(before[at]))
            if length > 2 and len(at):
                head["score"] += sums(at, np.log(contexts))
            head["levels"] += sums(at)
            if length == 2:
                head["pairs"] = sums(at)
            if length < order:
                head["longest"][n > 0] += rest[start[n > 0]] > 0
            else:
                head["longest"] += sums(at)
            del stay
        if length == order:
            head["score"] += sums(at, np.log(rest[at]))
            return [pa.table([pa.array(head[f.name], f.type) for f in SUMS], schema=SUMS)]
        on = np.flatnonzero((left > length) & (rest[:-1] > 0) & (rest[1:] > 0))
        kept = [packed(rest[s : s + size]) if size > 0 else b"" for s, size in zip(start.tolist(), (n - length + 1).tolist(), strict=True)]
        head["rest"] = [len(x) for x in kept]
        again = [packed(x) for x in np.split(before[on + 1], np.cumsum(sums(on))[:-1])] if length > 1 else [b""] * many
        state = pa.array([b"".join(x) for x in zip([x.tobytes() for x in head], kept, again, strict=True)], pa.binary())
        out = [pa.table([pa.array(np.full(many, -1, np.int32)), pa.array(np.full(many, block)), *(pa.nulls(many, pa.int64()) for _ in range(2)), state], schema=STEP)]
        del before, rest, kept, again, contexts, state
        more = counted(block, keys(h, length + 1)[on], doc[on]) if len(on) else [pa.nulls(0, f.type) for f in EXPLODED]
        # by the highest bits, so a block's rows of a slice stand together
        part = ((np.asarray(more[1]).view(np.uint64) >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)).astype(np.int32)
        return [*out, pa.table([pa.array(part), *more, pa.nulls(len(part), pa.binary())], schema=STEP)]

    return run


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for more in tables[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def scored(docs: DataFrame, order: int = ORDER, slices: int = SLICES, block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, n_backoff (words that backed off from their longest n-gram) and log_score.

    The input is read several times and must give its rows in the same order: a table, or a staged one.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = [[rows.select("row", "text").mapInArrow(lambda x: exploded(x, block), ddl(EXPLODED))]]
    states: list[DataFrame] = []
    for length in range(1, order + 1):
        # single words are fewer
        groups = 2 if length == 1 else GROUPS
        known: list[list[DataFrame]] = []
        for some in found:
            known.append(dealt(elsewhere(_union(some)).withColumn("group", in_group(F.col("block"), groups)), "group", list(range(groups))))
            if length > 1:
                drop(*some)
        steps = []
        for group in range(groups):
            texts = rows.select("row", "text").mapInArrow(lambda x: bundled(x, block, groups, group), ddl(BUNDLED))  # noqa: B023
            own = _union([texts, *(x.select("block", "state").where(in_group(F.col("block"), groups) == group) for x in states)])
            own = own if states else own.withColumn("state", F.lit(None).cast("binary"))
            both = _union([x[group] for x in known]).groupBy("block").cogroup(own.groupBy("block"))
            if length < order:
                steps.append(dealt(both.applyInArrow(_step(length, order, slices), ddl(STEP)), "part", list(range(-1, slices)), codec="zstd"))
            else:
                steps.append(staged(both.applyInArrow(_step(length, order, slices), ddl(SUMS))))
            drop(*(x[group] for x in known))
        drop(*states)
        if length < order:
            states, found = [x[0] for x in steps], list(zip(*(x[1:] for x in steps), strict=True))
    last = _union(steps)
    n, every = F.col("words"), int(last.agg(F.sum("words")).first()[0] or 0)
    top = F.when(n < order, n * (n + 1) / 2).otherwise(n * order - order * (order - 1) / 2)
    backed = top - n - F.col("levels")
    log_score = F.col("score") + backed * float(np.log(BACKOFF)) - (n - F.col("pairs")) * F.log(F.lit(float(every)) - n + 1.0)
    return rows.select("row", "doc_id").join(last, "row").select(
        "doc_id", n.alias("n_words"), F.when((n > 0) & F.lit(order > 1), n - 1 - F.col("longest")).otherwise(F.lit(0)).cast("long").alias("n_backoff"), F.when(n > 0, log_score).otherwise(0.0).alias("log_score")
    )


def op3_lmscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = scored(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "n_backoff", F.round("log_score", 4).alias("log_score"))


def oracle() -> str:
    return rf"""
with d as (select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) ws from documents),
w as (select doc_id, unnest(ws) w, generate_subscripts(ws, 1) i from d),
k as (select *, lag(w) over (partition by doc_id order by i) p, lag(w, 2) over (partition by doc_id order by i) q from w),
c as (select *, count(*) over (partition by w) - count(*) over (partition by doc_id, w) one, count(*) over (partition by p, w) - count(*) over (partition by doc_id, p, w) two,
  count(*) over (partition by q, p, w) - count(*) over (partition by doc_id, q, p, w) three, count(*) over () - count(*) over (partition by doc_id) others from k),
t as (select *, lag(one) over (partition by doc_id order by i) one_before, lag(two) over (partition by doc_id order by i) two_before, ln(greatest(one, 1) / (others + 1.0)) share from c),
u as (select *, case when two > 0 then ln(two / one_before) else ln({BACKOFF}) + share end pair from t),
s as (select doc_id, count(*) n, sum(case when i = 1 then 0 when i = 2 then (two = 0)::int else (three = 0)::int end) b,
  sum(case when i = 1 then share when i = 2 then pair when three > 0 then ln(three / two_before) else ln({BACKOFF}) + pair end) score from u group by doc_id)
select d.doc_id, coalesce(n, 0)::bigint n_words, coalesce(b, 0)::bigint n_backoff, round(coalesce(score, 0), 4) log_score from d left join s using (doc_id)"""
