"""Substring dedup: repeated passages of 50 and more words are confirmed, then located with Aho-Corasick automata and removed.

A window is 50 consecutive words of one document. A word is removed if a window covers it whose word sequence also starts in a document with
a smaller doc_id.

1. Each window has a phrase, the eight-word run of it with the smallest hash, so equal windows have equal phrases. A document has a phrase in
   about 22 words. Phrases are counted over all documents; those of one document only can't be in a repeated window.
2. Documents are dealt to blocks by a hash of doc_id. A block sends each of its distinct windows whose phrase recurs, once, under a 96-bit hash
   of its words; the hash's rows, one for each block, have the smallest and the largest doc_id. Windows of two documents are confirmed, and a
   block that has a copy to remove gets back where one of its documents has the window, and the smallest doc_id.
3. Confirmed windows that follow each other in that document are a passage, with the smallest doc_id of each of its windows. Each block
   compiles its shard of the passages to an automaton with pyahocorasick, over numbers for words: of each passage a run of PIECE words in such
   steps that every window holds a whole one. All documents of the block are streamed through it. Where a run occurs, the document is compared
   with the passage word by word; what a whole window of the passage covers goes, if that window's smallest doc_id is smaller. Hashes and
   positions of other documents have no part in this: without its automaton a block removes nothing.

What crosses a shuffle is counted per block first, so a passage in a third of all documents makes one row for each block, and a block's
automaton is bounded by its text. A task has one block at a time, and many blocks at large sizes.

Null and empty texts have no words. A null doc_id is not smaller than any and has no smaller one: nothing is removed there or because of it.
Rows that repeat a doc_id are one document's texts, each judged by itself against smaller doc_ids. Extra columns are ignored, and an empty
table gives no rows. A block holds its texts in memory, about BLOCK_BYTES, and a longer text whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import by_block, grams, long_grams, mixed, rows_of, sliding_min, small, staged, table, text_bytes, word_hashes

WINDOW, PHRASE, PIECE = 50, 8, 20
#: Text of a block on average, and the most shuffle partitions that blocks are dealt to.
BLOCK_BYTES, PARTITIONS = 8 << 20, 20_000
BASE = 90
SALT = np.uint64(0xD6E8FEB86659FD93)
RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])


def picks(h: np.ndarray, window: int, phrase: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all phrases by start, and of each window's phrase, the smallest it has."""
    every = grams(h, phrase)
    width = window - phrase + 1
    return every, sliding_min(every, width) if len(every) >= width else every[:0]


def window_keys(h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes (64 and 32 bits) of each window."""
    return long_grams(h, window), (long_grams(mixed(h ^ SALT), window) >> np.uint64(32)).astype(np.int64)


def _phrases(window: int, phrase: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 100):
            docs, found = [], []
            for doc, words in zip(b.column("doc_id").to_pylist(), word_hashes(b.column("text").to_pylist()), strict=True):
                if len(words) >= window:
                    some = np.unique(picks(words, window, phrase)[1])
                    docs.append(np.full(len(some), doc, np.int64))
                    found.append(some.view(np.int64))
            if docs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(docs)), pa.array(np.concatenate(found))], names=["doc_id", "phrase"])

    return run


def _streamed(rows: DataFrame, dealt: DataFrame, blocks: int) -> DataFrame:
    """By block, first ``rows`` of (block, a, b), then the block's documents by doc_id and text hash: in the same order each time."""
    docs = dealt.select("block", F.lit(1).alias("kind"), F.col("doc_id").alias("a"), F.xxhash64("text").alias("b"), "text")
    both = rows.select("block", F.lit(0).alias("kind"), "a", "b").unionByName(docs, allowMissingColumns=True)
    return both.repartition(min(blocks, PARTITIONS), "block").sortWithinPartitions("block", "kind", "a", "b")


def _windows(window: int, phrase: int):
    """Of each block, the windows whose phrase recurs, with smallest and largest doc_id, and the place of one in the smallest document."""

    def emit(block: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        if held:
            a, b, place, doc = (np.concatenate([x[k] for x in held]) for k in range(4))
            order = np.lexsort((place, b, a))  # places grow with the doc_id
            first = np.concatenate([[True], (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])])
            start = np.flatnonzero(first)
            last = order[np.append(start[1:], len(order)) - 1]
            start = order[start]
            back = np.argsort(place[start])  # neighbours lie together, which compresses
            start, last = start[back], last[back]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(start), block, np.int32)), *map(pa.array, (a[start], b[start], doc[start], doc[last], place[start]))], names=["block", "a", "b", "low", "high", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, known, recurring, held, rank = None, [], None, [], 0
        for now, kind, rows in by_block(batches):
            if now != block:
                yield from emit(block, held)
                block, known, recurring, held, rank = now, [], None, [], 0
            if kind == 0:
                known.append(np.asarray(rows.column("a")))
                continue
            if not known:
                continue
            if recurring is None:
                recurring = np.sort(np.concatenate(known))
            each = ((doc, h) for some in small([rows], 100) for doc, h in zip(some.column("a").to_pylist(), word_hashes(some.column("text").to_pylist()), strict=True))
            for doc, h in each:
                if len(h) >= window:
                    mine = picks(h, window, phrase)[1].view(np.int64)
                    at = np.minimum(np.searchsorted(recurring, mine), len(recurring) - 1)
                    hit = np.flatnonzero(recurring[at] == mine)
                    if len(hit):
                        a, b = window_keys(h, window)
                        held.append((a.view(np.int64)[hit], b[hit], rank << 32 | hit, np.full(len(hit), doc, np.int64)))
                rank += 1
        yield from emit(block, held)

    return run


def spelled(number: int, width: int) -> str:
    """A number in ``width`` characters of BASE: few, as an automaton looks through the characters that can follow."""
    out = []
    for _ in range(width):
        number, digit = divmod(number, BASE)
        out.append(chr(33 + digit))
    return "".join(out)


class Shard:
    """A block's part of the passages as an automaton of their pieces, each word a number in as many characters."""

    def __init__(self, passages: list[tuple[list[bytes], np.ndarray]], window: int, piece: int):
        """passages: words, and the smallest doc_id of each window."""
        self.window, self.piece = window, piece
        self.number: dict[bytes, int] = {}
        self.words = [np.fromiter((self.number.setdefault(w, len(self.number) + 1) for w in words), np.int64, len(words)) for words, _ in passages]
        self.low = [low for _, low in passages]
        self.least, self.most = [int(low.min()) for low in self.low], [int(low.max()) for low in self.low]
        self.width = 1
        while BASE**self.width <= len(self.number):
            self.width += 1
        spellings = [spelled(n, self.width) for n in range(len(self.number) + 1)]
        self.spelling, self.unknown = {w: spellings[n] for w, n in self.number.items()}, spellings[0]
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.places: list[list[tuple[int, int]]] = []  # of each piece, the passages and offsets that have it
        for k, words in enumerate(self.words):
            for at in range(0, len(words) - piece + 1, window - piece + 1):
                key = "".join([spellings[n] for n in words[at : at + piece].tolist()])
                if (which := self.automaton.get(key, -1)) < 0:
                    which = len(self.places)
                    self.places.append([])
                    self.automaton.add_word(key, which)
                self.places[which].append((k, at))
        if self.places:
            self.automaton.make_automaton()

    def removed(self, words: list[bytes], doc: int) -> np.ndarray:
        """Which words go."""
        n, window = len(words), self.window
        mark = np.zeros(n + 1, np.int64)
        if n >= window and self.places:
            text, found = "".join([self.spelling.get(w, self.unknown) for w in words]), set()
            for end, which in self.automaton.iter(text):
                end, part = divmod(end + 1, self.width)
                if not part:  # else it is across words
                    found.update((k, end - self.piece - at) for k, at in self.places[which] if self.least[k] < doc)
            text = np.fromiter((self.number.get(w, 0) for w in words), np.int64, n) if found else None
            for k, shift in found:
                passage = self.words[k]
                lo, hi = max(0, -shift), min(len(passage), n - shift)
                other = np.flatnonzero(passage[lo:hi] != text[lo + shift : hi + shift]) + lo
                if hi - lo - len(other) < window:
                    continue
                edges = np.concatenate([[lo - 1], other, [hi]])
                for j in np.flatnonzero(np.diff(edges) > window).tolist():
                    x, y = int(edges[j]) + 1, int(edges[j + 1])
                    if self.most[k] < doc:
                        mark[x + shift] += 1
                        mark[y + shift] -= 1
                    else:
                        gone = x + shift + np.flatnonzero(self.low[k][x : y - window + 1] < doc)
                        mark[gone] += 1  # a passage has a window once
                        mark[gone + window] -= 1
        return np.cumsum(mark[:n]) > 0


def passages(places: np.ndarray, low: np.ndarray, texts: list[str | None], window: int) -> list[tuple[list[bytes], np.ndarray]]:
    """Runs of windows that follow each other in one document, as words and the windows' smallest doc_ids."""
    order = np.argsort(places)
    places, low = places[order], low[order]
    edges = np.flatnonzero(np.diff(places) != 1) + 1
    out, words, at = [], [], -1
    for lo, hi in zip([0, *edges], [*edges, len(places)], strict=True):
        rank, start = divmod(int(places[lo]), 1 << 32)
        if rank != at:
            at, words = rank, (texts[rank] or "").encode().split()
        out.append((words[start : start + hi - lo + window - 1], low[lo:hi]))
    return out


def _digests(docs: list[tuple], shard: Shard | None) -> pa.RecordBatch:
    out: list[list] = [[], [], [], []]
    for doc, text in docs:
        words = (text or "").encode().split()
        gone = shard.removed(words, doc) if shard else np.zeros(len(words), bool)
        kept = [words[i] for i in np.flatnonzero(~gone)] if gone.any() else words
        for column, x in zip(out, (doc, len(words), int(gone.sum()), hashlib.sha256(b" ".join(kept)).hexdigest()), strict=True):
            column.append(x)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, RESULT.types, strict=True)], schema=RESULT)


def _locate(window: int, piece: int):
    def emit(known: list[tuple], docs: list[tuple]) -> Iterator[pa.RecordBatch]:
        shard = None
        if known:
            shard = Shard(passages(*(np.concatenate([x[k] for x in known]) for k in range(2)), [t for _, t in docs], window), window, piece)
        for at in range(0, len(docs), 500):
            yield _digests(docs[at : at + 500], shard)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, known, docs = None, [], []
        for now, kind, rows in by_block(batches):
            if now != block:
                yield from emit(known, docs)
                block, known, docs = now, [], []
            if kind == 0:
                known.append((np.asarray(rows.column("a")), np.asarray(rows.column("b"))))
            else:
                docs += rows_of([rows], "a", "text")
        yield from emit(known, docs)

    return run


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in small(batches):
        yield _digests(list(rows_of([b], "doc_id", "text")), None)


def deduplicated(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, piece: int = PIECE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed and the hash of the words kept, for each row."""
    blocks = max(1, -(-text_bytes(docs) // block_bytes))
    block = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(blocks)).cast("int").alias("block")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    unnamed, docs = docs.where("doc_id is null"), docs.where("doc_id is not null")
    dealt = docs.select(block, "doc_id", "text")
    found = docs.mapInArrow(_phrases(window, phrase), "doc_id long, phrase long").select(block, "doc_id", "phrase")
    every = Window.partitionBy("phrase")
    counted = found.groupBy("block", "phrase").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    recurring = counted.withColumns({"low": F.min("low").over(every), "high": F.max("high").over(every)}).where("low < high")
    phrases = recurring.select("block", F.col("phrase").alias("a"), F.lit(0).cast("long").alias("b"))
    windows = _streamed(phrases, dealt, blocks).mapInArrow(_windows(window, phrase), "block int, a long, b long, low long, high long, place long")
    same = Window.partitionBy("a", "b")
    # windows in two documents, for the blocks where a copy is to go
    confirmed = windows.withColumns({"first": F.min("low").over(same), "last": F.max("high").over(same)}).where("first < last and high > first")
    shards = staged(confirmed.select("block", F.col("place").alias("a"), F.col("first").alias("b")))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return _streamed(shards, dealt, blocks).mapInArrow(_locate(window, piece), schema).union(unnamed.mapInArrow(_whole, schema))


def op8_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents"))


def oracle() -> str:
    return rf"""
with d as (select row_number() over () r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) ws from documents),
w as (select r, doc_id, i, md5(array_to_string(ws[i:i + {WINDOW - 1}], ' ')) h from (select r, doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) i from d where len(ws) >= {WINDOW})),
f as (select h, min(doc_id) first_doc from w group by h having min(doc_id) < max(doc_id)),
x as (select r, i from w join f using (h) where first_doc < doc_id),
j as (select r, unnest(ws) word, generate_subscripts(ws, 1) i from d),
g as (select j.r, j.i, word, coalesce(max(x.i) over (partition by j.r order by j.i) >= j.i - {WINDOW - 1}, false) gone from j left join x on x.r = j.r and x.i = j.i),
a as (select r, count(*) n, sum(gone::int) n_gone, string_agg(word, ' ' order by i) filter (where not gone) kept from g group by r)
select d.doc_id, coalesce(n, 0)::bigint n_words, coalesce(n_gone, 0)::bigint n_removed, sha256(coalesce(kept, '')) kept_sha256 from d left join a using (r)"""
