"""N-gram Jaccard join: MinHash banding finds candidate groups, full sets of word n-grams decide.

Two documents are linked if the Jaccard similarity of their sets of five-word shingles is 0.8 or more. Bands and rows are chosen for a
target recall at that similarity. Documents with equal sets form one class member with a weight, so copies are never expanded.

Members that share a band hash are candidates. Candidates are gathered in groups (connected through shared band hashes); a group's sets are
compared block by block, so a task holds two blocks at most and a large group is dealt over many tasks. Blocks are bounded by members and by
shingles. Inside a task the common shingles of all pairs come from one matrix product, and only each member's number of links and one edge of a
spanning forest leave it.

Words are runs of characters other than the six ASCII white-space characters, taken unchanged. A text of fewer than five words has one shingle,
all its words. Null and empty texts have none: they link to nothing and are classes of their own. Each row is a document of its own, known by
its place in the input, so rows with null and with repeated doc_ids are compared like all others; a class without any doc_id has a null
class_id. Extra columns are ignored, and an empty table gives no rows. The input is read twice and must give its rows in the same order: a
table, or a staged one.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free, grams, small, staged, table, word_hashes

WORDS, SIMILARITY, RECALL, ROWS = 5, 0.8, 0.9999, 4
#: Members and shingles of a block, and of the tasks that small groups share.
BLOCK, ITEMS = 1024, 1 << 19
#: Candidates at most whose rows are broadcast to find their texts; more are joined by shuffling the texts.
FEW = 1 << 20
SIGNED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("key_a", pa.int64()), ("key_b", pa.int64()), ("items", pa.int64()), ("bands", pa.list_(pa.int64()))])


def band_count(similarity: float = SIMILARITY, recall: float = RECALL, rows: int = ROWS) -> int:
    """Fewest bands of ``rows`` hashes that join pairs of this similarity with at least this probability."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - similarity**rows)))


def shingles(texts: list[str | None], words: int = WORDS) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the word n-grams of each text."""
    for h in word_hashes(texts):
        yield np.unique(grams(h, min(words, len(h)))) if len(h) else h


def signer(bands: int, rows: int):
    """A function from a set to its band hashes: minima of multiply-shift permutations, mixed by band."""
    draw = np.random.default_rng(20)
    a = draw.integers(0, 1 << 63, (bands * rows, 1), np.uint64) * np.uint64(2) + np.uint64(1)
    c = draw.integers(0, 1 << 63, (bands * rows, 1), np.uint64)
    salt = draw.integers(0, 1 << 63, (rows, 1), np.uint64) * np.uint64(2) + np.uint64(1)

    def sign(items: np.ndarray) -> np.ndarray:
        low = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(items), 2048):
            x = items[None, at : at + 2048] * a
            x += c
            np.minimum(low, x.min(1), out=low)
        return (low.reshape(bands, rows).T * salt).sum(0, dtype=np.uint64)

    return sign


def signed(rows: DataFrame, bands: int, per_band: int = ROWS, words: int = WORDS) -> DataFrame:
    """row, doc_id, a 128-bit key of the set, its size and its band hashes; the last four null for texts without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = signer(bands, per_band)
        for b in small(batches, 100):
            out: list[list] = [[] for _ in SIGNED.names]
            for row, doc, items in zip(b.column("row").to_pylist(), b.column("doc_id").to_pylist(), shingles(b.column("text").to_pylist(), words), strict=True):
                key, found = (None, None, None), None
                if len(items):
                    key = (*np.frombuffer(xxhash.xxh3_128_digest(items.tobytes()), np.int64).tolist(), len(items))
                    found = sign(items).view(np.int64)
                for column, x in zip(out, (row, doc, *key, found), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, SIGNED.types, strict=True)], schema=SIGNED)

    return rows.mapInArrow(run, "row long, doc_id long, key_a long, key_b long, items long, bands array<long>")


def components(edges: DataFrame) -> DataFrame:
    """(id, root): the smallest id of each connected component, for all ids on edges (a, b).

    Each round links every id and its neighbours to the smallest of them, first among the larger, then among the smaller neighbours;
    stars remain. Rounds are written to the shared folder. The smallest ids are dealt anew before they are joined, so Spark can split the
    join of a star's many edges.
    """
    edges = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low")).repartition(F.xxhash64("a"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low")).repartition(F.xxhash64("a"))
        pairs = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        edges = staged(pairs, edges)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    ids = edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("id"), "root")
    return ids.union(edges.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of ``left`` with all of ``right``."""
    n, m = len(left), len(right)
    items = np.concatenate([*left, *right])
    owner = np.repeat(np.arange(n + m), [len(x) for x in (*left, *right)])
    order = np.argsort(items, kind="stable")
    items, owner = items[order], owner[order]
    number = np.concatenate([[0], np.cumsum(items[1:] != items[:-1])]) if len(items) else items.astype(np.int64)
    from_left = np.bincount(number, owner < n).astype(np.int64)
    shared = (from_left > 0) & (np.bincount(number) > from_left)
    keep = shared[number]
    owner, number = owner[keep], (np.cumsum(shared) - 1)[number[keep]]
    out, width = np.zeros((n, m), np.float32), max(64, (1 << 22) // max(1, n + m))
    bounds = np.searchsorted(number, np.arange(0, int(shared.sum()) + width, width))
    for k in range(len(bounds) - 1):
        lo, hi = bounds[k], bounds[k + 1]
        if hi > lo:
            x = np.zeros((n + m, width), np.float32)
            x[owner[lo:hi], number[lo:hi] - k * width] = 1
            out += x[:n] @ x[n:].T
    return out.astype(np.int64)


def forest(n: int, pairs: np.ndarray) -> list[int]:
    """Root of each of ``n`` nodes, the smallest node of its component."""
    parent = list(range(n))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in pairs.tolist():
        a, b = find(i), find(j)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def verifier(similarity: float):
    share = Fraction(str(similarity))

    def verify(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, p, q), some in rows.groupby(["part", "p", "q"], sort=True):
            some = some.drop_duplicates("member").sort_values("member")
            ids, weight = some.member.to_numpy(), some.weight.to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in some.full]
            size = np.array([len(x) for x in sets])
            left, right = (np.flatnonzero(some.block == b) for b in (p, q))
            both = common_counts([sets[i] for i in left], [sets[i] for i in right])
            joint = size[left][:, None] + size[right][None, :] - both
            linked = both * share.denominator >= joint * share.numerator
            if p == q:
                np.fill_diagonal(linked, False)
            links = np.zeros(len(ids), np.int64)
            links[left] += linked @ weight[right]
            if p != q:
                links[right] += linked.T @ weight[left]
            i, j = np.nonzero(linked)
            root = forest(len(ids), np.stack([left[i], right[j]], 1))
            out.append(pd.DataFrame({"member": ids, "links": links, "root": ids[root]}))
        return pd.concat(out)

    return verify


def grouped(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, per_band: int = ROWS, words: int = WORDS) -> DataFrame:
    """row (place in the input), doc_id, class_row (a row of its class), class_id (smallest doc_id of its class), n_links (rows linked with it)."""
    bands = band_count(similarity, recall, per_band)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    signs = staged(signed(rows, bands, per_band, words))
    # a set's member is the first of its rows
    sets = signs.where("key_a is not null").groupBy("key_a", "key_b").agg(F.min("row").alias("member"), F.min("doc_id").alias("low_doc"), F.count("*").alias("weight"), F.first("items").alias("items"), F.first("bands").alias("bands"))
    members = staged(sets)
    banded = members.select("member", F.posexplode("bands").alias("band", "hash"))
    lowest = banded.groupBy("band", "hash").agg(F.min("member").alias("low"), F.max("member").alias("high")).where("low < high").drop("high").repartition(F.xxhash64("band", "hash"))
    near = banded.join(lowest, ["band", "hash"]).where("member <> low").select(F.col("member").alias("a"), F.col("low").alias("b"))
    groups = components(near).withColumnRenamed("id", "member").join(members.select("member", "weight", "items"), "member")
    groups = staged(groups)
    sizes = groups.groupBy("root").agg(F.count("*").alias("size"), F.sum("items").alias("all_items"))
    candidates, items = groups.agg(F.count("*"), F.coalesce(F.sum("items"), F.lit(0))).first()
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("all_items") / ITEMS)).cast("int")
    shared = max(1, -(-candidates // BLOCK), -(-items // ITEMS))  # tasks that the small groups share
    placed = groups.join(sizes.repartition(F.xxhash64("root")), "root").select(
        F.col("member").alias("row"), "weight", F.col("root").alias("part"), blocks.alias("blocks"), F.pmod(F.xxhash64("member"), blocks).cast("int").alias("block"),
        F.when(blocks > 1, F.col("root")).otherwise(-1 - F.pmod(F.xxhash64("root"), F.lit(shared))).alias("task"),
    )

    names = ["row", "weight", "part", "blocks", "block", "task"]

    def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 100):
            full = [items.tobytes() for items in shingles(b.column("text").to_pylist(), words)]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(full, pa.binary())], names=["member", *names[1:], "full"])

    texts = rows.select("row", "text")
    if candidates <= FEW:
        texts = texts.join(F.broadcast(groups.select(F.col("member").alias("row"))), "row", "left_semi")
    full = texts.join(placed, "row").mapInArrow(full_sets, "member long, weight long, part long, blocks int, block int, task long, full binary")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = full.withColumn("other", other).select("*", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q")).drop("other", "blocks")
    checked = staged(dealt.groupBy("task", "p", "q").applyInPandas(verifier(similarity), "member long, links long, root long"), groups)
    links = checked.groupBy("member").agg(F.sum("links").alias("links"))
    classes = components(checked.where("member <> root").select(F.col("member").alias("a"), F.col("root").alias("b"))).select(F.col("id").alias("member"), "root")
    named = classes.join(members.select("member", "low_doc"), "member").groupBy("root").agg(F.min("low_doc").alias("class_doc")).repartition(F.xxhash64("root"))
    classes = classes.join(named, "root")
    found = members.select("key_a", "key_b", "member", "weight", "low_doc").join(links, "member", "left").join(classes, "member", "left")
    return signs.select("row", "doc_id", "key_a", "key_b").join(found, ["key_a", "key_b"], "left").select(
        "row", "doc_id", F.coalesce("root", "member", "row").alias("class_row"), F.when(F.col("root").isNotNull(), F.col("class_doc")).when(F.col("member").isNotNull(), F.col("low_doc")).otherwise(F.col("doc_id")).alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("weight", F.lit(1)) - 1).cast("long").alias("n_links"),
    )


def joined(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row for each document: doc_id, class_id (smallest doc_id linked with it through links), n_links (documents linked with it)."""
    return grouped(docs, similarity).select("doc_id", "class_id", "n_links")


def deduplicated(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` with all their columns, of each class only the row with the smallest doc_id (null last, then the first row)."""
    linked = staged(grouped(docs, similarity).where("n_links > 0").select("class_row", F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row"))
    first = linked.groupBy("class_row").agg(F.min(F.struct("unnamed", "doc_id", "row")).alias("first")).select("first.row")
    gone, row = linked.select("row").join(first, "row", "left_anti"), free(docs, "row")
    kept = docs.withColumn(row, F.monotonically_increasing_id()).join(gone.withColumnRenamed("row", row), row, "left_anti")
    return kept.drop(row)


def op5_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(table(spark, sf_dir, "documents"))


def oracle() -> str:
    """All pairs that share a shingle, without banding."""
    return rf"""
with recursive d as (select row_number() over () r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) ws from documents),
g as (select distinct r, md5(array_to_string(ws[i:i + {WORDS - 1}], ' ')) g from (select r, ws, unnest(range(1, greatest(len(ws) - {WORDS - 2}, 2))) i from d where len(ws) > 0)),
n as (select r, count(*) n from g group by r),
p as (select a.r x, b.r y, count(*) c from g a join g b on a.g = b.g and a.r < b.r group by all),
l as (select x, y from p join n a on a.r = x join n b on b.r = y where c >= {SIMILARITY} * (a.n + b.n - c)),
e as (select x, y from l union all select y, x from l),
c as (select r id, r root from d union select e.y, c.root from c join e on e.x = c.id where c.root < e.y),
m as (select id, min(root) root from c group by id),
k as (select root, min(doc_id) class_id from m join d on d.r = m.id group by root)
select doc_id, class_id, (select count(*) from e where e.x = m.id)::bigint n_links from m join d on d.r = m.id join k using (root)"""
