"""Exact top-k search by inner product with a pivot-distance index.

Vectors become integers (floor of 1024 times each component), and scores are integer inner products. One more coordinate,
sqrt(M - |x|^2) with M the largest squared norm, puts all vectors on a sphere; a query has 0 there. Then a larger inner product is a
smaller distance, and the triangle inequality bounds it: |d(q, p) - d(p, x)| <= d(q, x) for each pivot p.

Each vector belongs to its nearest pivot and is keyed by the distance to it; a pivot's annuli (rings of distance) are cut into blocks of
bounded size, so a vector that many rows share is dealt over many tasks. A query first searches the blocks nearest to it, which gives a
score that its k-th result reaches at least. Then it goes to all other blocks that could hold a better score. Inside a block the vectors
are sorted by distance and the search goes outward from the query's own distance until the bound falls under the k-th best score.

Vectors that are null, empty, or that hold null or non-finite components take no part, nor do rows with null vec_id. Vectors of other
dimensions have no inner product, so each dimension is an index of its own. Ties go to the smaller vec_id; repeated rows are candidates of
their own, though never for a query of the same vec_id. Of the vectors of a query's vec_id the smallest, by its components in order, is asked.
Extra columns are ignored, and an empty table gives no rows. A task holds one block; queries stream past it.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import by_block, small, staged, table

K, EVERY, SCALE = 10, 100, 1024
#: Pivots are chosen by farthest-first traversal of a sample of this many rows, the smallest hashes of vec_id; all rows are indexed.
PIVOTS, SAMPLE = 32, 4000
#: Vectors of a ring on average, rings of a pivot at most, vectors of a block, and the rings whose first blocks a query searches first.
RING, RINGS, BLOCK, FIRST = 1000, 64, 4000, 2


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and integer components, for valid rows."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e")).where("vec_id is not null and size(e) > 0")
    v = v.where(~F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    return v.select("vec_id", F.transform("e", lambda x: F.floor(x * scale).cast("long")).alias("v"))


def asked(vectors: DataFrame, every: int = EVERY) -> DataFrame:
    """The queries: one vector for each vec_id that ``every`` divides."""
    return vectors.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first traversal from the first row; fewer pivots if the sample has fewer distinct rows."""
    chosen, gap = [0], ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < count and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def distances(v: np.ndarray, lift: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances on the sphere of rows (components and last coordinate) from pivots."""
    x = np.concatenate([v, lift[:, None]], 1)
    return np.sqrt(np.maximum(((x**2).sum(1)[:, None] - 2 * x @ pivots.T) + (pivots**2).sum(1), 0))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).reshape(len(column), -1)


def keyed(v: DataFrame, pivots: np.ndarray, top: float) -> DataFrame:
    """Adds the nearest pivot and the distance to it."""
    shipped = v.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                x = _matrix(b.column("v")).astype(np.float64)
                d = distances(x, np.sqrt(np.maximum(top - (x**2).sum(1), 0)), shipped.value)
                near = d.argmin(1)
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("v"), pa.array(near, pa.int32()), pa.array(d[np.arange(len(d)), near])], names=["vec_id", "v", "pivot", "dist"])

    return v.mapInArrow(run, "vec_id long, v array<long>, pivot int, dist double")


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def _outward(ids: np.ndarray, x: np.ndarray, dist: np.ndarray, pivot: np.ndarray, top: float, k: int, query: int, q: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of a query's k best vectors of a block that reach its bound, by sorted annuli outward from its own distance."""
    norm = float((q * q).sum())
    own = float(distances(q[None].astype(np.float64), np.zeros(1), pivot[None])[0, 0])
    found_ids, found = np.empty(0, np.int64), np.empty(0, np.int64)
    lo = hi = int(np.searchsorted(dist, own))
    step = 256
    while lo > 0 or hi < len(dist):
        # the annuli on both sides, as far as a score of the bound can still be met
        reach = np.sqrt(max(0.0, norm + top - 2 * (bound - 1))) + 1e-3
        first, last = max(lo - step, int(np.searchsorted(dist, own - reach))), min(hi + step, int(np.searchsorted(dist, own + reach, "right")))
        first, last = min(first, lo), max(last, hi)
        if first == lo and last == hi:
            break
        at = np.r_[first:lo, hi:last]
        at = at[ids[at] != query]
        found_ids, found = np.concatenate([found_ids, ids[at]]), np.concatenate([found, x[at] @ q])
        keep = best(found_ids, found, k)
        found_ids, found = found_ids[keep], found[keep]
        if len(found) == k:
            bound = max(bound, float(found[-1]))
        lo, hi, step = first, last, step * 2
    keep = found >= bound
    return found_ids[keep], found[keep]


def searcher(pivots: np.ndarray, top: float, k: int):
    """Searches blocks for the queries sent to them: a block's vectors come first, then its queries."""
    names = ["query_id", "vec_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, ready = None, [], None
        for now, kind, rows in by_block(batches):
            if now != block:
                block, held, ready = now, [], None
            if kind == 0:
                held.append(rows)
                continue
            if not held:
                continue
            if ready is None:
                x, ids, dist = (np.concatenate(c) for c in zip(*((_matrix(r.column("v")), np.asarray(r.column("id")), np.asarray(r.column("x"))) for r in held), strict=True))
                order = np.lexsort((ids, dist))
                ready = (ids[order], x[order], dist[order], pivots[held[0].column("pivot")[0].as_py()])
            for some in small([rows]):
                out: list[list] = [[np.empty(0, np.int64)] for _ in names]
                for query, q, bound in zip(some.column("id").to_pylist(), _matrix(some.column("v")), some.column("x").to_pylist(), strict=True):
                    ids, scores = _outward(*ready, top, k, query, q, bound)
                    for column, values in zip(out, (np.full(len(ids), query, np.int64), ids, scores), strict=True):
                        column.append(values)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=names)

    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best vectors. ``vectors`` come from ``integers``, and ``queries`` are rows like them, one for each vec_id."""
    vectors, queries = staged(vectors), staged(queries)
    widths = sorted(r["n"] for r in vectors.select(F.size("v").alias("n")).distinct().collect())
    none = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    each = [_search(vectors.where(F.size("v") == n), queries.where(F.size("v") == n), k) for n in widths]
    return functools.reduce(DataFrame.union, each) if each else none


def _search(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    wide = vectors.agg(F.max(F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x * x))).first()[0]
    top = float(wide)
    some = vectors.orderBy(F.xxhash64("vec_id", F.lit(9)), "vec_id").limit(SAMPLE).collect()
    sample = np.array([r["v"] for r in some], np.float64)
    pivots = choose_pivots(np.concatenate([sample, np.sqrt(np.maximum(top - (sample**2).sum(1), 0))[:, None]], 1), PIVOTS)
    index = staged(keyed(vectors, pivots, top))
    # annuli: rings of equal width between a pivot's nearest and farthest vector, then blocks of bounded size
    span = {r["pivot"]: (r["lo"], r["hi"]) for r in index.groupBy("pivot").agg(F.min("dist").alias("lo"), F.max("dist").alias("hi")).collect()}
    low = F.element_at(F.array(*[F.lit(float(span.get(p, (0, 0))[0])) for p in range(len(pivots))]), F.col("pivot") + 1)
    width = F.element_at(F.array(*[F.lit(float(max(span.get(p, (0, 1))[1] - span.get(p, (0, 1))[0], 1e-9))) for p in range(len(pivots))]), F.col("pivot") + 1)
    count = min(RINGS, max(1, index.count() // (len(pivots) * RING)))
    ring = F.least(F.floor((F.col("dist") - low) / width * count), F.lit(count - 1)).cast("int")
    index = index.withColumn("ring", ring)
    # at most PIVOTS * RINGS rows
    rings = index.groupBy("pivot", "ring").agg(F.min("dist").alias("near"), F.max("dist").alias("far"), F.count("*").alias("size")).collect()
    rings.sort(key=lambda r: (r["pivot"], r["ring"]))
    place = {(r["pivot"], r["ring"]): n for n, r in enumerate(rings)}
    near, far, of = (np.array([r[c] for r in rings]) for c in ("near", "far", "pivot"))
    blocks = np.array([-(-r["size"] // BLOCK) for r in rings])
    first_block = np.concatenate([[0], np.cumsum(blocks)])
    number = F.create_map(*[F.lit(x) for r in rings for x in (r["pivot"] * RINGS + r["ring"], int(first_block[place[r["pivot"], r["ring"]]]))])
    parts = F.create_map(*[F.lit(x) for r in rings for x in (r["pivot"] * RINGS + r["ring"], int(blocks[place[r["pivot"], r["ring"]]]))])
    key = F.col("pivot") * RINGS + F.col("ring")
    index = index.withColumn("block", (F.element_at(number, key) + F.pmod(F.xxhash64("vec_id", F.lit(13)), F.element_at(parts, key))).cast("int"))

    def routes(batches: Iterator[pa.RecordBatch], later: bool) -> Iterator[pa.RecordBatch]:
        """Sends queries to the blocks whose bound reaches theirs: the FIRST with the best bounds, or the others."""
        for b in small(batches):
            if not len(b):
                continue
            q = _matrix(b.column("q")).astype(np.float64)
            d = distances(q, np.zeros(len(q)), pivots)[:, of]
            gap = np.maximum(0, np.maximum(near - d, d - far))
            most = ((q**2).sum(1)[:, None] + top - gap**2) / 2 + 1
            # several blocks of a ring have its bound; the first blocks are the best rings' first ones
            order = np.argsort(-most, axis=1, kind="stable")
            early = np.zeros(most.shape, bool)
            np.put_along_axis(early, order[:, :FIRST], True, 1)
            ids, bounds = b.column("query_id"), np.asarray(b.column("bound"))
            rows, where = [], []
            for i in range(len(q)):
                for r in np.flatnonzero(most[i] >= bounds[i] if later else early[i]):
                    to = range(int(first_block[r]), int(first_block[r + 1]))
                    to = (to[1:] if early[i, r] else to) if later else to[:1]
                    rows += [i] * len(to)
                    where += to
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows, pa.int64())), b.column("q").take(pa.array(rows, pa.int64())), pa.array(bounds[rows]), pa.array(where, pa.int32())], names=["query_id", "q", "bound", "block"])

    def visit(q: DataFrame, later: bool) -> DataFrame:
        sent = q.mapInArrow(lambda batches: routes(batches, later), "query_id long, q array<long>, bound double, block int")
        rows = index.select("block", F.lit(0).alias("kind"), F.col("vec_id").alias("id"), "v", F.col("dist").alias("x"), "pivot")
        rows = rows.union(sent.select("block", F.lit(1), "query_id", "q", "bound", F.lit(None).cast("int")))
        return rows.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(searcher(pivots, top, k), "query_id long, vec_id long, score long")

    first_round = queries.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.lit(-1e300).alias("bound"))
    found = staged(visit(first_round, False))
    kth = found.groupBy("query_id").agg(F.sort_array(F.collect_list("score"), False).alias("s")).where(F.size("s") >= k).select("query_id", F.element_at("s", k).cast("double").alias("kth"))
    bounded = first_round.drop("bound").join(kth, "query_id", "left").select("query_id", "q", F.coalesce("kth", F.lit(-1e300)).alias("bound"))
    every = found.union(visit(bounded, True))
    # Spark keeps each task's k best of a query before the shuffle
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return every.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integers(table(spark, sf_dir, "embeddings"))
    return search(vectors, asked(vectors))


def oracle() -> str:
    return f"""
with v as (select vec_id, list_transform(embedding, lambda x: floor({SCALE}::double * x::double)::bigint) v from embeddings
  where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id query_id, x.vec_id vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * x.v[i]))::bigint score
  from (select vec_id, min(v) v from v where vec_id % {EVERY} = 0 group by vec_id) q join v x on x.vec_id <> q.vec_id and len(x.v) = len(q.v))
select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::integer rank, vec_id, score from s
qualify rank <= {K}"""
