"""Best-fit packing with conflicts: bins hold sequences of tokens for training.

Documents go to shards by a hash of doc_id (of their place in the input, if it is null), about SHARD_ROWS each, so a hot source or a large group of copies is dealt over all shards.
In a shard, items are placed largest first into the fullest bin that still fits and does not conflict: a bin holds one document of a
duplicate cluster, and at most ``per_source`` of a source. Bins are kept ordered by what they have left; each has a bitmap of
clusters and one of sources, and the search goes on from the tightest bin to its successors until one is compatible.

A text longer than a bin is cut into full pieces, each a bin of its own, and a rest. Documents without tokens (null, empty) get a row
with null bin. A null source or cluster conflicts with nothing. Equal sizes go by doc_id (null last), then by tokens, cluster and source;
repeated rows are items of their own. Extra columns are ignored, and an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

CAPACITY, PER_SOURCE, SHARD_ROWS = 4096, 4, 4000


def word_count(text: Column | str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def best_fit(sizes: list[int], clusters: list, sources: list, capacity: int, per_source: int) -> list[tuple[int, int]]:
    """Bin and offset of each item, in the given order; sizes are 1 to ``capacity``."""
    number = {c: k for k, c in enumerate(dict.fromkeys(c for c in clusters if c is not None))}
    source_number = {s: k for k, s in enumerate(dict.fromkeys(s for s in sources if s is not None))}
    full = (1 << per_source) - 1
    bins: list[tuple[int, int]] = []  # (left, bin), ordered
    held: list[int] = []
    used: list[int] = []
    out = []
    for size, cluster, source in zip(sizes, clusters, sources, strict=True):
        bit = 1 << number[cluster] if cluster is not None else 0
        shift = source_number[source] * per_source if source is not None else None
        i = bisect_left(bins, (size, -1))
        while i < len(bins):
            k = bins[i][1]
            if not held[k] & bit and (shift is None or (used[k] >> shift) & full != full):
                break
            i += 1
        if i < len(bins):
            left, k = bins.pop(i)
        else:
            left, k = capacity, len(held)
            held.append(0)
            used.append(0)
        held[k] |= bit
        if shift is not None:
            taken = (used[k] >> shift) & full
            used[k] |= (taken << 1 | 1) << shift
        out.append((k, capacity - left))
        if left > size:
            insort(bins, (left - size, k))
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Takes doc_id, n_tokens, source, cluster; returns doc_id, piece, piece_tokens, shard, bin_id (null without tokens), bin_offset."""
    shards = max(1, -(-docs.count() // shard_rows))
    items = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)).alias("n_tokens"), F.col("source").cast("string"), F.col("cluster").cast("string"))
    items = items.withColumn("shard", F.pmod(F.xxhash64(F.coalesce("doc_id", F.monotonically_increasing_id()), F.lit(5)), F.lit(shards)))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(rest=rows.n_tokens % capacity, text=rows.cluster.fillna(""), name=rows.source.fillna("")).sort_values(["rest", "doc_id", "n_tokens", "text", "name"], ascending=[False, True, False, True, True])
        rows["doc_id"] = rows.doc_id.astype("Int64")  # whole numbers beside nulls
        shard, out, bins = int(rows.shard.iloc[0]), [], 0
        for doc, n in zip(rows.doc_id, rows.n_tokens, strict=True):
            for piece in range(n // capacity):
                out.append((doc, piece, capacity, bins, 0))
                bins += 1
        some = rows[rows.rest > 0]
        none = lambda column: [None if pd.isna(x) else x for x in column]
        placed = best_fit(some.rest.tolist(), none(some.cluster), none(some.source), capacity, per_source)
        out += [(doc, n // capacity, rest, bins + k, at) for doc, n, rest, (k, at) in zip(some.doc_id, some.n_tokens, some.rest, placed, strict=True)]
        out += [(doc, 0, 0, None, None) for doc in rows.doc_id[rows.n_tokens == 0]]
        got = pd.DataFrame(out, columns=["doc_id", "piece", "piece_tokens", "bin", "bin_offset"])
        return pd.DataFrame({"doc_id": got.doc_id, "piece": got.piece, "piece_tokens": got.piece_tokens, "shard": shard, "bin_id": got.bin.astype("Int64") + (shard << 32), "bin_offset": got.bin_offset.astype("Int64")})

    return items.groupBy("shard").applyInPandas(run, "doc_id long, piece long, piece_tokens long, shard long, bin_id long, bin_offset long")


def with_clusters(docs: DataFrame) -> DataFrame:
    """Words as tokens, and equal texts as a duplicate cluster: only exact copies conflict, near copies are another operator's work."""
    return docs.select("doc_id", word_count().alias("n_tokens"), "source", F.when(F.length("text") > 0, F.xxhash64("text")).alias("cluster"))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(with_clusters(table(spark, sf_dir, "documents")))
