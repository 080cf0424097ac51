"""Candidates of requests: fan-out, scores, arg-max, confidence, adaptive expansion, cascades."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MARGIN, INITIAL, MOST = 0.05, 4, 8


def fan_out(requests: DataFrame, candidates: int | Column, first: int = 0) -> DataFrame:
    """Each request once for each candidate, numbered in ``cand_idx`` from ``first``."""
    last = (F.lit(candidates) if isinstance(candidates, int) else candidates) + (first - 1)
    return requests.where(last >= first).withColumn("cand_idx", F.explode(F.sequence(F.lit(first), last.cast("int"))))


def collapsed(candidates: DataFrame) -> DataFrame:
    """The requests of a fan-out again."""
    return candidates.where("cand_idx = 0").drop("cand_idx")


#: Rows at most of a side that is broadcast, and the parts that a key is dealt to beyond.
FEW, SALTS = 10_000, 64


def paired(rows: DataFrame, single: DataFrame, key: str, few: int = FEW) -> DataFrame:
    """Joins ``rows`` to ``single``, which has one row for each key: broadcast if it is small, else each key is dealt to SALTS tasks."""
    if single.limit(few + 1).count() <= few:
        return rows.join(F.broadcast(single), key)
    salted = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    copies = single.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(copies, [key, "_salt"]).drop("_salt")


def in_chunks(rows: DataFrame, order: Column, size: int, *keys: str) -> DataFrame:
    """Consecutive chunks of ``size`` rows in order, for each key."""
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1
    return rows.withColumns({"chunk": F.floor(position / size).cast("long"), "place": (position % size).cast("long")})


def ensemble(scores: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """Weighted sum of rankers' scores (request, cand_idx, ranker, score); rankers without a weight don't count."""
    weight = F.try_element_at(F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]), F.col("ranker"))
    return scores.groupBy("request", "cand_idx").agg(F.sum(F.col("score") * weight).alias("score"))


def selected(scores: DataFrame) -> DataFrame:
    """Each request's best candidate: highest score, then smallest index; the first candidate if none has a score."""
    better = F.struct(F.coalesce(F.col("score"), F.lit(float("-inf"))).alias("score"), (-F.col("cand_idx")).alias("place"))
    best = scores.groupBy("request").agg(F.max(better).alias("best"), F.count("score").alias("scored"))
    return best.select("request", F.when(F.col("scored") > 0, -F.col("best.place")).otherwise(0).cast("int").alias("cand_idx"), F.when(F.col("scored") > 0, F.col("best.score")).alias("score"))


def top_two(scores: DataFrame) -> DataFrame:
    """Highest and second highest score of each request, and their difference; nulls where there is one candidate."""
    two = scores.withColumn("n", F.row_number().over(Window.partitionBy("request").orderBy(F.desc("score"), "cand_idx"))).where("n <= 2")
    tops = two.groupBy("request").agg(F.max(F.when(F.col("n") == 1, F.col("score"))).alias("first"), F.max(F.when(F.col("n") == 2, F.col("score"))).alias("second"))
    return tops.withColumn("margin", F.col("first") - F.col("second"))


def unconfident(scores: DataFrame, margin: float = MARGIN) -> DataFrame:
    """Requests whose two best scores are closer than ``margin``. A single candidate is never unconfident: nothing is compared."""
    return top_two(scores).where(F.col("margin") < margin).select("request")


def adaptive(requests: DataFrame, score: Callable[[DataFrame], DataFrame], initial: int = INITIAL, most: int = MOST, margin: float = MARGIN, per_request: bool = True) -> DataFrame:
    """Scores ``initial`` candidates, and up to ``most`` where the best two are close; then all of a request's candidates are ranked together.

    With ``per_request`` off, one unconfident request expands all. ``score`` maps a fan-out to (request, cand_idx, score).
    """
    first = score(fan_out(requests, initial))
    if most <= initial or initial < 2:
        return selected(first)
    close = unconfident(first, margin)
    again = requests.join(close, "request", "left_semi") if per_request else requests.join(close.limit(1).select(F.lit(True).alias("_any")), F.col("_any"), "left_semi")
    return selected(first.unionByName(score(fan_out(again, most - initial, initial))))


def dispatched(has_video: Column, visual: Column, text: Column, candidates: Column) -> Column:
    """The score that counts: visual if there is a video and a visual score, else the text score; null for a single candidate."""
    return F.when(candidates <= 1, None).when(has_video & visual.isNotNull(), visual).otherwise(text)


def cascade(requests: DataFrame, stage: Callable[[DataFrame, int], DataFrame], seed: int = 0) -> DataFrame:
    """Two stages: the second works on what the first left over (its ``residual``), with the next seed.

    ``stage`` takes rows with ``request`` and ``signal`` and returns ``request``, ``target`` and ``residual``.
    """
    one = stage(requests, seed)
    two = stage(one.select("request", F.col("residual").alias("signal")), seed + 1)
    name = lambda df, n: df.select("request", F.col("target").alias(f"target_{n}"), F.col("residual").alias(f"residual_{n}"))
    return name(one, 1).join(name(two, 2), "request")
