"""Separation in two parts: what depends on the recording and the prompt is prepared once, then candidates are made from it."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import solver


def prepare(requests: DataFrame, candidates: int, features: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None, spans: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Requests with their candidate count and a column for each of ``features``, which map a frame to one with that column.

    Each is an encoder of a column that many requests may share: it runs on the distinct values of its input and is joined back. ``spans`` adds
    predicted anchors to requests that have none. Write or persist the result; ``separate`` can be run on it many times.
    """
    if candidates < 1:
        raise ValueError("one candidate at least")
    rows = requests.withColumn("candidates", F.lit(candidates))
    if spans is not None and "anchors" in rows.columns:
        rows = rows.where("anchors is not null").unionByName(spans(rows.where("anchors is null")).select(rows.columns))
    for column, encode in (features or {}).items():
        keyed = rows.withColumn("_key", F.sha2(F.to_json(F.struct(column)).cast("binary"), 256))
        once = keyed.groupBy("_key").agg(F.first(column).alias(column))
        rows = keyed.drop(column).join(encode(once), "_key").drop("_key")
    return rows


def separate(prepared: DataFrame, noise: Column, field: Callable[[Column, Column], Column], steps: int, candidates: int | None = None) -> DataFrame:
    """Each prepared request once for each of its candidates, in ``cand_idx``, and ``latent``: the noise after midpoint steps through ``field``.

    ``candidates`` must be what the requests were prepared for.
    """
    if candidates is not None:
        prepared = prepared.where(F.assert_true(F.col("candidates") == candidates, F.lit("candidates must be those of the preparation")).isNull())
    rows = prepared.withColumn("cand_idx", F.explode(F.sequence(F.lit(0), F.col("candidates") - 1)))
    return rows.withColumn("latent", solver.midpoint(field, noise, F.lit(steps)))
