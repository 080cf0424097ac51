"""Batches of active requests: grouping, choice of the next group, one step, expansion; as tables, a round at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GROUP = ("stage", "candidates", "max_candidates", "steps", "step_index", "shape")


def with_group(active: DataFrame) -> DataFrame:
    """Requests that can share a batch have equal ``group``. The margin is no part of it."""
    return active.withColumn("group", F.concat_ws("|", *[F.col(c).cast("string") for c in GROUP]))


def next_batch(active: DataFrame, most: int) -> DataFrame:
    """The first ``most`` requests, by admission, of the group to run next: least progress, then earliest admission, then largest."""
    grouped = with_group(active)
    ranked = grouped.groupBy("group").agg(F.min("step_index").alias("_step"), F.min("admitted_ms").alias("_since"), F.count(F.lit(1)).alias("_size"))
    chosen = ranked.orderBy("_step", "_since", F.desc("_size"), "group").limit(1).select("group")
    return grouped.join(F.broadcast(chosen), "group", "left_semi").orderBy("admitted_ms", "request").limit(most)  # chosen is one row


def advanced(active: DataFrame, batch: DataFrame) -> DataFrame:
    """The active requests after the batch made a step."""
    done = batch.select("request", F.lit(1).alias("_step"))
    return active.join(done, "request", "left").withColumn("step_index", F.col("step_index") + F.coalesce("_step", F.lit(0))).drop("_step")


def finished(active: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requests with all steps done, and the others."""
    done = F.col("step_index") >= F.col("steps")
    return active.where(done), active.where(~done)


def admitted(waiting: DataFrame, active: DataFrame, cancelled: DataFrame, most: int) -> DataFrame:
    """Waiting requests that were not cancelled, in order of arrival, as many as there are free places."""
    free = max(0, most - active.count())
    return waiting.join(cancelled.select("request"), "request", "left_anti").orderBy("arrived_ms", "request").limit(free)


def batched(rows: DataFrame, most: int) -> DataFrame:
    """Deals each group's requests to batches of ``most`` at most, numbered in ``batch``.

    A group is first dealt by hash to as many parts as it needs, and only a part is put in order, so a group of any size is many tasks' work.
    """
    sizes = rows.groupBy("group").agg(F.greatest(F.ceil(F.count(F.lit(1)) / most), F.lit(1)).alias("_parts"))
    dealt = rows.join(sizes, "group").withColumn("_part", F.pmod(F.xxhash64("request"), F.col("_parts")))
    place = F.row_number().over(Window.partitionBy("group", "_part").orderBy("admitted_ms", "request")) - 1
    return dealt.withColumn("batch", F.col("_part") + F.col("_parts") * F.floor(place / most)).drop("_parts", "_part")


def merged(batch: DataFrame, payload: str) -> DataFrame:
    """One row for each group and batch: the requests' payloads one after another, with offsets to part them again."""
    rows = batch.groupBy("group", "batch").agg(F.array_sort(F.collect_list(F.struct("admitted_ms", "request", payload))).alias("_rows"))
    sizes = F.transform("_rows", lambda r: F.size(r[payload]))
    return rows.select("group", "batch", F.transform("_rows", lambda r: r["request"]).alias("requests"), sizes.alias("sizes"), F.flatten(F.transform("_rows", lambda r: r[payload])).alias(payload))


def parted(merged_rows: DataFrame, payload: str) -> DataFrame:
    """The requests' own payloads again; offsets are summed once for a batch, and a request takes its own slice only."""
    starts = F.aggregate("sizes", F.array(F.lit(0)), lambda have, n: F.concat(have, F.array(F.element_at(have, -1) + n)))
    own = F.transform("requests", lambda r, i: F.struct(r.alias("request"), F.slice(F.col(payload), F.get("_starts", i) + 1, F.get("sizes", i)).alias(payload)))
    rows = merged_rows.withColumn("_starts", starts).select("group", "batch", F.explode(own).alias("_own"))
    return rows.select("group", "batch", "_own.request", f"_own.{payload}")


def simulate(requests: DataFrame, most_active: int, batch_size: int) -> list[dict]:
    """The schedule of a bounded set of requests (collected: a planning aid, not a data path), one entry for each step: the batch and who finished."""
    waiting = sorted((r.asDict() for r in requests.collect()), key=lambda r: (r["admitted_ms"], r["request"]))
    active, log = [], []
    while waiting or active:
        while waiting and len(active) < most_active:
            active.append(waiting.pop(0))
        groups: dict[tuple, list[dict]] = {}
        for r in active:
            groups.setdefault(tuple(str(r[c]) for c in GROUP), []).append(r)
        rank = lambda k: (min(r["step_index"] for r in groups[k]), min(r["admitted_ms"] for r in groups[k]), -len(groups[k]), k)
        batch = groups[min(groups, key=rank)][:batch_size]
        for r in batch:
            r["step_index"] += 1
        over = [r for r in batch if r["step_index"] >= r["steps"]]
        active = [r for r in active if r["step_index"] < r["steps"]]
        log.append({"batch": [r["request"] for r in batch], "finished": [r["request"] for r in over]})
    return log
