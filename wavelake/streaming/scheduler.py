"""Requests as a stream: admission, steps and completion in micro-batches with state.

A micro-batch is a round: each key (a worker's lane) admits what arrived, in order and up to its places, advances the group with the least
progress by one step, and emits who finished. State survives restarts through the query's checkpoint, so a failed query goes on where it was.
Spark limits how much a round reads (``maxFilesPerTrigger``); it does not turn producers away, which ``batcher`` does for callers in process.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

REQUEST = "lane long, request long, stage string, shape string, steps int, candidates int, max_candidates int, admitted_ms double, cancelled boolean"
STATE = "request array<long>, stage array<string>, shape array<string>, steps array<int>, candidates array<int>, max_candidates array<int>, admitted_ms array<double>, step_index array<int>, round long, active array<boolean>"
EVENT = "lane long, round long, request long, event string, step_index int"
FIELDS = ("request", "stage", "shape", "steps", "candidates", "max_candidates", "admitted_ms", "step_index")


def round_of(batch_size: int, most_active: int):
    """One lane's round, for ``applyInPandasWithState``."""

    def run(key: tuple, arrived: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows, number = [], 0
        if state.exists:
            kept = state.get
            rows = [dict(zip(FIELDS, r[:8], strict=True), active=r[8]) for r in zip(*kept[:8], kept[9], strict=True)]
            number = kept[8]
        out = []
        for some in arrived:
            for r in some.sort_values(["admitted_ms", "request"]).to_dict("records"):
                if r["cancelled"]:
                    out += [(key[0], number, x["request"], "cancelled", x["step_index"]) for x in rows if x["request"] == r["request"] and not x["active"]]
                    rows = [x for x in rows if x["request"] != r["request"] or x["active"]]
                else:
                    rows.append({f: r[f] for f in FIELDS[:-1]} | {"step_index": 0, "active": False})
        free = most_active - sum(r["active"] for r in rows)
        for r in rows:
            if free > 0 and not r["active"]:
                r["active"], free = True, free - 1
                out.append((key[0], number, r["request"], "admitted", 0))
        groups: dict[tuple, list[dict]] = {}
        for r in rows:
            if r["active"]:
                groups.setdefault(tuple(r[f] for f in ("stage", "shape", "steps", "candidates", "max_candidates", "step_index")), []).append(r)
        if groups:
            best = min(groups, key=lambda g: (g[-1], min(r["admitted_ms"] for r in groups[g]), -len(groups[g]), g))
            for r in groups[best][:batch_size]:
                r["step_index"] += 1
                over = r["step_index"] >= r["steps"]
                out.append((key[0], number, r["request"], "finished" if over else "step", r["step_index"]))
            rows = [r for r in rows if r["step_index"] < r["steps"]]
        if rows:
            state.update((*([r[f] for r in rows] for f in FIELDS), number + 1, [r["active"] for r in rows]))
            state.setTimeoutDuration(1)  # another round even if nothing arrives
        elif state.exists:
            state.remove()
        yield pd.DataFrame(out, columns=["lane", "round", "request", "event", "step_index"])

    return run


def scheduled(requests: DataFrame, batch_size: int = 4, most_active: int = 16) -> DataFrame:
    """Events of the requests' lives. ``requests`` is a stream of REQUEST rows."""
    return requests.groupBy("lane").applyInPandasWithState(round_of(batch_size, most_active), EVENT, STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)


def on_complete(events: DataFrame, callback: Callable[[DataFrame, int], None], checkpoint: str):
    """Calls back with each micro-batch's finished requests before it is committed; a batch may come again after a failure, with the same number."""
    return events.writeStream.foreachBatch(lambda rows, number: callback(rows.where(F.col("event") == "finished"), number)).option("checkpointLocation", checkpoint).outputMode("append").start()


def counters(events: DataFrame) -> DataFrame:
    """Requests by event, running totals."""
    return events.groupBy("event").agg(F.count(F.lit(1)).alias("n"))
