"""Predicates, masks and validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_subset(column: Column, subset: str, is_list: bool = True) -> Column:
    """Membership in a list column, or part of a text column."""
    return F.array_contains(column, subset) if is_list else column.contains(subset)


def capped_status(duration: Column, most: float) -> Column:
    """``skipped`` past the cap; an unknown duration passes."""
    return F.when(duration > most, "skipped").otherwise("ok")


def unsupported(reasons: dict[str, Column]) -> Column:
    """Name of the first condition that holds, null if none does."""
    return F.coalesce(*[F.when(c, name) for name, c in reasons.items()])


def without_keys(rows: DataFrame, key: str, pattern: str) -> DataFrame:
    """Rows whose key does not match."""
    return rows.where(~F.col(key).rlike(pattern))


def none_left(rows: DataFrame, key: str, allowed: str) -> DataFrame:
    """The rows; a key that does not match ``allowed`` is an error."""
    return rows.where(F.assert_true(F.col(key).rlike(allowed), F.concat(F.lit("unexpected key: "), F.col(key))).isNull())


def overridden(base: Column, given: Column) -> Column:
    """Map ``base`` with the values of ``given`` for keys that it has."""
    known = F.map_filter(given, lambda k, v: F.map_contains_key(base, k))
    return F.map_zip_with(base, known, lambda k, a, b: F.coalesce(b, a))


def key_differences(have: Column, want: Column) -> Column:
    """Missing and unexpected keys, each sorted."""
    return F.struct(F.array_sort(F.array_except(want, have)).alias("missing"), F.array_sort(F.array_except(have, want)).alias("unexpected"))


def trimmed(x: Column, frames: Column, hop: int) -> Column:
    """Array cut to whole frames; it may keep up to hop - 1 items past the true end."""
    return F.slice(x, F.lit(1), (frames * hop).cast("int"))


def setting_error() -> Column:
    """What is wrong with a request's settings, null if they are sound."""
    return unsupported({"bad steps": F.col("steps") < 1, "bad candidates": F.col("candidates") < 1, "bad max_candidates": F.col("max_candidates") < F.col("candidates"), "bad margin": F.col("margin") < 0})


def valid_settings(rows: DataFrame) -> DataFrame:
    """Rows whose request settings are sound; others are an error that says which setting is not."""
    return rows.where(F.assert_true(setting_error().isNull(), F.coalesce(setting_error(), F.lit(""))).isNull())
