"""Hashes, file names, run names and other text."""

from __future__ import annotations

import sys
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Short metric codes and their columns; fixed values.
METRIC_NAMES = {"CE": "ContentEnjoyment", "CU": "ContentUsefulness", "PC": "ProductionComplexity", "PQ": "ProductionQuality"}


def short_hash(text: Column, digits: int = 12) -> Column:
    return F.substring(F.sha2(text.cast("binary"), 256), 1, digits)


def safe_stem(path: Column) -> Column:
    """Last part of a path without its extension; other characters than letters, digits, dot, line and underscore become underscores."""
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(.)\.[^.]*$", "$1")
    return F.regexp_replace(stem, r"(?U)[^\w.-]", "_")


def run_name(*parts: Column) -> Column:
    """Parts that are neither null nor empty, joined with hyphens."""
    return F.array_join(F.filter(F.array(*parts), lambda p: p.isNotNull() & (p != "")), "-")


def metric_name(code: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in METRIC_NAMES.items() for x in kv]), code), code)


def first_text(*columns: Column) -> Column:
    """First that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


#: Characters that texts are trimmed of: all of Unicode's category Zs.
SPACES = "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"


def trimmed(text: Column) -> Column:
    return F.trim(text, F.lit(SPACES))


@cache
def _capitals() -> tuple[str, str]:
    """Characters with a capital of one character, and their capitals."""
    pairs = []
    for c in map(chr, range(sys.maxunicode + 1)):
        if not "\ud800" <= c <= "\udfff":
            # where the capital in full is several characters, the title case can still be one
            one = next((x for x in (c.upper(), c.title()) if len(x) == 1), "\u1e9e" if c == "\u00df" else c)
            if one != c:
                pairs.append((c, one))
    return "".join(c for c, _ in pairs), "".join(one for _, one in pairs)


def capitals(text: Column) -> Column:
    """Text in capitals, character by character, so its length stays: a sharp s becomes a capital sharp s, where ``upper`` writes SS."""
    return F.translate(text, *_capitals())


def backwards(text: Column) -> Column:
    """Text with its last character first. A character keeps its combining marks; in plain ASCII each stands alone."""
    whole = F.array_join(F.reverse(F.regexp_extract_all(text, F.lit(r"\X"), F.lit(0))), "")
    return F.when(F.octet_length(text) == F.length(text), F.reverse(text)).otherwise(whole)
