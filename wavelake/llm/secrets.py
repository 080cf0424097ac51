"""Secret scans, native throughout: base patterns, and a randomness test battery over long tokens.

Positions are code points, ends exclusive. They come from cutting a text at a pattern's matches: gaps and matches alternate. Lengths are
summed for PART matches at a time, so a text of many matches costs little more for each than one of few.

The battery looks at tokens of 20 and more characters of the encodings' alphabets. For each it infers the encoding (digits, hex, lower-case
or upper-case letters, base32, lower-case alphanumeric, alphanumeric, base64; separators in hex are left out) and tests the symbols against
uniform draws: chi-squared over the alphabet, runs above and below its middle, and serial correlation of neighbours. Their least p-value,
times three, is the token's p-value against uniform draws. Another p-value is against the null of names and words: the kind of character
(lower, upper, digit, other) changes seldom, words of one kind have the frequencies of letters in text, and digits come in short runs.

Both kinds of p-value are weighted by length, as longer tokens can show more: p times the mean length over the token's own. Benjamini and
Hochberg's rule runs over all distinct tokens of the corpus for each, at FDR: one finds the tokens that are not text, the other those that are
not uniform. Only the first without the second are discoveries. A token is one test however often it occurs. The rules use counts in bins of
-log10 of p over length, so the driver gets some thousand rows at most. Discoveries that overlap no base span are ``random`` spans.

Null and empty texts have no spans, and an empty table gives no rows. Repeated rows are scanned one by one and alike. All columns of the input
stay; what ``scan`` finds is one more column, whose name gets underscores until the input has none like it.
"""

from __future__ import annotations

import functools
from math import log, log10, sqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free, let, table

# Fixed values of the base rules: pattern, least length, and whether the length is the second group's.
BASE = {
    "assign": (r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8),
    "access": (r"AKIA[A-Z0-9]+", 16),
    "hex": (r"[0-9a-f]{32,}+", 32),
}
KINDS = (*BASE, "random")
TOKEN = r"[A-Za-z0-9+/_-]{20,}+={0,2}"
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Hex in groups, such as UUIDs; dates and the like have no letter.
SEPARATED = "^(?=.*[a-fA-F])([0-9a-f]+([-_][0-9a-f]+)+|[0-9A-F]+([-_][0-9A-F]+)+)$"
ALPHABETS = {"digits": DIGITS, "hex": DIGITS + "abcdef", "lower": LOWER, "upper": UPPER, "base32": UPPER + "234567", "alnum36": DIGITS + LOWER, "alnum62": UPPER + LOWER + DIGITS, "base64": UPPER + LOWER + DIGITS + "+/"}
FDR = 0.01
#: Share of neighbours in names and words whose kinds of character differ.
CHANGES = 0.12
#: Share of digits in text that another digit follows.
DIGIT_RUN = 0.6
#: Letters in names and words of some European languages, per cent, from a to z.
LETTERS = (8.5, 1.5, 3.0, 4.2, 13.0, 1.8, 2.0, 3.8, 7.4, 0.4, 1.2, 4.4, 2.7, 8.0, 5.8, 2.4, 0.5, 6.6, 6.8, 7.0, 4.4, 1.5, 1.2, 0.3, 1.0, 0.6)
SURPRISE = [-log(x / 100) for x in LETTERS]
MEAN_SURPRISE = sum(x / 100 * y for x, y in zip(LETTERS, SURPRISE, strict=True))
SURPRISE_SPREAD = sqrt(sum(x / 100 * (y - MEAN_SURPRISE) ** 2 for x, y in zip(LETTERS, SURPRISE, strict=True)))
BINS_PER_UNIT, PART = 20, 64


def in_parts(items: Column, use) -> Column:
    """``use`` of the array's slices of PART items; nothing for an empty array."""
    last = F.ceil(F.size(items) / PART).cast("int") - 1
    slices = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda k: F.slice(items, k * PART + 1, F.lit(PART)))
    return let(slices, use)


def running(items: Column, more) -> Column:
    """0 and then, for each item, ``more`` of the value before it and the item."""
    return F.aggregate(items, F.array(F.lit(0)), lambda have, x: F.concat(have, F.array(more(F.element_at(have, -1), x))))


def cut(text: Column, pattern: str, kind: str, least: int = 0) -> Column:
    """Array of (start, rank, end, kind, match) for all non-overlapping matches whose last group has ``least`` characters."""
    group = 1 if kind == "assign" else 0
    gaps, found, values = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    parts = F.transform(
        F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), found.alias("found"), values.alias("value")),
        lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["found"]).alias("size"), (F.length(x["value"]) >= least).alias("fits"), x["found"].alias("found")),
    )
    span = "array<struct<start:int,rank:int,end:int,kind:string,found:string>>"
    none = F.array().cast(span)

    def step(have: Column, x: Column) -> Column:
        start = have["at"] + x["gap"]
        end = start + x["size"]
        one = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), x["found"].alias("found"))
        return F.struct(end.alias("at"), F.when(x["fits"], F.concat(have["spans"], F.array(one))).otherwise(have["spans"]).alias("spans"))

    def placed(slices: Column) -> Column:
        sizes = F.transform(slices, lambda some: F.aggregate(some, F.lit(0), lambda n, x: n + x["gap"] + x["size"]))
        starts = running(sizes, lambda n, size: n + size)
        begin = lambda at: F.struct(at.alias("at"), none.alias("spans"))
        return let(starts, lambda starts: F.flatten(F.transform(slices, lambda some, k: F.aggregate(some, begin(F.element_at(starts, k + 1)), step, lambda have: have["spans"]))))

    # plain containment tests are cheap and spare most texts the pattern
    hint = {"access": text.contains("AKIA"), "hex": text.rlike(TOKEN), "random": F.lit(True), "assign": functools.reduce(Column.__or__, (F.lower(text).contains(w) for w in ("passw", "secret", "token", "api")))}[kind]
    return F.when(hint & text.rlike(pattern), let(parts, lambda parts: in_parts(parts, placed))).otherwise(none)


def upper_tail(z: Column) -> Column:
    """P(N > z), by the polynomial of Abramowitz and Stegun (26.2.17)."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    p = F.exp(-x * x / 2) * F.lit(0.3989422804014327) * poly
    return F.when(z >= 0, p).otherwise(1 - p)


def times(text: Column, what: Column) -> Column:
    """How often ``what`` occurs in ``text``; occurrences can't overlap here."""
    return ((F.length(text) - F.length(F.replace(text, what, F.lit("")))) / F.length(what)).cast("double")


def battery(token: Column) -> Column:
    """encoding, p_uniform, p_runs, p_serial (against uniform draws) and p_text (against names and words) of a token."""
    return let(F.regexp_replace(token, "=+$", ""), lambda body: let(F.when(body.rlike(SEPARATED), F.translate(body, "-_", "")).otherwise(body), _decoded))


def _decoded(body: Column) -> Column:
    encoding = (
        F.when(body.rlike("^[0-9]+$"), "digits").when(body.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex").when(body.rlike("^[a-z]+$"), "lower").when(body.rlike("^[A-Z]+$"), "upper").when(body.rlike("^[A-Z2-7]+$"), "base32").when(body.rlike("^[a-z0-9]+$"), "alnum36")
        .when(body.rlike("^[A-Za-z0-9]+$"), "alnum62").otherwise("base64")
    )

    def named(e: Column) -> Column:
        symbols = F.when(e == "hex", F.lower(body)).when(e == "base64", F.translate(body, "-_", "+/")).otherwise(body)
        alphabet = F.coalesce(*[F.when(e == k, F.lit(v)) for k, v in ALPHABETS.items()])
        kinds = F.translate(body, LOWER + UPPER + DIGITS + "+/_-", "l" * 26 + "u" * 26 + "d" * 10 + "ssss")
        return let(F.struct(e.alias("encoding"), symbols.alias("symbols"), alphabet.alias("alphabet"), kinds.alias("kinds")), _counted)

    return let(encoding, named)


def _counted(v: Column) -> Column:
    half = F.coalesce(*[F.when(v["encoding"] == name, F.translate(v["symbols"], a, "l" * (len(a) // 2) + "h" * (len(a) - len(a) // 2))) for name, a in ALPHABETS.items()])
    squares = F.aggregate(F.split(v["alphabet"], "(?!^)(?!$)"), F.lit(0.0), lambda s, c: s + F.pow(times(v["symbols"], c), F.lit(2)))
    codes = F.transform(F.split(v["symbols"], "(?!^)(?!$)"), lambda c: F.instr(v["alphabet"], c).cast("double"))
    changes = sum((times(v["kinds"], F.lit(a + b)) for a in "luds" for b in "luds" if a != b), F.lit(0.0))
    letters = F.array(*(F.struct(F.lit(c).alias("c"), F.lit(x).alias("x")) for c, x in zip(LOWER, SURPRISE, strict=True)))
    surprise = F.when(v["encoding"].isin("lower", "upper"), F.aggregate(letters, F.lit(0.0), lambda s, a: s + times(F.lower(v["symbols"]), a["c"]) * a["x"])).otherwise(0.0)
    return let(F.struct(v["encoding"].alias("encoding"), surprise.alias("surprise"), F.length(v["symbols"]).cast("double").alias("n"), F.length(v["alphabet"]).cast("double").alias("k"), half.alias("half"), squares.alias("squares"), codes.alias("codes"), changes.alias("changes")), _summed)


def _summed(v: Column) -> Column:
    total = F.aggregate(v["codes"], F.lit(0.0), lambda s, x: s + x)
    power = F.aggregate(v["codes"], F.lit(0.0), lambda s, x: s + x * x)
    more = F.size(v["codes"]) - 1
    lagged = F.aggregate(F.zip_with(F.slice(v["codes"], F.lit(1), more), F.slice(v["codes"], F.lit(2), more), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x) + F.element_at(v["codes"], 1) * F.element_at(v["codes"], -1)
    low, high = times(v["half"], F.lit("l")), times(v["half"], F.lit("h"))
    runs = 1 + times(v["half"], F.lit("lh")) + times(v["half"], F.lit("hl"))
    figures = F.struct(*(v[n].alias(n) for n in ("encoding", "n", "k", "squares", "changes", "surprise")), total.alias("total"), power.alias("power"), lagged.alias("lagged"), runs.alias("runs"), (2 * low * high / v["n"] + 1).alias("mean"))
    return let(figures, _tested)


def _tested(v: Column) -> Column:
    n, df = v["n"], v["k"] - 1
    # Wilson and Hilferty's normal score of chi-squared
    z_chi = (F.pow(F.greatest(v["squares"] * v["k"] / n - n, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    spread = (v["mean"] - 1) * (v["mean"] - 2) / (n - 1)
    z_runs = F.when(spread > 0, F.abs(v["runs"] - v["mean"]) / F.sqrt(spread)).otherwise(F.lit(99.0))
    below = n * v["power"] - v["total"] * v["total"]
    z_serial = F.when(below > 0, F.abs((n * v["lagged"] - v["total"] * v["total"]) / below + 1 / (n - 1)) * F.sqrt(n)).otherwise(F.lit(99.0))
    z_text = (v["changes"] - 0.5 - CHANGES * (n - 1)) / F.sqrt(CHANGES * (1 - CHANGES) * (n - 1))
    z_letters = (v["surprise"] - n * MEAN_SURPRISE) / (SURPRISE_SPREAD * F.sqrt(n))
    z_text = F.when(v["encoding"].isin("lower", "upper"), z_letters).otherwise(z_text)
    digits = F.when(v["encoding"] == "digits", F.pow(F.lit(DIGIT_RUN), n - 1))
    return let(
        F.struct(z_chi.alias("chi"), z_runs.alias("runs"), z_serial.alias("serial"), z_text.alias("text")),
        lambda z: F.struct(v["encoding"].alias("encoding"), n.alias("n"), upper_tail(z["chi"]).alias("p_uniform"), (2 * upper_tail(z["runs"])).alias("p_runs"), (2 * upper_tail(z["serial"])).alias("p_serial"), F.greatest(F.coalesce(digits, upper_tail(z["text"])), F.lit(1e-300)).alias("p_text")),
    )


def candidates(text: Column) -> Column:
    """Array of long tokens with start, end and their tests."""
    return F.transform(cut(text, TOKEN, "random"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), battery(s["found"]).alias("tests")))


def not_uniform(tests: Column) -> Column:
    """The battery's p-value: the least of its three, times three."""
    return F.greatest(F.least(F.lit(1.0), 3 * F.least(tests["p_uniform"], tests["p_runs"], tests["p_serial"])), F.lit(1e-300))


def score(p: Column, n: Column) -> Column:
    """Bin of -log10 of p over length; the bin's lower edge is not above it."""
    return F.floor((F.log10(n) - F.log10(p)) * BINS_PER_UNIT).cast("int")


def discovery_rule(texts: DataFrame, fdr: float = FDR) -> tuple[float, float]:
    """The least bins that Benjamini and Hochberg's rule takes as not text and as not uniform (infinite if it takes none)."""
    tokens = texts.where(F.col("text").rlike(TOKEN)).select(F.explode(cut(F.col("text"), TOKEN, "random")).alias("t")).select("t.found").distinct()
    tests = tokens.select(battery(F.col("found")).alias("t")).select("t.*")
    pair = F.array(F.struct(F.lit(0).alias("rule"), F.col("p_text").alias("p")), F.struct(F.lit(1).alias("rule"), not_uniform(F.struct("p_uniform", "p_runs", "p_serial")).alias("p")))
    counts = tests.select("n", F.explode(pair).alias("r")).groupBy("r.rule", score(F.col("r.p"), F.col("n")).alias("bin")).agg(F.count("*").alias("tokens"), F.sum("n").alias("length")).collect()
    total = sum(r["tokens"] for r in counts if r["rule"] == 0)
    mean = sum(r["length"] for r in counts if r["rule"] == 0) / max(1, total)
    return tuple(_least_bin({r["bin"]: r["tokens"] for r in counts if r["rule"] == rule}, total, mean, fdr) for rule in (0, 1))


def _least_bin(counts: dict[int, int], total: int, mean: float, fdr: float) -> float:
    least, found = float("inf"), 0
    for b in sorted(counts, reverse=True):
        found += counts[b]
        if total * mean * 10 ** (-b / BINS_PER_UNIT) <= fdr * found:
            least = b
    return least


def scan(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """The documents with all their columns, and last a struct of base and spans: ordered arrays of (start, rank, end, kind)."""
    not_text, uneven = (F.lit(float(x)) for x in discovery_rule(docs.select("text"), fdr))
    bare = lambda spans: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    text = F.coalesce("text", F.lit(""))
    base = F.array_sort(bare(F.concat(*(cut(text, pattern, kind, length) for kind, (pattern, length) in BASE.items()))))
    found = F.filter(candidates(text), lambda t: (score(t["tests"]["p_text"], t["tests"]["n"]) >= not_text) & (score(not_uniform(t["tests"]), t["tests"]["n"]) < uneven))
    found = F.transform(found, lambda t: F.struct(t["start"].alias("start"), F.lit(KINDS.index("random")).alias("rank"), t["end"].alias("end"), F.lit("random").alias("kind")))

    def both(base: Column) -> Column:
        # a base span ends before a token starts or starts after its end, and base spans are few next to a token: whole texts of both are rare
        free_ones = let(found, lambda found: F.filter(found, lambda t: ~F.exists(base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))))
        return F.struct(base.alias("base"), F.when(text.rlike(TOKEN), F.array_sort(F.concat(base, free_ones))).otherwise(base).alias("spans"))

    return docs.select("*", let(base, both).alias(free(docs, "secrets")))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each run of overlapping spans replaced by ``mark``; PART spans at a time, each time from a piece of the text."""

    def step(piece: Column, begin: Column):
        def add(have: Column, s: Column) -> Column:
            more = F.concat(have["out"], F.substring(piece, have["at"] - begin + 1, s["start"] - have["at"]), F.lit(mark))
            return F.struct(F.greatest(have["at"], s["end"]).alias("at"), F.when(s["start"] < have["at"], have["out"]).otherwise(more).alias("out"))

        return add

    def one(some: Column, begin: Column, end: Column) -> Column:
        start = F.struct(begin.alias("at"), F.lit("").alias("out"))
        return let(F.substring(text, begin + 1, end - begin), lambda piece: F.aggregate(some, start, step(piece, begin), lambda have: have["out"]))

    def whole(slices: Column) -> Column:
        ends = running(slices, lambda at, some: F.greatest(at, F.array_max(F.transform(some, lambda s: s["end"]))))
        pieces = lambda ends: F.array_join(F.transform(slices, lambda some, k: one(some, F.element_at(ends, k + 1), F.element_at(ends, k + 2))), "")
        return let(ends, lambda ends: F.concat(pieces(ends), F.substring(text, F.element_at(ends, -1) + 1, F.length(text))))

    return F.when(F.size(spans) > 0, let(spans, lambda spans: in_parts(spans, whole))).otherwise(text)


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "secrets.*")
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE]
    return got.select("doc_id", *counts, F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
