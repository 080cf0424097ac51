"""Mixing sources to target weights by iterative proportional fitting, native throughout.

Tokens are summed for each cell of (source, lang, topic). Raking scales the cells' weights to the target shares of each marginal in turn until
no share is off by more than TOLERANCE, or, where the targets contradict each other, until the gap falls no more. A cell's documents are then
kept with the probability that its weight asks for, capped at 1, at a scale that spends the token budget; what capped cells leave goes to the
others, until nothing changes. If all cells are capped, the budget is not spent.

Targets are shares by value; values without one share what is left in proportion to their tokens. A marginal without targets gets its corpus
shares raised to a power. The topic is a column of that name, or else the form of the text.

Null or empty keys form a category of their own, ``(none)``; null and empty texts have no tokens and are kept with their cell's
probability, or never in a cell without tokens. The draw is a hash of doc_id, so rows of one doc_id in one cell are kept or left together, and
so are rows with a null one. All columns of the input stay; what ``sample`` finds is one more column, whose name gets underscores until the
input has none like it. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import free, let, staged, table
from .packing import word_count

DIMS = ("source", "lang", "topic")
#: Without targets, a target share is the corpus share raised to this power, then scaled to sum to 1: under 1 evens the mix out.
POWERS = {"source": 0.7, "lang": 0.6, "topic": 0.8}
BUDGET, TOLERANCE, SEED = 0.5, 1e-12, "mix-1"
#: Sweeps over the marginals between two tests of the gap.
SWEEPS = 8


def topic(text: Column, n_tokens: Column) -> Column:
    """The form of a text: many line breaks, long words, or by its length."""
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return F.when(n_tokens == 0, "empty").when(10 * breaks >= n_tokens, "lines").when(F.length(text) >= 9 * n_tokens, "dense").when(n_tokens < 100, "note").when(n_tokens >= 1000, "long").otherwise("prose")


def keyed(docs: DataFrame) -> Column:
    """A struct of source, lang, topic and n_tokens for each row of ``docs``."""
    name = lambda c: F.coalesce(F.nullif(c.cast("string"), F.lit("")), F.lit("(none)"))
    form = lambda n: docs["topic"] if "topic" in docs.columns else topic(docs["text"], n)
    return let(word_count(docs["text"]), lambda n: F.struct(name(docs["source"]).alias("source"), name(docs["lang"]).alias("lang"), name(form(n)).alias("topic"), n.alias("n_tokens")))


def _target(d: str, given: dict[str, float] | None, unnamed: float, power: float) -> Column:
    """The target of a cell's value in marginal ``d``; all values' targets need not sum to 1. ``unnamed`` are the tokens of values without one."""
    tokens = F.sum("tokens").over(Window.partitionBy(d))
    if not given:
        return F.pow(tokens, F.lit(power))
    own = F.coalesce(*[F.when(F.col(d) == value, F.lit(float(share))) for value, share in given.items()], F.lit(None).cast("double"))
    left = max(0.0, 1 - math.fsum(given.values()))
    return F.coalesce(own, F.lit(left) * tokens / F.lit(unnamed or 1.0))


def rake(cells: DataFrame, targets: dict[str, dict[str, float]] | None = None, powers: dict = POWERS, tolerance: float = TOLERANCE) -> DataFrame:
    """Takes source, lang, topic and n_tokens; returns source, lang, topic, tokens and weight; weights meet the target marginals."""
    cells = cells.groupBy(*DIMS).agg(F.sum("n_tokens").cast("double").alias("tokens")).where("tokens > 0")
    targets = {d: (targets or {}).get(d) for d in DIMS}
    without = {d: F.sum(F.when(F.col(d).isin(*some), 0.0).otherwise(F.col("tokens"))).alias(d) for d, some in targets.items() if some}
    unnamed = cells.agg(*without.values()).first().asDict() if without else {}
    cells = cells.select(*DIMS, "tokens", F.col("tokens").alias("weight"), *(_target(d, targets[d], unnamed.get(d), powers[d]).alias(f"t_{d}") for d in DIMS))
    cells = staged(cells.where(" and ".join(f"t_{d} > 0" for d in DIMS)))
    before = math.inf
    while True:
        swept = cells
        for _ in range(SWEEPS):
            for d in DIMS:
                swept = swept.withColumn("weight", F.col("weight") * F.col(f"t_{d}") / F.sum("weight").over(Window.partitionBy(d)))
        cells = staged(swept, cells)
        gap = gaps(cells)
        if gap <= tolerance or gap > 0.99 * before:
            return cells.select(*DIMS, "tokens", "weight")
        before = gap


def gaps(cells: DataFrame) -> float:
    """The largest difference between a value's share of the weights and its target share."""
    whole = cells
    for d in DIMS:
        whole = whole.withColumn(f"w_{d}", F.sum("weight").over(Window.partitionBy(d)))
    sums = whole.agg(F.sum("weight").alias("all"), *(F.sum(F.col(f"t_{d}") * F.col("weight") / F.col(f"w_{d}")).alias(f"t_{d}") for d in DIMS)).first()
    if sums["all"] is None:
        return 0.0
    off = [F.max(F.abs(F.col(f"w_{d}") / sums["all"] - F.col(f"t_{d}") / sums[f"t_{d}"])) for d in DIMS]
    return float(whole.agg(F.greatest(*off)).first()[0])


def calibrated(cells: DataFrame, budget: float = BUDGET) -> DataFrame:
    """Adds prob, the share of each cell's tokens to keep; together they keep ``budget`` of all tokens of the cells if the weights allow."""
    tokens, weight = cells.agg(F.sum("tokens"), F.sum("weight")).first()
    if not tokens:
        return cells.withColumn("prob", F.lit(0.0))
    rate, scale = F.col("weight") / F.lit(weight) * F.lit(tokens) / F.col("tokens"), budget
    while True:  # cells at their cap stay there; the others share what the budget has left; each round caps a cell or ends
        full, rest = cells.agg(F.sum(F.when(rate * scale >= 1, F.col("tokens")).otherwise(0.0)), F.sum(F.when(rate * scale < 1, F.col("tokens") * rate).otherwise(0.0))).first()
        if not rest or (budget * tokens - full) / rest <= scale * (1 + 1e-12):
            break
        scale = (budget * tokens - full) / rest
    return cells.withColumn("prob", F.least(F.lit(1.0), rate * F.lit(scale)))


def draw(doc_id: Column) -> Column:
    """A number from [0, 1) for each doc_id."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", doc_id.cast("string"), F.lit(SEED)).cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def sample(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, budget: float = BUDGET) -> DataFrame:
    """All documents with their columns, and last ``mix``: source, lang, topic, n_tokens, prob and kept. Spark broadcasts the cells only if small."""
    name = free(docs, "mix")
    keys, chance = free(docs, "_keys"), free(docs, "_chance")
    cells = calibrated(rake(docs.select(keyed(docs).alias("k")).select("k.*"), targets), budget)
    cells = cells.select(F.struct(*DIMS, "prob").alias(chance))
    rows = docs.select("*", keyed(docs).alias(keys))
    same = [F.col(f"{keys}.{d}") == F.col(f"{chance}.{d}") for d in DIMS]
    rows = rows.join(cells, same, "left")
    prob = F.coalesce(F.col(f"{chance}.prob"), F.lit(0.0))
    mix = F.struct(*(F.col(f"{keys}.{d}").alias(d) for d in (*DIMS, "n_tokens")), prob.alias("prob"), (draw(F.col("doc_id")) < prob).alias("kept"))
    return rows.withColumn(name, mix).drop(keys, chance)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample(table(spark, sf_dir, "documents")).select("doc_id", "mix.*").withColumn("prob", F.round("prob", 6))


def oracle(rounds: int = 32, scalings: int = 16) -> str:
    """Raking and scaling by rounds enough to converge."""
    steps, last = [], "c0"
    for r in range(rounds):
        for d in DIMS:
            name = f"w{r}_{d}"
            steps.append(f"{name} as materialized (select * replace (weight * t_{d} / sum(weight) over (partition by {d}) as weight) from {last})")
            last = name
    scales = [f"s0 as materialized (select {BUDGET}::double s)"]
    for k in range(scalings):
        scales.append(f"""s{k + 1} as materialized (select greatest(s, coalesce(({BUDGET} * any_value(total) - coalesce(sum(tokens) filter (rate * s >= 1), 0)) / nullif(sum(tokens * rate) filter (rate * s < 1), 0), s)) s
  from r cross join s{k} group by s)""")
    targets = ", ".join(f"pow(sum(tokens) over (partition by {d}), {POWERS[d]}) t_{d}" for d in DIMS)
    return f"""
with n as (select doc_id, text, coalesce(nullif(source, ''), '(none)') source, coalesce(nullif(lang, ''), '(none)') lang,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint n_tokens from documents),
d as materialized (select doc_id, source, lang, n_tokens, case when n_tokens = 0 then 'empty' when 10 * (length(text) - length(replace(text, chr(10), ''))) >= n_tokens then 'lines'
    when length(text) >= 9 * n_tokens then 'dense' when n_tokens < 100 then 'note' when n_tokens >= 1000 then 'long' else 'prose' end topic from n),
c as (select source, lang, topic, sum(n_tokens)::double tokens from d group by all having sum(n_tokens) > 0),
c0 as materialized (select *, {targets}, tokens weight from c),
{", ".join(steps)},
r as materialized (select source, lang, topic, tokens, weight / (sum(weight) over ()) * (sum(tokens) over ()) / tokens rate, sum(tokens) over () total from {last}),
{", ".join(scales)},
p as (select source, lang, topic, least(1.0, rate * s) prob from r cross join s{scalings})
select doc_id, source, lang, topic, n_tokens, round(coalesce(prob, 0), 6) prob,
  ('0x' || substr(md5(doc_id || ':{SEED}'), 1, 8))::bigint / 4294967296.0 < coalesce(prob, 0) kept
from d left join p using (source, lang, topic)"""
