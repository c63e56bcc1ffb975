"""Mixing sources to target weights by iterative proportional fitting, in built-in functions only.

Tokens are summed by cell (source, language, topic). The cells' weights are raked to the three target marginals in turn
until all hold. The ratio of raked to given tokens, scaled to the budget, is the probability with which a document of
the cell is drawn; a hash of its doc_id draws it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hash_share, heavy_bar, materialize, read_table

MARGINS = ("source", "lang", "topic")
#: Default target of a margin: its share of tokens to this power, which lifts what is rare.
TEMPERATURE = {"source": 0.7, "lang": 0.7, "topic": 0.8}
#: Share of all tokens that is drawn.
BUDGET = 0.6
#: Raking ends when no margin is further from its target than this share of it, or when the gap has not become smaller by
#: LEAST_GAIN of it within PATIENCE rounds: then the targets do not go together.
TOLERANCE = 1e-5
LEAST_GAIN, PATIENCE = 0.05, 8
SEED = "mix-1"
#: More cells than this are joined by shuffle and not broadcast; a cell has under 200 bytes.
BROADCAST_CELLS = 50_000
#: Topics as (name, pattern): the first that the text matches, else "prose" (fixed values).
TOPICS = (("licence", r"(?i)licensed? under|copyright"), ("table", r"\|[^|\n]*\|[^|\n]*\|"), ("contact", r"@|\d{3}"))


def token_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def topic_of(text: Column) -> Column:
    found = F.lit("prose")
    for name, pattern in reversed(TOPICS):
        found = F.when(text.rlike(pattern), name).otherwise(found)
    return found


def keyed(docs: DataFrame, *more: Column) -> DataFrame:
    """The margins of each row (null counts as a value of its own, written as empty), its tokens and more columns."""
    known = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"__{c}") for c in ("source", "lang")]
    return docs.select(*more, *known, topic_of(F.col("text")).alias("__topic"), token_count(F.col("text")).alias("__tokens"))


def cells_of(rows: DataFrame) -> DataFrame:
    """A row for each cell with its documents and tokens, stored. Its size is that of the metadata, not of the texts."""
    keys = [f"__{m}" for m in MARGINS]
    return materialize(rows.groupBy(*keys).agg(F.count("*").alias("__docs"), F.sum("__tokens").alias("__base")), "mix-cells")


def targets_of(cells: DataFrame, margin: str, given: dict[str, float] | None) -> DataFrame:
    """The margin's values with their target shares: those given, or shares of tokens to the power TEMPERATURE.

    Values without tokens have no target, and targets of values that do not occur are left out; shares sum to 1.
    """
    own = cells.groupBy(f"__{margin}").agg(F.sum("__base").alias("__t")).filter("__t > 0")
    if given is None:
        raw = own.select(f"__{margin}", F.pow(F.col("__t").cast("double"), TEMPERATURE[margin]).alias("__share"))
    else:
        names = F.from_json(F.lit(_json(given)), "map<string,double>")
        raw = own.select(f"__{margin}", F.element_at(names, F.col(f"__{margin}")).alias("__share")).filter("__share > 0")
    raw = materialize(raw, "mix-targets")
    total = raw.agg(F.sum("__share")).first()[0] or 1.0
    return raw.select(f"__{margin}", (F.col("__share") / F.lit(total)).alias(f"__goal_{margin}"))


def _json(values: dict[str, float]) -> str:
    import json

    return json.dumps(values)


def _weighted(cells: DataFrame, factors: dict[str, DataFrame]) -> DataFrame:
    """The cells with __weight: their tokens times the factors of their values; 0 for values without a factor."""
    weight = F.col("__base").cast("double")
    for m in MARGINS:
        cells = cells.join(factors[m], f"__{m}", "left")
        weight = weight * F.coalesce(F.col(f"__f_{m}"), F.lit(0.0))
    return cells.withColumn("__weight", weight)


def rake(cells: DataFrame, targets: dict[str, dict[str, float] | None] | None = None) -> tuple[DataFrame, float]:
    """The cells with __weight, raked so that each margin's shares are its targets, and the gap that remains, as a share.

    The total stays that of the tokens. Each step sums the weights of one margin and replaces the factors of its values;
    these small tables are all that is kept between steps. Cells without tokens, or of values whose target is none, weigh 0.
    Given targets that do not go together (a gap over TOLERANCE is left) are a ValueError; default ones are met as far as
    they can be, and the gap tells how far.
    """
    goals = {m: materialize(targets_of(cells, m, (targets or {}).get(m)), "mix-goals") for m in MARGINS}
    total = float(cells.agg(F.sum("__base")).first()[0] or 0)
    factors = {m: goals[m].select(f"__{m}", F.lit(1.0).alias(f"__f_{m}")) for m in MARGINS}
    gaps: list[float] = []
    while True:
        worst = 0.0
        for m in MARGINS:
            sums = _weighted(cells, factors).groupBy(f"__{m}").agg(F.sum("__weight").alias("__sum"), F.first(f"__f_{m}").alias("__old"))
            ratio = F.col(f"__goal_{m}") * total / F.col("__sum")
            step = materialize(sums.filter("__sum > 0").join(goals[m], f"__{m}").select(f"__{m}", (ratio * F.col("__old")).alias(f"__f_{m}"), F.abs(ratio - 1).alias("__gap")), "mix-factors")
            worst = max(worst, step.agg(F.max("__gap")).first()[0] or 0.0)
            factors[m] = step.drop("__gap")
        gaps.append(worst)
        if worst <= TOLERANCE or (len(gaps) > PATIENCE and worst > (1 - LEAST_GAIN) * gaps[-1 - PATIENCE]):
            break
    raked = materialize(_weighted(cells, factors), "mix-raked")
    gap = _gap(raked, goals, total)
    if gap > TOLERANCE and any((targets or {}).values()):
        raise ValueError(f"the targets do not go together: some margin stays {gap:.3g} of its target away")
    return raked, gap


def _gap(raked: DataFrame, goals: dict[str, DataFrame], total: float) -> float:
    """The largest distance of a margin from its target, as a share of the target."""
    worst = 0.0
    for m in MARGINS:
        sums = raked.groupBy(f"__{m}").agg(F.sum("__weight").alias("__sum"))
        told = goals[m].join(sums, f"__{m}", "left").agg(F.max(F.abs(F.coalesce("__sum", F.lit(0.0)) / (F.col(f"__goal_{m}") * total) - 1))).first()[0]
        worst = max(worst, told or 0.0)
    return worst


def scale_to_budget(raked: DataFrame, budget: float) -> float:
    """The factor s for which the expected tokens, each probability s * weight / tokens capped at 1, are the budget's share."""
    total, most = raked.filter("__base > 0").agg(F.sum("__base").cast("double"), F.max(F.col("__weight") / F.col("__base"))).first()
    if not total or not most:
        return 0.0
    goal = budget * total
    reach = raked.filter("__weight > 0").agg(F.sum("__base").cast("double"), F.min(F.col("__weight") / F.col("__base"))).first()
    if reach[0] <= goal:
        return 1.0 / reach[1]  # every document that may be drawn is
    low, high = 0.0, 1.0 / reach[1]
    for _ in range(4):
        grid = [low + (high - low) * k / 24 for k in range(25)]
        sums = raked.agg(*(F.sum(F.least(F.col("__base").cast("double"), F.col("__weight") * s)).alias(f"s{k}") for k, s in enumerate(grid))).first()
        k = max(k for k in range(25) if sums[k] <= goal or k == 0)
        low, high = grid[k], grid[min(24, k + 1)]
        if math.isclose(low, high):
            break
    a, b = sums[k], sums[min(24, k + 1)]
    return low + (high - low) * ((goal - a) / (b - a) if b > a else 0.0)


def probabilities(docs: DataFrame, targets=None, budget: float = BUDGET) -> tuple[DataFrame, DataFrame, float]:
    """The cells with __p, the probability of drawing a document, the same rows as they stand in the join, and the margins' gap."""
    cells = cells_of(keyed(docs))
    raked, gap = rake(cells, targets)
    scale = scale_to_budget(raked, budget)
    ratio = F.when(F.col("__base") > 0, F.least(F.lit(1.0), F.col("__weight") / F.col("__base") * F.lit(scale))).otherwise(0.0)
    table = materialize(raked.withColumn("__p", ratio).select("__source", "__lang", "__topic", "__docs", "__base", "__weight", "__p"), "mix-probabilities")
    return table, table.select("__source", "__lang", "__topic", "__docs", "__p"), gap


def _with_probability(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Joins each row with its cell; rows without tokens get probability 0."""
    return _with_cell(rows, table).withColumn("__p", F.when(F.col("__tokens") > 0, F.col("__p")).otherwise(0.0))


def _with_cell(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Many cells are split: the few heavy ones are broadcast, the others shuffle."""
    keys = ["__source", "__lang", "__topic"]
    if table.count() <= BROADCAST_CELLS:
        return rows.join(F.broadcast(table.drop("__docs")), keys)
    bar = heavy_bar(table.agg(F.sum("__docs")).first()[0])
    heavy, light = table.filter(F.col("__docs") >= bar).drop("__docs"), table.filter(F.col("__docs") < bar).drop("__docs")
    return rows.join(F.broadcast(heavy), keys).unionByName(rows.join(F.broadcast(heavy.drop("__p")), keys, "left_anti").join(light, keys))


def mix(docs: DataFrame, targets=None, budget: float = BUDGET, seed: str = SEED) -> DataFrame:
    """For every row: doc_id, source, lang, topic, n_tokens, probability, selected and margin_gap (the same in all rows).

    A null source or language is a value of its own (returned as null); null and empty texts have no tokens and
    probability 0; whole texts count, however long; rows that repeat a doc_id are drawn together. Other columns of docs,
    whatever their names, are not read. An empty table gives no rows.
    """
    _, table, gap = probabilities(docs, targets, budget)
    rows = keyed(docs, F.col("doc_id"), F.col("source"), F.col("lang"))
    joined = _with_probability(rows, table)
    return joined.select(
        "doc_id", "source", "lang", F.col("__topic").alias("topic"), F.col("__tokens").alias("n_tokens"), F.col("__p").alias("probability"),
        (hash_share("doc_id", seed) < F.col("__p")).alias("selected"), F.lit(gap).alias("margin_gap"),
    )


def sample_to_mix(docs: DataFrame, targets=None, budget: float = BUDGET, seed: str = SEED) -> DataFrame:
    """The rows of docs that mix selects, with docs' columns."""
    _, table, _ = probabilities(docs, targets, budget)
    rows = keyed(docs, F.struct("*").alias("__row"))
    drawn = _with_probability(rows, table).withColumn("__id", F.col("__row.doc_id")).filter(hash_share("__id", seed) < F.col("__p"))
    return drawn.select("__row.*")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents"))


QUERIES = {"op3_mixing": op3_mixing}
ORACLES: dict[str, str] = {}
