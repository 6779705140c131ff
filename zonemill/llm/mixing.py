"""Mixing sources to target weights: iterative proportional fitting, then calibrated sampling.

Built-in functions only. Documents are summed up to cells, one per combination of the mixed
columns; a hot source is pre-aggregated in every task. The cells' token weights are raked:
in turn for each column, the weights of a value are scaled to its target share, for a fixed
number of rounds; a round joins the cells with a marginal table of each column and
is written, so that no task holds all cells and a lost executor costs one round. The raked
shares become inclusion probabilities, ``min(1, scale * wanted / held)`` with the scale that
makes the expected sum of kept tokens the asked share of all tokens. A document is kept if a hash of its id, as a number
in [0, 1), is below its cell's probability, so a repeated run or task keeps the same rows.

Where many tokens are kept, probabilities of wanted cells end at 1 and the kept tokens alone
fall short of the targets. The ``weight`` of a document, ``keep_share * wanted / (held *
probability)``, makes up for it: the expected kept tokens times weights have the raked shares
for every ``keep_share``, and in total ``keep_share`` of all tokens.

Cells are as many as there are combinations of values, not documents. They are joined by
broadcast only where their counted number is below ``BROADCAST_CELLS``, else by a shuffle.

Defined cases: NULL values of a mixed column are one value of their own; NULL and empty
texts count no token and are drawn with their cell, or kept where it holds no token; a value without a target has target
0 and its documents go; targets need not sum to 1; repeated rows count and are drawn alike;
without any token all documents stay; an empty table gives an empty result; other columns are kept, and clashing ones replaced.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonemill.llm.common import written

ROUNDS = 10
BROADCAST_CELLS = 50_000


def text_tokens(text: Column) -> Column:
    """A token per four code points."""
    return F.coalesce(F.ceil(F.char_length(text) / F.lit(4.0)), F.lit(0)).cast("long")


def flattened(cells: DataFrame, column: str, power: float) -> DataFrame:
    """Targets (column, target) that are the values' own token sums to a power: 1 keeps, 0 levels them."""
    held = cells.groupBy(column).agg(F.sum("tokens").alias("tokens"))
    return held.select(column, F.pow(F.col("tokens").cast("double"), F.lit(power)).alias("target"))


def raked(cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (the mixed columns and tokens) with ``share``: its part of the mixed tokens."""
    for at, (column, wanted) in enumerate(targets.items()):
        total = wanted.agg(F.sum("target")).first()[0] or 1.0
        wanted = wanted.select(F.col(column).alias("_value"), (F.col("target") / F.lit(total)).alias("_wanted"))
        cells = cells.join(wanted, F.col(column).eqNullSafe(F.col("_value")), "left")
        cells = cells.withColumn(f"_target{at}", F.coalesce("_wanted", F.lit(0.0))).drop("_value", "_wanted")
    cells = cells.withColumn("share", F.col("tokens").cast("double"))
    for _ in range(rounds):
        for at, column in enumerate(targets):
            # One row a value, summed up in every task first; Spark chooses how the cells meet it.
            marginal = cells.groupBy(F.col(column).alias("_value")).agg(F.sum("share").alias("_held"))
            cells = cells.join(marginal, F.col(column).eqNullSafe(F.col("_value")), "left")
            scaled = F.when(F.col("_held") > 0, F.col("share") * F.col(f"_target{at}") / F.col("_held")).otherwise(0.0)
            cells = cells.withColumn("share", scaled).drop("_value", "_held")
        cells = written(cells, "raked")
    return cells.drop(*[f"_target{at}" for at in range(len(targets))])


def calibrated(cells: DataFrame, keep_share: float) -> DataFrame:
    """``cells`` with ``probability`` such that the expected kept tokens are ``keep_share`` of all, and ``weight``.

    The expected sum is concave in the scale and made of straight lines, so Newton's steps from
    below rise to the line that holds the solution and end there. A step sums up the cells that
    the scale keeps whole and the others; only these sums reach the driver.
    """
    tokens, shares = cells.agg(F.sum("tokens"), F.sum("share")).first()
    tokens, shares = float(tokens or 0), shares or 0.0
    wanted = F.col("share") / F.lit(shares) * F.lit(tokens) if shares > 0 else F.lit(0.0)
    cells = cells.withColumn("_wanted", wanted)
    cells = cells.withColumn("_rate", F.when(F.col("tokens") > 0, F.col("_wanted") / F.col("tokens")).otherwise(0.0))
    scale, before = 0.0, -1
    while True:
        whole = F.col("_rate") * F.lit(scale) >= 1
        kept, held, rest = cells.agg(
            F.count(F.when(whole, 1)), F.sum(F.when(whole, F.col("tokens"))), F.sum(F.when(~whole, F.col("_wanted")))
        ).first()
        if kept == before or (rest or 0.0) <= 1e-9 * tokens:
            break
        scale, before = (tokens * keep_share - (held or 0)) / rest, kept
    chance = F.when(F.col("tokens") == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.lit(scale) * F.col("_rate")))
    cells = cells.withColumn("probability", chance)
    lifted = F.when(F.col("probability") > 0, F.col("_rate") * F.lit(keep_share) / F.col("probability")).otherwise(0.0)
    cells = cells.withColumn("weight", F.when(F.col("tokens") == 0, F.lit(1.0)).otherwise(lifted))
    return cells.drop("_wanted", "_rate")


def draw(id_col: str) -> Column:
    """A number in [0, 1) from a hash of the id."""
    text = F.concat(F.lit("mix:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def mix(
    docs: DataFrame,
    powers: Mapping[str, float] | None = None,
    targets: Mapping[str, DataFrame] | None = None,
    keep_share: float = 0.9,
    tokens: Column | None = None,
    id_col: str = "doc_id",
    names: tuple[str, str, str] = ("tokens", "probability", "kept"),
    weight: str | None = None,
) -> DataFrame:
    """Add ``tokens``, ``probability`` and ``kept``, or columns of other ``names``.

    ``weight`` names a column for the weights with which kept tokens reach the targets.

    ``targets`` gives (value, target) of each mixed column; ``powers`` derives the targets
    of a column from the documents themselves (see :func:`flattened`).
    """
    docs = docs.drop(*names, *([weight] if weight else []))
    docs = docs.withColumn(names[0], text_tokens(F.col("text")) if tokens is None else tokens)
    columns = [*(powers or {}), *(targets or {})]
    cells = written(docs.groupBy(*columns).agg(F.sum(names[0]).alias("tokens")), "cells")
    wanted = {c: flattened(cells, c, p) for c, p in (powers or {}).items()} | dict(targets or {})
    cells = written(calibrated(raked(cells, wanted), keep_share), "mix")
    added = [F.col("probability").alias(names[1]), *([F.col("weight").alias(weight)] if weight else [])]
    named = cells.select(*[F.col(c).alias(f"_cell{i}") for i, c in enumerate(columns)], *added)
    if named.count() <= BROADCAST_CELLS:
        named = F.broadcast(named)
    same = [F.col(c).eqNullSafe(F.col(f"_cell{i}")) for i, c in enumerate(columns)]
    joined = docs.join(named, same, "left").drop(*[f"_cell{i}" for i in range(len(columns))])
    return joined.withColumn(names[2], draw(id_col) < F.coalesce(names[1], F.lit(0.0)))
