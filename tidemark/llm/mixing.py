"""Mixing documents to target weights by iterative proportional fitting.

Documents are counted into cells of source, language and topic. The cells' token
weights are raked, one dimension after the other, until the sums over every
dimension equal the target shares, and documents are drawn with the probability
that gives each cell its weight within a token budget.

Texts are read once to count and once to draw; everything between works on the
table of cells. Cells are counted with partial sums, so a source with a third of
all rows is one row per task. Built-in functions only.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.sizing import fits
from tidemark.sources.storage import materialise

DIMENSIONS = ("source", "lang", "topic")
# Sweeps over all dimensions between two looks at the error, and looks at most.
_SWEEPS, _LOOKS = 4, 25
# Cells that one task rakes; more are dealt over the cluster, with the same result.
_CELLS_PER_TASK = 500_000
# Stands for NULL in a dimension; no text holds it otherwise.
_NONE = "\u0000none"

# What a text is about, first match first, from its own words alone. Each pattern comes with a plain string
# that all its matches hold, or None: few texts hold it, and looking for it costs far less. Patterns need
# no more than the characters next to it, and so never go over a word several times.
TOPICS = (
    ("legal", ((None, "(?i)licen[sc]e"),)),
    ("contact", (("@", "[a-z0-9.]@[a-z0-9.]"), ("-", "[0-9]{3}-[0-9]{4}"))),
    ("table", ((" | ", None),)),
)


def topic_of(text: Column) -> Column:
    """The topic of a text; NULL, empty and unmatched texts are ``prose``."""
    out = F.lit("prose")
    for name, signs in reversed(TOPICS):
        out = F.when(reduce(or_, [_holds(text, *sign) for sign in signs]), name).otherwise(out)
    return out


def _holds(text: Column, plain: str | None, pattern: str | None) -> Column:
    parts = [] if plain is None else [F.contains(text, F.lit(plain))]
    return reduce(and_, parts if pattern is None else [*parts, text.rlike(pattern)])


def token_count(text: Column) -> Column:
    """Words between blanks; NULL has none."""
    plain = F.coalesce(F.trim(F.regexp_replace(text.cast("string"), "[\\x20\\x09-\\x0D]+", " ")), F.lit(""))
    return F.when(plain == "", F.lit(0)).otherwise(
        F.length(plain) - F.length(F.replace(plain, F.lit(" "), F.lit(""))) + 1
    ).cast("long")


def count_cells(docs: DataFrame, dimensions: dict[str, Column], tokens: Column) -> DataFrame:
    """Tokens per cell, ``__tokens``; NULL is a value of its own; cells without tokens are left out."""
    named = docs.select(
        *[F.coalesce(c.cast("string"), F.lit(_NONE)).alias(n) for n, c in dimensions.items()],
        tokens.alias("__tokens"),
    )
    return named.groupBy(*dimensions).agg(F.sum("__tokens").alias("__tokens")).filter("__tokens > 0")


def tempered_targets(cells: DataFrame, dimension: str, power: float = 0.5) -> DataFrame:
    """Target shares ``(value, share)`` of a dimension: its token shares to a power, made to sum to 1."""
    sums = cells.groupBy(F.col(dimension).alias("value")).agg(
        F.pow(F.sum("__tokens").cast("double"), F.lit(power)).alias("share")
    )
    total = sums.agg(F.sum("share")).first()[0]
    return sums.withColumn("share", F.col("share") / F.lit(total or 1.0))


def rake(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = 1e-9) -> DataFrame:
    """Cells with ``weight``: shares whose sums over every dimension meet the targets.

    ``targets`` maps a dimension to ``(value, share)``. Cells of values without a
    positive target are left out; shares of values that have no cell are spread over
    the others in proportion, so the weights sum to 1. An empty table stays empty.
    Stops when no sum is off by more than the tolerance, or after 100 sweeps: targets
    that contradict the empty cells are then met as far as the last sweep goes.
    """
    table = cells.withColumn("weight", F.col("__tokens").cast("double"))
    for name, target in targets.items():
        target = target.groupBy(F.coalesce(F.col("value").cast("string"), F.lit(_NONE)).alias(name)).agg(
            F.sum(F.col("share").cast("double")).alias(_share(name))
        )
        table = table.join(F.broadcast(target) if fits(target) else target, name).filter(F.col(_share(name)) > 0)
    table = materialise(table, "cells")
    for name in targets:
        present = table.select(name, _share(name)).distinct().agg(F.sum(_share(name))).first()[0]
        table = table.withColumn(_share(name), F.col(_share(name)) / F.lit(present or 1.0))
    single = table.count() <= _CELLS_PER_TASK
    for _ in range(_LOOKS):
        # In one partition the windows below need no exchange.
        table = table.coalesce(1) if single else table
        for _ in range(_SWEEPS):
            for name in targets:
                over = Window.partitionBy(name)
                table = table.withColumn("weight", F.col("weight") * F.col(_share(name)) / F.sum("weight").over(over))
        table = materialise(table, "raked")
        worst = 0.0
        for name in targets:
            off = table.groupBy(name).agg(F.abs(F.sum("weight") - F.first(_share(name))).alias("e"))
            worst = max(worst, off.agg(F.max("e")).first()[0] or 0.0)
        if worst <= tolerance:
            break
    return table.drop(*[_share(n) for n in targets])


def _share(name: str) -> str:
    return f"__share_{name}"


def calibrated(cells: DataFrame, budget_share: float) -> DataFrame:
    """Adds ``copies`` and ``probability`` to raked cells.

    ``copies`` is how often each document would have to be taken for the cell to get
    its weight of the budget (a share of all tokens). A document is drawn at most
    once, so what full cells cannot give is passed on to the others in proportion:
    ``probability`` is the smaller of 1 and a common multiple of ``copies``.
    """
    row = cells.agg(F.sum("__tokens").alias("t"), F.sum("weight").alias("w")).first()
    total, weight = float(row["t"] or 0), row["w"] or 1.0
    budget = total * budget_share
    per_token = F.col("weight") / F.col("__tokens") / F.lit(weight)
    scale = budget
    while True:
        full = F.col("__tokens") <= F.lit(scale) * F.col("weight") / F.lit(weight)
        row = cells.agg(
            F.sum(F.when(full, F.col("__tokens"))).alias("given"),
            F.sum(F.when(~full, F.col("weight") / F.lit(weight))).alias("open"),
        ).first()
        if not row["open"]:
            break
        raised = max(scale, (budget - float(row["given"] or 0)) / row["open"])
        if raised <= scale * (1 + 1e-12):
            break
        scale = raised
    return cells.withColumn("copies", F.lit(budget) * per_token).withColumn(
        "probability", F.least(F.lit(1.0), F.lit(scale) * per_token)
    )


def draw(
    docs: DataFrame, cells: DataFrame, dimensions: dict[str, Column], id_col: str, text_col: str, seed: int = 1
) -> DataFrame:
    """Rows of ``docs`` drawn with the probability of their cell, which is added with ``copies``.

    A row's draw depends on its id, text and the seed alone, so a repeated run draws
    the same rows and rows that repeat both share their fate. Rows of no cell are
    not drawn.
    """
    keys = {f"__key_{n}": F.coalesce(c.cast("string"), F.lit(_NONE)) for n, c in dimensions.items()}
    chances = cells.select(
        *[F.col(n).alias(f"__key_{n}") for n in dimensions],
        F.col("probability").alias("__p"), F.col("copies").alias("__copies"),
    )
    random = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), 11)
    columns = [c for c in docs.columns if c not in ("probability", "copies")]
    return (
        docs.withColumns(keys)
        .join(F.broadcast(chances) if fits(chances) else chances, list(keys))
        .filter(random.cast("double") * F.lit(2.0**-53) < F.col("__p"))
        .select(
            *[F.col(f"`{c}`") for c in columns],
            F.col("__p").alias("probability"), F.col("__copies").alias("copies"),
        )
    )


def mixed_sample(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    lang_col: str = "lang", budget_share: float = 0.5, power: float = 0.5, seed: int = 1,
) -> DataFrame:
    """A sample of ``docs`` whose tokens follow tempered source, language and topic shares.

    Columns of ``docs`` and ``topic, probability, copies``, which replace columns of
    these names. Texts without tokens (NULL, empty) are drawn with the probability of
    their cell like any other; where no text of their cell has tokens, not at all.
    """
    text = F.col(f"`{text_col}`").cast("string")
    dimensions = {
        "source": F.col(f"`{source_col}`"), "lang": F.col(f"`{lang_col}`"), "topic": topic_of(text)
    }
    cells = materialise(count_cells(docs, dimensions, token_count(text)), "token-cells")
    targets = {n: tempered_targets(cells, n, power) for n in dimensions}
    chances = materialise(calibrated(rake(cells, targets), budget_share), "chances")
    columns = [F.col(f"`{c}`") for c in docs.columns if c != "topic"]
    return draw(docs, chances, dimensions, id_col, text_col, seed).select(
        *columns, dimensions["topic"].alias("topic"),
        *[c for c in ("probability", "copies") if c not in docs.columns],
    )
