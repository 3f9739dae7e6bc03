"""Histograms, exact summary statistics and the evaluation summary."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeloom.session import stored


def _long(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``(column, v)`` for every listed value, nulls left out."""
    pairs = F.array(
        *[F.struct(F.lit(n).alias("column"), c.cast("double").alias("v")) for n, c in columns.items()]
    )
    return df.select(F.inline(pairs)).where(F.col("v").isNotNull())


def histogram(df: DataFrame, columns: dict[str, Column], bins: int = 30) -> DataFrame:
    """``(column, bin, lo, hi, n)`` with ``bins`` equal bins, empty ones included.

    Bins run from the least to the greatest value and the last one is closed. A
    constant column spreads half a unit to either side. One aggregate finds the
    ranges, one counts the bins.
    """
    ranges = [
        F.struct(
            F.lit(name).alias("column"),
            F.when(F.min(c) == F.max(c), F.min(c.cast("double")) - 0.5)
            .otherwise(F.min(c.cast("double")))
            .alias("min"),
            F.when(F.min(c) == F.max(c), F.max(c.cast("double")) + 0.5)
            .otherwise(F.max(c.cast("double")))
            .alias("max"),
        )
        for name, c in columns.items()
    ]
    limits = df.agg(F.array(*ranges).alias("_r")).select(F.inline("_r")).where("min IS NOT NULL")
    by_name = limits.agg(
        F.map_from_entries(F.collect_list(F.struct("column", F.struct("min", "max"))))
    ).scalar()
    valued = _long(df, columns).withColumn("_range", by_name).select(
        "column",
        F.least(
            F.width_bucket(
                F.col("v"),
                F.col("_range")[F.col("column")]["min"],
                F.col("_range")[F.col("column")]["max"],
                F.lit(bins),
            ),
            F.lit(bins),
        )
        .cast("int")
        .alias("bin"),
    )
    counts = valued.groupBy("column", "bin").agg(F.count(F.lit(1)).alias("_n"))
    width = (F.col("max") - F.col("min")) / bins
    grid = limits.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
    return grid.join(counts, ["column", "bin"], "left").select(
        "column",
        "bin",
        (F.col("min") + width * (F.col("bin") - 1)).alias("lo"),
        (F.col("min") + width * F.col("bin")).alias("hi"),
        F.coalesce("_n", F.lit(0)).alias("n"),
    )


# Pieces that a stretch of values is cut into in one round.
PIECES = 32
# Distinct values that are ordered in one task at most.
ORDERED = 20_000


def value_counts(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``(column, v, n)``: distinct values with their counts, summed map-side first."""
    counts = _long(df, columns).groupBy("column", "v").agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > 0)


@dataclass(frozen=True)
class Stretch:
    """Values of a column from ``low`` on and below ``high`` (None: all) that hold wanted ranks.

    ``before``: rows below it; ``rows`` and ``distinct``: what it holds.
    """

    column: str
    low: float | None
    high: float | None
    before: int
    rows: int
    distinct: int


def _inside(values: DataFrame, stretches: list[Stretch]) -> DataFrame:
    """The values of the stretches, with their number ``_s``; there are at most as many stretches as wanted ranks."""
    table = [(i, s.column, s.low, s.high, s.before) for i, s in enumerate(stretches)]
    schema = "_s int, column string, _low double, _high double, _before long"
    known = values.sparkSession.createDataFrame(table, schema)
    fits = (F.col("_low").isNull() | (F.col("v") >= F.col("_low"))) & (F.col("_high").isNull() | (F.col("v") < F.col("_high")))
    return values.join(F.broadcast(known), "column").where(fits)


def _cut(values: DataFrame, stretches: list[Stretch], ranks: dict[str, set[int]]) -> list[Stretch]:
    """The pieces of the stretches that hold wanted ranks; approximate cut points decide only how even they are."""
    inside = _inside(values, stretches)
    numbers = range(1, PIECES)
    cuts = (
        inside.groupBy("_s")
        .agg(F.percentile_approx("v", [i / PIECES for i in numbers], 16 * PIECES).alias("_a"))
        .selectExpr("_s", *[f"_a[{i - 1}] AS _c{i}" for i in numbers])
    )
    cuts = stored(cuts, "cuts")
    piece = F.expr(" + ".join(f"CAST(v >= _c{i} AS INT)" for i in numbers)).alias("_piece")
    counted = (
        inside.join(F.broadcast(cuts), "_s").select("_s", "_n", piece)
        .groupBy("_s", "_piece").agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("distinct"))
        .orderBy("_s", "_piece").collect()
    )  # a row for each piece
    edges = {r["_s"]: [r[f"_c{i}"] for i in numbers] for r in cuts.collect()}
    out, upto = [], {}
    for r in counted:
        s = stretches[r["_s"]]
        before = upto.get(r["_s"], s.before)
        upto[r["_s"]] = before + r["rows"]
        if any(before <= rank < before + r["rows"] for rank in ranks[s.column]):
            low = edges[r["_s"]][r["_piece"] - 1] if r["_piece"] else s.low
            above = edges[r["_s"]][r["_piece"] :]
            high = above[0] if above else s.high
            out.append(Stretch(s.column, low, high, before, r["rows"], r["distinct"]))
    return out


def wanted_stretches(values: DataFrame, ranks: dict[str, set[int]], sizes: dict[str, tuple[int, int]], ordered: int) -> list[Stretch]:
    """Stretches of at most ``ordered`` distinct values that hold all wanted ranks, by as many rounds of cutting as it takes.

    A round divides a stretch into ``PIECES`` of about equally many distinct values, so the rounds grow with the
    logarithm of the input.
    """
    done: list[Stretch] = []
    large = [Stretch(c, None, None, 0, *sizes[c]) for c in ranks]
    while True:
        done += [s for s in large if s.distinct <= ordered]
        large = [s for s in large if s.distinct > ordered]
        if not large:
            return done
        large = _cut(values, large, ranks)


def exact_quantiles(
    values: DataFrame, probs: tuple[float, ...] = (0.25, 0.5, 0.75), ordered: int = ORDERED
) -> DataFrame:
    """``(column, prob, value)``: exact quantiles of ``value_counts``, interpolated.

    The wanted ranks are narrowed down to stretches of at most ``ordered`` distinct values, and only those are
    ordered, each in a task. Every round reads the values anew, so hand in a written table.
    """
    ordered = max(1, ordered)
    heads = values.groupBy("column").agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("distinct")).collect()
    sizes = {r["column"]: (r["rows"], r["distinct"]) for r in heads}
    places = [(c, float(p), p * (rows - 1)) for c, (rows, _) in sizes.items() for p in probs]
    ranks: dict[str, set[int]] = {}
    for column, _, at in places:
        ranks.setdefault(column, set()).update((floor(at), ceil(at)))
    stretches = wanted_stretches(values, ranks, sizes, ordered)
    upto = F.col("_before") + F.sum("_n").over(Window.partitionBy("_s").orderBy("v"))
    placed = _inside(values, stretches).select("column", "v", "_n", upto.alias("_upto"))
    wanted = [(c, p, at, r) for c, p, at in places for r in sorted({floor(at), ceil(at)})]
    asked = values.sparkSession.createDataFrame(wanted, "column string, prob double, _at double, _rank long")
    hit = (F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_n"))
    picked = placed.join(F.broadcast(asked), "column").where(hit)
    low, high = F.min("v"), F.max("v")
    return picked.groupBy("column", "prob").agg(
        (low + (high - low) * (F.max("_at") - F.floor(F.max("_at")))).alias("value")
    )


def describe(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """One row per column: count, mean, sample std, min, quartiles, max; 2 decimals.

    The table is read once, into written counts of distinct values; moments and quartiles
    come from those. The deviation is summed around the mean, not from squares.
    """
    values = stored(value_counts(df, columns), "value-counts")
    v, n = F.col("v"), F.col("_n")
    first = values.groupBy("column").agg(
        F.sum(n).alias("count"),
        (F.sum(v * n) / F.sum(n)).alias("mean"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    )
    means = first.agg(F.map_from_entries(F.collect_list(F.struct("column", "mean")))).scalar()
    spread = (
        values.withColumn("_means", means)
        .select("column", "_n", (v - F.col("_means")[F.col("column")]).alias("_off"))
        .groupBy("column")
        .agg(
            F.when(
                F.sum(n) > 1, F.sqrt(F.sum(F.col("_off") * F.col("_off") * n) / (F.sum(n) - 1))
            ).alias("std")
        )
    )
    quantiles = (
        exact_quantiles(values)
        .groupBy("column")
        .agg(
            *[
                F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name)
                for p, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
            ]
        )
    )
    return (
        first.join(spread, "column")
        .join(quantiles, "column")
        .select(
            "column",
            "count",
            *[F.round(c, 2).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")],
        )
    )


def evaluation_summary(sections: dict[str, DataFrame]) -> DataFrame:
    """One table ``(section, name, value)`` from tables ``(name, value)``."""
    rows = [
        df.select(
            F.lit(section).alias("section"),
            F.col("name"),
            F.round(F.col("value").cast("double"), 4).alias("value"),
        )
        for section, df in sections.items()
    ]
    return reduce(DataFrame.unionByName, rows)
