"""Exact order statistics and global running totals without one big partition.

Both first take a small sketch of the column. The sketch only decides how the work is
cut into pieces; results are exact whatever it returns.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SKETCH_ACCURACY = 20_000
BRACKET_MARGIN = 2 / SKETCH_ACCURACY


# (rough probability, exact 1-based rank as a function of the row count)
Target = tuple[float, Callable[[Column], Column]]


def _with_brackets(values: DataFrame, targets: Sequence[Target], by: list[str]) -> DataFrame:
    """Count rows per cell: one cell per distinct value near a target rank, one cell
    for each stretch between targets."""
    around = sorted({p for p, _ in targets})
    edges = [
        min(max(p + side, 0.0), 1.0)
        for p in around
        for side in (-BRACKET_MARGIN, BRACKET_MARGIN)
    ]
    sketch = values.groupBy(*by).agg(
        F.percentile_approx("value", edges, SKETCH_ACCURACY).alias("edges")
    )
    # One row per group; groups are closed sets (segment, tier, label), so this is small.
    if by:
        marked = values.join(F.broadcast(sketch), by)
    else:
        marked = values.crossJoin(F.broadcast(sketch))
    value = F.col("value")
    near, passed = F.lit(False), F.lit(0)
    for i in range(len(around)):
        low, high = F.col("edges")[2 * i], F.col("edges")[2 * i + 1]
        near = near | ((value >= low) & (value <= high))
        passed = passed + (value > low).cast("int") + (value > high).cast("int")
    return (
        marked.select(
            *by, "value", F.when(near, value).alias("exact"), F.when(~near, passed).alias("gap")
        )
        .groupBy(*by, "exact", "gap")
        .agg(
            F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("rows")
        )
    )


def order_statistics(
    values: DataFrame,
    targets: Sequence[Target],
    by: Sequence[str] = (),
    few_values: bool = False,
) -> DataFrame:
    """The values at given ranks, per group: columns ``by``, ``n``, ``s0``, ``s1``, ...

    ``values`` has the columns ``by`` and ``value``; ``by`` must be a closed set of
    groups. With ``few_values`` the column is known to have few distinct values (days,
    scores) and is counted without a sketch. One task sees only the cells, that is the
    distinct values within 0.01 % of rank around each target.
    """
    by = list(by)
    values = values.where(F.col("value").isNotNull()).select(*by, "value")
    if few_values:
        cells = values.groupBy(*by, "value").agg(F.count("*").alias("rows"))
        cells = cells.select(
            *by,
            F.col("value").alias("exact"),
            F.col("value").alias("low"),
            F.col("value").alias("high"),
            "rows",
        )
    else:
        cells = _with_brackets(values, targets, by)
    group = Window.partitionBy(*by)
    cells = cells.select(
        *by,
        "exact",
        "low",
        "high",
        "rows",
        F.sum("rows").over(group.orderBy("low")).alias("upto"),
        F.sum("rows").over(group).alias("n"),
    )
    upto, rows = F.col("upto"), F.col("rows")
    picks = []
    for i, (_, rank) in enumerate(targets):
        wanted = rank(F.col("n"))
        # A rank next to a bracket is the first or last row of a stretch between targets.
        found = (
            F.when(F.col("exact").isNotNull(), F.col("exact"))
            .when(wanted == upto - rows + 1, F.col("low"))
            .when(wanted == upto, F.col("high"))
            .otherwise(F.raise_error("rank outside its sketch bracket"))
        )
        hit = (wanted <= upto) & (wanted > upto - rows)
        picks.append(F.max(F.when(hit, found)).alias(f"s{i}"))
    return cells.groupBy(*by).agg(F.max("n").alias("n"), *picks)


def quantiles(
    values: DataFrame,
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    few_values: bool = False,
) -> DataFrame:
    """Linearly interpolated quantiles, per group: ``by``, ``n``, ``q0``, ``q1``, ..."""
    targets: list[Target] = []
    for p in probabilities:
        targets.append((p, lambda n, p=p: F.floor((n - 1) * p) + 1))
        targets.append((p, lambda n, p=p: F.least(F.floor((n - 1) * p) + 2, n)))
    found = order_statistics(values, targets, by, few_values)
    columns = []
    for i, p in enumerate(probabilities):
        position = (F.col("n") - 1) * F.lit(float(p))
        low, high = F.col(f"s{2 * i}").cast("double"), F.col(f"s{2 * i + 1}").cast("double")
        fraction = position - F.floor(position)
        columns.append((low + (high - low) * fraction).alias(f"q{i}"))
    return found.select(*by, "n", *columns)


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    few_values: bool = False,
) -> dict[str, list[float]]:
    """Like ``DataFrame.approxQuantile`` but exact; all columns share the passes."""
    long = df.select([F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "metric", "value"
    )
    rows = quantiles(long, probabilities, ["metric"], few_values).collect()
    found = {r["metric"]: [r[f"q{i}"] for i in range(len(probabilities))] for r in rows}
    return {c: found.get(c, [None] * len(probabilities)) for c in columns}


def _cut_points(df: DataFrame, columns: Sequence[str]) -> list[list[float]]:
    """Cuts into as many ranges as the cluster has shuffle partitions, by one sketch
    with a partial step."""
    ranges = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    grid = [i / ranges for i in range(1, ranges)]
    row = df.agg(*[F.percentile_approx(c, grid, 4 * ranges).alias(c) for c in columns]).first()
    return [list(row[c] or ()) for c in columns]


def _bucketed(df: DataFrame, column: str, cuts: Sequence[float], out: str) -> DataFrame:
    splits = [-math.inf, *sorted(set(cuts)), math.inf]
    if len(splits) < 3:
        return df.withColumn(out, F.lit(0.0))
    bucketizer = Bucketizer(splits=splits, inputCol=column, outputCol=out, handleInvalid="keep")
    return bucketizer.transform(df)


def running_totals(
    df: DataFrame,
    order: str,
    tie: str | None = None,
    descending: bool = False,
    sums: Mapping[str, str] | None = None,
    rank: str = "rank",
    count: str | None = None,
    totals: Mapping[str, str] | None = None,
) -> DataFrame:
    """Global rank and running sums over a total order, in parallel.

    ``order`` is a non-null number, ``tie`` a unique number that breaks ties.
    ``sums`` maps new running columns to their (BIGINT) sources; ``count`` and
    ``totals`` name columns for the overall row count and overall sums.

    Rows go to value ranges; each range is ordered by its own task and shifted by the
    size of the ranges before it. A value that fills more than one range (most
    customers share one frequency, say) is cut again by ranges of ``tie``, so a range
    holds about as much as any shuffle partition. ``df`` is read three times: stage it first.
    """
    sums, totals = dict(sums or {}), dict(totals or {})
    key = F.col(order).cast("double")
    keyed = df.withColumn("_key", -key if descending else key)
    if tie:
        keyed = keyed.withColumn("_tie", F.col(tie).cast("double"))
    cuts = _cut_points(keyed, ["_key", "_tie"] if tie else ["_key"])
    repeated = sorted({a for a, b in zip(cuts[0], cuts[0][1:]) if a == b})
    after_repeated = [math.nextafter(value, math.inf) for value in repeated]
    keyed = _bucketed(keyed, "_key", [*cuts[0], *after_repeated], "_range")
    if tie and repeated:
        keyed = _bucketed(keyed, "_tie", cuts[1], "_tie_range")
        keyed = keyed.withColumn(
            "_part", F.when(F.col("_key").isin(repeated), F.col("_tie_range")).otherwise(0.0)
        ).drop("_tie_range")
    else:
        keyed = keyed.withColumn("_part", F.lit(0.0))

    # One row per pair of ranges: at most a constant times the shuffle partitions for
    # each repeated value.
    sources = sorted({*sums.values(), *totals.values()})
    sizes = keyed.groupBy("_range", "_part").agg(
        F.count("*").alias("_rows"), *[F.sum(s).alias(f"_sum_{s}") for s in sources]
    )
    before = Window.orderBy("_range", "_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = sizes.select(
        "_range",
        "_part",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_rows").over(everything).alias("_rows_all"),
        *[
            F.coalesce(F.sum(f"_sum_{s}").over(before), F.lit(0)).alias(f"_before_{s}")
            for s in sources
        ],
        *[F.sum(f"_sum_{s}").over(everything).alias(f"_all_{s}") for s in sources],
    )
    local = Window.partitionBy("_range", "_part").orderBy("_key", *([tie] if tie else []))
    running = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = keyed.select(
        "*",
        F.row_number().over(local).alias("_row"),
        *[F.sum(s).over(running).alias(f"_run_{name}") for name, s in sums.items()],
    )
    added = [(F.col("_row") + F.col("_rows_before")).cast("bigint").alias(rank)]
    added += [
        (F.col(f"_run_{name}") + F.col(f"_before_{s}")).alias(name) for name, s in sums.items()
    ]
    if count:
        added.append(F.col("_rows_all").alias(count))
    added += [F.col(f"_all_{s}").alias(name) for name, s in totals.items()]
    return placed.join(F.broadcast(offsets), ["_range", "_part"]).select(*df.columns, *added)
