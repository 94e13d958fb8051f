"""Global positions and exact quantiles that no single task has to hold.

A window without partitions, or one over a group that owns a third of the rows, ends in one task. Here the
rows are range-sorted over the whole cluster instead, written once, and each sorted part is shifted by the
number of rows before it. Only one row per part (at most ``spark.sql.shuffle.partitions``) or per group and
part goes through a window. Quantiles need no sort: brackets around the wanted ranks are narrowed by counting.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfscout.session import passing_tables, spill

# A bracket of a wanted rank is walked once it has so few rows, and cut into so many cells before.
WALKED_ROWS = 4096
CELLS = 4096
_LARGEST = sys.float_info.max

_PART_BITS = 33


def _numbered(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Range-sorted and written, with the part (``_part``) and place within it (``_row``) of each row."""
    marked = df.orderBy(*order).withColumn("_mark", F.monotonically_increasing_id())
    split = marked.withColumn("_part", F.shiftright("_mark", _PART_BITS).cast("int")).withColumn(
        "_row", F.col("_mark").bitwiseAND(F.lit((1 << _PART_BITS) - 1))
    )
    return spill(split.drop("_mark"), "sorted")


def with_position(df: DataFrame, order: Sequence[Column | str], name: str = "position") -> DataFrame:
    """Add the 0-based place of each row in the global order."""
    held = _numbered(df, order)
    sizes = held.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    # One row per sorted part: at most spark.sql.shuffle.partitions rows.
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    return held.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_before") + F.col("_row")).cast("long").alias(name)
    )


def with_group_position(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], name: str = "position"
) -> DataFrame:
    """Add the 0-based place of each row within its group; a hot group is spread over many tasks."""
    placed = with_position(df, [*group, *order], "_place")
    # Written, so that the join meets two plain shuffles and a hot group's partition can be split.
    starts = spill(placed.groupBy(*group).agg(F.min("_place").alias("_start")), "starts")
    return placed.join(starts, list(group)).select(
        *df.columns, (F.col("_place") - F.col("_start")).alias(name)
    )


def value_counts(df: DataFrame, group: Sequence[str], value: str, weight: str = "weight") -> DataFrame:
    """Distinct values with their number of rows, written once; the input of the quantiles below."""
    return spill(df.groupBy(*group, value).agg(F.count("*").alias(weight)), "values")


def weighted_quantiles(
    counts: DataFrame,
    group: Sequence[str],
    value: str,
    weight: str,
    probabilities: Sequence[float],
    walked_rows: int = WALKED_ROWS,
) -> DataFrame:
    """Exact linear-interpolated quantiles per group of a (group, value, weight) table.

    Returns ``(*group, prob, quantile)``; a group without values has no row. Nothing is sorted as a whole: each wanted rank has a bracket,
    at first all values of its group. A pass cuts the brackets into cells, adds up the weights per cell in the tasks, and leaves
    the cell that holds the rank, until it has one value or at most ``walked_rows`` rows; those are gathered and walked. The table must be
    cheap to read more than once (see ``spill``); a value may stand in several of its rows.
    """
    group, spark = list(group), counts.sparkSession
    # One struct as the key, in which a NULL equals a NULL.
    key = F.struct(*([F.col(c) for c in group] or [F.lit(0)])).alias("_g")
    rows = counts.where(F.col(value).isNotNull()).select(key, F.col(value).cast("double").alias("_v"), F.col(weight).cast("long").alias("_w"))
    whole = rows.groupBy("_g").agg(
        F.sum("_w").alias("_total"), F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.count("*").alias("_rows"), F.lit(0).cast("long").alias("_before")
    )
    place = F.col("prob") * (F.col("_total") - 1)
    wanted = whole.withColumn("prob", F.explode(F.lit([float(p) for p in probabilities]))).withColumn("_place", place).drop("_total")
    wanted = wanted.withColumn("_rank", F.explode(F.array_distinct(F.array(F.floor("_place"), F.ceil("_place")))))
    with passing_tables(spark) as lasting:
        wanted, spread = lasting(wanted, "ranks"), True
        wide = (F.col("_rows") > walked_rows) & (F.col("_low") < F.col("_high"))
        while not wanted.where(wide).isEmpty():
            wanted, spread = lasting(_narrowed(rows, wanted.where(wide), spread).unionByName(wanted.where(~wide)), "ranks"), False

    many = wanted.where("_low < _high")
    walk = Window.partitionBy("_g", "_before").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    walked = _inside(rows, many).withColumn("_upto", F.col("_before") + F.sum("_w").over(walk))
    held = (F.col("_rank") >= F.col("_upto") - F.col("_w")) & (F.col("_rank") < F.col("_upto"))
    found = walked.select("_g", "_before", "_v", "_w", "_upto").join(many, ["_g", "_before"]).where(held).select("_g", "prob", "_place", "_v")
    found = found.unionByName(wanted.where("NOT (_low < _high)").select("_g", "prob", "_place", F.col("_low").alias("_v")))
    ends = found.groupBy("_g", "prob", "_place").agg(F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    share = F.col("_place") - F.floor("_place")
    between = F.when(share == 0, F.col("_least")).otherwise(F.col("_least") * (1 - share) + F.col("_most") * share)
    return ends.select(*[F.col("_g").getField(c).alias(c) for c in group], "prob", between.alias("quantile"))


def _inside(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows within the brackets of the wanted ranks; brackets of a group do not overlap."""
    brackets = wanted.select("_g", "_low", "_high", "_before").distinct()
    return rows.join(brackets, "_g").where((F.col("_v") >= F.col("_low")) & (F.col("_v") <= F.col("_high")))


def _narrowed(rows: DataFrame, wanted: DataFrame, spread: bool) -> DataFrame:
    """The wanted ranks with the cell of their bracket that holds them; ``spread`` cuts by magnitude, else in equal widths.

    The ends of a bracket are values of its own and fall into different cells of equal width, so every second pass at least makes it smaller.
    """
    low, high = F.greatest("_low", F.lit(-_LARGEST)), F.least("_high", F.lit(_LARGEST))

    def scaled(x: Column) -> Column:
        if spread:
            return F.signum(x) * F.log1p(F.abs(x))
        # Halved only where the width of the bracket is no number.
        return F.when(high - low > _LARGEST, x / 2).otherwise(x)

    width = scaled(high) - scaled(low)
    cell = F.when(width > 0, F.least(F.floor((scaled(F.col("_v")) - scaled(low)) / width * CELLS), F.lit(CELLS - 1))).otherwise(F.lit(0))
    cell = (
        F.when(F.isnan("_v"), F.lit(CELLS + 1)).when(F.col("_v") > _LARGEST, F.lit(CELLS)).when(F.col("_v") < -_LARGEST, F.lit(-1)).otherwise(cell)
    )
    cells = _inside(rows, wanted).groupBy("_g", F.col("_before").alias("_outer"), cell.cast("int").alias("_cell")).agg(
        F.sum("_w").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.count("*").alias("_rows")
    )
    # At most CELLS + 3 rows per bracket.
    running = Window.partitionBy("_g", "_outer").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_start", F.col("_outer") + F.coalesce(F.sum("_n").over(running), F.lit(0)))
    ranks = wanted.select("_g", "prob", "_place", "_rank", F.col("_before").alias("_outer"))
    held = (F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_start") + F.col("_n"))
    return ranks.join(cells, ["_g", "_outer"]).where(held).select(
        "_g", "_low", "_high", "_rows", F.col("_start").alias("_before"), "prob", "_place", "_rank"
    )


def column_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Exact quantiles of several columns in one pass: ``(column, prob, quantile)``, NULLs skipped."""
    counts = value_counts(stacked(df, columns).where(F.col("value").isNotNull()), ["column"], "value")
    return weighted_quantiles(counts, ["column"], "value", "weight", probabilities)


def approximate_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int = 10_000
) -> DataFrame:
    """One-pass variant with a rank error of 1/accuracy."""
    aggregates = [F.percentile_approx(c, list(map(float, probabilities)), accuracy).alias(c) for c in columns]
    wide = df.agg(*aggregates)
    return (
        wide.unpivot([], list(columns), "column", "values")
        .select("column", F.arrays_zip(F.lit(list(map(float, probabilities))).alias("prob"), F.col("values").alias("quantile")).alias("z"))
        .select("column", F.explode("z").alias("p"))
        .select("column", "p.prob", F.col("p.quantile").cast("double").alias("quantile"))
    )


def stacked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long form ``(column, value)`` of numeric columns."""
    typed = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return typed.unpivot([], list(columns), "column", "value")
