"""Row numbers, ranks, shares, lags and top-n.

A window without a partition, or with one hot partition, sends all its rows through one task.
The functions here range-partition by the ordering instead, park the result, and add each
range's starting offset, so no task sees more than one range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.numeric import safe_pct
from tallyloom.operators.joins import join_null_safe
from tallyloom.session import park

# monotonically_increasing_id() keeps the row's place inside its partition in the low 33 bits.
_PLACE_BITS = 33


def _offsets(stamped: DataFrame, weight: Column) -> DataFrame:
    """Sum of weights in all earlier ranges: one row per range, so it is safe to broadcast."""
    per_range = stamped.groupBy("_range").agg(F.sum(weight).alias("_n"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return per_range.select(
        "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )


def _by_range(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Range-partition, sort and park ``df`` with each row's range and place in it."""
    row_id = F.monotonically_increasing_id()
    stamped = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_row", row_id)
    )
    return park(stamped, "ranges").select(
        "*",
        F.shiftright("_row", _PLACE_BITS).alias("_range"),
        F.col("_row").bitwiseAND((1 << _PLACE_BITS) - 1).alias("_place"),
    )


def surrogate_key(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """``row_number()`` over the whole frame. ``order`` must be total for repeatable keys."""
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    stamped = _by_range(df, columns)
    offsets = F.broadcast(_offsets(stamped, F.lit(1)))
    return (
        stamped.join(offsets, "_range")
        .withColumn(name, F.col("_offset") + F.col("_place") + 1)
        .drop("_range", "_row", "_place", "_offset")
    )


def _ranged_by_value(df: DataFrame, value: str, before: Sequence[str] = ()) -> DataFrame:
    """Ranges of falling ``value``, NULL last. Rows that tie are spread by a hash of the whole row, so they may fill several ranges."""
    hashed = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
    return _by_range(df, [*(F.col(c) for c in before), F.col(value).desc(), F.xxhash64(*hashed)])


def _with_rank(ranged: DataFrame, value: str, name: str, partition: Sequence[str], dense: bool) -> DataFrame:
    """Add the rank by falling ``value`` within ``partition`` to rows in ranges of falling ``value``.

    A group's rows in a range are ranked there. From one range to the next go a group's rows, distinct values, last value and that value's
    rank so far: a row for each group and range, which only such rows meet as have some of their group in an earlier range.
    """
    group = F.struct(*partition) if partition else F.struct(F.lit(0))
    inside = Window.partitionBy("_range", "_group").orderBy(F.col(value).desc())
    local = (
        ranged.withColumn("_group", group)
        .withColumn("_step", F.dense_rank().over(inside))
        .withColumn("_local", F.rank().over(inside))
    )
    pieces = local.groupBy("_range", "_group").agg(
        F.count("*").alias("n"),
        F.max("_step").alias("steps"),
        F.max("_local").alias("last_local"),
        F.min_by(value, "_place").alias("first"),
        F.max_by(value, "_place").alias("last"),
    )
    ranges = Window.partitionBy("_group").orderBy("_range")
    earlier = ranges.rowsBetween(Window.unboundedPreceding, -1)
    so_far = ranges.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    linked = pieces.select(
        "*",
        F.sum("n").over(earlier).alias("_rows_before"),
        (F.col("first").eqNullSafe(F.lag("last").over(ranges)) & F.lag("n").over(ranges).isNotNull()).cast("int").alias("_goes_on"),
    )
    # the rank of a piece's last value, if that value begins in it
    begins = F.when((F.col("steps") > 1) | (F.col("_goes_on") == 0), F.coalesce("_rows_before", F.lit(0)) + F.col("last_local"))
    carried = linked.withColumn("begins", begins).select(
        "_range",
        "_group",
        "_rows_before",
        (F.sum("steps").over(earlier) - F.sum("_goes_on").over(so_far)).alias("_steps_before"),
        "_goes_on",
        F.last("begins", ignorenulls=True).over(earlier).alias("_open_rank"),
    )
    met = local.join(carried.where("_rows_before is not null"), ["_range", "_group"], "left")
    if dense:
        rank = F.col("_step") + F.coalesce("_steps_before", F.lit(0))
    else:
        ties_on = (F.col("_goes_on") == 1) & (F.col("_step") == 1)
        rank = F.when(ties_on, F.col("_open_rank")).otherwise(F.col("_local") + F.coalesce("_rows_before", F.lit(0)))
    return met.select(*ranged.columns, rank.cast("long").alias(name))


def _without_range(ranked: DataFrame) -> DataFrame:
    return ranked.drop("_row", "_range", "_place")


def _ranks(
    df: DataFrame, value: str, name: str, partition: Sequence[str], weight: Column
) -> DataFrame:
    """The rank of each distinct value, by descending ``value`` within ``partition``.

    ``weight`` is what a distinct value adds to the ranks after it.
    """
    keys = [*partition, value]
    steps = df.groupBy(*keys).agg(weight.cast("long").alias("_weight"))
    stamped = _by_range(steps, [*(F.col(c) for c in partition), F.col(value).desc()])
    earlier = (
        Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = stamped.join(F.broadcast(_offsets(stamped, F.col("_weight"))), "_range").select(
        *keys,
        (F.col("_offset") + F.coalesce(F.sum("_weight").over(earlier), F.lit(0))).alias("_before"),
    )
    if partition:
        starts = placed.groupBy(*partition).agg(F.min("_before").alias("_start"))
        placed = join_null_safe(placed, starts, partition)
    else:
        placed = placed.withColumn("_start", F.lit(0))
    return placed.select(*keys, (F.col("_before") - F.col("_start") + 1).alias(name))


def _ranked(df: DataFrame, value: str, name: str, partition: Sequence[str], dense: bool, by_rows: bool) -> DataFrame:
    if by_rows:
        return _without_range(_with_rank(_ranged_by_value(df, value, partition), value, name, partition, dense))
    weight = F.lit(1) if dense else F.count(F.lit(1))
    return join_null_safe(df, _ranks(df, value, name, partition, weight), [*partition, value])


def dense_rank_by(df: DataFrame, value: str, name: str, partition: Sequence[str] = (), by_rows: bool = False) -> DataFrame:
    """``dense_rank()`` by descending value, within ``partition`` if given; NULL ranks last.

    Distinct values are ranked and joined back, which suits values that repeat. ``by_rows`` ranks the rows themselves in ranges, without a
    join on the value, which suits values that are nearly unique; a range then holds all copies of a row that is repeated in every
    column, while other ties are spread. Eager, as ``surrogate_key``.
    """
    return _ranked(df, value, name, partition, True, by_rows)


def rank_by(df: DataFrame, value: str, name: str, partition: Sequence[str] = (), by_rows: bool = False) -> DataFrame:
    """``rank()`` by descending value: ties share a rank and leave a gap after them. Otherwise as ``dense_rank_by``."""
    return _ranked(df, value, name, partition, False, by_rows)


def revenue_ranks(products: DataFrame, value: str = "total_revenue") -> DataFrame:
    """Revenue rank among all products and among those of the same category, over one stored pass of ranges."""
    overall = _with_rank(_ranged_by_value(products, value), value, "revenue_rank", [], dense=True)
    return _without_range(_with_rank(overall, value, "category_revenue_rank", ["category"], dense=True))


def lag_growth(
    daily: DataFrame, order: str, value: str, rows: int, lag_name: str, growth_name: str
) -> DataFrame:
    """The value ``rows`` rows earlier (not days) and the growth since then in percent.

    Rows are numbered by ranges of the ordering, and each meets the one whose number is ``rows`` less; both are
    equi-joined on a unique number, so no task holds more than a range. ``order`` should be total. Eager, as ``surrogate_key``.
    """
    numbered = surrogate_key(daily, [order], "_n")
    earlier = numbered.select((F.col("_n") + rows).alias("_n"), F.col(value).alias(lag_name))
    lagged = numbered.join(earlier, "_n", "left").drop("_n")
    change = F.col(value) - F.col(lag_name)
    return lagged.withColumn(growth_name, F.round(safe_pct(change, F.col(lag_name)), 2))


def share_of_partition(df: DataFrame, partition: Sequence[str], value: str, name: str) -> DataFrame:
    """Percentage of the partition's total; totals are aggregated map-side, then joined."""
    totals = df.groupBy(*partition).agg(F.sum(value).alias("_total"))
    joined = join_null_safe(df, totals, partition)
    return joined.withColumn(name, safe_pct(F.col(value), F.col("_total"))).drop("_total")


def share_of_total(df: DataFrame, value: str, name: str) -> DataFrame:
    """Percentage of the grand total."""
    total = df.agg(F.sum(value).alias("_total")).scalar()
    return df.withColumn(name, safe_pct(F.col(value), total))


def top_n(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """First ``n`` rows of a total order; Spark keeps ``n`` rows per task, not a full sort."""
    return df.orderBy(*order).limit(n)


def first_n_per(
    df: DataFrame, by: Sequence[str], order: Sequence[Column | str], n: int, name: str = "position"
) -> DataFrame:
    """First ``n`` rows of each group; each task drops surplus rows before the shuffle."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)
