"""Exact medians per group by bracketing, also of groups too large for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DayTimeIntervalType, YearMonthIntervalType

from flatloom.scratch import written

# The sketch's size; its ranks are off by well under BRACKET, and the result is exact in any case.
SKETCH_K = 800
BRACKET = 0.01
# Distinct values of a group that may be ranked in one task; a larger bracket is cut into SPLITS first.
RANKED, SPLITS = 1 << 18, 64


def _number(value: Column, kind: DataType) -> Column:
    """The value as a double that never falls where the value rises."""
    if isinstance(kind, DayTimeIntervalType):
        return F.unix_micros(F.lit("1970-01-01 00:00:00Z").cast("timestamp") + value).cast("double")
    if isinstance(kind, YearMonthIntervalType):
        return (F.extract(F.lit("YEAR"), value) * 12 + F.extract(F.lit("MONTH"), value)).cast("double")
    return value.cast("double")


def _brackets(valued: DataFrame) -> DataFrame:
    """(_g, _total, _from, _to): per group its number of values, and two numbers with the middle most likely between."""
    # The sketch has no NaN; it stands with infinity, below which all else lies.
    number = F.nanvl(F.col("_number"), F.lit(float("inf")))
    sketched = valued.groupBy("_group").agg(F.count("*").alias("_total"), F.kll_sketch_agg_double(number, SKETCH_K).alias("_sketch"))
    low, high = (F.kll_sketch_get_quantile_double("_sketch", F.lit(0.5 + side * BRACKET)) for side in (-1, 1))
    top = F.when(high == float("inf"), F.lit(float("nan"))).otherwise(high)
    return sketched.select(F.col("_group").alias("_g"), "_total", low.alias("_from"), top.alias("_to"))


def _covers(rank: Column, first: Column, n: Column) -> Column:
    return (rank > first) & (rank <= first + n)


def _low() -> Column:
    return F.floor((F.col("_total") + 1) / 2)


def _high() -> Column:
    return F.floor(F.col("_total") / 2) + 1


# What is known of a group: values inside of its bracket with their numbers, and how many lie below (-1) or above (1).
_COUNTED = ("_group", "_total", "_side", "_value", "_number", "_n")


def _same() -> Column:
    return F.col("_group").eqNullSafe(F.col("_g"))


def _sides(valued: DataFrame, bounds: DataFrame) -> DataFrame:
    """The values of each group counted: those inside of its bounds one by one, the others by side."""
    joined = valued.join(bounds, _same())
    side = F.when(F.col("_number") < F.col("_from"), -1).when(F.col("_number") > F.col("_to"), 1).otherwise(0)
    kept = [F.when(side == 0, F.col(c)).alias(c) for c in ("_value", "_number")]
    counted = joined.groupBy("_group", "_total", side.alias("_side"), *kept).agg(F.count("*").alias("_n"))
    return counted.select(*_COUNTED)


def _sizes(counted: DataFrame) -> DataFrame:
    """(_group, _total, _hit, _size): whether the bracket has both middle values, and its distinct values."""
    before = F.coalesce(F.sum(F.when(F.col("_side") < 0, F.col("_n"))), F.lit(0))
    inside = F.coalesce(F.sum(F.when(F.col("_side") == 0, F.col("_n"))), F.lit(0))
    sizes = counted.groupBy("_group", "_total").agg(
        before.alias("_before"), inside.alias("_inside"), F.count_if(F.col("_side") == 0).alias("_size"),
        F.min("_number").alias("_least"), F.max("_number").alias("_most"),
    )
    hit = (F.col("_before") < _low()) & (F.col("_before") + F.col("_inside") >= _high())
    can_cut = (F.col("_size") > RANKED) & ~F.col("_least").eqNullSafe(F.col("_most"))
    return sizes.select("_group", "_total", hit.alias("_hit"), can_cut.alias("_large"))


def _narrowed(counted: DataFrame) -> DataFrame:
    """The counted values once more, with the inside of large groups cut at quantiles: only the
    parts that hold a middle value stay inside, what lies before them is added up."""
    names = _sizes(counted).filter("_large").select(F.col("_group").alias("_g"))
    names = written(names, "large-groups")
    large = counted.join(names, _same(), "left_semi")
    ranks = F.array(*[F.lit(i / SPLITS) for i in range(1, SPLITS)])
    sketch = F.kll_sketch_agg_double(F.nanvl(F.col("_number"), F.lit(float("inf"))), SKETCH_K)
    cuts = large.filter("_side = 0").groupBy("_group").agg(sketch.alias("_sketch"), F.min("_number").alias("_least"))
    # The smallest value stands alone, so that every round takes something away.
    all_cuts = F.array_union(F.array("_least"), F.kll_sketch_get_quantile_double("_sketch", ranks))
    cuts = written(cuts.select(F.col("_group").alias("_g"), all_cuts.alias("_cuts")), "median-cuts")
    part = F.when(F.col("_side") < 0, -1).when(F.col("_side") > 0, SPLITS + 2)
    part = part.otherwise(F.size(F.filter("_cuts", lambda c: c < F.col("_number"))))
    parted = written(large.join(cuts, _same()).select(*_COUNTED, part.alias("_part")), "median-parts")
    sums = parted.groupBy("_group", "_part", "_total").agg(F.sum("_n").alias("_n"))
    # One row per group and part.
    upto = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("_first", F.sum("_n").over(upto) - F.col("_n"))
    middle = _covers(_low(), F.col("_first"), F.col("_n")) | _covers(_high(), F.col("_first"), F.col("_n"))
    held = sums.filter(middle).groupBy(F.col("_group").alias("_g")).agg(F.min("_part").alias("_p"), F.max("_part").alias("_q"))
    held = written(held, "median-middle")
    side = F.when(F.col("_part") < F.col("_p"), -1).when(F.col("_part") > F.col("_q"), 1).otherwise(0)
    cut = parted.join(held, _same()).withColumn("_side", side)
    cut = cut.withColumns({c: F.when(F.col("_side") == 0, F.col(c)) for c in ("_value", "_number")})
    cut = cut.groupBy(*_COUNTED[:-1]).agg(F.sum("_n").alias("_n"))
    return written(counted.join(names, _same(), "left_anti").unionByName(cut), "median-narrowed")


def _small(brackets: DataFrame) -> tuple[DataFrame, int]:
    """The brackets as a table of known size, and the number of values of the largest group.

    They are written: the size of rows that come from the driver is not known, so all values would be
    shuffled by their group to meet them, and sorted in as many tasks as there are groups.
    """
    table = written(brackets, "median-brackets")
    return table, table.agg(F.max("_total")).first()[0] or 0


def _fitting(valued: DataFrame, brackets: DataFrame) -> DataFrame:
    """The counted values, with both middle values inside and no more inside than a task can rank."""
    counted = written(_sides(valued, brackets), "median-sides")
    worst = F.bool_and("_hit").alias("hit"), F.bool_or("_large").alias("large")
    state = _sizes(counted).agg(*worst).first()
    if state["hit"] is False:
        missed = _sizes(counted).filter("not _hit").select(F.col("_group").alias("_g"), "_total")
        missed = written(missed, "median-missed")
        none = {c: F.lit(None).cast("double") for c in ("_from", "_to")}
        again = written(_sides(valued, missed.withColumns(none)), "median-sides")
        counted = counted.join(missed.drop("_total"), _same(), "left_anti").unionByName(again)
        state = _sizes(counted).agg(*worst).first()
    while state["large"]:
        counted = _narrowed(counted)
        state = _sizes(counted).agg(*worst).first()
    return counted


def _ranked(counted: DataFrame) -> DataFrame:
    """(_group, _low, _high, _hit): the two middle values of each group."""
    running = Window.partitionBy("_group").orderBy("_side", "_value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("_first", F.sum("_n").over(running) - F.col("_n"))
    low, high = (_covers(rank, F.col("_first"), F.col("_n")) for rank in (_low(), _high()))
    return ranked.groupBy("_group").agg(
        F.max(F.when(low, F.col("_value"))).alias("_low"),
        F.max(F.when(high, F.col("_value"))).alias("_high"),
        # Both middle values lie inside of the bracket.
        (F.bool_or(low & (F.col("_side") == 0)) & F.bool_or(high & (F.col("_side") == 0))).alias("_hit"),
    )


def median_by(rows: DataFrame, group: str, value: str, name: str = "median") -> DataFrame:
    """Exact median of ``value`` per ``group``; groups without a value do not appear.

    The built-in median keeps every distinct value of a group in one task. Here a mergeable quantile
    sketch brackets the middle of each group in one pass; a second pass counts what lies below
    and keeps only the values inside, about a fiftieth. These are ranked. The sketch decides
    nothing but the amount of work: counts tell whether the middle was hit, a group whose bracket missed it is
    taken whole, and a bracket with too many values is cut at quantiles and counted again.
    NULL is a group of its own; NaN is above all numbers. Numbers give doubles, intervals give
    intervals, as with the built-in.
    """
    kind = rows.schema[value].dataType
    valued = rows.select(F.col(group).alias("_group"), F.col(value).alias("_value")).filter("_value is not null")
    valued = valued.withColumn("_number", _number(F.col("_value"), kind))
    brackets, largest = _small(_brackets(valued))
    found = None
    # Values of the largest bracket, by the sketch's estimate: a task can rank them as they are counted.
    if 3 * BRACKET * largest <= RANKED:
        found = written(_ranked(_sides(valued, brackets)), "medians")
        if not found.filter("not _hit").isEmpty():
            found = None
    if found is None:
        found = _ranked(_fitting(valued, brackets))
    interval = isinstance(kind, (DayTimeIntervalType, YearMonthIntervalType))
    lower, upper = (F.col(c) if interval else F.col(c).cast("double") for c in ("_low", "_high"))
    # The same weighting of the two middle values as the built-in median.
    median = F.when(lower == upper, lower).otherwise(lower * 0.5 + upper * 0.5)
    return found.select(F.col("_group").alias(group), median.alias(name))
