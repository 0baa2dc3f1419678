"""Operators along an order: runs, gaps, moving windows, prefix sums, medians."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def longest_run(rows: DataFrame, key: str, order: str, hot: Column, least: int = 3) -> DataFrame:
    """(key, first, last) of the longest run of neighbouring order values with hot, at least so long; the first of equals."""
    on = rows.where(hot).withColumn("__g", F.col(order) - F.row_number().over(Window.partitionBy(key).orderBy(order)))
    each = on.groupBy(key, "__g").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n")).where(F.col("n") >= least)
    return each.groupBy(key).agg(F.max_by(F.struct("first", "last"), F.struct(F.col("n"), -F.col("first"))).alias("r")).select(key, "r.first", "r.last")


def merged_runs(rows: DataFrame, key: str, order: str, hot: Column, gap: int = 2) -> DataFrame:
    """(key, first, last) of runs with hot; those less than gap apart are one."""
    w = Window.partitionBy(key).orderBy(order)
    on = rows.where(hot).withColumn("__new", F.coalesce((F.col(order) - F.lag(order).over(w) > gap).cast("int"), F.lit(0))).withColumn("__g", F.sum("__new").over(w))
    return on.groupBy(key, "__g").agg(F.min(order).alias("first"), F.max(order).alias("last")).drop("__g")


def upper_median(values: Column) -> Column:
    """The middle, of an even number the upper one."""
    return F.element_at(F.array_sort(values), F.floor(F.size(values) / 2).cast("int") + 1)


def moving_mean(value: str, key: str, order: str, k: int = 5) -> Column:
    """Over k rows, with zeros beyond the ends."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(-(k // 2), k // 2)
    return F.sum(value).over(w) / float(k)


def moving_max(value: str, key: str, order: str, reach: int = 40) -> Column:
    return F.max(value).over(Window.partitionBy(key).orderBy(order).rowsBetween(-reach, reach))


def line_gaps(lines: DataFrame) -> DataFrame:
    """(page_num, line_idx, gap, pitch): distances of line centres between 1.7 and 8 times the page's pitch.

    The pitch is the upper median of the distances from 10 to 200; a page needs five of those.
    """
    w = Window.partitionBy("page_num").orderBy("cy", "line_idx")
    steps = lines.withColumn("gap", F.lead("cy").over(w) - F.col("cy"))
    usual = steps.where("gap > 10 and gap < 200").groupBy("page_num").agg(F.collect_list("gap").alias("g")).where("size(g) >= 5").select("page_num", upper_median(F.col("g")).alias("pitch"))
    return steps.join(usual, "page_num").where("gap > 1.7 * pitch and gap < 8 * pitch").select("page_num", "line_idx", "gap", "pitch")
