"""What the corpus operators have in common: tables in the shared folder, positions, components."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..keep import drop, fresh
from ..keep import keep as cut

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut_thin(df: DataFrame, rows: int) -> DataFrame:
    """cut for about so many narrow rows, in no more parts than these need; the number of parts grows with them."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(df.coalesce(min(n, 8 + rows // 100_000)))


@contextmanager
def written(df: DataFrame, codec: str = "zstd") -> Iterator[DataFrame]:
    """A Parquet copy of df in the shared folder for the length of a with-block.

    What is derived from it has to be computed (see cut) before the block ends.
    """
    spark = df.sparkSession
    path = fresh(spark)
    df.write.option("compression", codec).parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        drop(spark, path)


def lean(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """run for mapInArrow, after which the Python worker gives free memory back, as it outlives its task."""

    @functools.wraps(run)
    def wrapped(batches: Batches) -> Batches:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):
            ctypes.CDLL("libc.so.6").malloc_trim(0)

    return wrapped


def whole_groups(batches: Batches, keys: list[str]) -> Batches:
    """The same rows in batches that end where a group ends; rows equal in keys, whole numbers, come side by side."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        by = np.column_stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys])
        starts = np.flatnonzero((by[1:] != by[:-1]).any(1)) + 1
        if held:
            last = [held[0].column(k)[0].as_py() for k in keys]
            if by[0].tolist() != last:
                starts = np.concatenate(([0], starts))
            if not len(starts):
                held.append(batch)
                continue
        elif not len(starts):
            held = [batch]
            continue
        done = [*held, batch.slice(0, starts[-1])]
        if sum(b.num_rows for b in done):
            yield pa.concat_batches(done)
        held = [batch.slice(starts[-1])]
    if held:
        yield pa.concat_batches(held)


def _in_order(df: DataFrame, by: list[Column]) -> DataFrame:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = cut(df).repartitionByRange(n, *by).sortWithinPartitions(*by)
    return cut(rows.withColumn("__mid", F.monotonically_increasing_id()).withColumn("__part", F.shiftright("__mid", 33).cast("int")))


def running(df: DataFrame, by: list[Column], sums: list[str]) -> DataFrame:
    """df with rank, from 0, in the order by, and before_x, the sum of x in the rows before, for each x of sums.

    A task sums its own stretch of the order; only a row for each task meets in one.
    """
    rows = _in_order(df, by)
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    per = rows.groupBy("__part").agg(F.count("*").alias("n"), F.min("__mid").alias("lo"), *(F.sum(x).alias(x) for x in sums))
    zero = lambda c: F.coalesce(c, F.lit(0))
    per = per.select(F.col("__part").alias("p"), "lo", zero(F.sum("n").over(earlier)).alias("n"), *(zero(F.sum(x).over(earlier)).alias(f"o_{x}") for x in sums))
    own = Window.partitionBy("__part").orderBy("__mid").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({f"w_{x}": zero(F.sum(x).over(own)) for x in sums}).join(F.broadcast(per), F.col("__part") == F.col("p"))
    return rows.select(*df.columns, (F.col("__mid") - F.col("lo") + F.col("n")).alias("rank"), *((F.col(f"w_{x}") + F.col(f"o_{x}")).alias(f"before_{x}") for x in sums))


def positions(df: DataFrame, key: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rank of every row within its key without bringing a key into one task.

    Rows are range-partitioned on (key, order), so a hot key spreads over many tasks. Returns
    (rows, parts): rows has ``__part`` and ``__mid`` added; parts has for each (key, __part)
    ``__lo``, the first ``__mid``, and ``__before``, the key's rows in earlier parts. A row's
    rank from 0 is ``__mid - __lo + __before``. parts has at most keys + partitions rows.
    Nulls of key are a key of their own. Rows equal in key and order are ranked arbitrarily. df is
    kept before it is sorted, as finding the ranges would compute it once more; it should be narrow.
    """
    by = [F.col(key).asc_nulls_last(), *(F.col(c).asc_nulls_last() for c in order)]
    rows = _in_order(df, by)
    per = rows.groupBy(key, "__part").agg(F.min("__mid").alias("__lo"), F.count("*").alias("__n"))
    earlier = Window.partitionBy(key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    return rows, per.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).drop("__n")


def rank() -> Column:
    return F.col("__mid") - F.col("__lo") + F.col("__before")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (u long, v long) as rows (node, root), root the least node.

    Alternates large-star and small-star steps until the edges no longer change. Every step
    aggregates before it shuffles, and a hub's rows only meet one row of minima in a join, which
    Spark splits when skewed. Nodes without an edge to another node have no row. Null ends are dropped.
    """
    edges = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())

    def mark(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    seen = mark(edges)
    while seen[0]:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # kept, so that the join with a hub's rows has an exchange of its own, whose partitions Spark can split
        least = cut_thin(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), seen[0])
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_thin(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), seen[0])
        now = mark(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
