"""Mixing sources to target weights by systematic sampling.

A source's documents all have the same expected number of copies, target / source_size. Along
(size, doc_id) the expected copies are summed up; with a random offset added, a document is taken
once for each integer that its stretch of the sum crosses. As neighbours are of like size, the
words taken from a source differ from its target by about one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import positions, rank, running

WEIGHTS, SHARE, MOST, SEED = (3, 1, 2), 1.5, 2, "mix"
#: Sources up to which the table of their parts is broadcast.
FEW_SOURCES = 10_000


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size) to (source, source_size, target), one row a source.

    Sources by code point, null last, have the weights in turn. Targets are in proportion to the
    weights and sum to share times all sizes, but stop at most times the source's own; the level
    is found in closed form: with sources by size / weight, those before the first whose limit
    exceeds its part of the rest are at their limit. An empty table gives no rows.
    """
    named = F.col("source").asc_nulls_last()
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = running(sizes.select("source", "source_size"), [named], []).select("source", "source_size", weight.cast("long").alias("w"), (F.col("source_size") / weight).alias("ratio"))
    level = running(ranked, [F.col("ratio").asc_nulls_last(), named], ["source_size", "w"])
    whole, all_weights = level.agg(F.sum("source_size"), F.sum("w")).first()
    level = level.withColumn("rest", share * F.lit(whole).cast("long") - most * F.col("before_source_size")).withColumn("w_rest", F.lit(all_weights).cast("long") - F.col("before_w"))
    free = F.when(most * F.col("source_size") * F.col("w_rest") >= F.col("w") * F.col("rest"), F.col("w_rest"))
    (per_weight,) = level.agg(F.max_by(F.col("rest") / F.col("w_rest"), free)).first()
    limit = (most * F.col("source_size")).cast("double")
    return level.select("source", "source_size", F.coalesce(F.least(limit, F.col("w") * F.lit(per_weight).cast("double")), limit).alias("target"))


def offset(seed: str = SEED) -> Column:
    """A number from 0 to under 1 for each source."""
    name = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed), name)), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def copies(docs: DataFrame, size: Column | None = None, seed: str = SEED, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """docs with __size, __source_size, __target and __copies, how often the mix takes the row.

    docs needs doc_id, source and text, or what size, its number of words, is made of. Null text has no words. Null is a source of its own, the
    last. A source without words has target 0 and no copies. Rows equal in source, size and
    doc_id may swap their copies. An empty table gives no rows.
    """
    rows, parts = positions(docs.withColumn("__size", words_in(F.col("text")) if size is None else size).withColumnRenamed("source", "__source"), "__source", ["__size", "doc_id"])
    sizes = rows.groupBy(F.col("__source").alias("source")).agg(F.sum("__size").alias("source_size"))
    own = targets(sizes, weights, share, most).withColumn("u", offset(seed))
    at = parts.join(own, F.col("__source").eqNullSafe(F.col("source"))).select(F.col("__source").alias("__s"), F.col("__part").alias("__p"), "__lo", "__before", F.col("source_size").alias("__source_size"), F.col("target").alias("__target"), F.col("u").alias("__u"))
    if sizes.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES:
        at = F.broadcast(at)
    met = rows.join(at, (F.col("__part") == F.col("__p")) & F.col("__source").eqNullSafe(F.col("__s")))
    rate = F.when(F.col("__source_size") > 0, F.col("__target") / F.col("__source_size")).otherwise(0.0)
    crossed = F.floor(F.col("__u") + rate * (rank() + 1)) - F.floor(F.col("__u") + rate * rank())
    named = [F.col("__source").alias(c) if c == "source" else F.col(c) for c in docs.columns]
    return met.select(*named, "__size", "__source_size", "__target", crossed.cast("long").alias("__copies"))


def _whole(docs: DataFrame) -> list[Column]:
    """Two hashes of a row's columns; maps, which can't be hashed, as JSON."""
    columns = [F.to_json(F.struct(c)) if "map<" in kind else F.col(c) for c, kind in docs.dtypes]
    null = F.concat(*(F.when(F.col(c).isNull(), "1").otherwise("0") for c in docs.columns))
    return [F.xxhash64(null, *columns).alias("__one"), F.xxhash64(F.lit("two"), *columns, null).alias("__two")]


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs, each as often as the mix takes it; all columns stay.

    The texts are shuffled once, by two hashes of the whole row, when the copies, which are counted
    without them, come back. Rows that are equal throughout share theirs; rows of one doc_id that differ
    in anything, or null ids, have their own. Null text has no words, null is a source. An empty table stays empty.
    """
    keys = ["__one", "__two"]
    thin = docs.select("doc_id", "source", words_in(F.col("text")).alias("__n"), *_whole(docs))
    taken = copies(thin, F.col("__n"), **options).groupBy(*keys).agg(F.sum("__copies").alias("__times")).where("__times > 0")
    rows = docs.select("*", *_whole(docs)).join(taken, keys)
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    once = rows.withColumn("__nth", first).where("__nth = 1")
    return once.withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__times").cast("int")))).select(*docs.columns)
