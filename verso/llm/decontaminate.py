"""Benchmark decontamination: a broadcast hash set of test n-grams against all token windows.

DataFrame functions only. The n-grams of the benchmark, as strings, are a literal hash set of the
plan, which every executor gets once, as long as there are at most max_grams of them. In every
n-gram one word, its longest, is its anchor; the windows around a document's anchor words are the
only ones that are put together and looked up, so that most of a text costs one look-up a word.
The set holds the n-grams themselves: what is found is verified. A larger benchmark is joined by
shuffling instead, window by window.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def words(text: Column) -> Column:
    """Runs of digits, letters (A-Z lower-cased) and non-ASCII characters; null has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), ascii_uppercase, ascii_lowercase)
    return F.filter(F.split(lowered, GAP), lambda w: w != "")


def gram(tokens: Column, start: Column, n: Column) -> Column:
    return F.array_join(F.slice(tokens, start + 1, n), " ")


def test_grams(benchmark: DataFrame, n: int = 10) -> DataFrame:
    """Distinct (gram, size, anchor, items): windows of n words; an item of fewer is one window."""
    base = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w")).where("size(w) > 0")
    base = base.withColumn("size", F.least(F.size("w"), F.lit(n)))
    at = base.select("item", "w", "size", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("size"))).alias("start"))
    own = at.select("item", "size", F.slice("w", F.col("start") + 1, F.col("size")).alias("g"))
    own = own.withColumn("anchor", F.aggregate("g", F.lit(""), lambda best, w: F.when(F.length(w) > F.length(best), w).otherwise(best)))
    return own.groupBy(F.array_join("g", " ").alias("gram"), "size", "anchor").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _covered(starts: Column) -> Column:
    """Words inside [start, start + size) of any of the sorted structs."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def step(acc: Column, x: Column) -> Column:
        end = x["start"] + x["size"]
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + F.greatest(F.lit(0), end - F.greatest(acc["end"], x["start"]))).alias("n"))

    return F.aggregate(starts, zero, step, lambda acc: acc["n"])


def with_hits(docs: DataFrame, grams: DataFrame, n: int = 10, max_grams: int = 100_000) -> DataFrame:
    """docs with __n_words and __hits, a sorted array of (start, size, gram) of windows in the benchmark.

    Rows keep their columns and partitions unless the benchmark has over max_grams distinct windows.
    Null and empty texts have no words and no hits, nor have any texts where the benchmark is empty;
    repeated rows have equal hits, and an empty table gives no rows.
    """
    # a generator, as a filter on what follows would otherwise repeat the tokenising in each of its terms
    tokens = docs.withColumn("__w", F.explode(F.array(words(F.col("text")))))
    few = grams.select("gram", "size", "anchor").limit(max_grams + 1).collect()
    if not few:
        none = F.array().cast("array<struct<start:int,size:int,gram:string>>")
        return tokens.select(*docs.columns, F.size("__w").alias("__n_words"), none.alias("__hits"))
    if len(few) > max_grams:
        return _shuffled(docs, grams, n)
    found = []
    for size in sorted({r["size"] for r in few}):
        own = [r for r in few if r["size"] == size]
        anchors = sorted({r["anchor"] for r in own})
        last = F.size("__w") - size
        at = F.filter(F.transform("__w", lambda w, i: F.when(w.isin(anchors), i)), lambda i: i.isNotNull() & (last >= 0))
        starts = F.array_distinct(F.flatten(F.transform(at, lambda i: F.sequence(F.greatest(F.lit(0), i - (size - 1)), F.greatest(F.least(i, last), F.lit(0))))))
        named = F.transform(starts, lambda s: F.struct(s.alias("start"), F.lit(size).alias("size"), gram(F.col("__w"), s, F.lit(size)).alias("gram")))
        found.append(F.filter(named, lambda x: x["gram"].isin([r["gram"] for r in own])))
    hits = F.array_sort(F.concat(*found)) if len(found) > 1 else F.array_sort(found[0])
    return tokens.select(*docs.columns, F.size("__w").alias("__n_words"), hits.alias("__hits"))


def _names(c: Column) -> list[Column]:
    return [F.xxhash64(c).alias("__one"), F.xxhash64(F.lit("two"), c).alias("__two")]


def _shuffled(docs: DataFrame, grams: DataFrame, n: int) -> DataFrame:
    """with_hits by a shuffle join of the windows of each distinct text; for benchmarks that are too large to broadcast.

    Windows travel as two hashes, texts are named by two of their own; equal texts are looked up once.
    """
    keys = ["__one", "__two"]
    sizes = [r["size"] for r in grams.select("size").distinct().collect()]  # 1 to n
    texts = docs.select("text", *_names(F.coalesce("text", F.lit("")))).groupBy(*keys).agg(F.first("text").alias("text"))
    each = texts.select(*keys, F.explode(F.array(words(F.col("text")))).alias("__w")).withColumn("size", F.explode(F.array(*map(F.lit, sizes)))).where(F.size("__w") >= F.col("size"))
    starts = F.transform(F.sequence(F.lit(0), F.size("__w") - F.col("size")), lambda s: F.struct(s.alias("start"), gram(F.col("__w"), s, F.col("size")).alias("gram")))
    each = each.select(*keys, "size", F.explode(starts).alias("x")).select(*keys, "size", "x.start", *(c.alias(k) for c, k in zip(_names(F.col("x.gram")), ("g1", "g2"), strict=True)))
    wanted = grams.select("size", *(c.alias(k) for c, k in zip(_names(F.col("gram")), ("g1", "g2"), strict=True)))
    hits = each.join(wanted, ["size", "g1", "g2"], "left_semi").groupBy(*keys).agg(F.collect_list(F.struct("start", "size")).alias("__at"))
    rows = docs.select("*", *_names(F.coalesce("text", F.lit("")))).join(hits, keys, "left").withColumn("__w", F.explode(F.array(words(F.col("text")))))
    found = F.transform(F.coalesce("__at", F.array().cast("array<struct<start:int,size:int>>")), lambda x: F.struct(x["start"].alias("start"), x["size"].alias("size"), gram(F.col("__w"), x["start"], x["size"]).alias("gram")))
    return rows.select(*docs.columns, F.size("__w").alias("__n_words"), F.array_sort(found).alias("__hits"))


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, max_grams: int = 100_000) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    docs needs doc_id and text, benchmark item_id and text; other columns are ignored. Null and
    empty texts have no words; such items match nothing. Null item_ids are left out of items.
    Repeated rows, also of one doc_id, are judged each for itself. Empty tables give no rows or no hits.
    """
    grams = test_grams(benchmark.select("item_id", "text"), n)
    rows = with_hits(docs.select("doc_id", "text"), grams, n, max_grams)
    thin = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("__n_words").cast("long").alias("n_words"), _covered(F.col("__hits")).cast("long").alias("n_hit"), F.array_distinct(F.transform("__hits", lambda x: x["gram"])).alias("grams"))
    items = thin.select("row", "doc_id", "n_words", "n_hit", F.explode_outer("grams").alias("gram")).join(grams.select("gram", "items"), "gram", "left")
    own = items.groupBy("row", "doc_id", "n_words", "n_hit").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return own.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def uncontaminated(docs: DataFrame, benchmark: DataFrame, n: int = 10, max_grams: int = 100_000) -> DataFrame:
    """The rows of docs in whose text no window of the benchmark occurs; all columns stay.

    Null and empty texts stay, as does all where the benchmark is empty; repeated rows stay or go together.
    """
    grams = test_grams(benchmark.select("item_id", "text"), n)
    return with_hits(docs, grams, n, max_grams).where(F.size("__hits") == 0).select(*docs.columns)


def without_spans(docs: DataFrame, benchmark: DataFrame, n: int = 10, max_grams: int = 100_000) -> DataFrame:
    """docs with clean_words: the text's words without those inside a window of the benchmark.

    A column of that name is replaced. Null and empty texts have ''. Repeated rows are equal; an empty table gives no rows.
    """
    docs = docs.drop("clean_words")
    grams = test_grams(benchmark.select("item_id", "text"), n)
    rows = with_hits(docs, grams, n, max_grams)
    kept = F.filter(words(F.col("text")), lambda w, i: ~F.exists("__hits", lambda x: (x["start"] <= i) & (i < x["start"] + x["size"])))
    return rows.withColumn("clean_words", F.array_join(kept, " ")).select(*docs.columns, "clean_words")
