"""Phrase chunks: candidacy, runs, part-of-speech patterns, scores, spaced selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values.
BLOCKED = ("grenville",)
CLICHES = ("heart", "soul", "love", "dream", "hope", "darkness", "light", "shadow")
HEADER = "HUMAN DOCUMENT"
TAGS = {"ADP": "p", "DET": "d", "PRON": "d", "ADJ": "a", "ADV": "r", "NUM": "a", "NOUN": "n", "PROPN": "n", "VERB": "v", "AUX": "x", "PART": "t"}
#: Over TAGS; m in words: a modifier is a or r.
NOUN_PHRASE, VERB_PHRASE = "^p?[dv]?[ar]*n+", "^r*[vx][arxt]*"


def page_number(text: Column, line: Column) -> Column:
    return text.rlike("^[0-9]+$") & (line <= 1)


def header_lines(words: DataFrame, phrase: str = HEADER) -> DataFrame:
    """(page_num, line_idx) of lines 0 and 1 in capitals throughout with phrase in them."""
    own = words.where("line_idx <= 1").groupBy("page_num", "line_idx").agg(F.bool_and(F.col("text") == F.upper("text")).alias("upper"), F.sort_array(F.collect_list(F.struct("bbox_x0", "id", "text"))).alias("w"))
    return own.where(F.col("upper") & F.array_join(F.transform("w", lambda x: x["text"]), " ").contains(phrase)).select("page_num", "line_idx")


def header_lines_any(words: DataFrame, phrase: str = HEADER) -> DataFrame:
    """As header_lines, but one word with a letter in capitals is enough."""
    cased = (F.col("text") == F.upper("text")) & (F.col("text") != F.lower("text"))
    own = words.where("line_idx <= 1").groupBy("page_num", "line_idx").agg(F.bool_or(cased).alias("upper"), F.sort_array(F.collect_list(F.struct("bbox_x0", "id", "text"))).alias("w"))
    return own.where(F.col("upper") & F.array_join(F.transform("w", lambda x: x["text"]), " ").contains(phrase)).select("page_num", "line_idx")


def candidates(words: DataFrame, phrase: str = HEADER) -> DataFrame:
    """Words that may stand in a chunk."""
    single = (F.length("text") != 1) | F.col("text").isin("I", "a", "O")
    own = words.where(~F.lower("text").isin(*BLOCKED) & (F.col("conf") >= 0.7) & single & ~page_number(F.col("text"), F.col("line_idx")))
    return own.join(header_lines(words, phrase), ["page_num", "line_idx"], "left_anti")


def runs(cands: DataFrame) -> DataFrame:
    """cands with run, counted from 0 in the page: a new one where the line jumps by more than one."""
    order = Window.partitionBy("page_num").orderBy("line_idx", "bbox_x0", "id")
    jump = F.coalesce((F.col("line_idx") - F.lag("line_idx").over(order) > 1).cast("int"), F.lit(0))
    return cands.withColumn("__jump", jump).withColumn("run", F.sum("__jump").over(order).cast("int")).drop("__jump")


def chunks(cands: DataFrame, max_len: int = 4) -> DataFrame:
    """(page_num, run, start, words): from left to right the longer of a noun and a verb phrase, cut off at max_len.

    cands needs pos, rarity and is_content; words are structs in reading order. A page is one row while its phrases are found.
    """
    tag = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in TAGS.items() for x in kv)), F.coalesce("pos", F.lit(""))), F.lit("o"))
    word = F.struct("line_idx", "bbox_x0", "id", "text", "rarity", "is_content", "pos", "bbox_y0", "bbox_x1", "bbox_y1", tag.alias("tag"))
    own = runs(cands).groupBy("page_num", "run").agg(F.sort_array(F.collect_list(word)).alias("w"))
    own = own.withColumn("tags", F.array_join(F.transform("w", lambda x: x["tag"]), ""))

    def longest(i: Column) -> Column:
        rest = F.substring(F.col("tags"), i + 1, F.length("tags"))
        return F.least(F.lit(max_len), F.greatest(*(F.length(F.regexp_extract(rest, p, 0)) for p in (NOUN_PHRASE, VERB_PHRASE))))

    state = F.struct(F.lit(0).alias("next"), F.array().cast("array<struct<start:int,n:int>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        take = (x["i"] >= acc["next"]) & (x["n"] > 0)
        return F.struct(F.when(take, x["i"] + x["n"]).otherwise(acc["next"]).alias("next"), F.when(take, F.array_append(acc["out"], F.struct(x["i"].alias("start"), x["n"].alias("n")))).otherwise(acc["out"]).alias("out"))

    sizes = F.transform(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.struct(i.alias("i"), longest(i).alias("n")))
    found = own.select("page_num", "run", "w", F.explode(F.aggregate(sizes, state, step, lambda a: a["out"])).alias("c"))
    return found.select("page_num", "run", F.col("c.start").alias("start"), F.slice("w", F.col("c.start") + 1, F.col("c.n")).alias("words"))


def chunk_score(words: Column) -> Column:
    """Rarity, content and clichés of a chunk's words, its length and its last word; -999 without content."""
    total = F.aggregate(words, F.lit(0.0), lambda s, w: s + F.coalesce(w["rarity"], F.lit(0.0)) + F.when(w["is_content"] == 1, 0.4).otherwise(0.0) - F.when(F.lower(w["text"]).isin(*CLICHES), 0.4).otherwise(0.0))
    n, last = F.size(words), F.element_at(words, -1)
    bonus = F.when(n == 1, 0.0).when(n == 2, 0.7).when(n == 3, 0.6).when(n == 4, 0.2).otherwise(-0.4)
    return F.when(F.exists(words, lambda w: w["is_content"] == 1), total + bonus + F.when(last["pos"].isin("NOUN", "PROPN"), 0.4).otherwise(0.0)).otherwise(-999.0)


def scored(found: DataFrame) -> DataFrame:
    """chunks with line_idx and x0 of the first word, ordinal in the page, text, n and score."""
    first = F.element_at("words", 1)
    ordinal = F.row_number().over(Window.partitionBy("page_num").orderBy("run", "start")) - 1
    return found.select("page_num", ordinal.alias("ordinal"), first["line_idx"].alias("line_idx"), first["bbox_x0"].alias("x0"), F.array_join(F.transform("words", lambda w: w["text"]), " ").alias("text"), F.size("words").alias("n"), F.round(chunk_score(F.col("words")), 4).alias("score"), "words")


def select(scored_: DataFrame, n: int = 3, min_line_dist: int = 2, variation: int = 0, seed: int = 42) -> DataFrame:
    """Up to n chunks a page by score, at least min_line_dist lines apart: (page_num, rank, line_idx, x0, text, score) in reading order.

    With variation 1 or 2 the best 4n (12 at least) or 6n (18) are shuffled first, with draws of the seeded generator.
    """
    from ..functions.noise import draw

    own = scored_.where("score > -100").groupBy("page_num").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("neg"), "ordinal", "line_idx", "x0", "text"))).alias("pool"))
    if variation:
        own = own.withColumn("pool", F.slice("pool", 1, max(n * 4, 12) if variation == 1 else max(n * 6, 18)))
        # a step of the shuffle swaps i, from the last down, with a place up to i
        at = F.sequence(F.lit(1), F.size("pool") - 1)

        def swap(a: Column, k: Column) -> Column:
            i = F.size(a) - k
            j = F.floor(draw(F.lit(seed * 1000), k) * (i + 1)).cast("int")
            return F.transform(a, lambda x, p: F.when(p == i, F.get(a, j)).when(p == j, F.get(a, i)).otherwise(x))

        own = own.withColumn("pool", F.when(F.size("pool") > 1, F.aggregate(at, F.col("pool"), swap)).otherwise(F.col("pool")))
    none = F.filter("pool", lambda x: F.lit(False))

    def take(acc: Column, c: Column) -> Column:
        free = (F.size(acc) < n) & F.forall(acc, lambda p: F.abs(p["line_idx"] - c["line_idx"]) >= min_line_dist)
        return F.when(free, F.array_append(acc, c)).otherwise(acc)

    picked = own.select("page_num", F.aggregate("pool", none, take).alias("p"))
    order = F.array_sort(F.transform("p", lambda c: F.struct(c["line_idx"].alias("line_idx"), c["x0"].alias("x0"), c["text"].alias("text"), (-c["neg"]).alias("score"))))
    return picked.select("page_num", F.posexplode(order).alias("rank", "c")).select("page_num", "rank", "c.*")


def rarest(words: DataFrame, n: int = 20) -> DataFrame:
    """The n rarest content words of each page."""
    order = Window.partitionBy("page_num").orderBy(F.desc("rarity"), "id")
    return words.where("is_content = 1").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
