"""Data contracts of the page tables, as rows (name, ok, detail)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_pages(pages: DataFrame, first: int, last: int) -> DataFrame:
    """(page_num, kind): numbers of the range without a row, and rows outside the range."""
    wanted = pages.sparkSession.range(first, last + 1).select(F.col("id").alias("page_num"))
    return page_difference(pages.select(F.col("page_num").cast("long").alias("page_num")), wanted)


def page_difference(have: DataFrame, wanted: DataFrame) -> DataFrame:
    """(page_num, kind): pages that only wanted has, missing, and those that only have has, extra."""
    a, b = wanted.select("page_num").distinct(), have.select("page_num").distinct()
    return a.subtract(b).withColumn("kind", F.lit("missing")).unionAll(b.subtract(a).withColumn("kind", F.lit("extra")))


def pages_without_row(corrections: DataFrame, pages: DataFrame) -> DataFrame:
    return corrections.join(pages, "page_num", "left_anti").select("page_num")


def wrong_sizes(pages: DataFrame, width: int = 1400, height: int = 2100) -> DataFrame:
    return pages.where((F.col("width_px") != width) | (F.col("height_px") != height)).select("page_num", "width_px", "height_px")


def orphan_words(words: DataFrame, pages: DataFrame) -> DataFrame:
    return words.join(pages, "page_num", "left_anti").select("id", "page_num")


#: Of a word.
INCOMPLETE = "pos is null or lemma is null or frequency is null or rarity is null or is_content is null or is_connective is null"


def incomplete_features(words: DataFrame) -> DataFrame:
    return words.where(INCOMPLETE).select("id", "page_num")


def bad_boxes(words: DataFrame, pages: DataFrame) -> DataFrame:
    return words.join(pages, "page_num").where("bbox_x0 < 0 or bbox_y0 < 0 or bbox_x1 > width_px or bbox_y1 > height_px or bbox_x0 >= bbox_x1 or bbox_y0 >= bbox_y1").select("id", "page_num")


def graphless(corrections: DataFrame, graph: DataFrame) -> DataFrame:
    return corrections.join(graph.select("page_num").distinct(), "page_num", "left_anti").select("page_num")


def edgeless(graph: DataFrame) -> DataFrame:
    """Pages of which no node has an edge."""
    return graph.groupBy("page_num").agg(F.bool_and(F.size("edges") == 0).alias("none")).where("none").select("page_num")


def dockless(words: DataFrame, docks: DataFrame) -> DataFrame:
    """Pages with words of which none has a dock."""
    have = words.join(docks.select(F.col("word_id").alias("id")), "id", "left_semi").select("page_num").distinct()
    return words.select("page_num").distinct().join(have, "page_num", "left_anti")


def unparsed(json: Column) -> Column:
    """True for text that is not JSON."""
    return F.try_parse_json(json).isNull() & json.isNotNull()


def ports_without_node(docks: DataFrame, ports: str = "ports") -> DataFrame:
    return docks.where(~F.forall(ports, lambda p: p["node_id"].isNotNull())).select("word_id")


def header_numbers(words: DataFrame, number: Column | None = None) -> DataFrame:
    """(page_num, numbered, matched): whether lines 0 to 2 have digits, and the page's number among them; number, if it isn't page_num."""
    top = words.where("line_idx <= 2").groupBy("page_num").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_idx", "bbox_x0", "id", "text"))), lambda x: x["text"]), " ").alias("t"))
    digits = F.regexp_extract_all("t", F.lit(r"\d+"), 0)
    return top.select("page_num", (F.size(digits) > 0).alias("numbered"), F.array_contains(digits, (F.col("page_num") if number is None else number).cast("string")).alias("matched"))


def rate(found: DataFrame) -> DataFrame:
    """header_numbers to one row (numbered, matched, rate): pages with digits, those with their own number, and the share; 0 if there are none."""
    sums = found.agg(F.coalesce(F.sum(F.col("numbered").cast("long")), F.lit(0)).alias("numbered"), F.coalesce(F.sum((F.col("numbered") & F.col("matched")).cast("long")), F.lit(0)).alias("matched"))
    return sums.withColumn("rate", F.when(F.col("numbered") > 0, F.col("matched") / F.col("numbered")).otherwise(0.0))


def poorly_numbered(words: DataFrame, least: float = 0.85) -> DataFrame:
    """The pages whose header has digits but not the page's number, where they are so many that the rate is under least."""
    return unmatched(header_numbers(words), least)


def unmatched(found: DataFrame, least: float = 0.85) -> DataFrame:
    """poorly_numbered of what header_numbers has found."""
    low = rate(found).where(F.col("rate") < least).select("rate")
    return found.where("numbered and not matched").crossJoin(F.broadcast(low)).select("page_num")


def missing_images(pages: DataFrame, images: DataFrame) -> DataFrame:
    """Pages without an image, or whose image (page_num, width, height) has another size: (page_num, kind)."""
    met = pages.join(images.select("page_num", "width", "height"), "page_num", "left")
    kind = F.when(F.col("width").isNull(), "missing").when((F.col("width") != F.col("width_px")) | (F.col("height") != F.col("height_px")), "size")
    return met.select("page_num", kind.alias("kind")).where("kind is not null")


def report(counts: dict[str, DataFrame]) -> DataFrame:
    """(name, ok, failures) of each check, given the rows that break it; rows with failures stand for so many."""
    out = None
    for name, rows in counts.items():
        many = F.coalesce(F.sum("failures"), F.lit(0)).cast("long") if "failures" in rows.columns else F.count("*")
        one = rows.agg(many.alias("failures")).select(F.lit(name).alias("name"), (F.col("failures") == 0).alias("ok"), "failures")
        out = one if out is None else out.unionAll(one)
    return out
