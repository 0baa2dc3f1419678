"""Whitespace of pages: gutters between lines, slits between words, rivers, clearances, docks and ports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Edge of the tiles that overlap joins are keyed on, in pixels.
TILE = 64


def line_extents(words: DataFrame) -> DataFrame:
    return words.groupBy("page_num", "line_idx").agg(F.min("bbox_x0").alias("x0"), F.min("bbox_y0").alias("y0"), F.max("bbox_x1").alias("x1"), F.max("bbox_y1").alias("y1"), F.count("*").alias("n"))


def h_gutters(words: DataFrame, bodies: DataFrame) -> DataFrame:
    """Bands above the first line, between consecutive lines and below the last that are over 1 high.

    (page_num, gutter_id, kind, line_idx_a, line_idx_b, x0, y0, x1, y1); ids count from 0 on what is kept.
    """
    order = Window.partitionBy("page_num").orderBy("line_idx")
    lines = line_extents(words).select("page_num", "line_idx", "y0", "y1")
    lined = lines.select("page_num", "line_idx", "y0", "y1", F.lag("line_idx").over(order).alias("above"), F.lag("y1").over(order).alias("above_y1"), F.lead("line_idx").over(order).alias("below"))
    b = bodies.select("page_num", F.col("x0").alias("bx0"), F.col("y0").alias("by0"), F.col("x1").alias("bx1"), F.col("y1").alias("by1"))
    none = F.lit(None).cast("int")
    before = F.struct(F.col("above").alias("a"), F.col("line_idx").alias("b"), F.when(F.col("above").isNull(), F.col("by0")).otherwise(F.col("above_y1")).alias("top"), F.col("y0").alias("bottom"), F.lit(0).alias("last"))
    after = F.when(F.col("below").isNull(), F.struct(F.col("line_idx").alias("a"), none.alias("b"), F.col("y1").alias("top"), F.col("by1").alias("bottom"), F.lit(1).alias("last")))
    bands = lined.join(b, "page_num").select("page_num", "line_idx", "bx0", "bx1", F.explode(F.array_compact(F.array(before, after))).alias("g")).where("g.bottom > g.top + 1")
    number = F.row_number().over(Window.partitionBy("page_num").orderBy("line_idx", "g.last")) - 1
    return bands.select("page_num", number.alias("gutter_id"), F.lit("h_line").alias("kind"), F.col("g.a").alias("line_idx_a"), F.col("g.b").alias("line_idx_b"), F.col("bx0").alias("x0"), F.col("g.top").alias("y0"), F.col("bx1").alias("x1"), F.col("g.bottom").alias("y1"))


def v_slits(words: DataFrame, bodies: DataFrame, gutters: DataFrame) -> DataFrame:
    """Gaps before, between and after the words of a line that are over 1 wide; ids go on from the gutters'."""
    order = Window.partitionBy("page_num", "line_idx").orderBy("bbox_x0", "id")
    whole = Window.partitionBy("page_num", "line_idx")
    b = bodies.select("page_num", F.col("x0").alias("bx0"), F.col("x1").alias("bx1"))
    spread = words.select("page_num", "line_idx", "id", "bbox_x0", "bbox_x1", F.lead("bbox_x0").over(order).alias("next"), F.row_number().over(order).alias("nth"), F.min("bbox_x0").over(whole).alias("first"), F.min("bbox_y0").over(whole).alias("y0"), F.max("bbox_y1").over(whole).alias("y1"))
    right = F.struct(F.col("nth").alias("k"), F.col("bbox_x1").alias("x0"), F.coalesce("next", "bx1").alias("x1"))
    left = F.when(F.col("nth") == 1, F.struct(F.lit(0).alias("k"), F.col("bx0").alias("x0"), F.col("first").alias("x1")))
    gaps = spread.join(b, "page_num").select("page_num", "line_idx", "y0", "y1", F.explode(F.array_compact(F.array(left, right))).alias("s")).where("s.x1 > s.x0 + 1")
    start = gutters.groupBy("page_num").agg(F.count("*").alias("start"))
    number = F.row_number().over(Window.partitionBy("page_num").orderBy("line_idx", "s.k")) - 1
    return gaps.join(start, "page_num", "left").select("page_num", (F.coalesce("start", F.lit(0)) + number).cast("int").alias("gutter_id"), F.lit("v_slit").alias("kind"), F.col("line_idx").alias("line_idx_a"), F.lit(None).cast("int").alias("line_idx_b"), F.col("s.x0").alias("x0"), "y0", F.col("s.x1").alias("x1"), "y1")


def band_pairs(left: DataFrame, right: DataFrame, keys: list[str], value: str, other: str, reach: float) -> DataFrame:
    """Join where |value - other| <= reach within keys: buckets of that width turn it into an equi-join."""
    a = left.withColumn("__b", F.explode(F.array(*(F.floor(F.col(value) / reach) + i for i in (-1, 0, 1)))))
    b = right.withColumn("__b", F.floor(F.col(other) / reach))
    return a.join(b, [*keys, "__b"]).where(F.abs(F.col(value) - F.col(other)) <= reach).drop("__b")


def river_scores(slits: DataFrame, reach: float = 4.0) -> DataFrame:
    """slits with river_score: by how many lines a vertical cluster of slit centres spans, the greatest over clusters with the slit."""
    centre = slits.select("page_num", "gutter_id", F.col("line_idx_a").alias("line"), ((F.col("x0") + F.col("x1")) / 2).alias("cx"))
    other = centre.select("page_num", F.col("gutter_id").alias("o_id"), F.col("line").alias("o_line"), F.col("cx").alias("ox"))
    met = band_pairs(centre, other, ["page_num"], "cx", "ox", reach).where("line <> o_line")
    # a slit's neighbours are those of its page, so the join is made once and its pairs folded at once
    near = met.groupBy("page_num", "gutter_id").agg((F.size(F.collect_set("o_line")) + 1).alias("n"), F.collect_set("o_id").alias("ids")).where("n >= 3")
    score = F.least(F.lit(1.0), (F.col("n") - 2) / 4.0).alias("score")
    spread = near.select("page_num", score, F.explode(F.array_append("ids", F.col("gutter_id"))).alias("gutter_id"))
    best = spread.groupBy("page_num", "gutter_id").agg(F.max("score").alias("river_score"))
    return slits.join(best, ["page_num", "gutter_id"], "left").withColumn("river_score", F.coalesce("river_score", F.lit(0.0)))


#: Of a word's box, for either axis: its range across, and its near and far edge.
_AXES = (("bbox_x0", "bbox_x1", "bbox_y0", "bbox_y1"), ("bbox_y0", "bbox_y1", "bbox_x0", "bbox_x1"))
_BOX = ("bbox_x0", "bbox_y0", "bbox_x1", "bbox_y1")


def breathing(words: DataFrame, bodies: DataFrame) -> DataFrame:
    """(page_num, id, top, bottom, left, right): distance to the nearest word in each direction, or to the body's edge; 0 at least.

    Both axes go through one join on tiles, in which a word also meets itself and so stays.
    """
    sides = F.array(*(F.struct(F.lit(k).alias("axis"), *(F.col(c).alias(n) for c, n in zip(axis, ("low", "high", "near", "far"), strict=True))) for k, axis in enumerate(_AXES)))
    tiled = words.select("page_num", "id", *_BOX, F.inline(sides)).withColumn("t", F.explode(F.sequence(F.floor(F.col("low") / TILE), F.floor(F.col("high") / TILE))))
    other = tiled.select("page_num", "axis", "t", F.col("id").alias("o"), *(F.col(c).alias("o_" + c) for c in ("low", "high", "near", "far")))
    met = tiled.join(other, ["page_num", "axis", "t"]).where((F.col("o_high") >= F.col("low")) & (F.col("o_low") <= F.col("high")))

    def least(axis: int, gap: Column) -> Column:
        return F.min(F.when((F.col("axis") == axis) & (F.col("id") != F.col("o")) & (gap >= 0), gap))

    before, after = F.col("near") - F.col("o_far"), F.col("o_near") - F.col("far")
    found = met.groupBy("page_num", "id", *_BOX).agg(least(0, before).alias("above"), least(0, after).alias("below"), least(1, before).alias("west"), least(1, after).alias("east"))
    b = bodies.select("page_num", *(F.col(c).alias("b" + c) for c in ("x0", "y0", "x1", "y1")))
    room = lambda edge, gap: F.greatest(F.lit(0.0), F.least(edge, F.coalesce(gap, edge))).cast("double")
    return found.join(b, "page_num").select("page_num", "id", room(F.col("bbox_y0") - F.col("by0"), F.col("above")).alias("top"), room(F.col("by1") - F.col("bbox_y1"), F.col("below")).alias("bottom"), room(F.col("bbox_x0") - F.col("bx0"), F.col("west")).alias("left"), room(F.col("bx1") - F.col("bbox_x1"), F.col("east")).alias("right"))


def slack_direction(top: Column, bottom: Column, left: Column, right: Column) -> Column:
    """The direction whose clearance is at least 1.3 times the next one's, or ''."""
    ranked = F.sort_array(F.array(*(F.struct(v.alias("v"), F.lit(c).alias("c")) for c, v in (("N", top), ("S", bottom), ("W", left), ("E", right)))), asc=False)
    first, second = F.element_at(ranked, 1), F.element_at(ranked, 2)
    return F.when(first["v"] <= 0, "").when((second["v"] > 0) & (first["v"] < 1.3 * second["v"]), "").otherwise(first["c"])


def _bordered(words: DataFrame, gutters: DataFrame) -> DataFrame:
    above = gutters.where("line_idx_b is not null").select("page_num", F.col("line_idx_b").alias("line_idx"), F.col("gutter_id").alias("dock_above"))
    below = gutters.where("line_idx_a is not null").select("page_num", F.col("line_idx_a").alias("line_idx"), F.col("gutter_id").alias("dock_below"))
    return words.join(above, ["page_num", "line_idx"], "left").join(below, ["page_num", "line_idx"], "left")


def _between_slits(words: DataFrame, slits: DataFrame) -> DataFrame:
    """words with dock_left and dock_right; grouped by all their columns, which leaves them where the join on lines put them."""
    s = slits.select("page_num", F.col("line_idx_a").alias("line_idx"), F.col("gutter_id").alias("__g"), F.col("x0").alias("__x0"), F.col("x1").alias("__x1"))
    left, right = F.col("bbox_x0") - F.col("__x1"), F.col("__x0") - F.col("bbox_x1")
    pick = lambda d: F.min(F.when(d >= 0, F.struct(d.alias("d"), F.col("__g").alias("g"))))["g"]
    return words.join(s, ["page_num", "line_idx"], "left").groupBy(*words.columns).agg(pick(left).alias("dock_left"), pick(right).alias("dock_right"))


def dock_lines(words: DataFrame, gutters: DataFrame) -> DataFrame:
    """(id, dock_above, dock_below): the gutters that border the word's line."""
    return _bordered(words.select("id", "page_num", "line_idx"), gutters).select("id", "dock_above", "dock_below")


def nearest_slits(words: DataFrame, slits: DataFrame) -> DataFrame:
    """(id, dock_left, dock_right): the nearest slit of the line on either side; of equally near ones the first."""
    return _between_slits(words.select("page_num", "line_idx", "id", "bbox_x0", "bbox_x1"), slits).select("id", "dock_left", "dock_right")


def docks(words: DataFrame, bodies: DataFrame, gutters: DataFrame, slits: DataFrame) -> DataFrame:
    """The word_docks table, ports without node ids: docks, breathing, slack_direction and ports N, S, W, E where there is a dock."""
    own = _between_slits(_bordered(words.select("page_num", "line_idx", "id", *_BOX), gutters), slits)
    return docked(own.join(breathing(words, bodies), ["page_num", "id"]))


def docked(all_: DataFrame, nodes: Column | None = None) -> DataFrame:
    """The word_docks table of words with their docks and clearances top, bottom, left, right; nodes, a map by compass, are the ports' node_id."""
    cx, cy = (F.col("bbox_x0") + F.col("bbox_x1")) / 2, (F.col("bbox_y0") + F.col("bbox_y1")) / 2
    step = lambda c: F.least(F.col(c) * 0.5, F.lit(15.0))

    def port(compass: str, dock: str, x: Column, y: Column) -> Column:
        return F.when(F.col(dock).isNotNull(), F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"), F.col(dock).alias("gutter_id"), F.lit(compass).alias("compass"), *([] if nodes is None else [nodes[compass].alias("node_id")])))

    ports = F.array_compact(F.array(port("N", "dock_above", cx, F.col("bbox_y0") - step("top")), port("S", "dock_below", cx, F.col("bbox_y1") + step("bottom")), port("W", "dock_left", F.col("bbox_x0") - step("left"), cy), port("E", "dock_right", F.col("bbox_x1") + step("right"), cy)))
    return all_.select("page_num", F.col("id").alias("word_id"), "line_idx", "dock_above", "dock_below", "dock_left", "dock_right", F.col("top").alias("breathing_top"), F.col("bottom").alias("breathing_bottom"), F.col("left").alias("breathing_left"), F.col("right").alias("breathing_right"), slack_direction(F.col("top"), F.col("bottom"), F.col("left"), F.col("right")).alias("slack_direction"), ports.alias("ports"))
