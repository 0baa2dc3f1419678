"""Operators on page images: as long tables (page_num, y, x, value) where windows and sums do, in numpy for whole images."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values.
SHADOW_STEP, SHADOW_DARKER, STRIP, MARGIN = 12, 5, 100, 8
#: Sums of the same means in another order differ by less than this, means of whole numbers that aren't equal by more.
EXACT = 1e-9


def ink_threshold(pixels: DataFrame) -> DataFrame:
    """(page_num, threshold): half a deviation under the mean, 60 at least."""
    return pixels.groupBy("page_num").agg(F.greatest(F.lit(60), F.floor(F.avg("value") - 0.5 * F.stddev_pop("value")).cast("int")).alias("threshold"))


def profile(pixels: DataFrame, axis: str, how: str = "sum") -> DataFrame:
    """Sums or means along rows (axis y) or columns (axis x)."""
    return pixels.groupBy("page_num", axis).agg((F.sum if how == "sum" else F.avg)("value").alias("value"))


def shadow_edge(profiles: DataFrame, key: str, at: str, value: str, low_edge: bool) -> DataFrame:
    """(key, cut): place after the steepest step of a profile, where it is a shadow's edge.

    low_edge: place 0 is at the page's edge. The step has to be SHADOW_STEP, and the edge's side darker by over
    SHADOW_DARKER in the mean, whatever order the places come in. Profiles of under eight places have none.
    """
    w = Window.partitionBy(key).orderBy(at)
    sign = 1 if low_edge else -1
    steps = profiles.withColumn("__step", sign * (F.lead(value).over(w) - F.col(value)))
    peaks = steps.groupBy(key).agg(F.max_by(at, F.struct("__step", -F.col(at))).alias("peak"), F.max("__step").alias("step"), F.count("*").alias("n")).where((F.col("n") >= 8) & (F.col("step") >= SHADOW_STEP))
    met = profiles.join(peaks, key)
    left = F.avg(F.when(F.col(at) < F.greatest(F.lit(1), F.col("peak")), F.col(value)))
    right = F.avg(F.when(F.col(at) > F.col("peak"), F.col(value)))
    sides = met.groupBy(key, "peak").agg(left.alias("l"), right.alias("r")).withColumn("r", F.coalesce("r", F.col("l") + 1))
    darker = F.col("r") - F.col("l") if low_edge else F.col("l") - F.col("r")
    return sides.where(darker > SHADOW_DARKER + EXACT).select(key, (F.col("peak") + 1).alias("cut"))


def shadow_regions(pixels: DataFrame, text: DataFrame, valid: DataFrame, strip: int = STRIP, margin: int = MARGIN) -> DataFrame:
    """(page_num, x0, y0, x1, y1): the dark margins beside a page's text box, up to four, for whitewash.

    text and valid are boxes (page_num, x0, y0, x1, y1). On each side where the text is over margin from the
    valid region's edge, the mean of the strip next to the text, strip wide at most, is searched for a
    shadow's edge. What is cut is between the valid region's edge and that place. Fixed rule: on the left
    and at the top the profile runs from the text outwards and is judged as if it began at the page's edge.
    """
    b = text.join(valid.select("page_num", *(F.col(c).alias("v" + c) for c in ("x0", "y0", "x1", "y1"))), "page_num")
    out = None
    for side, axis, low, depth in (("left", "x", True, F.col("x0") - F.col("vx0")), ("right", "x", False, F.col("vx1") - F.col("x1")), ("top", "y", True, F.col("y0") - F.col("vy0")), ("bottom", "y", False, F.col("vy1") - F.col("y1"))):
        other = "y" if axis == "x" else "x"
        near = b.where(depth > margin).withColumn("d", F.least(F.lit(strip), depth))
        begin = F.col(f"{axis}0") - F.col("d") if low else F.col(f"{axis}1")
        near = near.select("page_num", "x0", "y0", "x1", "y1", "vx0", "vy0", "vx1", "vy1", "d", begin.alias("begin"))
        own = pixels.withColumnsRenamed({"x": "px", "y": "py"}).join(near, "page_num")
        own = own.where((F.col("p" + axis) >= F.col("begin")) & (F.col("p" + axis) < F.col("begin") + F.col("d")) & (F.col("p" + other) >= F.col(other + "0")) & (F.col("p" + other) < F.col(other + "1")))
        place = F.col("begin") + F.col("d") - 1 - F.col("p" + axis) if low else F.col("p" + axis) - F.col("begin")
        profiles = own.groupBy("page_num", place.alias("at")).agg(F.avg("value").alias("v"))
        cut = near.join(shadow_edge(profiles, "page_num", "at", "v", low), "page_num").withColumn("cut", F.col("begin") + F.col("cut"))
        box = {"left": ("vx0", "y0", "cut", "y1"), "right": ("cut", "y0", "vx1", "y1"), "top": ("x0", "vy0", "x1", "cut"), "bottom": ("x0", "cut", "x1", "vy1")}[side]
        one = cut.select("page_num", F.lit(side).alias("side"), *(F.col(c).alias(n) for c, n in zip(box, ("x0", "y0", "x1", "y1"), strict=True)))
        out = one if out is None else out.unionAll(one)
    return out


def moving_max_2d(pixels: DataFrame, reach: int = 40) -> DataFrame:
    """The greatest value in a square around each pixel, one direction after the other."""
    across = F.max("value").over(Window.partitionBy("page_num", "y").orderBy("x").rowsBetween(-reach, reach))
    down = F.max("value").over(Window.partitionBy("page_num", "x").orderBy("y").rowsBetween(-reach, reach))
    return pixels.withColumn("value", across).withColumn("value", down)


def _mirrored(pixels: DataFrame, axis: str, size: str, k: int) -> DataFrame:
    """Rows beyond both ends, as in a mirror that stands on the edge, so far as a window of k reaches."""
    ends = F.array(F.col(axis), F.when(F.col(axis) < k, -F.col(axis) - 1), F.when(F.col(size) - F.col(axis) <= k, 2 * F.col(size) - F.col(axis) - 1))
    return pixels.withColumn(axis, F.explode(F.array_compact(ends)))


def moving_mean_2d(pixels: DataFrame, k: int = 200) -> DataFrame:
    """Means over k by k pixels, k / 2 of them before; images are mirrored at their edges."""
    out = pixels
    for axis, other in (("x", "y"), ("y", "x")):
        sized = out.withColumn("__n", F.max(axis).over(Window.partitionBy("page_num")) + 1)
        w = Window.partitionBy("page_num", other).orderBy(axis).rowsBetween(-(k // 2), (k - 1) // 2)
        out = _mirrored(sized, axis, "__n", k).withColumn("value", F.avg("value").over(w)).where((F.col(axis) >= 0) & (F.col(axis) < F.col("__n"))).drop("__n")
    return out


def whitewash(pixels: DataFrame, text: DataFrame, shadows: DataFrame) -> DataFrame:
    """pixels with 255 outside the page's text box (page_num, x0, y0, x1, y1) and inside its shadows."""
    box = text.select("page_num", *(F.col(c).alias("t" + c) for c in ("x0", "y0", "x1", "y1")))
    s = shadows.groupBy("page_num").agg(F.collect_list(F.struct("x0", "y0", "x1", "y1")).alias("s"))
    own = pixels.join(box, "page_num", "left").join(s, "page_num", "left")
    inside = (F.col("x") >= F.col("tx0")) & (F.col("x") < F.col("tx1")) & (F.col("y") >= F.col("ty0")) & (F.col("y") < F.col("ty1"))
    dark = F.coalesce(F.exists("s", lambda r: (F.col("x") >= r["x0"]) & (F.col("x") < r["x1"]) & (F.col("y") >= r["y0"]) & (F.col("y") < r["y1"])), F.lit(False))
    return own.select("page_num", "y", "x", F.when(F.coalesce(inside, F.lit(True)) & ~dark, F.col("value")).otherwise(255).alias("value"))


def without_stamp(pixels: DataFrame, stamps: DataFrame, offsets: DataFrame, height: int) -> DataFrame:
    """pixels with 255 from eight rows above the page's stamp (page_num, y0), moved by its rounded dy, down to the bottom."""
    top = stamps.join(offsets.select("page_num", "dy"), "page_num").select("page_num", (F.bround(F.col("y0") + F.col("dy")).cast("int") - 8).alias("top"))
    own = pixels.join(top.where((F.col("top") > 0) & (F.col("top") < height)), "page_num", "left")
    return own.withColumn("value", F.when(F.col("y") >= F.col("top"), 255).otherwise(F.col("value"))).drop("top")


def pasted(pixels: DataFrame, offsets: DataFrame, out_w: int, out_h: int) -> DataFrame:
    """Images pasted at the rounded offset (page_num, dx, dy) of their page; what falls outside the canvas goes.

    The rest of the canvas has no rows; its colour is the caller's.
    """
    own = pixels.join(offsets.select("page_num", "dx", "dy"), "page_num")
    at = own.select("page_num", (F.col("y") + F.bround("dy").cast("int")).alias("y"), (F.col("x") + F.bround("dx").cast("int")).alias("x"), "value")
    return at.where((F.col("x") >= 0) & (F.col("y") >= 0) & (F.col("x") < out_w) & (F.col("y") < out_h))


def layered(pixels: DataFrame, overlay: DataFrame, paper: int = 244) -> DataFrame:
    """pixels faded towards paper, with an overlay (page_num, y, x, colour, alpha) on them; an overlay's later rows, by its layer, lie over earlier ones."""
    from ..functions.columns import faded, over

    each = overlay.groupBy("page_num", "y", "x").agg(F.transform(F.sort_array(F.collect_list(F.struct("layer", "colour", "alpha"))), lambda o: o).alias("o"))
    base = pixels.join(each, ["page_num", "y", "x"], "left").withColumn("value", faded(F.col("value"), paper))
    laid = F.aggregate(F.coalesce("o", F.array().cast("array<struct<layer:int,colour:int,alpha:int>>")), F.col("value"), lambda v, o: over(v, o["colour"], o["alpha"]))
    return base.select("page_num", "y", "x", laid.alias("value"))


def shifted(pixels: DataFrame, dy: int, height: int) -> DataFrame:
    """The image moved down by dy; what comes in is 255."""
    return pixels.withColumn("y", F.pmod(F.col("y") + dy, F.lit(height))).withColumn("value", F.when((F.col("y") < dy) | (F.col("y") >= height + dy), 255).otherwise(F.col("value")))


def cell_case(tl: Column, tr: Column, br: Column, bl: Column) -> Column:
    """Which corners of a cell are inside, as bits 1, 2, 4, 8 clockwise from the top left."""
    return sum((F.when(v < 0, 1 << k).otherwise(0) for k, v in enumerate((tl, tr, br, bl))), F.lit(0))


def gaussian(image: np.ndarray, sigma: float = 60) -> np.ndarray:
    """Blur with the edge's values beyond it, four deviations wide."""
    reach = int(4 * sigma + 0.5)
    x = np.arange(-reach, reach + 1)
    kernel = np.exp(-0.5 * (x / sigma) ** 2)
    kernel /= kernel.sum()
    for axis in (0, 1):
        padded = np.pad(image, [(reach, reach) if a == axis else (0, 0) for a in (0, 1)], mode="edge")
        image = np.apply_along_axis(lambda v: np.convolve(v, kernel, "valid"), axis, padded)
    return image


def _box(image: np.ndarray, k: int) -> np.ndarray:
    for axis in (0, 1):
        padded = np.pad(image, [(k // 2, (k - 1) // 2) if a == axis else (0, 0) for a in (0, 1)], mode="symmetric")
        total = np.cumsum(np.insert(padded, 0, 0, axis), axis)
        n = image.shape[axis]
        image = (np.take(total, np.arange(k, k + n), axis) - np.take(total, np.arange(n), axis)) / k
    return image


def _greatest(image: np.ndarray, reach: int) -> np.ndarray:
    for axis in (0, 1):
        padded = np.pad(image, [(reach, reach) if a == axis else (0, 0) for a in (0, 1)], mode="edge")
        image = np.lib.stride_tricks.sliding_window_view(padded, 2 * reach + 1, axis).max(-1)
    return image


def normalised(gray: np.ndarray, reach: int = 40, sigma: float = 60, k: int = 200) -> np.ndarray:
    """Paper evened out and contrast stretched, as bytes."""
    flat = np.clip(gray / np.maximum(gaussian(_greatest(gray, reach), sigma), 1) * 255, 0, 255)
    mean = _box(flat, k)
    deviation = np.sqrt(np.maximum(_box(flat * flat, k) - mean * mean, 0))
    white = mean - 0.3 * deviation
    span = np.maximum(white - (mean - 2.5 * deviation), 100)
    return np.clip((flat - (white - span)) * 255 / span, 0, 255).astype(np.uint8)


def normalise_images(images: DataFrame, reach: int = 40, sigma: float = 60, k: int = 200) -> DataFrame:
    """images (page_num, width, height, gray: bytes) normalised, image by image."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [normalised(np.frombuffer(r.gray, np.uint8).reshape(r.height, r.width).astype(np.float64), reach, sigma, k).tobytes() for r in batch.itertuples()]
            yield batch[["page_num", "width", "height"]].assign(gray=out)

    return images.select("page_num", "width", "height", "gray").mapInPandas(run, "page_num long, width int, height int, gray binary")


def rotate_images(images: DataFrame, angles: DataFrame) -> DataFrame:
    """images (page_num, width, height, gray: bytes) turned by their page's angle; pages without one are left alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [np.clip(np.rint(rotated(np.frombuffer(r.gray, np.uint8).reshape(r.height, r.width).astype(np.float64), r.angle)), 0, 255).astype(np.uint8).tobytes() for r in batch.itertuples()]
            yield batch[["page_num", "width", "height"]].assign(gray=out)

    own = images.join(angles.select("page_num", "angle"), "page_num", "left").withColumn("angle", F.coalesce("angle", F.lit(0.0)))
    return own.select("page_num", "width", "height", "gray", "angle").mapInPandas(run, "page_num long, width int, height int, gray binary")


def rotated(gray: np.ndarray, degrees: float) -> np.ndarray:
    """The image turned about its centre by linear sampling; what comes in has the value of pixel (5, 5)."""
    if abs(degrees) < 0.005:
        return gray
    h, w = gray.shape
    c, s = np.cos(np.radians(degrees)), np.sin(np.radians(degrees))
    y, x = np.mgrid[0:h, 0:w] - np.array([(h - 1) / 2, (w - 1) / 2])[:, None, None]
    sx, sy = x * c - y * s + (w - 1) / 2, x * s + y * c + (h - 1) / 2
    x0, y0 = np.floor(sx).astype(int), np.floor(sy).astype(int)
    known = (x0 >= 0) & (y0 >= 0) & (x0 < w - 1) & (y0 < h - 1)
    a, b = np.clip(x0, 0, w - 2), np.clip(y0, 0, h - 2)
    u, v = sx - x0, sy - y0
    out = (gray[b, a] * (1 - u) + gray[b, a + 1] * u) * (1 - v) + (gray[b + 1, a] * (1 - u) + gray[b + 1, a + 1] * u) * v
    return np.where(known, out, gray[min(5, h - 1), min(5, w - 1)])
