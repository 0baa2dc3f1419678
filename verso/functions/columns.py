"""Small column functions: rounding, boxes, glyphs, colours, images."""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.
WIDE, NARROW = "mwMW—–", "iljtfrI!.,;:'\"’‘“”()[]|"
#: Rough widths of these, of other capitals and digits, and of the rest.
GLYPHS = (1.9, 0.55, 1.25, 1.0)


def half_even(x: Column) -> Column:
    return F.bround(x, 0).cast("int")


def clamp(x: Column, low: Column | float, high: Column | float) -> Column:
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.least(F.greatest(x, lit(low)), lit(high))


def strict_greatest(*xs: Column) -> Column:
    """greatest, but null if one is null."""
    known = xs[0].isNotNull()
    for x in xs[1:]:
        known &= x.isNotNull()
    return F.when(known, F.greatest(*xs))


def strict_least(*xs: Column) -> Column:
    known = xs[0].isNotNull()
    for x in xs[1:]:
        known &= x.isNotNull()
    return F.when(known, F.least(*xs))


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """A struct, or null if its first coordinate is null."""
    return F.when(x0.isNotNull(), F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1")))


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def glyph_weight(text: Column) -> Column:
    """Sum of rough advance widths: wide 1.9, narrow 0.55, other capitals and digits 1.25, else 1."""
    narrow = "[" + "".join("\\" + c if c in "[]|().'\"" else c for c in NARROW) + "]"
    wide_n, narrow_n = _count(text, f"[{WIDE}]"), _count(text, narrow)
    tall_n = _count(text, r"[\p{Lu}\p{Nd}]") - _count(text, "[MWI]")
    rest = F.char_length(text) - wide_n - narrow_n - tall_n
    return sum((F.lit(g) * n for g, n in zip(GLYPHS[1:], (narrow_n, tall_n, rest), strict=True)), GLYPHS[0] * wide_n)


def alnum_length(text: Column) -> Column:
    return F.char_length(F.regexp_replace(text, r"[^\p{L}\p{N}]", ""))


def colour_ramp(rarity: Column) -> dict[str, Column]:
    """Overlay colours by rarity: share of 1.5 to 6, alpha and line width."""
    s = clamp((rarity - 1.5) / 4.5, 0.0, 1.0)
    return {"share": s, "alpha": half_even(45 + 165 * s), "line_width": 1 + half_even(3 * s)}


def luma(r: Column, g: Column, b: Column) -> Column:
    return 0.299 * r + 0.587 * g + 0.114 * b


def stretched(value: Column, mean: Column, deviation: Column) -> Column:
    """Local contrast: white and black points from mean and deviation, 100 apart at least; cut to 0 to 255."""
    white = mean - 0.3 * deviation
    span = F.greatest(F.lit(100.0), white - (mean - 2.5 * deviation))
    return F.floor(clamp((value - (white - span)) * 255.0 / span, 0.0, 255.0)).cast("int")


def bottom_left_box(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """A box given by shares of the page, y from the bottom up, in pixels from the top: struct(x0, y0, x1, y1), rounded half to even."""
    return F.struct(half_even(x * width).alias("x0"), half_even((1 - y - h) * height).alias("y0"), half_even((x + w) * width).alias("x1"), half_even((1 - y) * height).alias("y1"))


def faded(value: Column, paper: Column | int, share: float = 0.62) -> Column:
    """A pixel drawn towards the paper's colour, 0 to 255, cut to a whole number."""
    return F.floor(value + (paper - value) * share).cast("int")


def over(value: Column, colour: Column, alpha: Column) -> Column:
    """A colour of opacity alpha, 0 to 255, laid over a pixel; no colour leaves it."""
    return F.when(colour.isNull(), value).otherwise(half_even((colour * alpha + value * (255 - alpha)) / 255.0))


def padded_path(prefix: str, n: Column, suffix: str) -> Column:
    """prefix, n with at least four digits, suffix; longer numbers are not cut."""
    s = n.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(s) < 4, F.lpad(s, 4, "0")).otherwise(s), F.lit(suffix))


def contain(width: Column, height: Column, cell_w: int, cell_h: int) -> Column:
    """How an image fits into a cell: struct(w, h, x, y), centred, one pixel at least."""
    scale = F.least(cell_w / width, cell_h / height)
    w, h = F.greatest(F.lit(1), half_even(width * scale)), F.greatest(F.lit(1), half_even(height * scale))
    return F.struct(w.alias("w"), h.alias("h"), F.floor((cell_w - w) / 2).cast("int").alias("x"), F.floor((cell_h - h) / 2).cast("int").alias("y"))


def packed(flags: np.ndarray) -> bytes:
    """Flags in as few bytes as go to a task; a multiple of eight of them."""
    return zlib.compress(np.packbits(flags).tobytes())


@lru_cache(4)
def unpacked(data: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(data), np.uint8)).astype(bool)
