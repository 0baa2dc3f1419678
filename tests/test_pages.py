"""Image, export and extraction operators against plain versions."""

import gzip
import json
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from verso.operators import export, quality, raster, recognition
from verso.sources import typeset


def edge(profile, low):
    """The place of a shadow's edge in a profile, by its definition."""
    if len(profile) < 8:
        return None
    step = np.diff(profile) * (1 if low else -1)
    at = int(step.argmax())
    if step[at] < 12:
        return None
    left, right = np.mean(profile[: max(1, at)]), np.mean(profile[at + 1 :])
    return at + 1 if (left < right - 5 if low else right < left - 5) else None


@pytest.mark.parametrize("seed", range(4))
def test_shadow_regions(spark, seed):
    rng = np.random.default_rng(seed)
    h, w = 60, 50
    gray = rng.integers(200, 230, (h, w)).astype(float)
    gray[:, :4] -= 120
    gray[:, w - 5 :] -= 90
    gray[:6] -= 100 * (seed % 2)
    gray[h - 7 :] -= 80
    gray[14:20] -= 60 * (seed > 1)
    text, valid = (16, 22, 34, 45), (1, 2, 49, 58)
    x0, y0, x1, y1 = text
    want = set()
    for side, margin in (("left", x0 - valid[0]), ("right", valid[2] - x1), ("top", y0 - valid[1]), ("bottom", valid[3] - y1)):
        if margin <= 8:
            continue
        d = min(20, margin)
        strip = {"left": gray[y0:y1, x0 - d : x0].mean(0)[::-1], "right": gray[y0:y1, x1 : x1 + d].mean(0), "top": gray[y0 - d : y0, x0:x1].mean(1)[::-1], "bottom": gray[y1 : y1 + d, x0:x1].mean(1)}[side]
        cut = edge(strip, side in ("left", "top"))
        if cut is not None:
            want.add({"left": (side, valid[0], y0, x0 - d + cut, y1), "right": (side, x1 + cut, y0, valid[2], y1), "top": (side, x0, valid[1], x1, y0 - d + cut), "bottom": (side, x0, y1 + cut, x1, valid[3])}[side])
    pixels = spark.createDataFrame([(1, y, x, float(gray[y, x])) for y in range(h) for x in range(w)], "page_num long, y int, x int, value double")
    box = lambda b: spark.createDataFrame([(1, *b)], "page_num long, x0 int, y0 int, x1 int, y1 int")
    got = {tuple(r)[1:] for r in raster.shadow_regions(pixels, box(text), box(valid), strip=20).collect()}
    assert got == want and want


def test_shadow_edge_of_ties(spark):
    """Sides whose means differ by exactly SHADOW_DARKER have no edge, those with a 40th more have one, in whatever order they are summed up."""
    rng, rows = np.random.default_rng(7), []
    for page in range(400):
        # six places of 40ths, the one before the steepest step, three brighter ones
        dark, bright = rng.integers(2000, 2400, 6), rng.integers(2000, 3000, 2)
        bright = [*bright, 3 * (200 + page % 2) + int(dark.sum()) // 2 - int(bright.sum())]
        dark[0] -= dark.sum() % 2
        whole = [*dark, 0, *bright]
        rows += [(page, x, float(whole[x]) / 40) for x in rng.permutation(len(whole)).tolist()]
    profiles = spark.createDataFrame(rows, "page_num long, x int, value double").coalesce(1)
    cuts = [r["page_num"] for r in raster.shadow_edge(profiles, "page_num", "x", "value", True).collect()]
    assert sorted(cuts) == list(range(1, 400, 2))
    mirrored = profiles.select("page_num", (9 - F.col("x")).alias("x"), F.when(F.col("x") == 6, 200.0).otherwise(F.col("value")).alias("value"))
    assert sorted(r["page_num"] for r in raster.shadow_edge(mirrored, "page_num", "x", "value", False).collect()) == list(range(1, 400, 2))


def test_rotation_and_coding(spark):
    rng = np.random.default_rng(2)
    gray = rng.integers(0, 256, (12, 15)).astype(np.uint8)
    images = spark.createDataFrame([(1, 15, 12, gray.tobytes()), (2, 15, 12, gray.tobytes())], "page_num long, width int, height int, gray binary")
    turned = {r["page_num"]: np.frombuffer(r["gray"], np.uint8).reshape(12, 15) for r in raster.rotate_images(images, spark.createDataFrame([(1, 5.0)], "page_num long, angle double")).collect()}
    assert (turned[2] == gray).all() and (turned[1] == np.clip(np.rint(raster.rotated(gray.astype(float), 5.0)), 0, 255)).all() and (turned[1] != gray).any()
    content = bytes(export.coded(images).first()["content"])
    assert content[:8] == b"\x89PNG\r\n\x1a\n" and int.from_bytes(content[16:20], "big") == 15
    at, size = content.index(b"IDAT") + 4, int.from_bytes(content[content.index(b"IDAT") - 4 : content.index(b"IDAT")], "big")
    rows = zlib.decompress(content[at : at + size])
    assert b"".join(rows[y * 16 + 1 : y * 16 + 16] for y in range(12)) == gray.tobytes()


def test_page_files(spark):
    pages = spark.createDataFrame([(7, "ü"), (12345, None)], "pageNum long, title string")
    one, two = ({r["name"]: (bytes(r["content"]), bytes(r["twin"])) for r in export.page_files(p).collect()} for p in (pages, pages.repartition(3)))
    assert one == two and set(one) == {"p0007.json", "p12345.json"}
    assert all(gzip.decompress(b) == a for a, b in one.values()) and json.loads(one["p12345.json"][0]) == {"pageNum": 12345, "title": None}


def test_pages_are_replaced_in_their_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [(p, f"a{p}") for p in range(0, 40)]
    export.replace_pages(spark.createDataFrame(first, "page_num long, text string"), path, 10)
    export.replace_pages(spark.createDataFrame([(3, "b"), (3, "c"), (55, "d")], "page_num long, text string"), path, 10)
    rows = sorted((r["page_num"], r["text"]) for r in export.read_pages(spark, path).collect())
    assert rows == sorted([x for x in first if x[0] != 3] + [(3, "b"), (3, "c"), (55, "d")])
    assert len(list((tmp_path / "t").glob("pages=*"))) == 5
    assert sorted(r["text"] for r in export.read_pages(spark, path, [3, 12], 10).collect()) == ["a12", "b", "c"]


def test_extraction_of_pages(spark):
    gray = np.full((400, 300), 255, np.uint8)
    lines = []
    for i in range(9):
        y = 40 + 40 * i
        gray[y : y + 16, 20:60] = gray[y : y + 16, 70:130] = 0
        if i != 4:
            lines.append((1, "abcd efghij" if i != 6 else "ab", 0.95 if i != 6 else 0.95, 20, y, 130, y + 16))
    lines[2] = (1, "x9 ?", 0.4, 20, 120, 130, 136)
    lines.append((2, "no image here", 0.9, 10, 10, 140, 20))

    def backend(image, box):
        found = []
        for i in range(9):
            y = 40 + 40 * i
            if box[1] <= y + 8 <= box[3]:
                found.append(("read again" if i != 4 else "lost line", 0.97, (20, y, 130, y + 16)))
        return found

    table = spark.createDataFrame(lines, "page_num long, text string, conf double, x0 int, y0 int, x1 int, y1 int")
    images = spark.createDataFrame([(1, 300, 400, gray.tobytes())], "page_num long, width int, height int, gray binary")
    got = recognition.extracted(table, images, backend).collect()
    words = {(r["page_num"], r["line_idx"], r["text"]): (r["x0"], r["x1"]) for r in got}
    assert words[1, 0, "abcd"] == (20, 60) and words[1, 0, "efghij"] == (70, 130)
    assert (1, 2, "read") in words and (1, 4, "lost") in words and words[1, 4, "line"] == (70, 130)
    assert [t for p, _, t in words if p == 2] == ["no", "image", "here"] and words[2, 0, "no"][0] == 10 and words[2, 0, "here"][1] == 140
    assert recognition.extracted(table.limit(0), images, backend).count() == 0


def test_advance_and_lengths_agree_with_columns(spark):
    from verso.functions.columns import glyph_weight
    from verso.operators.tokens import shares

    words = ["Wim", "it,", "Ünï9", "—x", "ABC", "mm"]
    frame = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string").orderBy("i")
    assert recognition.advance(words).tolist() == pytest.approx([r[0] for r in frame.select(glyph_weight(F.col("w"))).collect()])
    (parts,) = spark.createDataFrame([(words,)], "w array<string>").select(shares(F.col("w"), F.lit(13), F.lit(240))).first()
    assert recognition.by_length(words, 13, 240).tolist() == [[p["x0"], p["x1"]] for p in parts]


def test_taggers_and_frequency_tables_plug_in(spark):
    words = typeset.words(spark.createDataFrame([(1, "The Cats sat. cats the")], "doc_id long, text string"))
    known = spark.createDataFrame([("cat", 0.01), ("sat", 1e-9)], "lemma string, frequency double")
    tagger = lambda text, first: (F.when(first, F.lit("DET")).otherwise("NOUN"), F.regexp_replace(F.lower(text), "s$", ""))
    got = {r["id"] % 1000: r for r in typeset.features(words, tagger, known).collect()}
    assert got[0]["pos"] == "DET" and got[1]["lemma"] == "cat" and got[1]["rarity"] == 2.0 and got[0]["frequency"] == 0 and got[2]["rarity"] == 6.0


def test_features_of_many_lemmas(spark, sf, monkeypatch):
    words = typeset.words(spark.read.parquet(f"{sf}/documents.parquet").limit(20))
    want = {r["id"]: r for r in typeset.features(words).collect()}
    monkeypatch.setattr(typeset, "MOST_LEMMAS", 10)
    monkeypatch.setattr(typeset, "LEAST_FREQUENCY", 1e-3)
    assert {r["id"]: r for r in typeset.features(words).collect()} == want


def test_header_rate(spark):
    rows = [(10, 0, "A 10"), (11, 2, "11"), (12, 3, "12"), (13, 1, "14"), (14, 0, "none")]
    words = spark.createDataFrame([(p, li, t, 0, i) for i, (p, li, t) in enumerate(rows)], "page_num long, line_idx int, text string, bbox_x0 int, id long")
    assert tuple(quality.rate(quality.header_numbers(words)).first()) == (3, 2, pytest.approx(2 / 3))
    assert [r["page_num"] for r in quality.poorly_numbered(words).collect()] == [13] and quality.poorly_numbered(words, 0.6).count() == 0
    assert tuple(quality.rate(quality.header_numbers(words.limit(0))).first()) == (0, 0, 0.0)
