"""Operators that are drawn, walked or searched: properties, hand-made pages and plain versions."""

import itertools
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from verso.functions import noise
from verso.operators import graph, outlines, quality, raster, recognition, search, whitespace
from verso.operators import chunks as ch
from verso.operators.export import replace_pages, updated, write_pages
from verso.sources import wire

WORDS = [
    (1, 1, "The", 110, 120, 200, 150, 0, 0.95, "DET", 1.3, 0),
    (2, 1, "old", 220, 120, 300, 150, 0, 0.95, "ADJ", 3.2, 1),
    (3, 1, "window", 330, 118, 520, 152, 0, 0.95, "NOUN", 3.9, 1),
    (4, 1, "gleamed", 110, 180, 340, 212, 1, 0.95, "VERB", 5.6, 1),
    (5, 1, "softly", 352, 180, 520, 210, 1, 0.95, "ADV", 5.0, 1),
]
SCHEMA = "id long, page_num long, text string, bbox_x0 int, bbox_y0 int, bbox_x1 int, bbox_y1 int, line_idx int, conf double, pos string, rarity double, is_content int"


@pytest.fixture(scope="module")
def page(spark):
    words = spark.createDataFrame(WORDS, SCHEMA)
    body = spark.createDataFrame([(1, 100, 100, 900, 300)], "page_num long, x0 int, y0 int, x1 int, y1 int")
    g = whitespace.h_gutters(words, body)
    s = whitespace.river_scores(whitespace.v_slits(words, body, g))
    d = whitespace.docks(words, body, g, s)
    n = graph.nodes(g, s, d).cache()
    return {"words": words, "body": body, "gutters": g, "slits": s, "docks": d, "nodes": n, "edges": graph.edges(n, g, s).cache()}


def test_gutters_and_slits(page):
    g = [tuple(r) for r in page["gutters"].orderBy("gutter_id").select("gutter_id", "line_idx_a", "line_idx_b", "y0", "y1").collect()]
    assert g == [(0, None, 0, 100, 118), (1, 0, 1, 152, 180), (2, 1, None, 212, 300)]
    s = [tuple(r) for r in page["slits"].orderBy("gutter_id").select("gutter_id", "line_idx_a", "x0", "x1", "river_score").collect()]
    assert s == [(3, 0, 100, 110, 0), (4, 0, 200, 220, 0), (5, 0, 300, 330, 0), (6, 0, 520, 900, 0), (7, 1, 100, 110, 0), (8, 1, 340, 352, 0), (9, 1, 520, 900, 0)]


def test_docks_and_ports(page):
    rows = {r["word_id"]: r for r in page["docks"].collect()}
    air = lambda i: tuple(rows[i][f"breathing_{k}"] for k in ("top", "bottom", "left", "right"))
    assert [air(i) for i in range(1, 6)] == [(20, 30, 10, 20), (20, 30, 20, 30), (18, 28, 30, 380), (28, 88, 10, 12), (28, 90, 12, 380)]
    assert [rows[i]["slack_direction"] for i in range(1, 6)] == ["S", "", "E", "S", "E"]
    assert [tuple(rows[i][f"dock_{k}"] for k in ("above", "below", "left", "right")) for i in (1, 3, 5)] == [(0, 1, 3, 4), (0, 1, 5, 6), (1, 2, 8, 9)]
    assert {p["compass"]: (p["x"], p["y"]) for p in rows[1]["ports"]} == {"N": (155, 110), "S": (155, 165), "W": (105, 135), "E": (210, 135)}
    assert {p["compass"]: (p["x"], p["y"]) for p in rows[3]["ports"]} == {"N": (425, 109), "S": (425, 166), "W": (315, 135), "E": (535, 135)}


def test_graph_and_paths(page, spark):
    kinds = dict(map(tuple, page["nodes"].groupBy("kind").count().collect()))
    assert kinds == {"gutter_end": 6, "intersection": 14, "port": 20, "inject": 20}
    assert page["edges"].count() == 2 * 69 and page["edges"].where("cost = 0 and src < dst").count() >= 5
    ports = {(r["word_id"], r["compass"]): r["node_id"] for r in page["nodes"].where("kind = 'port'").collect()}
    asked = [(1, "E", 2, "W", 0), (1, "E", 5, "W", 196), (3, "W", 4, "E", 91), (2, "E", 5, "W", 91)]
    requests = spark.createDataFrame([(1, ports[a, p], ports[b, q]) for a, p, b, q, _ in asked], "page_num long, start int, end int")
    found = {(r["start"], r["end"]): r["cost"] for r in graph.shortest_paths(page["edges"], requests).collect()}
    assert [found[ports[a, p], ports[b, q]] for a, p, b, q, _ in asked] == [c for *_, c in asked]


def test_chunks_and_selection(page):
    scored = ch.scored(ch.chunks(ch.candidates(page["words"])))
    assert [(r["text"], r["score"]) for r in scored.orderBy("ordinal").collect()] == [("The old window", 10.2), ("gleamed softly", 12.1)]
    assert [r["text"] for r in ch.select(scored).collect()] == ["gleamed softly"]
    assert [r["text"] for r in ch.select(scored, min_line_dist=1).orderBy("rank").collect()] == ["The old window", "gleamed softly"]


def test_search(page):
    assert [tuple(r) for r in search.search(page["words"], " Old  window ").collect()] == [(1, 1, "The old window")]
    assert [r["hits"] for r in search.search(page["words"], "l").collect()] == [3]
    assert search.search(page["words"], "  ").count() == 0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 8), st.integers(0, 8), st.integers(0, 50)), max_size=30))
def test_dijkstra(links):
    own: dict = {}
    for k, (a, b, c) in enumerate(links):
        own.setdefault(a, []).append((b, float(c), k))
    cost = {0: 0.0}
    for _ in range(9):
        for a, b, c in links:
            if a in cost and cost[a] + c < cost.get(b, math.inf):
                cost[b] = cost[a] + c
    for end in range(9):
        got, way, gutters = graph.dijkstra(own, 0, end)
        assert got == cost.get(end)
        assert got is None or (way[0] == 0 and way[-1] == end and len(gutters) == len(way) - 1)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(5, 60), min_size=1, max_size=4), st.lists(st.tuples(st.integers(3, 30), st.integers(1, 20)), min_size=1, max_size=7))
def test_segments(expected, shape):
    at, segments = 0, []
    for width, gap in shape:
        segments.append((at, at + width))
        at += width + gap
    got = recognition.group_segments([float(e) for e in expected], segments)
    n, m = len(expected), len(segments)

    def cost(bounds):
        own = 0.0
        for e, (a, b) in zip(expected, bounds, strict=True):
            own += abs(segments[b][1] - segments[a][0] - e) + sum(1.5 * max(0, segments[i + 1][0] - segments[i][1] - 4) for i in range(a, b))
        return own

    ways = [list(zip((0, *c), (*(x - 1 for x in c), m - 1), strict=True)) for c in itertools.combinations(range(1, m), n - 1)] if n <= m else []
    if not ways:
        assert got is None
    else:
        assert cost(got) == pytest.approx(min(map(cost, ways)))


def test_noise(spark):
    xs = [random.Random(1).uniform(-500, 500) for _ in range(200)]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", noise.noise(F.col("x"), F.lit(9)).alias("n"))
    for r in df.collect():
        assert -1 <= r["n"] <= 1 and r["n"] == pytest.approx(float(noise.noise_1d(r["x"], 9)), abs=1e-12)
    plane = spark.createDataFrame(list(zip(xs, xs[::-1], strict=True)), "x double, y double").select("x", "y", noise.noise2(F.col("x"), F.col("y"), F.lit(3)).alias("n"))
    for r in plane.collect():
        assert -1 <= r["n"] <= 1 and r["n"] == pytest.approx(float(noise.noise_2d(r["x"], r["y"], 3)), abs=1e-12)
    draws = [r["d"] for r in spark.range(1, 500).select(noise.draw(F.lit(42000), F.col("id")).alias("d")).collect()]
    assert 0 <= min(draws) < 0.05 and 0.95 < max(draws) < 1


def test_blob_is_closed_and_hugs():
    boxes = [(100, 100, 200, 130), (208, 100, 300, 130), (120, 180, 260, 210)]
    loops = outlines.blob([*boxes], outlines.necks([boxes[:2], boxes[2:]]), wobble=0)
    assert len(loops) >= 1 and abs(outlines.area(loops[0])) > sum((x1 - x0) * (y1 - y0) for x0, y0, x1, y1 in boxes)
    (x0, y0), (x1, y1) = loops[0].min(0), loops[0].max(0)
    assert x0 < 100 and y0 < 100 and x1 > 300 and y1 > 210


def test_contours_of_a_ring_and_a_saddle():
    y, x = np.mgrid[0:40, 0:40] - 20.0
    r = np.hypot(x, y)
    outer, inner = sorted(outlines.contours(np.abs(r - 12) - 4), key=lambda p: -abs(outlines.area(p)))
    assert outlines.area(outer) * outlines.area(inner) < 0 and abs(outlines.area(outer)) == pytest.approx(math.pi * 16**2, rel=0.05)
    saddle = np.ones((4, 4))
    saddle[1, 1] = saddle[2, 2] = -1
    assert len(outlines.contours(saddle, lambda p: np.ones(len(p)))) == 2
    assert len(outlines.contours(saddle, lambda p: -np.ones(len(p)))) == 1


def test_flow_stays_inside_and_out_of_walls():
    body, wall = (0, 0, 200, 100), (90, 0, 110, 60)
    way = outlines.flow((10, 20), (190, 20), body, [wall], seed=3)
    assert tuple(way[0]) == (10, 20) and tuple(way[-1]) == (190, 20)
    assert all(0 <= x <= 200 and 0 <= y <= 100 and not (90 <= x <= 110 and y <= 60) for x, y in way[:-1])


def test_drawn_keeps_each_rows_points(spark):
    rows = spark.createDataFrame([(i, float(i % 4)) for i in range(40)], "page_num long, n double")
    line = lambda r: np.array([(r["page_num"], k) for k in range(int(r["n"]))])
    got = outlines.drawn(rows, outlines.POINTS, line, "points").collect()
    assert len(got) == 40 and all([(p["x"], p["y"]) for p in r["points"]] == [(r["page_num"], k) for k in range(r["page_num"] % 4)] for r in got)
    some = lambda r: [np.array([(k, -1.0)] * k) for k in range(int(r["n"]))]
    got = outlines.drawn(rows, f"array<{outlines.POINTS}>", some, "loops").collect()
    assert all([len(x) for x in r["loops"]] == list(range(r["page_num"] % 4)) for r in got)
    assert outlines.drawn(rows.limit(0), outlines.POINTS, line, "points").count() == 0


def test_banner_without_wobble():
    p = outlines.banner((0, 0, 100, 20), ends=("square", "point"), wobble=0)
    assert p[:, 0].min() == -6 and p[:, 0].max() == pytest.approx(106 + 0.55 * 32) and set(np.round(p[:, 1], 6)) == {-6.0, 10.0, 26.0}


def test_channel_width():
    p = outlines.channel(np.array([(0, 0), (100, 0)], float), [1], {1: 20.0}, jitter=0, meander=0, width_mod=0)
    assert p[:, 1].max() == pytest.approx(4) and p[:, 1].min() == pytest.approx(-4)


def test_raster_against_numpy(spark):
    rng = np.random.default_rng(2)
    image = rng.integers(0, 255, (12, 12))
    rows = spark.createDataFrame([(1, y, x, int(image[y, x])) for y in range(12) for x in range(12)], "page_num long, y int, x int, value int")
    grid = lambda df: np.array([r["value"] for r in df.orderBy("y", "x").collect()], float).reshape(12, 12)
    assert (grid(raster.moving_max_2d(rows, 2)) == raster._greatest(image, 2)).all()
    assert np.allclose(grid(raster.moving_mean_2d(rows, 4)), raster._box(image.astype(float), 4))
    assert (grid(raster.shifted(rows, 3, 12))[3:] == image[:-3]).all() and (grid(raster.shifted(rows, 3, 12))[:3] == 255).all()
    out = raster.normalised(np.full((30, 30), 200.0), 2, 1, 4)
    assert (out == out[0, 0]).all()


def test_recognition():
    gray = np.full((20, 120), 250)
    gray[4:16, 5:40] = gray[4:16, 60:110] = 10
    assert [w for w, _, _ in recognition.split_words("abc defgh", gray, 100)] == ["abc", "defgh"]
    a, b = recognition.split_words("abc defgh", gray, 100)
    assert (a[1], a[2], b[1], b[2]) == (105, 140, 160, 210)
    reads = lambda g, box: [("fine again", 0.99, box)]
    lines = [("one two three", 0.99, (0, 10 + 30 * i, 100, 30 + 30 * i)) for i in range(7) if i != 4]
    page = np.full((400, 120), 250)
    assert recognition.repaired([("bad read", 0.5, (0, 0, 100, 20)), *lines], page, reads)[0][0] == "fine again"
    far = [("one two three", 0.99, (0, 60 + 30 * i, 100, 80 + 30 * i)) for i in range(9) if i != 4]
    seen = recognition.recovered(far, page, lambda g, box: [("lost line", 0.9, (0, 182, 100, 198))])
    assert [t for t, _, _ in seen].count("lost line") == 1


def test_page_list():
    assert wire.page_list("1,3,5-7", 9) == [1, 3, 5, 6, 7] and wire.page_list(" 2 , 4-3 ,,7", 9) == [2, 7] and wire.page_list(None, 3) == [1, 2, 3]


def test_writing(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "page_num long, text string")
    replace_pages(rows, str(tmp_path / "t"))
    replace_pages(spark.createDataFrame([(2, "c")], "page_num long, text string"), str(tmp_path / "t"))
    assert sorted((r["page_num"], r["text"]) for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [(1, "a"), (2, "c")]
    changed = updated(rows, spark.createDataFrame([(1, None)], "page_num long, text string"), "page_num")
    assert sorted(map(tuple, changed.collect()), key=str) == [(1, None), (2, "b")]


def test_pages_round_trip_and_stream(spark, page, tmp_path):
    from verso.api import Book
    from verso.operators.export import page_documents, ports_with_nodes
    from verso.streaming.pages import arriving, keep_words

    words = page["words"].selectExpr("*", "null as prefix", "null as suffix", "lower(text) as lemma", "0.1D as frequency", "0 as is_connective")
    words = words.withColumn("prefix", F.col("prefix").cast("string")).withColumn("suffix", F.col("suffix").cast("string"))
    pages = spark.createDataFrame([(1, "p0001.jpg", 1400, 2100)], "page_num long, image_path string, width_px int, height_px int")
    fixed = spark.createDataFrame([(1, 100, 100, 900, 300, 0, 0, 1400, 2100)], "page_num long, body_x0 int, body_y0 int, body_x1 int, body_y1 int, valid_x0 int, valid_y0 int, valid_x1 int, valid_y1 int")
    docks = ports_with_nodes(page["docks"], page["nodes"])
    gutters = page["gutters"].withColumn("river_score", F.lit(0.0)).unionByName(page["slits"])
    write_pages(page_documents(pages, fixed, words, gutters, docks, graph.adjacency(page["nodes"], page["edges"])), str(tmp_path / "book/pages"))
    (tmp_path / "book/catalog.json").write_text('{"pages": [1], "chapters": [{"pageNum": 1, "label": "CHAPTER I", "roman": "I"}]}')
    (tmp_path / "book/search-index.json").write_text('{"old": [[1, 2]], "window": [[1, 1], [4, 3]]}')
    assert sorted(map(tuple, wire.search_index(spark, str(tmp_path / "book/search-index.json")).collect())) == [("old", 1, 2), ("window", 1, 1), ("window", 4, 3)]
    book = Book.open(spark, str(tmp_path / "book"))
    assert [r[0] for r in book.list_pages().collect()] == [1] and book.list_chapters().first()["roman"] == "I"
    assert book.page_meta(1)["body"]["x1"] == 900 and book.page_meta(9) is None and book.image_url(7).endswith("/p0007.jpg")
    own = book.page(1)
    assert own.words.count() == 5 and own.gutters.count() == 10 and own.docks.count() == 5 and own.graph.count() == 60
    assert own.bbox_of([1, 2])["x1"] == 300 and own.bbox_of([])["x1"] == 0 and own.word(3)["text"] == "window"
    assert [r["text"] for r in own.select_chunks().collect()] == ["gleamed softly"]
    points, gutters = own.between(1, 5)
    assert len(points) >= 2 and len(gutters) == len(points) - 1
    assert len(own.channel(points, gutters)) > 4 and len(own.obstacles([1, 2])) == 3
    with pytest.raises(LookupError):
        book.page(2)
    for _ in range(2):
        keep_words(arriving(spark, str(tmp_path / "book/pages")), str(tmp_path / "words"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "words")).count() == 5
    book.close()


def test_checks(spark, page):
    pages = spark.createDataFrame([(1, 1400, 2099), (3, 1400, 2100)], "page_num long, width_px int, height_px int")
    got = {r["page_num"]: r["kind"] for r in quality.missing_pages(pages, 1, 2).collect()}
    assert got == {2: "missing", 3: "extra"}
    assert [r["page_num"] for r in quality.wrong_sizes(pages).collect()] == [1]
    bad = page["words"].withColumn("bbox_x1", F.when(F.col("id") == 3, 2000).otherwise(F.col("bbox_x1")))
    rep = {r["name"]: r["failures"] for r in quality.report({"boxes": quality.bad_boxes(bad, pages), "orphans": quality.orphan_words(bad, pages)}).collect()}
    assert rep == {"boxes": 1, "orphans": 0}
    assert quality.edgeless(graph.adjacency(page["nodes"], page["edges"])).count() == 0


def test_publish_and_check(spark, tmp_path):
    from verso.__main__ import main
    from verso.api import Book

    docs = spark.createDataFrame([(1, "The old window gleamed softly. " * 30), (2, "Night fell over the quiet town. " * 9), (3, None), (4, " ")], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "docs"))
    assert main(["publish", str(tmp_path / "docs"), str(tmp_path / "book")]) == 0
    book = Book.open(spark, str(tmp_path / "book"))
    assert [r[0] for r in book.list_pages().collect()] == [100000, 200000]
    assert book.search_pages("quiet town").first()["page_num"] == 200000
    assert {(r["token"], r["page_num"]): r["cnt"] for r in wire.search_index(spark, str(tmp_path / "book/search-index.json")).collect()}["window", 100000] == 30
    assert book.page(100000).graph.count() > 0
    book.close()
    assert main(["check", str(tmp_path / "docs"), "--pages", "100000"]) == 0


def test_images(spark):
    pages = spark.createDataFrame([(1, 10, 20), (2, 10, 20), (3, 10, 20)], "page_num long, width_px int, height_px int")
    images = spark.createDataFrame([(1, 10, 20), (2, 10, 21)], "page_num long, width int, height int")
    assert {tuple(r) for r in quality.missing_images(pages, images).collect()} == {(2, "size"), (3, "missing")}
    files = spark.createDataFrame([("book", b"xyz" * 9)], "path string, content binary")
    made = wire.rendered(files, lambda content, n: content[n : n + 1], [1, 2], offset=9).collect()
    assert {(r["page_num"], bytes(r["content"])) for r in made} == {(1, b"x"), (2, b"y")}
    rows = spark.createDataFrame([(1, y, 0, 7) for y in range(30)], "page_num long, y int, x int, value int")
    out = raster.without_stamp(rows, spark.createDataFrame([(1, 20)], "page_num long, y0 int"), spark.createDataFrame([(1, 0.4)], "page_num long, dy double"), 30)
    assert out.where("value = 255").agg(F.min("y")).first()[0] == 12
    from verso.functions.columns import contain

    assert tuple(pages.limit(1).select(contain(F.col("width_px"), F.col("height_px"), 100, 100).alias("c")).first()["c"]) == (50, 100, 25, 0)
