"""Pages set by numpy against the words table; lines segmented at once against each one alone."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from verso.functions import columns
from verso.functions.noise import noise_2d
from verso.operators import outlines, recognition
from verso.plans.catalogue import QUERIES
from verso.plans.tables import Tables
from verso.sources import typeset

ODD = ["", "   ", "one", "-- ... !", "a b c\u0085 \u0085d e ! (f) & x&y", " hier  　 日本語 ¡olé! \U0001f600 \U0001f600x ǅungla ½ ² Ⅷ", "tab\tand\x0bvt\x0cff\r\n  cr", None]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Short and odd texts, long ones of many pages, and a doc_id that two texts share."""
    draw, top = random.Random(11), str(tmp_path_factory.mktemp("odd"))
    parts = ["the", "River,", "Mill", "iii", "(WIDE)", "42", "—", "...", "élan", "wwwmmm", "x", "naïve-ly", "O'Neill's"]
    texts = [(i, t) for i, t in enumerate(ODD)] + [(i, " ".join(draw.choice(parts) for _ in range(draw.randrange(1, 1500)))) for i in range(20, 40)]
    texts += [(30, "another text of the same number, of more words than one line has"), (None, "no number")]
    spark.createDataFrame(texts, "doc_id long, text string").repartition(3).write.parquet(f"{top}/documents.parquet")
    return top


def alone(expected, segments):
    """group_segments over all cuts, one line at a time, as it was."""
    n, m = len(expected), len(segments)
    begin, end = np.array(segments, float).T
    swallowed = np.concatenate(([0], np.cumsum(1.5 * np.maximum(0, begin[1:] - end[:-1] - 4))))
    cost, cuts = np.array([0.0] + [np.inf] * m), []
    for width in expected:
        each = cost[None, :m] + np.abs(end[:, None] - begin[None] - width) + swallowed[:, None] - swallowed[None]
        each[np.triu_indices(m, 1)] = np.inf
        cuts.append(each.argmin(1))
        cost = np.concatenate(([np.inf], each.min(1)))
    out, j = [], m
    for cut in cuts[::-1]:
        out.append((int(cut[j - 1]), j - 1))
        j = int(cut[j - 1])
    return out[::-1]


@pytest.mark.parametrize("pages", [1, 3, 1000])
def test_settings_are_the_words(spark, odd, pages):
    schema = "page_num long, id long, line_idx int, x0 int, y0 int, x1 int, y1 int, n int"
    got = typeset.over_settings(spark, Tables(spark, odd).read("documents"), schema, lambda p: [*p.columns, p.end - p.begin], pages)
    want = Tables(spark, odd).words.select("page_num", "id", "line_idx", "bbox_x0", "bbox_y0", "bbox_x1", "bbox_y1", F.char_length("text"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_segment_dp_of_lines_alone(spark, odd):
    words = Tables(spark, odd).words.select((F.col("page_num") * 100 + F.col("line_idx")).alias("key"), "bbox_x0", "id", (columns.glyph_weight(F.col("text")) * 10).alias("e"), "bbox_x1", "w").collect()
    lines: dict = {}
    for r in sorted(words, key=lambda r: (r["key"], r["bbox_x0"], r["id"], r["e"], r["bbox_x1"])):
        e, s = lines.setdefault(r["key"], ([], []))
        e.append(r["e"])
        s.extend([(r["bbox_x0"], r["bbox_x0"] + 5), (r["bbox_x0"] + 7, r["bbox_x1"])] if r["w"] % 5 == 0 else [(r["bbox_x0"], r["bbox_x1"])])
    want = {(k, len(e), ",".join(f"{a}-{b}" for a, b in alone(e, s))) for k, (e, s) in lines.items()}
    got = QUERIES["segment_dp"](spark, odd)
    assert got.columns == ["key", "n_words", "cuts"] and got.count() == len(want)
    assert {tuple(r) for r in got.collect()} == want
    assert "collect_list" not in got._jdf.queryExecution().executedPlan().toString()


def test_segment_lines_at_once(spark):
    draw, rows = random.Random(2), []
    for key in range(60):
        m = draw.randrange(0, 8)
        at = sorted(draw.sample(range(200), 2 * m))
        rows.append((key, [float(draw.randrange(5, 60)) for _ in range(draw.randrange(0, 5))], list(zip(at[::2], at[1::2]))))
    found = recognition.segment_lines(spark.createDataFrame(rows, "key long, expected array<double>, segments array<struct<a:int,b:int>>")).collect()
    want = {k: alone(e, s) if 0 < len(e) <= len(s) else None for k, e, s in rows}
    assert {r["key"]: r["groups"] and [tuple(g) for g in r["groups"]] for r in found} == want and None in want.values()


def walked(start, end, body, walls, seed, step=2.5, most=600, freq=0.007, weight=0.45, headings=24):
    """One walk alone, by every heading and wall at every step."""
    turns = np.arange(headings) / headings * 2 * np.pi
    ways, now, goal = np.stack((np.cos(turns), np.sin(turns)), 1), np.array(start, float), np.array(end, float)
    out, nearest, stalled = [now], np.hypot(*(goal - now)), 0
    for _ in range(most):
        left = np.hypot(*(goal - now))
        if left < step * 1.5:
            break
        nearest, stalled = (left, 0) if left < nearest - 1 else (nearest, stalled + 1)
        x, y = (now + step * ways).T
        free = (x >= body[0]) & (x <= body[2]) & (y >= body[1]) & (y <= body[3])
        for w in walls:
            free &= ~((x >= w[0]) & (x <= w[2]) & (y >= w[1]) & (y <= w[3]))
        if not free.any():
            break
        cost = noise_2d(x * freq, y * freq, seed) * 0.7 + (1 - ways @ ((goal - now) / left)) * weight * (1 + min(3, stalled / 15))
        now = np.stack((x, y), 1)[np.where(free, cost, np.inf).argmin()]
        out.append(now)
    return np.array([*out, goal])


@pytest.mark.parametrize("options", [{}, {"weight": 0.02, "most": 90}, {"freq": 3.0, "most": 60}, {"headings": 5, "most": 200}])
def test_walks_together_are_those_alone(options):
    draw, asked = random.Random(4), []
    for seed in range(12):
        body = (100, 120, 100 + draw.randrange(0, 900), 120 + draw.randrange(1, 1500))
        point = lambda: (draw.uniform(body[0] - 5, body[2]), draw.uniform(body[1], body[3]))  # noqa: B023, E731
        walls = [(x, y, x + draw.randrange(0, 160), y + 28) for x, y in (point() for _ in range(draw.choice((0, 1, 40))))]
        asked.append((point(), point(), body, walls, seed))
    asked[3] = (asked[3][0], asked[3][0], *asked[3][2:])
    asked[5] = (*asked[5][:3], [(-1e4, -1e4, 1e4, 1e4)], 5)
    of = np.repeat(np.arange(12), [len(a[3]) for a in asked])
    found = outlines.flows(*(np.array([a[k] for a in asked], float) for k in range(3)), np.array([w for a in asked for w in a[3]], float), of, np.arange(12), **options)
    for a, got in zip(asked, found, strict=True):
        assert got == pytest.approx(walked(*a, **options))
        assert (got == outlines.flow(*a, **options)).all()
