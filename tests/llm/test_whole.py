"""The corpus operators do the whole job where links, rows and runs used to be lost."""

import numpy as np
import pytest

from verso.llm import jaccard_join, sentence_spans, url_aliases


def test_relative_links_and_targets_forms(spark):
    rows = [
        (1, "http://a.org/d/x?q=1", '<meta http-equiv="refresh" content="0; url=home.html?u=http://z.org/">'),
        (2, "http://a.org/d/e/x", "<link rel=canonical href='../y/./z/..'>"),
        (3, "http://a.org/p?a=1#f", "<meta http-equiv=refresh content='0; url=?p=1'>"),
        (4, "http://c.org", "<link rel=canonical href=one>"),
        (5, "http://c.org/m", "<link rel=canonical href='mailto:x@y.org'>"),
        (6, "http://c.org/n", "<link rel=canonical href='/../r/'>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {tuple(r) for r in url_aliases.links(pages).collect()}
    assert got == {
        ("http://a.org/d/x?q=1", "http://a.org/d/home.html?u=http://z.org/"), ("http://a.org/d/e/x", "http://a.org/d/y/"), ("http://a.org/p?a=1#f", "http://a.org/p?p=1"),
        ("http://c.org", "http://c.org/one"), ("http://c.org/n", "http://c.org/r/"),
    }
    rows = [
        (1, "https://a.org/1", "<link rel=canonical href='http://B.org/2#top'>"),
        (2, "https://b.org/2", "<link rel=canonical href='http://t.net/fr/1'>"),
        (3, "HTTPS://B.ORG/2", ""),
        (4, "https://b.org/other", ""),
        (5, "https://b.org/dir/x", "<meta http-equiv='refresh' content='0; url=../2'>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in url_aliases.verdicts(pages, url_aliases.links(pages)).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "block"}


def test_spans_of_one_doc_id_with_two_texts(spark):
    passage = " ".join(f"Run {i} of the passage has word{i} in it and more{i} here." for i in range(8))
    clean = " ".join(f"Clean {i} is text{i} that stands here only once{i}." for i in range(9))
    rows = [(1, passage), (2, f"{passage} Its end."), (2, clean), (2, "Short."), (3, f"First {clean}"), (4, f"Some own words. {passage}"), (4, f"Other words. {clean}"), (4, f"Other words. {clean}")]
    got = sentence_spans.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    left = {(r["doc_id"], r["text"]) for r in got}
    assert {(1, passage), (2, clean), (2, "Short.")} <= left
    assert all("passage" not in t for i, t in left if i in (2, 4)) and all("Clean 4" not in t for i, t in left if i in (3, 4))
    two = [(1, f"A start. {passage}"), (1, f"Another start. {passage}")]
    got = sentence_spans.without_repeats(spark.createDataFrame(two, "doc_id long, text string")).collect()
    assert sorted(r["n_words_removed"] > 0 for r in got) == [False, True]


def test_one_row_of_each_group(spark):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(100))
    near = lambda k: f"{text(k)} end"
    rows = [
        (1, text(1), "a"), (1, text(2), "b"), (2, near(1), "c"), (2, text(3), "d"), (1, text(1), "e"),
        (None, near(2), "f"), (None, text(4), "g"), (None, near(4), "h"), (None, text(4), "i"), (None, text(5), "j"), (None, None, "k"), (None, "", "l"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tag string")
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    groups = [{"a", "c", "e"}, {"b", "f"}, {"d"}, {"g", "h", "i"}, {"j"}, {"k", "l"}]
    tags = {r["tag"] for r in kept.collect()}
    assert kept.count() == len(tags) == len(groups) and all(len(tags & g) == 1 for g in groups)
    assert tags & {"a", "e"} and "b" in tags


@pytest.mark.parametrize("block", [12, 100, 1024])
def test_links_of_a_long_chain(spark, monkeypatch, block):
    """Texts that drift, so that each resembles only those near it: verified whole, in blocks and by bucket."""
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    words = [f"w{i}" for i in range(1600)]
    rows = [(str(i), " ".join(words[2 * i : 2 * i + 120])) for i in range(700)] + [("x" + str(i), " ".join([*words[:80:-1], f"e{i}"])) for i in range(9)]
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    near = {i: [j for j in sets if i != j and (i[0] == j[0] == "x" or "x" not in i + j and abs(int(i) - int(j)) < 60)] for i in sets}  # others share no run
    links = {i: sum(len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for j in near[i]) for i in sets}
    ways = []
    verify = jaccard_join._met
    monkeypatch.setattr(jaccard_join, "_met", lambda rows: (ways.append(rows.select("band").distinct().collect()) if "shingles" in rows.columns else None) or verify(rows))
    got = jaccard_join.similar_groups(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert {r["doc_id"]: r["n_links"] for r in got} == links and max(links.values()) < 20
    assert {r["class_id"] for r in got} == {"0", "x0"}
    assert (max(r["band"] for r in ways[0]) >= 0) == (block < 1024) and min(r["band"] for r in ways[0]) == -1


def test_near_copies_at_the_threshold_are_found(spark):
    """Recall against brute force for pairs of a similarity of 0.8 to 0.9, and none below."""
    rng = np.random.default_rng(9)
    rows, want = [], set()
    for i in range(300):
        base = [f"b{i}x{k}" for k in range(150)]
        other = list(base)
        for k in rng.choice(150, int(rng.integers(2, 5)), replace=False):
            other[k] = f"c{i}x{k}"
        a, b = ({tuple(w[k : k + 5]) for k in range(146)} for w in (base, other))
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(other))]
        if len(a & b) >= 0.8 * len(a | b):
            want.add(2 * i)
    got = {r["doc_id"] for r in jaccard_join.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r["n_links"] and r["doc_id"] % 2 == 0}
    assert got == want and 30 < len(want) < 290


def test_copies_and_their_links(spark):
    """Copies count as links of each other, other texts of a group with all their documents."""
    near = " ".join(f"n{k}" for k in range(100))
    rows = [(i, f"alone{i} " * 30) for i in range(6)] + [(10, near), (11, near + " end"), (12, near)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    seen = {r["doc_id"]: (r["class_id"], r["n_copies"], r["n_links"]) for r in jaccard_join.similar_groups(frame).collect()}
    assert seen == {**{i: (i, 1, 0) for i in range(6)}, 10: (10, 2, 2), 11: (10, 1, 2), 12: (10, 2, 2)}
