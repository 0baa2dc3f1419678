"""Each corpus operator against a plain version, and on awkward rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from verso.llm import decontaminate, jaccard_join, license_scan, quality_cnn, sentence_spans, shard_pack, source_mix, token_separators, transport_stream, url_aliases
from verso.llm.shared import components
from verso.llm.words import scan, scan_all

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, size string, shard int"
LONG = "lorem ipsum dolor " * 20_000
ROWS = [
    (1, None, "en", "a", 0, 0.5, "x", 1),
    (2, "", "en", "a", 0, 0.5, "x", 1),
    (3, "One", "en", None, 3, 0.5, None, 1),
    (4, "Licensed under the Apache License, Version 2.0. GNU General Public License", "en", "b", 3, 0.5, "x", 1),
    (4, "Licensed under the Apache License, Version 2.0. GNU General Public License", "en", "b", 3, 0.5, "x", 1),
    (None, "null id here and a few words more", "en", "b", 3, 0.5, "x", 1),
    (5, LONG, "en", "b", 3, None, "x", None),
    (6, "Ünïcode Straße ÉCOLE \U0001f600 naïve", "de", "c", 3, 0.5, "x", 1),
    (7, "... !!! ???", "de", "c", 3, 0.5, "x", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


def words(text):
    return WORD.findall((text or "").encode().lower())


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_words(texts):
    data = [t.encode() for t in texts.values()] + [b"", LONG.encode() * 4, "é1É_a".encode()]
    for text, one in zip(data, scan_all(data), strict=True):
        plain = WORD.findall(text.lower())
        assert [text.lower()[a:b] for a, b in zip(one.start, one.end, strict=True)] == plain
        assert len(set(zip(one.hash.tolist(), plain, strict=True))) == len(set(plain)) == len(set(one.hash.tolist()))
        assert (scan(text).hash == one.hash).all()


# --- 1


def test_license_templates():
    auto = license_scan.Automaton(license_scan.Template("t", "a b<<beginOptional>> c <<var;words=1-2>><<endOptional>> d"))
    for text, taken in (("a b d", 3), ("a b c x d", 5), ("a b c x y d", 6), ("a b c x y z d", 0), ("a b c d d", 5), ("a x d", 0), ("a b", 0)):
        assert auto.match(text.encode().split(), 0) == taken, text
    with pytest.raises(ValueError):
        license_scan.Automaton(license_scan.Template("t", "<<var;words=1-2>> a"))


def test_licenses(spark, odd, docs, texts):
    out = {r["doc_id"]: r for r in license_scan.licenses(docs).collect()}
    phrases = {"gpl": "gnu general public license", "apache": "apache license", "cc-by": "cc by", "mit": "mit license"}
    for i, text in texts.items():
        w, found = words(text), []
        for label, p in phrases.items():
            p = p.encode().split()
            found += [(k, label) for k in range(len(w)) if w[k : k + len(p)] == p]
        r = out[i]
        places = [k for k, _ in found]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (len(w), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found})))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    got = [(r["doc_id"], r["n_words"], r["labels"], r["score"]) for r in license_scan.licenses(odd).orderBy("doc_id").collect()]
    assert len(got) == len(ROWS) and (4, 12, "apache,apache-notice,gpl", 1.0) in got and (1, 0, "", 0.0) in got and (5, 60_000, "", 0.0) in got
    assert license_scan.licenses(empty(spark)).count() == 0


def test_license_across_segments():
    data = b"x " * (1 << 20) + b"gnu general public license " + b"y " * 50
    at = (1 << 20) - 3
    for cut in range(at, at + 4):
        found = license_scan.scan(data[2 * (at - cut + 3) :], [license_scan.Automaton(t) for t in license_scan.BASE])
        assert found.n_base == 1 and found.first_word == found.last_word


# --- 2


def test_quality(spark, odd, docs, sf):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    whole = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = {r["doc_id"]: r for r in quality_cnn.quality(whole, labels).collect()}
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    held = [i for i in known if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(out[i]["held_out"] for i in held) and sum(r["held_out"] for r in out.values()) == sum(zlib.crc32(str(i).encode()) % 3 == 1 for i in out)
    assert sum(out[i]["predicted"] == known[i] for i in held) / len(held) > 0.95
    flipped = labels.withColumn("quality", F.when(quality_cnn.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["doc_id"]: r["score"] for r in quality_cnn.quality(whole, flipped).collect()}
    assert all(again[i] == out[i]["score"] for i in out)
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in out.values())
    got = quality_cnn.quality(odd, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in quality_cnn.quality(odd, labels.limit(0)).collect()} == {0.5}
    assert quality_cnn.quality(empty(spark), labels).count() == 0
    assert quality_cnn.accepted(odd, labels).columns == odd.columns


def plain_probability(data, net):
    """The network by its definition, byte by byte."""
    n = max(1, -(-len(data) // quality_cnn.BLOCK))
    padded = data + b"\0" * (n * quality_cnn.BLOCK + quality_cnn.WIDTH - len(data))
    out = [[max(0.0, sum(float(net.table[j][padded[p + j]][f]) for j in range(quality_cnn.WIDTH)) + float(net.bias[f])) for p in range(n * quality_cnn.BLOCK)] for f in range(quality_cnn.FILTERS)]
    z = net.offset
    for f, responses in enumerate(out):
        chunks = [max(responses[k * quality_cnn.BLOCK : (k + 2) * quality_cnn.BLOCK]) for k in range(max(1, n - 1))]
        z += float(net.weight[f]) * sum(chunks) / len(chunks) + float(net.weight[quality_cnn.FILTERS + f]) * max(chunks)
    return 1 / (1 + np.exp(-z))


@pytest.fixture(scope="module")
def net():
    rng = np.random.default_rng(8)
    return quality_cnn.Network(rng.normal(0, 0.3, (quality_cnn.WIDTH, 256, quality_cnn.FILTERS)), rng.normal(0, 0.1, quality_cnn.FILTERS), rng.normal(0, 0.3, 2 * quality_cnn.FILTERS), 0.2)


@pytest.mark.parametrize("size", [0, 1, 127, 128, 129, 300, 1000])
def test_network_against_plain_version(net, size):
    data = np.random.default_rng(size).integers(0, 256, size, dtype=np.uint8).tobytes()
    assert quality_cnn.probability(data, net) == pytest.approx(plain_probability(data, net), rel=1e-9)


@pytest.mark.parametrize("size", [5, 200, 700])
def test_gradient_against_differences(net, size):
    data = np.random.default_rng(size).integers(32, 64, size, dtype=np.uint8).tobytes()
    loss = lambda n, y: -np.log(quality_cnn.probability(data, n) if y else 1 - quality_cnn.probability(data, n))
    for label in (0, 1):
        found = quality_cnn.gradient(data, label, net)
        rng = np.random.default_rng(1)
        for k in range(3):
            at = [tuple(rng.integers(0, d) for d in net[k].shape) for _ in range(12)]
            if k == 0:
                at = [(j, data[j + 1], f) for j in range(4) for f in range(0, 12, 4)]
            for place in at:
                less, more = (net._replace(**{net._fields[k]: net[k].copy()}) for _ in range(2))
                less[k][place] -= 1e-6
                more[k][place] += 1e-6
                assert found[k][place] == pytest.approx((loss(more, label) - loss(less, label)) / 2e-6, abs=1e-6)
        assert found[3][0] == pytest.approx((loss(net._replace(offset=net.offset + 1e-6), label) - loss(net._replace(offset=net.offset - 1e-6), label)) / 2e-6, abs=1e-6)


def test_learning_takes_each_labelled_document_once(spark):
    good, bad = "a calm page of plain words in order ", "zz## !!xx 99%% qq@@ "
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(i, (good if i % 2 else bad) * 9) for i in ids] + [(ids[0], bad * 9)] * 3000
    labels = [(i, i % 2) for i in ids] + [(ids[0], 0)] * 50 + [(ids[1], 0), (ids[1], 1), (None, 1), (ids[2], None), (-5, 1)]
    out = quality_cnn.quality(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int"), per_class=20)
    got = {r["doc_id"]: r["predicted"] for r in out.collect()}
    assert all(got[i] == i % 2 for i in ids)


def test_network_covers_whole_texts():
    net = quality_cnn.fit([b"good words in a text " * 9, b"bad!!! ###junk### " * 9], [1, 0], epochs=30, batch=1)
    long = b"good words in a text " * 9000
    assert quality_cnn.probability(long, net) > 0.5 > quality_cnn.probability(b"bad!!! ###junk### " * 9000, net)
    assert quality_cnn.probability(long + b"bad!!! ###junk### " * 9, net) != quality_cnn.probability(long, net)


# --- 3


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(1000 + i, 1000) for i in range(300)] + [(2000 + i, 2001 + i) for i in range(60)]
    parent = {x: x for e in edges for x in e}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: top(x) for x in linked}
    assert components(spark.createDataFrame([(1, 1), (None, 2)], "u long, v long")).count() == 0


def test_urls(spark):
    urls = [
        (1, "http://a.org/x"), (2, "https://x.example.com/en/1"), (3, "https://www.example.com/en/1"), (4, "http://b.org/#top"), (5, "http://c.org"), (6, None), (7, "no url"),
        (8, "HTTP://Sub.EXAMPLE.com/EN/"), (9, "http://n.net/es/q?x"), (10, "http://example.com"), (11, "http://d.org/1"), (12, "http://d.org/2"), (1, "http://a.org/x"),
    ]
    pages = spark.createDataFrame([(i, u, "") for i, u in urls], "page_id long, url string, html string")
    edges = spark.createDataFrame([("http://a.org/x", "http://t.net/fr/1"), ("http://c.org", "http://t.net/fr/1"), ("http://c.org", "http://c2.org/"), ("http://d.org/1", "http://n.net/es/q?x"), ("http://d.org/1", "http://k.com/"), ("http://d.org/1", "http://d.org/2"), (None, "http://b.org/#top")], "src string, dst string")
    got = [tuple(r) for r in url_aliases.verdicts(pages, edges).orderBy("page_id").select("page_id", "host", "path", "rule", "verdict").collect()]
    assert got == [
        (1, "a.org", "/x", None, "block"), (1, "a.org", "/x", None, "block"), (2, "x.example.com", "/en/1", "example.com/en/", "block"), (3, "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        (4, "b.org", "/", None, "allow"), (5, "c.org", "", None, "block"), (6, "", "", None, "allow"), (7, "", "", None, "allow"), (8, "sub.example.com", "/EN/", "com/", "allow"),
        (9, "n.net", "/es/q", "net/es/", "block"), (10, "example.com", "", None, "allow"), (11, "d.org", "/1", None, "allow"), (12, "d.org", "/2", None, "allow"),
    ]
    html = [
        ("http://a.org/x", '<LINK rel="canonical" href="/y?a=1&amp;b=2"><link rel="nofollow canonical" href="/y2">'), ("http://a.org/z", "<meta http-equiv='refresh' content='0; url=//o.org/w'>"),
        ("http://a.org/q#f", None), (None, "<link rel=canonical href=http://z.org>"), ("http://a.org/b", "<base href='/d/'><!-- <link rel=canonical href=no> --><meta property='og:url' content='e'>"),
    ]
    found = {tuple(r) for r in url_aliases.links(spark.createDataFrame(html, "url string, html string")).collect()}
    assert found == {("http://a.org/x", "http://a.org/y?a=1&b=2"), ("http://a.org/x", "http://a.org/y2"), ("http://a.org/z", "http://o.org/w"), ("http://a.org/b", "http://a.org/d/e")}
    assert url_aliases.verdicts(pages.limit(0), edges).count() == 0 and url_aliases.verdicts(pages, edges.limit(0)).where("verdict = 'block'").count() == 2


def planted_pages():
    """Pages whose verdicts come through chains of links of all kinds, with columns whose names clash."""
    rng = np.random.default_rng(21)
    urls, tags = [], []
    for i in range(160):
        tld = rng.choice(["org", "org", "org", "net", "com"])
        urls.append(f"{rng.choice(['http', 'https', 'HTTP'])}://{rng.choice(['www.', 'm.', 'Www.'])}{rng.choice(['example', 'other'])}{rng.integers(0, 9)}.{tld}/{rng.choice(['en', 'fr', 'es', 'de'])}/{i}{rng.choice(['', '#top', '?p=1', '/'])}")
    for url in urls:
        to = urls[int(rng.integers(0, len(urls)))] if rng.random() < 0.4 else rng.choice(["../es/1", "x", "/fr/2", "?q=2", "//m.example1.net/fr/9", "mailto:a@b.org", "", "./../de/./3"])
        kind = rng.integers(0, 4)
        tags.append(["", f'<link rel="canonical" href="{to}">', f"<META http-equiv=refresh content='3;URL={to}'>", f"<meta property='og:url' content='{to}'>"][kind])
    return [(i, u, t, "node", 1) for i, (u, t) in enumerate(zip(urls, tags, strict=True))] + [(900, None, "<link rel=canonical href=http://a.net/es/>", "n", 1), (901, "http://m.other1.org/q", None, "n", 1), (901, "http://m.other1.org/q", None, "n", 1)]


def test_registered_url_query_on_planted_links(spark, tmp_path):
    from urllib.parse import urljoin

    from verso.llm.queries import queries

    rows = planted_pages()
    spark.createDataFrame(rows, "page_id long, url string, html string, node string, root int").write.parquet(f"{tmp_path}/pages.parquet")
    parent = {}

    def form(u):
        scheme, _, rest = u.partition("://")
        host = re.match(r"[^/?#]*", rest)[0]
        return "https://" + host.lower() + rest[len(host) :].partition("#")[0] if scheme.lower() in ("http", "https") else u

    def top(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    def rule(u):
        scheme, found, rest = (u or "").partition("://")
        host, path = (m := re.match(r"([^/?#]*)([^?#]*)", rest))[1].lower() if found else "", m[2] if found else ""
        return host, path, max(((len(r.name), r.name, r.verdict) for r in url_aliases.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)), default=None)

    for _, url, html, *_ in rows:
        link = re.search(r"(?i)(?:href=|url=|content=)[\"']?([^\"'>]+)", html.replace("3;", "")) if html and url else None
        to = urljoin(url, link[1].replace("content='", "").replace("URL=", "")) if link else ""
        if "://" in to:
            parent[top(form(to))] = top(form(url))
    by_root = defaultdict(set)
    for u in list(parent):
        if r := rule(u)[2]:
            by_root[top(u)].add(r[2])
    want = []
    for i, url, *_ in rows:
        host, path, r = rule(url)
        passed = by_root.get(top(form(url)), set()) if url and form(url) in parent else set()
        want.append((i, host, path, r[1] if r else None, r[2] if r else "block" if passed == {"block"} else "allow"))
    got = [tuple(r[c] for c in ("page_id", "host", "path", "rule", "verdict")) for r in queries()["op3_url_aliases"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(v == "block" and r is None for _, _, _, r, v in want) > 5


# --- 4


def plain_targets(sizes, share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), share * sum(sizes.values())
    while free:
        w = sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * left / w > most * sizes[s] + 1e-9}
        if not over:
            return target | {s: weight[s] * left / w for s in free}
        for s in over:
            target[s] = most * sizes[s]
        left -= sum(target[s] for s in over)
        free -= over
    return target


def test_mix(spark, odd, docs):
    for rows in (docs.select("doc_id", "source", "text"), odd):
        got = source_mix.copies(rows).collect()
        sizes = Counter()
        for r in rows.collect():
            sizes[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        target = plain_targets(sizes)
        taken, largest = Counter(), Counter()
        assert len(got) == rows.count()
        for r in got:
            assert r["__source_size"] == sizes[r["source"]] and r["__target"] == pytest.approx(target[r["source"]]) and 0 <= r["__copies"] <= 2
            taken[r["source"]] += r["__copies"] * r["__size"]
            largest[r["source"]] = max(largest[r["source"]], r["__size"])
        assert all(abs(taken[s] - target[s]) <= largest[s] + 1 for s in sizes)
        assert Counter((r["doc_id"], r["__copies"]) for r in source_mix.copies(rows.repartition(3)).collect()) == Counter((r["doc_id"], r["__copies"]) for r in got)
    mixed = source_mix.mixture(docs)
    want = Counter({r["doc_id"]: r["__copies"] for r in source_mix.copies(docs).collect() if r["__copies"]})
    assert mixed.columns == docs.columns and Counter(r["doc_id"] for r in mixed.collect()) == want
    assert source_mix.mixture(odd).columns == odd.columns and source_mix.mixture(odd).count() == sum(r["__copies"] for r in source_mix.copies(odd).collect())
    same = spark.createDataFrame([(1, "a b c", "s", {"k": 1}), (1, "a b c", "s", {"k": 2}), (1, "a b c", "s", None), (1, None, "s", None), (None, None, "s", None)], "doc_id long, text string, source string, m map<string,int>")
    assert Counter(repr(r) for r in source_mix.mixture(same, share=2.0).collect()) == Counter({repr(r): 2 for r in same.collect()})
    many = spark.createDataFrame([(i, "w " * (i % 7 + 1), f"s{i % 41}") for i in range(400)], "doc_id long, text string, source string")
    by = {r["source"]: r for r in source_mix.targets(many.groupBy("source").agg(F.sum(source_mix.words_in(F.col("text"))).alias("source_size"))).collect()}
    want = plain_targets({s: r["source_size"] for s, r in by.items()})
    assert all(r["target"] == pytest.approx(want[s]) for s, r in by.items()) and len(by) == 41
    assert source_mix.copies(empty(spark)).count() == 0 and source_mix.mixture(empty(spark)).count() == 0


# --- 5


def test_spans(spark, docs):
    passage = " ".join(f"word{i * 7 % 61}x{i}" for i in range(55))
    rows = [(i, f"Start {i} of it. {' '.join(f'own{i}a{k}' for k in range(40))} {passage} {' '.join(f'end{i}b{k}' for k in range(40))}.") for i in range(5)]
    got = {r["doc_id"]: r for r in sentence_spans.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0]["n_removed"] == 0 and got[0]["text"] == rows[0][1]
    for i in range(1, 5):
        assert got[i]["n_words_removed"] > 30 and got[i]["text"].startswith(f"Start {i} of it. own{i}a0") and got[i]["text"].endswith(f"end{i}b39.")
        assert all(f"own{i}a{k}" in got[i]["text"].split() for k in range(40)) and all(f"end{i}b{k}" in got[i]["text"] for k in range(40))
    twice = [(1, f"{passage}. Another line stands here.\n{passage}. The end is near.")]
    (one,) = sentence_spans.without_repeats(spark.createDataFrame(twice, "doc_id long, text string")).collect()
    assert one["n_words_removed"] > 30 and "Another line stands here" in one["text"]


def plain_hash(word, k):
    """A word's hash by its definition, for where long sentences are cut."""
    from verso.llm.words import _BYTE, _PLACE

    h = sum(int(_BYTE[c]) * (int(_PLACE[i & 255]) + (i >> 8 << 1)) for i, c in enumerate(word)) + len(word)
    h %= 2**64
    h = (h ^ h >> 29) * 0xBF58476D1CE4E5B9 % 2**64
    return h ^ h >> 32


def plain_sentences(text):
    """Lists of words, cut at sentence ends and, in long sentences, after words whose hash is the least within three."""
    low = (text or "").encode().lower()
    found, out = [], []
    for m in WORD.finditer(low):
        found.append((m[0], not found or re.search(rb"[.!?\n]", low[found_end : m.start()]) is not None))
        found_end = m.end()
    hashes = [plain_hash(w, 0) for w, _ in found]
    groups = []
    for i, (w, first) in enumerate(found):
        if first:
            groups.append([])
        groups[-1].append(i)
    for g in groups:
        now = []
        for i in g:
            now.append(found[i][0])
            around = hashes[max(0, i - 3) : i + 4]
            if len(g) > 12 and 3 <= i < len(found) - 3 and hashes[i] == min(around) and around.index(hashes[i]) == 3 and i != g[-1]:
                out.append(now)
                now = []
        out.append(now)
    return out


def plain_spans(rows):
    """(n_sentences, n_removed, n_words, n_words_removed) of each row, in order of first places."""
    first, out = {}, []
    for text in rows:
        own = plain_sentences(text)
        again = set()
        for k in range(len(own) - 2):
            run = tuple(w for s in own[k : k + 3] for w in s)
            if run in first:
                again |= {k, k + 1, k + 2}
            first.setdefault(run, k)
        gone = set()
        for k in sorted(again):
            if k - 1 not in again:
                size = 0
                stretch = []
                while k in again:
                    stretch.append(k)
                    size += len(own[k])
                    k += 1
                if size >= 20:
                    gone |= set(stretch)
        out.append((len(own), len(gone), sum(map(len, own)), sum(len(own[k]) for k in gone)))
    return out


def test_spans_against_plain_version(docs, texts):
    want = dict(zip(sorted(texts), plain_spans([texts[i] for i in sorted(texts)]), strict=True))
    for r in sentence_spans.without_repeats(docs).collect():
        assert want[r["doc_id"]] == (r["n_sentences"], r["n_removed"], r["n_words"], r["n_words_removed"]), r["doc_id"]
        assert len(words(r["text"])) == r["n_words"] - r["n_words_removed"]


@pytest.mark.parametrize("kind", ["long", "string"])
def test_spans_of_repeated_and_null_ids(spark, kind):
    rng = np.random.default_rng(11)
    passages = [" ".join(f"p{p}w{i}." if i % 7 == 6 else f"p{p}w{i}" for i in range(28)) for p in range(6)]
    texts = [None, "", "hi there", *(" ".join(passages[p] for p in rng.integers(0, 6, int(rng.integers(1, 4)))) for _ in range(12))]
    rows = [(None if rng.random() < 0.3 else int(rng.integers(0, 9)), texts[int(rng.integers(0, len(texts)))]) for _ in range(70)] + [(1, "p"), (5, "p"), (5, "hi there")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("doc_id", F.col("doc_id").cast(kind))
    named = frame.select("doc_id", "text", F.xxhash64("text").alias("own"), F.xxhash64("doc_id").alias("by")).collect()
    order = sorted(named, key=lambda r: (r["own"] if r["doc_id"] is None else r["by"] if kind == "string" else r["doc_id"], r["own"]))
    want = Counter(zip((r["doc_id"] for r in order), plain_spans([r["text"] for r in order]), strict=True))
    got = sentence_spans.without_repeats(frame).collect()
    assert Counter((r["doc_id"], (r["n_sentences"], r["n_removed"], r["n_words"], r["n_words_removed"])) for r in got) == want
    assert max(Counter(s for r in got for s in re.findall(r"p\dw\d+", r["text"])).values()) <= 6


def test_spans_on_odd_rows(spark, odd):
    got = sentence_spans.without_repeats(odd).collect()
    assert len(got) == len(ROWS) and sum(r["doc_id"] is None for r in got) == 1
    assert all(r["n_removed"] == 0 for r in got if r["doc_id"] != 5)
    assert sentence_spans.without_repeats(empty(spark)).count() == 0


# --- 6


def sets(texts):
    out = {}
    for i, t in texts:
        w = words(t)
        out[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    return out


def test_similar_groups(spark, docs, texts):
    rng = np.random.default_rng(4)
    base = [f"w{x}" for x in rng.integers(0, 500, 120)]
    extra = []
    for i in range(60):
        own = list(base)
        for k in rng.integers(0, 120, int(rng.integers(0, 5))):
            own[k] = f"x{i}"
        extra.append((10_000 + i, " ".join(own)))
    both = docs.select("doc_id", "text").unionAll(spark.createDataFrame(extra, "doc_id long, text string"))
    s = sets([*texts.items(), *extra])
    links = defaultdict(set)
    ids = list(s)
    for a in range(len(ids)):
        for b in range(a):
            x, y = s[ids[a]], s[ids[b]]
            common = len(x & y)
            if common >= 0.8 * (len(x) + len(y) - common) - 1e-9:
                links[ids[a]].add(ids[b])
                links[ids[b]].add(ids[a])
    least = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            m = min([least[i], *(least[j] for j in links[i])])
            changed |= m != least[i]
            least[i] = m
    got = {r["doc_id"]: r for r in jaccard_join.similar_groups(both).collect()}
    assert {i: r["n_links"] for i, r in got.items()} == {i: len(links[i]) for i in ids}
    assert {i: r["class_id"] for i, r in got.items()} == least
    assert sorted(r["doc_id"] for r in jaccard_join.one_of_each(both).collect()) == sorted(set(least.values()))


def test_blocks_of_a_large_component(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 7)
    rows = [(i, " ".join(f"t{k}" for k in range(100)) + f" end{i}") for i in range(50)]
    got = jaccard_join.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["class_id"], r["n_links"]) for r in got} == {(0, 49)}


def test_pruning():
    least = jaccard_join.needed(0.8, 1e-7)
    assert list(least) == sorted(least) and least[0] > 0 and least[-1] < 96 * 0.8


def test_groups_on_odd_rows(spark, odd):
    got = jaccard_join.similar_groups(odd).collect()
    assert len(got) == len(ROWS)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["class_id"] == 1 and by[2]["class_id"] == 1 and by[4]["n_copies"] == 2 and by[None]["class_id"] is None
    kept = jaccard_join.one_of_each(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6]
    assert jaccard_join.similar_groups(empty(spark)).count() == 0 and jaccard_join.one_of_each(empty(spark)).count() == 0


# --- 7


def test_tree_and_bins():
    rng = np.random.default_rng(3)
    tree, plain = shard_pack.Tree(), []
    for k in rng.integers(0, 1000, 400).tolist():
        if k in plain:
            tree.remove(k)
            plain.remove(k)
        else:
            tree.add(k)
            plain.append(k)
        q = int(rng.integers(0, 1000))
        assert tree.ceiling(q) == min((x for x in plain if x >= q), default=None)
    assert 2 ** (tree.root[3] / 1.45) <= len(plain) * 2
    sizes = sorted(rng.integers(1, 100, 200).tolist(), reverse=True)
    left, want = [], []
    for s in sizes:
        fits = [(room, b) for b, room in enumerate(left) if room >= s]
        if fits:
            b = min(fits)[1]
            left[b] -= s
        else:
            b = len(left)
            left.append(120 - s)
        want.append(b)
    runs = sorted(Counter(sizes).items(), reverse=True)
    one_by_one = lambda where: [b for x in where for b, n in x for _ in range(n)]
    assert one_by_one(shard_pack.best_fit(runs, 120)) == want
    assert shard_pack.best_fit(runs, 120, max(want)) is None and len(shard_pack.best_fit(runs, 120, max(want) + 1)) == len(runs)
    sums = Counter()
    for s, b in zip(sizes, one_by_one(shard_pack.even_bins(runs, 7)), strict=True):
        sums[b] += s
    assert len(sums) == 7 and max(sums.values()) - min(sums.values()) <= 0.02 * sum(sizes)
    assert shard_pack.even_bins([(1000, 1), (3, 1), (2, 1), (1, 1)], 3) == [[(0, 1)], [(1, 1)], [(2, 1)], [(2, 1)]] and shard_pack.even_bins([], 3) == []
    assert shard_pack.even_bins([(50, 3), (1, 4)], 3) == [[(0, 1), (1, 1), (2, 1)], [(0, 2), (1, 2)]]


@pytest.mark.parametrize("options", [{}, {"shards": 5}])
def test_packing(spark, odd, docs, options):
    for rows in (docs, odd):
        got = shard_pack.packed(rows, **options).collect()
        text = {r["doc_id"]: r["text"] for r in rows.collect()}
        assert len(got) == rows.count()
        shards, sums = defaultdict(list), Counter()
        where = defaultdict(set)
        for r in got:
            data = (text[r["doc_id"]] or "").encode()
            assert r["size"] == len(data) + 8 and r["text_crc32"] == zlib.crc32(data)
            shards[r["shard"]].append(r["slot"])
            sums[r["shard"]] += r["size"]
            where[text[r["doc_id"]] or ""].add(r["shard"])
        assert all(sorted(s) == list(range(len(s))) for s in shards.values()) and all(len(w) == 1 for w in where.values())
        assert max(shards) < options.get("shards", 24)
    even = Counter()
    for r in shard_pack.packed(docs).collect():
        even[r["shard"]] += r["size"]
    alone = [n for n in even.values() if n * 24 > sum(even.values()) * 1.01]
    assert len(even) == 24 and max(even.values()) <= max([*alone, 1.01 * (sum(even.values()) - sum(alone)) / (24 - len(alone)) + 1])
    assert shard_pack.packed(empty(spark)).count() == 0


# --- 8


@pytest.mark.parametrize("most", [100_000, 3])
def test_contamination(spark, odd, docs, texts, sf, most):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet").unionByName(spark.createDataFrame([(900, "Short ITEM é"), (901, None), (902, "  "), (None, "lorem ipsum dolor")], "item_id long, text string"))
    extra = spark.createDataFrame([(9001, "a short item É and short item é"), (9002, "x lorem ipsum dolor y")], "doc_id long, text string")
    rows = docs.select("doc_id", "text").unionAll(extra)
    grams = defaultdict(set)
    for r in bench.collect():
        w = words(r["text"])
        for k in range(len(w) - min(10, len(w)) + 1 if w else 0):
            grams[tuple(w[k : k + 10])].add(r["item_id"])
    for r, text in zip(decontaminate.contamination(rows, bench, max_grams=most).orderBy("doc_id").collect(), [r["text"] for r in rows.orderBy("doc_id").collect()], strict=True):
        w, hit, items = words(text), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in grams:
                    hit.update(range(k, k + n))
                    items |= grams[tuple(w[k : k + n])]
        named = sorted(str(i) for i in items if i is not None)
        assert tuple(r)[1:] == (len(w), len(hit), len(named), hashlib.sha256(",".join(named).encode()).hexdigest(), bool(hit))
    clean = decontaminate.uncontaminated(odd, bench, max_grams=most)
    assert clean.columns == odd.columns and clean.count() == len(ROWS) - 1 and decontaminate.contamination(odd, bench, max_grams=most).count() == len(ROWS)
    kept = {r["doc_id"]: r["clean_words"] for r in decontaminate.without_spans(extra, bench, max_grams=most).collect()}
    assert kept == {9001: "a short item É and".replace("É", "É"), 9002: "x y"}
    assert decontaminate.contamination(empty(spark), bench, max_grams=most).count() == 0 and not decontaminate.contamination(odd, bench.limit(0), max_grams=most).where("contaminated").count()


# --- 9


def test_streams(spark, odd, docs, texts):
    out = {r["doc_id"]: r for r in transport_stream.streams(docs).collect()}
    for i, text in texts.items():
        data = text.encode()
        payload = data + b" " * (-len(data) % 192 or (192 if not data else 0))
        r = out[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        assert len(r["media"]) % 188 == 0 and hashlib.sha256(bytes(r["media"])).hexdigest() == r["media_sha256"] and r["media_bytes"] == len(r["media"])
        assert set(bytes(r["media"])[::188]) == {0x47}
    got = transport_stream.streams(odd, media=False).collect()
    assert len(got) == len(ROWS) and {r["payload_bytes"] for r in got if r["doc_id"] in (1, 2)} == {192}
    assert len({r["media_sha256"] for r in got if r["doc_id"] == 4}) == 1 and transport_stream.streams(empty(spark)).count() == 0


def test_damaged_streams():
    payload = transport_stream.padded(b"abc" * 40_000)
    packets = list(transport_stream.mux(payload))
    good = transport_stream.demux(b"".join(packets))
    assert good.payload == payload and good.counter_errors == good.bad_tables == 0 and good.timestamps == [3600 * i for i in range(len(good.timestamps))] and good.random_access == [0, 8, 16]
    assert transport_stream.demux(b"".join(packets[:20] + packets[21:])).counter_errors == 1
    table = bytearray(packets[0])
    table[12] ^= 1
    assert transport_stream.demux(bytes(table) + b"".join(packets[1:])).bad_tables == 1
    assert transport_stream.crc_mpeg(b"123456789") == 0x0376E6E7


def test_streams_of_other_makers():
    t = transport_stream
    payload = t.padded(b"abcdefg" * 9000)
    packets = list(t.mux(payload))
    null = bytes([0x47, 0x1F, 0xFF, 0x10]) + b"\xff" * 184
    good = t.demux(b"".join(packets))
    assert good.clocks == [n * 3600 for n in good.random_access]
    with_null = t.demux(b"".join(x for p in packets for x in (p, null)))
    assert with_null.counter_errors == 0 and with_null.payload == payload
    twice = t.demux(b"".join(p for p in packets for _ in range(2)))
    assert twice.counter_errors == 0 and twice.payload == payload and twice.timestamps == good.timestamps
    assert t.demux(b"".join(p for p in packets[:9] for _ in range(3))).counter_errors == 9
    # an announced jump of the counter, on a packet of a stream's own
    body = b"\0\0\1\xbd" + (192 + 3).to_bytes(2, "big") + b"\x84\0\0" + b"x" * 192
    tables = packets[:2]
    jump = [t._packet(0x100, True, 3, body[:182], 0), t._packet(0x100, False, 9, body[182:], 0x80)]
    assert t.demux(b"".join(tables + jump)).counter_errors == 0 and t.demux(b"".join(tables + jump)).payload == b"x" * 192
    assert t.demux(b"".join([*tables, jump[0], t._packet(0x100, False, 9, body[182:], 0)])).counter_errors == 1
    # a program table over two packets, with a long descriptor, naming video before private data
    wide = (0xE000 | 0x100).to_bytes(2, "big") + (0xF000 | 200).to_bytes(2, "big") + bytes(200) + bytes([0x1B, 0xE1, 0x01, 0xF0, 0, 0x06, 0xE1, 0x00, 0xF0, 0])
    section = t._section(2, 1, wide)
    split = [t._packet(0x1000, True, 0, section[:184]), t._packet(0x1000, False, 1, section[184:] + b"\xff" * (184 - len(section[184:])))]
    rest = [t._packet(0x100, True, 3, body[:182], 0), t._packet(0x100, False, 4, body[182:], 0)]
    assert t.demux(b"".join([packets[0], *split, *rest])).payload == b"x" * 192 and t.demux(b"".join([packets[0], *split, *rest])).bad_tables == 0
    video = t._section(2, 1, (0xE000 | 0x100).to_bytes(2, "big") + b"\xf0\x00" + bytes([0x1B, 0xE1, 0x00, 0xF0, 0]))
    only = t._packet(0x1000, True, 0, video + b"\xff" * (184 - len(video)))
    assert t.demux(b"".join([packets[0], only, *rest])).payload == b"x" * 192
    assert t.demux(b"".join([*tables, rest[0]])).cut_short == 1


# --- 10


@pytest.mark.parametrize("block", [1 << 16, 64])
def test_tokens(spark, odd, docs, texts, block, monkeypatch):
    monkeypatch.setattr(token_separators, "STRETCH", 5)
    bpe = token_separators.encoding(token_separators.VOCABULARY)
    got = token_separators.token_counts(docs, block=block).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {i: len(bpe.encode_ordinary(t)) for i, t in texts.items()}
    by_file = defaultdict(list)
    for r in got:
        by_file[r["file"]].append((r["document"], r["start"], r["n_tokens"]))
    for rows in by_file.values():
        rows.sort()
        assert [d for d, _, _ in rows] == list(range(len(rows))) and all(b[1] == a[1] + a[2] + 1 for a, b in zip(rows, rows[1:], strict=False))
    own = token_separators.token_counts(odd, block=block).collect()
    assert len(own) == len(ROWS) and {r["n_tokens"] for r in own if r["doc_id"] in (1, 2)} == {0}
    assert token_separators.token_counts(empty(spark)).count() == 0


def test_tokens_of_other_ids(spark):
    rows = [("a", "one two"), ("b", None), (None, "three"), ("a", "one two")]
    bpe = token_separators.encoding(token_separators.VOCABULARY).encode_ordinary
    got = token_separators.token_counts(spark.createDataFrame(rows, "doc_id string, text string"), block=2).collect()
    assert Counter((r["doc_id"], r["n_tokens"]) for r in got) == {("a", len(bpe("one two"))): 2, ("b", 0): 1, (None, len(bpe("three"))): 1}


@pytest.mark.parametrize("stretch", [1, 3, 1024])
def test_token_files(spark, tmp_path, stretch, monkeypatch):
    monkeypatch.setattr(token_separators, "STRETCH", stretch)
    rng = np.random.default_rng(6)
    want = set()
    for name, n, tail in (("a.bin", 40, 3), ("b.bin", 25, 0), ("c.bin", 0, 9)):
        flat = []
        for d in range(n):
            size = int(rng.integers(0, 30))
            want.add((name, d, len(flat), size, True))
            flat += [*rng.integers(0, 1000, size).tolist(), token_separators.SEPARATOR]
        if tail:
            want.add((name, n, len(flat), tail, False))
            flat += [5] * tail
        (tmp_path / name).write_bytes(np.array(flat, "<u2").tobytes())
    (tmp_path / "d.bin").write_bytes(b"")
    found = token_separators.scan(token_separators.read_token_files(spark, str(tmp_path), 16)).collect()
    assert {(r["file"].rpartition("/")[2], r["document"], r["start"], r["n_tokens"], r["ended"]) for r in found} == want


# --- all


def test_pipeline(spark, sf):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("score", F.lit(1)).withColumn("size", F.lit("s"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name != "shards":
            assert out.columns == docs.columns
        docs = out
    assert corpus_pipeline.run(spark, sf).count() > 100


@pytest.mark.parametrize("name", ["op1_license_scan", "op3_url_aliases", "op4_source_mix", "op8_decontaminate"])
def test_sql(spark, sf, name):
    import duckdb

    from verso.llm.queries import oracle_sql, queries

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = queries()[name](spark, sf)
    cur = con.execute(oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(repr([r[c] for c in names]) for r in df.collect()) == sorted(map(repr, map(list, cur.fetchall())))
