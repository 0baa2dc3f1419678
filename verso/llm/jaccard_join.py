"""Similarity join on word shingles: MinHash candidates, Bayesian pruning, exact verification.

Texts with one set of shingles form a class and are compared once. Classes that agree in a band of
MinHash values share a bucket. A pair is looked at in the bucket of the first band in which it
agrees: its MinHash values are compared a few at a time, and once the posterior probability that
its similarity reaches the threshold falls below the tolerance, the pair is dropped. Pairs that
stay are verified on the shingles themselves. No pairs leave a task, neither there nor here: only
a spanning forest of them and each class's numbers do. To verify, the classes that a forest of
unpruned pairs connects meet whole where a block holds them; a larger group of them meets block by
block, or bucket by bucket again, whichever moves fewer rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Batches, components, cut, cut_thin, lean, whole_groups, written
from .words import Words, mix, scan_all, utf8

HASHES, ROWS, STEP = 96, 4, 16
BANDS = HASHES // ROWS
_rng = np.random.default_rng(7)
_MULTIPLY = _rng.integers(1, 2**63, HASHES, dtype=np.uint64) | np.uint64(1)
_ADD = _rng.integers(1, 2**63, HASHES, dtype=np.uint64)
_WORD = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_KEY, _CHECK = _rng.integers(1, 2**63, 2, dtype=np.uint64) | np.uint64(1)
#: Members and shingles that a block has on average at most.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20
#: Pairs that are held at once, and shingles of groups that are handled together.
PAIRS, HELD_SHINGLES = 1 << 20, 1 << 20


def shingles(words: Words, n: int) -> np.ndarray:
    """Sorted distinct hashes of runs of n words; a text of fewer words is one run."""
    h = words.hash
    if not len(h):
        return h
    n = min(n, len(h))
    runs = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        runs += h[i : len(h) - n + 1 + i] * _WORD[i % 64] + np.uint64(i // 64)
    return np.unique(mix(runs + np.uint64(n)))


def signature(hashes: np.ndarray) -> np.ndarray:
    """A 16-bit hash of each MinHash value, four to a number: a number is a band."""
    least = np.full(HASHES, 2**32 - 1, np.uint32)
    for at in range(0, len(hashes), 2048):
        some = hashes[at : at + 2048, None] * _MULTIPLY + _ADD
        np.minimum(least, (some >> np.uint64(32)).astype(np.uint32).min(0), out=least)
    return (mix(least.astype(np.uint64) * _KEY) >> np.uint64(48)).astype(np.uint16).view(np.uint64)


def names(hashes: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit numbers that name the set."""
    if not len(hashes):
        return 0, 0
    n = np.uint64(len(hashes))
    whole = np.array([mix(hashes * _KEY).sum(dtype=np.uint64) + n, mix(hashes * _CHECK).sum(dtype=np.uint64) + n])
    return tuple(mix(whole).view(np.int64).tolist())


@cache
def needed(threshold: float, tolerance: float) -> tuple[int, ...]:
    """For each STEP of values compared, the matches under which a pair is dropped.

    With a uniform prior, the similarity after m matches in n has the distribution
    Beta(m + 1, n - m + 1), which is above t with the probability that of n + 1 tries at t
    at most m succeed.
    """
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        chance, m = 0.0, -1
        while chance < tolerance:
            m += 1
            chance += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


def describe(n: int):
    """Rows (doc_id, name, text) to (doc_id, name, key, check, size, bands): the set of runs' names, size and signature."""

    @lean
    def run(batches: Batches) -> Batches:
        for batch in batches:
            keys, sizes, bands = [], [], []
            for words in scan_all(utf8(batch.column("text"))):
                found = shingles(words, n)
                keys.append(names(found))
                sizes.append(len(found))
                bands.append(signature(found).view(np.int64) if len(found) else np.zeros(0, np.int64))
            columns = [pa.array([k for k, _ in keys], pa.int64()), pa.array([c for _, c in keys], pa.int64()), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("name"), *columns], names=["doc_id", "name", "key", "check", "size", "bands"])

    return run


def _pairs(batch: pa.RecordBatch, keys: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of a batch's rows, some at a time: within a block, or of block lo with block hi. Rows are sorted by keys, lo, hi, block."""
    by = np.column_stack([batch.column(k).to_numpy(zero_copy_only=False) for k in (*keys, "lo", "hi", "block")])
    n = len(by)
    if n < 2:
        return
    group = np.concatenate(([0], np.flatnonzero((by[1:, :-1] != by[:-1, :-1]).any(1)) + 1, [n]))
    end = np.repeat(group[1:], np.diff(group))
    left = by[:, -1] == by[:, -3]  # block is lo
    middle = np.repeat(np.add.reduceat(left, group[:-1]) + group[:-1], np.diff(group))
    same = by[:, -2] == by[:, -3]
    begin = np.where(same, np.arange(1, n + 1), np.where(left, middle, end))
    many = end - begin
    total = np.concatenate(([0], np.cumsum(many)))
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(total, total[at] + PAIRS, "right")) - 1)
        some = many[at:to]
        i = np.repeat(np.arange(at, to), some)
        j = np.arange(len(i)) - np.repeat(total[at:to] - total[at], some) + np.repeat(begin[at:to], some)
        if len(i):
            yield i, j
        at = to


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, BANDS)


def promising(i: np.ndarray, j: np.ndarray, bands: np.ndarray, sizes: np.ndarray, own: np.ndarray, threshold: float, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose first common band is own[i], or any where own is negative, that pruning leaves."""
    x, y = sizes[i], sizes[j]
    alive = np.minimum(x, y) >= threshold * np.maximum(x, y) - 1e-9
    i, j = i[alive], j[alive]
    for b in range(int(own.max(initial=-1)) + 1):
        equal = bands[i, b] == bands[j, b]
        alive = np.where(own[i] > b, ~equal, equal | (own[i] != b))
        i, j = i[alive], j[alive]
    each = bands.view(np.uint16)
    matches = np.zeros(len(i), np.int64)
    for step, least in enumerate(needed(threshold, tolerance)):
        part = slice(step * STEP, step * STEP + STEP)
        matches += (each[i, part] == each[j, part]).sum(1)
        alive = matches >= least
        i, j, matches = i[alive], j[alive], matches[alive]
    return i, j


def _forest(i: np.ndarray, j: np.ndarray, top: np.ndarray) -> np.ndarray:
    """Of the pairs, sorted by i, those that connect what those before did not; top, each row's group so far, is kept up to date."""
    out = []
    for at in np.split(np.arange(len(i)), np.flatnonzero(np.diff(i)) + 1) if len(i) else ():
        here = top[i[at[0]]]
        other, first = np.unique(top[j[at]], return_index=True)
        new = other != here
        if new.any():
            out.append(at[first[new]])
            top[np.isin(top, other[new])] = here
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def prune(threshold: float, tolerance: float):
    """Rows (band, gid, lo, hi, block, node, size, bands) of buckets, sorted, to those, less the last two and with other, of which a pair stays.

    other is null, but in the rows of a forest of the pairs that stay, where it is the second node.
    """

    @lean
    def run(batches: Batches) -> Batches:
        for batch in whole_groups(batches, ["band", "gid", "lo", "hi"]):
            bands, own = _matrix(batch.column("bands")), batch.column("band").to_numpy()
            sizes, node = batch.column("size").to_numpy(), batch.column("node").to_numpy()
            seen, top = np.zeros(len(node), bool), np.arange(len(node))
            trees = [np.zeros((2, 0), np.int64)]
            for i, j in _pairs(batch, ["band", "gid"]):
                i, j = promising(i, j, bands, sizes, own, threshold, tolerance)
                seen[i] = seen[j] = True
                at = _forest(i, j, top)
                trees.append(np.stack([i[at], j[at]]))
            i, j = np.concatenate(trees, 1)
            rows = np.concatenate([np.flatnonzero(seen), i])
            thin = batch.select(["band", "gid", "lo", "hi", "block", "node"]).take(pa.array(rows))
            other = pa.array(np.concatenate([np.zeros(len(rows) - len(i), np.int64), node[j]]), mask=np.arange(len(rows)) < len(rows) - len(i))
            yield pa.RecordBatch.from_arrays([*thin.columns, other], names=[*thin.schema.names, "other"])

    return run


def with_shingles(n: int):
    """Rows (node, copies, seats, text) to (node, copies, seats, size, bands, shingles) where the text has the node's set."""

    @lean
    def run(batches: Batches) -> Batches:
        for batch in batches:
            out = [shingles(words, n) for words in scan_all(utf8(batch.column("text")))]
            fits = [(k := names(s))[0] == node or k[0] ^ k[1] == node for s, node in zip(out, batch.column("node").to_pylist(), strict=True)]
            columns = [batch.column("node"), batch.column("copies"), batch.column("seats"), pa.array([len(s) for s in out], pa.int64())]
            columns += [pa.array([signature(s).view(np.int64) for s in out], pa.list_(pa.int64())), pa.array([s.tobytes() for s in out], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "copies", "seats", "size", "bands", "shingles"]).filter(pa.array(fits, pa.bool_()))

    return run


def _common(i: np.ndarray, j: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """Shingles in common of each pair; pairs are sorted by i."""
    used = np.unique(np.concatenate((i, j)))
    size = np.array([len(sets[r]) for r in used])
    codes = np.unique(np.concatenate([sets[r] for r in used]), return_inverse=True)[1]
    begin = np.zeros(int(used.max()) + 1, np.int64)
    begin[used] = np.concatenate(([0], np.cumsum(size)[:-1]))
    many = np.zeros(len(begin), np.int64)
    many[used] = size
    marked = np.zeros(int(codes.max()) + 1, bool)
    out = []
    for at in np.split(np.arange(len(i)), np.flatnonzero(np.diff(i)) + 1):
        own, other = codes[begin[i[at[0]]] : begin[i[at[0]]] + many[i[at[0]]]], j[at]
        marked[own] = True
        first, last = int(other[0]), int(other[-1])
        start = np.concatenate(([0], np.cumsum(many[other])[:-1]))
        if last - first + 1 == len(other):  # neighbours, as in a group of near copies
            hit = marked[codes[begin[first] : begin[last] + many[last]]]
        else:
            hit = marked[codes[np.arange(int(many[other].sum())) + np.repeat(begin[other] - start, many[other])]]
        out.append(np.add.reduceat(hit, start, dtype=np.int64))
        marked[own] = False
    return np.concatenate(out)


def verify(threshold: float, tolerance: float):
    """Rows (band, gid, lo, hi, block, node, copies, size, bands, shingles), sorted, to rows (node, texts, docs, other).

    texts and docs count linked classes and their documents; other, if not null, is a linked class.
    """

    def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Whole groups of about HELD_SHINGLES shingles."""
        by = np.column_stack([batch.column(k).to_numpy() for k in ("band", "gid", "lo", "hi")])
        starts = np.flatnonzero((by[1:] != by[:-1]).any(1)) + 1
        total = np.cumsum(batch.column("size").to_numpy())
        at = 0
        for start, next_ in zip(starts, np.append(starts, len(by))[1:], strict=True):
            if total[next_ - 1] - (total[at - 1] if at else 0) > HELD_SHINGLES:
                yield batch.slice(at, start - at)
                at = start
        yield batch.slice(at)

    @lean
    def run(batches: Batches) -> Batches:
        for batch in (s for b in whole_groups(batches, ["band", "gid", "lo", "hi"]) for s in slices(b)):
            bands, own, sizes, node, copies = _matrix(batch.column("bands")), *(batch.column(c).to_numpy() for c in ("band", "size", "node", "copies"))
            sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in batch.column("shingles")]
            texts, docs, top = np.zeros(len(node), np.int64), np.zeros(len(node), np.int64), np.arange(len(node))
            trees = [np.zeros((2, 0), np.int64)]
            for i, j in _pairs(batch, ["band", "gid"]):
                i, j = promising(i, j, bands, sizes, own, threshold, tolerance)
                if not len(i):
                    continue
                common = _common(i, j, sets)
                linked = common >= threshold * (sizes[i] + sizes[j] - common) - 1e-9
                i, j = i[linked], j[linked]
                for a, b in ((i, j), (j, i)):
                    texts += np.bincount(a, minlength=len(node))
                    docs += np.bincount(a, copies[b], len(node)).astype(np.int64)
                at = _forest(i, j, top)
                trees.append(np.stack([i[at], j[at]]))
            i, j = np.concatenate(trees, 1)
            seen = np.flatnonzero(texts)
            none = np.zeros(len(i), np.int64)
            other = pa.array(np.concatenate([texts[seen] * 0, node[j]]), mask=np.arange(len(seen) + len(i)) < len(seen))
            columns = [np.concatenate([node[seen], node[i]]), np.concatenate([texts[seen], none]), np.concatenate([docs[seen], none])]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), other], names=["node", "texts", "docs", "other"])

    return run


def similar_groups(docs: DataFrame, threshold: float = 0.8, shingle: int = 5, tolerance: float = 1e-7) -> DataFrame:
    """One row per document: doc_id, class_id, n_copies, n_links, n_linked_texts, n_runs.

    docs needs doc_id, of any type that has an order, and text; other columns are ignored. class_id is the least doc_id of the
    documents that links of a similarity of threshold or more connect. n_copies counts the
    documents with the same set of runs, itself included; n_linked_texts the other sets that
    reach the threshold, n_links the documents of these and the copies, without itself.

    Null text is empty. Texts without a word are copies of each other; a text of fewer words
    than shingle is one run. A null doc_id keeps its row and links; a class of which all ids are
    null has a null class_id. Repeated rows are copies. An empty table gives no rows.
    """
    shown = ["doc_id", "class_id", F.col("copies").alias("n_copies"), (F.col("docs") + F.col("copies") - 1).alias("n_links"), F.col("texts").alias("n_linked_texts"), F.col("size").alias("n_runs")]
    return _grouped(docs, threshold, shingle, tolerance, lambda rows: rows.select(*shown))


def _name() -> Column:
    """A number for each (doc_id, text)."""
    return F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text")


def _blocks(rows: DataFrame, blocks: Column) -> DataFrame:
    """A row for each pair of blocks that a row's own block is in: lo, hi and block added."""
    own = F.pmod(F.xxhash64("node"), F.col("__blocks")).cast("int")
    each = rows.withColumn("__blocks", blocks).withColumn("block", own).withColumn("__with", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
    return each.withColumn("lo", F.least("block", "__with")).withColumn("hi", F.greatest("block", "__with")).drop("__blocks", "__with")


def _met(rows: DataFrame) -> DataFrame:
    """Rows of one (band, gid, lo, hi) in one task, sorted."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "band", "gid", "lo", "hi").sortWithinPartitions("band", "gid", "lo", "hi", "block")


def _grouped(docs: DataFrame, threshold: float, shingle: int, tolerance: float, result: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What result makes of a row per document: doc_id, name, size, root of its group, class_id, copies, texts, docs."""
    rows = docs.select("doc_id", _name().alias("name"), "text")
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, name long, key long, check long, size long, bands array<long>"
    with written(rows.mapInArrow(describe(shingle), schema)) as seen:
        n_docs = seen.count()
        clash = cut(seen.groupBy("key").agg(F.min("check").alias("low"), F.max("check").alias("high")).where("low < high").select("key", F.lit(True).alias("clash")))
        if clash.count():  # sets that share their first name
            seen = seen.join(clash, "key", "left").withColumn("key", F.when(F.col("clash"), F.col("key").bitwiseXOR(F.col("check"))).otherwise(F.col("key")))
        of_class = seen.groupBy(F.col("key").alias("node")).agg(F.count("*").alias("copies"), F.min("name").alias("name"), F.min("doc_id").alias("first_id"), F.max("size").alias("size"), F.first("bands").alias("bands"))
        with written(of_class) as classes:
            linked = _linked(rows, classes, threshold, shingle, tolerance)
            counts = linked.groupBy("node").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
            joined = components(linked.where("other is not null").select(F.col("node").alias("u"), F.col("other").alias("v")))
            named = classes.select("node", "copies", "first_id").join(joined, "node", "left").join(counts, "node", "left").withColumn("root", F.coalesce("root", "node"))
            first = cut_thin(named.groupBy("root").agg(F.min("first_id").alias("class_id")), n_docs)
            named = named.join(first, "root").select(F.col("node").alias("key"), "root", "copies", "class_id", F.coalesce("texts", F.lit(0)).alias("texts"), F.coalesce("docs", F.lit(0)).alias("docs"))
            return cut_thin(result(seen.select("doc_id", "name", "key", "size").join(named, "key")), n_docs)


def _linked(rows: DataFrame, classes: DataFrame, threshold: float, shingle: int, tolerance: float) -> DataFrame:
    """verify's rows of all classes."""
    n_classes = classes.count()
    banded = classes.where("size > 0").select("node", F.posexplode("bands").alias("band", "value")).select("node", "band", F.xxhash64("band", "value").alias("gid"))
    full = banded.groupBy("gid").agg(F.count("*").alias("m")).where("m > 1")
    block = F.ceil(F.col("m") / BLOCK).cast("int")
    bucketed = _blocks(banded.join(full, "gid").join(classes.select("node", "size", "bands"), "node"), block)
    columns = ["band", "gid", "lo", "hi", "block", "node"]
    pruned = cut(_met(bucketed.select(*columns, "size", "bands")).mapInArrow(prune(threshold, tolerance), "band int, gid long, lo int, hi int, block int, node long, other long"))
    seats = pruned.where("other is null").drop("other")
    # kept, here and below, so that joins with a large group's rows have exchanges of their own, which Spark can split
    candidate = components(pruned.where("other is not null").select(F.col("node").alias("u"), F.col("other").alias("v")))
    members = candidate.join(seats.groupBy("node").agg(F.count("*").alias("n")), "node").join(classes.select("node", "copies", "size", "name"), "node")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int")
    sizes = members.groupBy("root").agg(blocks.alias("blocks"), (F.sum("n") < F.count("*") * blocks).alias("by_bucket"))
    members = members.join(cut_thin(sizes, n_classes), "root")
    by_root = _blocks(members.where("not by_bucket").select("node", F.lit(-1).alias("band"), F.col("root").alias("gid"), "blocks"), F.col("blocks"))
    by_bucket = seats.join(members.where("by_bucket").select("node"), "node")
    seat = by_root.select(*columns).unionAll(by_bucket.select(*columns)).groupBy("node").agg(F.collect_list(F.struct("band", "gid", "lo", "hi", "block")).alias("seats"))
    chosen = members.select("node", "name", "copies").join(seat, "node")
    # repeated rows of a chosen text fall together before they travel on
    texts = rows.select("name", "text").join(chosen, "name").groupBy("node").agg(*(F.first(c).alias(c) for c in ("copies", "seats", "text")))
    kinds = "node long, copies long, seats array<struct<band:int,gid:long,lo:int,hi:int,block:int>>, size long, bands array<long>, shingles binary"
    sets = texts.mapInArrow(with_shingles(shingle), kinds).select("node", "copies", "size", "bands", "shingles", F.explode("seats").alias("seat"))
    met = _met(sets.select("seat.*", "node", "copies", "size", "bands", "shingles"))
    return cut(met.mapInArrow(verify(threshold, tolerance), "node long, texts long, docs long, other long"))


def one_of_each(docs: DataFrame, threshold: float = 0.8, shingle: int = 5) -> DataFrame:
    """The rows of docs without all but one row of each group that similar_groups finds; all columns stay.

    Of a group's rows that with the least doc_id stays, and of several texts of that doc_id the one
    of the least hash; a null doc_id stays if no document with an id is in its group. Rows of one
    doc_id with texts in different groups are rows of these groups. An empty table gives no rows.
    """
    least = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "name", "n"))

    def first(rows: DataFrame) -> DataFrame:
        own = rows.groupBy("root", "name").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
        return own.groupBy("root").agg(least.alias("m")).select("m.name", "m.n")

    stay = _grouped(docs.select("doc_id", "text"), threshold, shingle, 1e-7, first)
    named = docs.withColumn("__name", _name())
    kept = named.join(stay.where("n = 1").select(F.col("name").alias("__name")), "__name", "left_semi")
    repeated = cut(stay.where("n > 1").select(F.col("name").alias("__name")))
    if not repeated.isEmpty():
        kept = kept.unionAll(named.join(repeated, "__name", "left_semi").dropDuplicates(["__name"]).select(*kept.columns))
    return kept.select(*docs.columns)
