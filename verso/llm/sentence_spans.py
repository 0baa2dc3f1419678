"""Substring dedup over sliding sentence spans.

A text is cut into sentences, at full stops, question and exclamation marks and line ends. Long
sentences are cut further at words whose hash is the least around, so that a passage is cut alike
wherever it stands. Every run of RUN consecutive sentences is hashed; the runs of all texts are
joined, and the sentences that a repeated run covers go, but for the run's first place: the least
doc_id's first. As a run begins with every sentence, the runs of a repeated passage cover it from
its first whole sentence to its last. What they cover stays if it has under LEAST_WORDS words in
a row, so that short phrases may come again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Batches, cut, lean, written
from .words import Words, mix, scan_all, utf8

RUN, LEAST_WORDS, LONG, REACH = 3, 20, 12, 3
#: Ids of several rows that are sent to all tasks; more are joined by a shuffle.
MOST_SENT = 100_000
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?\n")] = True
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def sentences(data: bytes, words: Words) -> np.ndarray:
    """Index of each sentence's first word, and the number of words at the end."""
    n = len(words.hash)
    if not n:
        return np.zeros(1, np.int64)
    ends = np.concatenate(([0], np.cumsum(_ENDS[np.frombuffer(data, np.uint8)], dtype=np.int64)))
    first = np.ones(n, bool)
    first[1:] = ends[words.start[1:]] > ends[words.end[:-1]]
    begin = np.append(np.flatnonzero(first), n)
    size = np.diff(begin)
    if (size > LONG).any():
        padded = np.concatenate((np.zeros(REACH, np.uint64), words.hash, np.zeros(REACH, np.uint64)))
        around = np.lib.stride_tricks.sliding_window_view(padded, 2 * REACH + 1)
        low = around.argmin(1) == REACH
        low[:REACH] = low[n - REACH :] = False
        after = np.flatnonzero(low & np.repeat(size > LONG, size)) + 1
        begin = np.unique(np.concatenate((begin, after[after < n])))
    return begin


def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(n, base & (2**64 - 1), np.uint64))))


_known = {}


def powers(k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of base k and of its inverse, mod 2^64; those of usual texts are kept."""
    if n <= 1 << 15:
        if k not in _known:
            _known[k] = _powers(_BASES[k], 1 << 15), _powers(pow(_BASES[k], -1, 2**64), 1 << 15)
        return _known[k]
    return _powers(_BASES[k], n), _powers(pow(_BASES[k], -1, 2**64), n)


def spans(words: Words, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the run that begins with each sentence, where there is one."""
    first, last = begin[:-RUN], begin[RUN:]
    out = []
    for k in (0, 1):
        up, down = powers(k, len(words.hash))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words.hash * up[: len(words.hash)], dtype=np.uint64)))
        out.append(mix((sums[last] - sums[first]) * down[first]))
    return out[0].view(np.int64), (out[1] >> np.uint64(33)).astype(np.int32)


@lean
def each_span(batches: Batches) -> Batches:
    """Rows (rid, variant, text) to (h, c, rid, variant, first): each run's hashes, and the sentence that it begins with; repeats within a text once."""
    for batch in batches:
        h, c, rids, variants, firsts = [], [], [], [], []
        texts = utf8(batch.column("text"))
        for rid, variant, data, words in zip(batch.column("rid").to_pylist(), batch.column("variant").to_pylist(), texts, scan_all(texts), strict=True):
            hash_, check = spans(words, sentences(data, words))
            if len(hash_):
                _, at = np.unique(hash_, return_index=True)
                h.append(hash_[at])
                c.append(check[at])
                rids.append(np.full(len(at), rid, np.int64))
                variants.append(np.full(len(at), variant, np.int64))
                firsts.append(at.astype(np.int32))
        if h:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (h, c, rids, variants, firsts)], names=["h", "c", "rid", "variant", "first"])


def covered(begin: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The sentences in runs that begin at firsts, where these cover LEAST_WORDS words in a row."""
    gone = np.zeros(len(begin), np.int64)
    np.add.at(gone, firsts, 1)
    np.add.at(gone, firsts + RUN, -1)
    out = np.cumsum(gone[:-1]) > 0
    edge = np.flatnonzero(np.diff(np.concatenate(([False], out, [False]))))
    for a, b in zip(edge[0::2], edge[1::2], strict=True):
        if begin[b] - begin[a] < LEAST_WORDS:
            out[a:b] = False
    return out


@lean
def without(batches: Batches) -> Batches:
    """Rows (doc_id, text, firsts, copies) to the result of without_repeats, copies rows of each; firsts: sentences at which runs to remove begin."""
    names = ["doc_id", "n_sentences", "n_removed", "n_words", "n_words_removed", "text"]
    for batch in batches:
        rows, of = [], []
        texts = utf8(batch.column("text"))
        for at, (data, words, firsts, copies) in enumerate(zip(texts, scan_all(texts), batch.column("firsts").to_pylist(), batch.column("copies").to_pylist(), strict=True)):
            begin = sentences(data, words)
            hash_, _ = spans(words, begin)
            sizes = np.diff(begin)
            again = np.ones(len(hash_), bool)
            again[np.unique(hash_, return_index=True)[1]] = False
            marks = np.union1d(np.array(firsts or [], np.int64), np.flatnonzero(again))
            place = np.append(words.start[begin[:-1]], len(data))
            for marked, n in ((marks, 1), (np.arange(len(hash_)), copies - 1)):
                if not n:
                    continue
                out, left = covered(begin, marked), data
                if out.any():
                    left = b"".join([data[: place[0]], *(data[place[i] : place[i + 1]] for i in np.flatnonzero(~out))])
                rows += [(len(sizes), int(out.sum()), int(sizes.sum()), int(sizes[out].sum()), left.decode())] * n
                of += [at] * n
        columns = list(zip(*rows, strict=True)) or [()] * 5
        kinds = [pa.int64()] * 4 + [pa.string()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(of, pa.int64())), *(pa.array(x, k) for x, k in zip(columns, kinds, strict=True))], names=names)


def _rows(docs: DataFrame) -> DataFrame:
    """docs as (doc_id, rid, variant, text, copies).

    rid is a whole-number doc_id, or a hash of another or of a null one's text. Where several rows
    share a rid, variant is the text's hash, and rows of equal texts are one with their number in
    copies; they fall together before their texts travel. Else variant is 0 and copies 1.
    """
    text = F.xxhash64("text")
    whole = dict(docs.dtypes)["doc_id"] in ("tinyint", "smallint", "int", "bigint")
    own = F.col("doc_id").cast("long") if whole else F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id"))
    rows = docs.select("doc_id", F.coalesce(own, text).alias("rid"), text.alias("own"), "text")
    shared = cut(rows.groupBy("rid").agg(F.count("*").alias("n")).where("n > 1").select("rid"))
    n = shared.count()
    alone = [F.lit(0).cast("long").alias("variant"), "text", F.lit(1).cast("long").alias("copies")]
    if not n:
        return rows.select("doc_id", "rid", *alone)
    few = F.broadcast(shared) if n <= MOST_SENT else shared
    met = rows.join(few, "rid", "left_semi").groupBy("rid", F.col("doc_id").isNull(), F.col("own").alias("variant"))
    met = met.agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.count("*").alias("copies"))
    return rows.join(few, "rid", "left_anti").select("doc_id", "rid", *alone).unionAll(met.select("doc_id", "rid", "variant", "text", "copies"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_sentences, n_removed, n_words, n_words_removed, text.

    docs needs doc_id, of any type that can be hashed, and text; other columns are ignored. text is
    what is left. Of two documents with a run of sentences the one with the lower doc_id keeps it, of
    two texts of one doc_id that of the lower hash, and within a document its first place. Ids that
    are not whole numbers are in the order of their hashes; a null doc_id stands for the hash of its
    text. Of repeated rows one is first, and the others lose what runs cover. Null text is
    empty; texts of fewer than RUN sentences keep all. An empty table gives no rows.
    """
    rows = _rows(docs)
    with written(rows.select("rid", "variant", "text").mapInArrow(each_span, "h long, c int, rid long, variant long, first int")) as found:
        repeated = found.groupBy("h", "c").agg(F.min("rid").alias("owner"), F.max("rid").alias("other")).where("owner < other").select("h", "c", "owner")
        marked = found.join(repeated, ["h", "c"]).where("rid > owner").select("rid", "variant", "first")
        texts = found.where("variant <> 0")
        own = texts.groupBy("h", "c", "rid").agg(F.min("variant").alias("low"), F.max("variant").alias("high")).where("low < high").select("h", "c", "rid", "low")
        marked = marked.unionAll(texts.join(own, ["h", "c", "rid"]).where("variant > low").select("rid", "variant", "first"))
        marks = cut(marked.groupBy("rid", "variant").agg(F.sort_array(F.collect_set("first")).alias("firsts")))
    kind = dict(docs.dtypes)["doc_id"]
    return rows.join(marks, ["rid", "variant"], "left").select("doc_id", "text", "firsts", "copies").mapInArrow(without, f"doc_id {kind}, n_sentences long, n_removed long, n_words long, n_words_removed long, text string")
