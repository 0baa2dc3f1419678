"""Quality classifier: a byte-level convolutional network in numpy.

A text's bytes are cut into blocks; a chunk is two neighbouring blocks, so that chunks overlap by
half and cover the whole text. Each filter spans WIDTH bytes; as a byte's embedding and the filters
are linear, both are kept as one table, (WIDTH, 256, FILTERS). Rectified responses are max-pooled
over each chunk; a document's features are, for each filter, the mean over its chunks and the
greatest, and a logistic layer makes one probability of them.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH, FILTERS, BLOCK = 4, 12, 128
#: Blocks that are handled at once, which bounds memory for long texts.
SLAB = 512


class Network(NamedTuple):
    table: np.ndarray
    bias: np.ndarray
    weight: np.ndarray
    offset: float


def _pooled(data: bytes, net: Network, places: bool = False):
    """Greatest response of each filter in each block, before rectifying; where it is, if places."""
    blocks = max(1, -(-len(data) // BLOCK))
    padded = np.zeros(blocks * BLOCK + WIDTH - 1, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    most, where = [], []
    for at in range(0, blocks, SLAB):
        n = min(SLAB, blocks - at) * BLOCK
        part = padded[at * BLOCK : at * BLOCK + n + WIDTH - 1]
        out = net.table[0].take(part[:n], 0)
        for j in range(1, WIDTH):
            out += net.table[j].take(part[j : n + j], 0)
        out = out.reshape(-1, BLOCK, out.shape[1])
        if places:
            own = out.argmax(1)
            where.append(own + (at + np.arange(len(out)))[:, None] * BLOCK)
            most.append(np.take_along_axis(out, own[:, None, :], 1)[:, 0])
        else:
            most.append(out.max(1))
    most = np.concatenate(most) + net.bias
    return (most, np.concatenate(where), padded) if places else most


def _chunks(most: np.ndarray) -> np.ndarray:
    """Rectified maxima of chunks of two blocks."""
    pooled = np.maximum(most, 0)
    return np.maximum(pooled[:-1], pooled[1:]) if len(pooled) > 1 else pooled


def probability(data: bytes, net: Network) -> float:
    chunks = _chunks(_pooled(data, net))
    z = float(np.concatenate([chunks.mean(0), chunks.max(0)]) @ net.weight) + net.offset
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def gradient(data: bytes, label: int, net: Network, weigh: float = 1.0) -> list[np.ndarray]:
    """Of weigh times the log loss, by table, bias, weight and offset."""
    most, where, padded = _pooled(data, net, True)
    chunks = _chunks(most)
    features = np.concatenate([chunks.mean(0), chunks.max(0)])
    z = float(features @ net.weight) + net.offset
    slope = net.weight.dtype.type((1 / (1 + np.exp(-np.clip(z, -30, 30))) - label) * weigh)
    down = np.repeat((slope * net.weight[:FILTERS] / len(chunks))[None], len(chunks), 0)
    down[chunks.argmax(0), np.arange(FILTERS)] += slope * net.weight[FILTERS:]
    block = np.zeros_like(most)
    if len(most) > 1:
        left = most[:-1] >= most[1:]
        block[:-1] += down * left
        block[1:] += down * ~left
    else:
        block += down
    block *= most > 0
    table = np.zeros_like(net.table)
    row, column = np.nonzero(block)
    for j in range(WIDTH):
        np.add.at(table[j], (padded[where[row, column] + j], column), block[row, column])
    return [table, block.sum(0), slope * features, np.full(1, slope)]


def fit(texts: list[bytes], labels: list[int], epochs: int = 12, batch: int = 16, rate: float = 0.01, cuts: float = 0.2, seed: int = 5) -> Network:
    """Adam on the log loss; both classes weigh the same. One class only gives its constant answer.

    With a chance of cuts, the same for both classes, a text is learned from as a short cut in an
    epoch, so that shortness itself says nothing; else as a whole.
    """
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32)
    net = Network(table, np.zeros(FILTERS, np.float32), rng.normal(0, 0.3, 2 * FILTERS).astype(np.float32), 0.0)
    y = np.array(labels, float)
    if len(set(labels)) < 2:
        return net._replace(weight=net.weight * 0, offset=0.0 if not labels else 20.0 * (2 * labels[0] - 1))
    share = {1: len(y) / 2 / y.sum(), 0: len(y) / 2 / (len(y) - y.sum())}
    params = [net.table, net.bias, net.weight, np.zeros(1, np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    t = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), batch):
            grads = [np.zeros_like(p) for p in params]
            some = order[at : at + batch]
            now = Network(params[0], params[1], params[2], float(params[3][0]))
            for i in some:
                text = texts[i]
                if rng.random() < cuts:
                    size = int(rng.integers(1, 200))
                    start = int(rng.integers(0, max(1, len(text) - size)))
                    text = text[start : start + size]
                for g, own in zip(grads, gradient(text, labels[i], now, share[labels[i]] / len(some)), strict=True):
                    g += own
            t += 1
            for p, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return Network(params[0], params[1], params[2], float(params[3][0]))


def held_out(doc_id: Column) -> Column:
    """crc32 of the id's digits, mod 3, is 1; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, per_class: int = 400) -> Network:
    """A network from the whole texts of at most per_class labelled documents of each class that are not held out.

    The documents are those of the least hashes, so reruns agree. Of a doc_id with several texts the
    least is learned from. Labels without a text, null, other and contradictory labels and held-out
    rows teach nothing; without any label all documents score 0.5.
    """
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("__most")).where("quality = __most").drop("__most")
    order = F.xxhash64("doc_id")
    chosen = [usable.where(F.col("quality") == q).orderBy(order, "doc_id").limit(per_class) for q in (0, 1)]
    met = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).join(F.broadcast(chosen[0].unionAll(chosen[1])), "doc_id")
    rows = met.groupBy("doc_id", "quality").agg(F.min("t").alias("t")).orderBy(order, "doc_id").collect()  # at most 2 * per_class
    return fit([r["t"].encode() for r in rows], [r["quality"] for r in rows])


def score(text: Column, net: Network) -> Column:
    """Probability of quality 1 of whole texts; null is empty, and an empty text is one empty chunk. Equal texts score alike."""

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([probability(b"" if t is None else t.encode(), net) for t in texts], dtype="float64")

    return F.pandas_udf(run, "double")(text)


def quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    docs needs doc_id and text, labels doc_id and quality; other columns are ignored. Null and
    empty texts have the score of an empty chunk. Repeated rows get equal scores; an empty table gives no rows.
    """
    net = learn(docs, labels, **options)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), net).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of docs that are not rejected; all columns stay.

    Null and empty texts are judged by the score of an empty chunk. Repeated rows stay or go together, a null doc_id too;
    an empty table stays empty, and without labels nothing is rejected.
    """
    net = learn(docs, labels, **options)
    return docs.withColumn("__score", score(F.col("text"), net)).where("__score >= 0.5").select(*docs.columns)
