"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Documents of equal text are a group. Groups, largest first, go into the bin with the least remaining
capacity that holds them, found in a balanced tree. The driver packs a histogram, not groups: of each
size as many as the tightest bin holds go into it at once, which is what one by one would come to.
With the sizes' bins known, each group finds its own by its rank among those of its size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import positions, rank

SHARDS = 24


class Tree:
    """AVL tree of distinct keys."""

    def __init__(self) -> None:
        self.root: list | None = None  # [key, left, right, height]

    def add(self, key) -> None:
        self.root = self._add(self.root, key)

    def remove(self, key) -> None:
        self.root = self._remove(self.root, key)

    def ceiling(self, key):
        """The least key that is not below key, or None."""
        node, best = self.root, None
        while node:
            if node[0] >= key:
                best, node = node[0], node[1]
            else:
                node = node[2]
        return best

    def _add(self, node, key):
        if node is None:
            return [key, None, None, 1]
        side = 1 if key < node[0] else 2
        node[side] = self._add(node[side], key)
        return self._even(node)

    def _remove(self, node, key):
        if node is None:
            return None
        if key == node[0]:
            if node[1] is None or node[2] is None:
                return node[1] or node[2]
            least = node[2]
            while least[1]:
                least = least[1]
            node[0] = least[0]
            node[2] = self._remove(node[2], least[0])
        else:
            side = 1 if key < node[0] else 2
            node[side] = self._remove(node[side], key)
        return self._even(node)

    @staticmethod
    def _height(node) -> int:
        return node[3] if node else 0

    def _turn(self, node, side: int):
        up = node[side]
        node[side], up[3 - side] = up[3 - side], node
        for x in (node, up):
            x[3] = 1 + max(self._height(x[1]), self._height(x[2]))
        return up

    def _even(self, node):
        node[3] = 1 + max(self._height(node[1]), self._height(node[2]))
        lean = self._height(node[1]) - self._height(node[2])
        if abs(lean) < 2:
            return node
        side = 1 if lean > 0 else 2
        child = node[side]
        if self._height(child[3 - side]) > self._height(child[side]):
            node[side] = self._turn(child, 3 - side)
        return self._turn(node, side)


Runs = list[tuple[int, int]]


def best_fit(runs: Runs, capacity: int, most: int | None = None) -> list[Runs] | None:
    """For each (size, count), in falling order of size, the (bin, count) in which best fit puts them; None if more than most bins are needed.

    Bins have a fixed capacity; an item above it has its own.
    """
    tree, bins, out = Tree(), 0, []
    for size, count in runs:
        own: Runs = []
        while count:
            found = tree.ceiling((size, -1))
            if found is None:
                if bins == most:
                    return None
                found = (max(capacity, size), bins)
                bins += 1
            else:
                tree.remove(found)
            # the tightest bin that holds one stays the tightest while it holds another
            n = min(count, found[0] // size)
            tree.add((found[0] - n * size, found[1]))
            own.append((found[1], n))
            count -= n
        out.append(own)
    return out


def even_bins(runs: Runs, bins: int) -> list[Runs]:
    """The (bin, count), bins 0 to bins - 1, of each (size, count), which are in falling order of size.

    Items that exceed an even part of what is left have a bin of their own. The others are packed
    at a capacity at which best fit needs no more bins than are left: from the least that could do
    upwards in growing steps, then by bisection of the last step.
    """
    alone, left, own = 0, sum(s * n for s, n in runs), []
    rest = list(runs)
    while rest and alone < bins - 1 and rest[0][0] * (bins - alone) > left:
        size, count = rest[0]
        if not own or own[-1][0] != size:
            own.append((size, []))
        own[-1][1].append((alone, 1))
        rest[0:1] = [(size, count - 1)] if count > 1 else []
        left -= size
        alone += 1
    if not rest:
        return [x for _, x in own]
    n = bins - alone
    low, step = max(-(-left // n), rest[0][0]) - 1, 1  # low is too little
    while (found := best_fit(rest, low + step, n)) is None:
        low, step = low + step, 2 * step
    high = low + step
    while high - low > max(1, high // 1_000_000):
        middle = (low + high) // 2
        if (better := best_fit(rest, middle, n)) is None:
            low = middle
        else:
            high, found = middle, better
    out = [x for _, x in own]
    for (size, _), where in zip(rest, found, strict=True):
        where = [(alone + b, k) for b, k in where]
        if own and own[-1][0] == size:
            out[-1] += where
        else:
            out.append(where)
    return out


def packed(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot.

    docs needs doc_id and text; other columns are ignored. size is the text's bytes plus 8.
    Documents of equal text share a shard; null text has no bytes and the checksum of no bytes, 0, and is a
    group with the empty text. Shards have near equal sums of size unless one group exceeds an even
    part: it then has a shard of its own. slot counts from 0 within the shard, equal texts side by
    side; rows equal in text and doc_id may swap slots. Fewer groups than shards leave shards
    empty; an empty table gives no rows.

    The driver holds a count for each distinct sum of a group, of which there are fewer than twice the root of
    the bytes of all documents, and which grow far more slowly where sizes repeat.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    thin = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("__group"))
    groups, parts = positions(thin.groupBy("__group").agg(F.sum("size").alias("__sum")), "__sum", ["__group"])
    runs = groups.groupBy("__sum").agg(F.count("*").alias("n")).toArrow()
    sums, counts = runs.column(0).to_numpy(), runs.column(1).to_numpy()
    order = np.argsort(-sums)
    where = even_bins([(int(s), int(n)) for s, n in zip(sums[order], counts[order], strict=True)], shards)
    upto = pa.array([np.cumsum([n for _, n in x]) for x in where], pa.list_(pa.int64()))
    bins = pa.array([[b for b, _ in x] for x in where], pa.list_(pa.int32()))
    of_sum = spark.createDataFrame(pa.table({"__sum": pa.array(sums[order], pa.int64()), "upto": upto, "bins": bins})) if len(sums) else spark.createDataFrame([], "__sum long, upto array<long>, bins array<int>")
    ranked = groups.join(parts, ["__sum", "__part"]).select("__group", "__sum", rank().alias("__rank"))
    put = ranked.join(of_sum, "__sum").select("__group", F.element_at("bins", F.size(F.filter("upto", lambda x: x <= F.col("__rank"))) + 1).alias("shard"))
    rows, parts = positions(thin.join(put, "__group"), "shard", ["__group", "doc_id"])
    return rows.join(F.broadcast(parts), ["shard", "__part"]).select("doc_id", "size", "text_crc32", "shard", rank().cast("long").alias("slot"))
