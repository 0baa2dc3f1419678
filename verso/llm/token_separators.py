"""Token counts by separator scan over flat token files.

A token file is nothing but token ids, each document's followed by the end-of-document id. Files
are read in blocks, each block is searched for separators at once, and a prefix scan over the
blocks of a file (running sums of tokens, running maximum of the last separator's place) stitches
the documents that cross blocks. The scan has two levels, blocks within a stretch of STRETCH and
stretches within a file, so that no task holds a file's blocks; separators don't move for it.
"""

from __future__ import annotations

import base64
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import Batches, cut, lean, written

VOCABULARY, PATTERN = "/opt/tokenizers/byte_bpe_50k.tiktoken", r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SEPARATOR, DTYPE, BLOCK, STRETCH = 50256, "<u2", 1 << 16, 1024


@cache
def encoding(path: str):
    """A byte-level BPE of the ranks at path, a file that every executor has."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_blocks(docs: DataFrame, path: str = VOCABULARY, block: int = BLOCK) -> DataFrame:
    """(file, block, tokens, docs): the token files of docs, one a partition, in blocks of so many ids.

    tokens are little-endian 16-bit ids; docs are the ids of the documents whose separator lies in
    the block, in order, which names what the scan finds. Null text has no tokens, only its separator.
    """

    @lean
    def run(batches: Batches) -> Batches:
        bpe = encoding(path)
        file, number = TaskContext.get().partitionId(), 0
        held, size = [], 0
        ends: list[tuple[int, object]] = []  # place from the first held token, doc_id
        kind = pa.int64()

        def out(n: int) -> pa.RecordBatch:
            nonlocal held, size, ends, number
            flat = np.concatenate(held)
            own = [i for p, i in ends if p < n]
            ends = [(p - n, i) for p, i in ends if p >= n]
            held, size = [flat[n:]], size - n
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([file], pa.int32()), pa.array([number - 1], pa.int64()), pa.array([flat[:n].tobytes()], pa.binary()), pa.array([own], pa.list_(kind))], names=["file", "block", "tokens", "docs"])

        for batch in batches:
            kind = batch.column("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.append(bpe.encode_to_numpy(text or "", disallowed_special=()), SEPARATOR).astype(DTYPE)
                held.append(ids)
                size += len(ids)
                ends.append((size - 1, doc_id))
                while size >= block:
                    yield out(block)
        if size:
            yield out(size)

    return docs.select("doc_id", "text").mapInArrow(run, f"file int, block long, tokens binary, docs array<{dict(docs.dtypes)['doc_id']}>")


def read_token_files(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """(file, block, tokens) of the flat token files at path, whose ids are little-endian 16-bit.

    Spark has no reader of parts of such files: each is read by one task and has 2 GB at most. Corpora
    that are written here are kept as blocks (token_blocks), which have no such bound.
    """
    width = np.dtype(DTYPE).itemsize * block
    files = spark.read.format("binaryFile").load(path)
    parts = files.select(F.col("path").alias("file"), "content", F.posexplode(F.sequence(F.lit(1).cast("long"), F.greatest(F.col("length"), F.lit(1)), F.lit(width).cast("long"))).alias("block", "at"))
    return parts.select("file", F.col("block").cast("long").alias("block"), F.substring("content", F.col("at").cast("int"), F.lit(width)).alias("tokens"))


def _searched(blocks: DataFrame, separator: int) -> DataFrame:
    """(file, block, tokens, ...) to (file, block, n, seps, ...): tokens and separators' places in each block."""
    others = [c for c in blocks.columns if c not in ("file", "block", "tokens")]
    kinds = dict(blocks.dtypes)

    @lean
    def run(batches: Batches) -> Batches:
        for batch in batches:
            flat = [np.frombuffer(x or b"", DTYPE) for x in batch.column("tokens").to_pylist()]
            found = [np.flatnonzero(x == separator) for x in flat]
            columns = [batch.column("file"), batch.column("block"), pa.array([len(x) for x in flat], pa.int64()), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*columns, *(batch.column(c) for c in others)], names=["file", "block", "n", "seps", *others])

    schema = ", ".join([f"file {kinds['file']}, block long, n long, seps array<long>", *(f"{c} {kinds[c]}" for c in others)])
    return blocks.select("file", "block", "tokens", *others).mapInArrow(run, schema)


def _stitched(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """found with base, before and nth, the tokens, the last separator's place and the separators ahead of each block; and what each file's end is."""
    stretch = F.floor(F.col("block") / STRETCH)
    thin = found.select("file", "block", stretch.alias("stretch"), "n", F.size("seps").cast("long").alias("k"), F.when(F.size("seps") > 0, F.element_at("seps", -1)).alias("last"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    within = Window.partitionBy("file", "stretch").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    thin = thin.withColumn("base", zero(F.sum("n").over(within))).withColumn("last", F.col("base") + F.col("last"))
    thin = thin.withColumn("before", F.max("last").over(within)).withColumn("nth", zero(F.sum("k").over(within)))
    sums = cut(thin.groupBy("file", "stretch").agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.max("last").alias("last"), F.max("block").alias("block")))
    earlier = Window.partitionBy("file").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("o_n", zero(F.sum("n").over(earlier))).withColumn("o_k", zero(F.sum("k").over(earlier))).withColumn("last", F.col("o_n") + F.col("last"))
    sums = sums.withColumn("o_last", F.max("last").over(earlier))
    placed = thin.join(sums.select("file", "stretch", "o_n", "o_k", "o_last"), ["file", "stretch"])
    before = F.coalesce(F.col("o_n") + F.col("before"), F.col("o_last"), F.lit(-1).cast("long"))
    placed = placed.select("file", "block", (F.col("o_n") + F.col("base")).alias("base"), before.alias("before"), (F.col("o_k") + F.col("nth")).alias("nth"))
    tails = sums.groupBy("file").agg(F.sum("k").alias("document"), (F.coalesce(F.max("last"), F.lit(-1)) + 1).alias("start"), F.sum("n").alias("n"), F.max("block").alias("block"))
    return found.join(placed, ["file", "block"]), tails


def _documents(placed: DataFrame, *named: str) -> DataFrame:
    """A row for each separator, with the element of each named array that goes with it."""
    ends = F.transform("seps", lambda p: p + F.col("base"))
    starts = F.transform(F.slice(F.concat(F.array("before"), ends), F.lit(1), F.size("seps")), lambda p: p + 1)
    each = placed.where(F.size("seps") > 0).select("file", "block", "nth", F.posexplode(F.arrays_zip(starts.alias("start"), ends.alias("end"), *named)).alias("i", "x"))
    return each.select("file", (F.col("nth") + F.col("i")).alias("document"), F.col("x.start").alias("start"), (F.col("x.end") - F.col("x.start")).alias("n_tokens"), "block", *(F.col(f"x.{c}").alias(c) for c in named))


def scan(blocks: DataFrame, separator: int = SEPARATOR) -> DataFrame:
    """(file, block, tokens) to (file, document, start, n_tokens, ended, block), a row a document.

    document counts from 0 in the file, start is the place of its first token, block the one in which
    it ends. Tokens after a file's last separator are a last document with ended false. Other
    columns are ignored, null tokens are none; empty files and tables have no rows. (file, block) names a row.
    """
    placed, tails = _stitched(cut(_searched(blocks.select("file", "block", "tokens"), separator)))
    whole = _documents(placed).select("file", "document", "start", "n_tokens", F.lit(True).alias("ended"), "block")
    tails = tails.where("n > start").select("file", "document", "start", (F.col("n") - F.col("start")).alias("n_tokens"), F.lit(False).alias("ended"), "block")
    return whole.unionAll(tails)


def token_counts(docs: DataFrame, path: str = VOCABULARY, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, file, document, start, n_tokens, n_blocks.

    docs needs doc_id, of any type, and text; other columns are ignored. The documents are written as flat token
    files and counted by the scan alone. Null and empty texts have 0 tokens. Repeated rows are
    counted each for itself; an empty table gives no rows.
    """
    with written(token_blocks(docs, path, block)) as files:
        placed, _ = _stitched(cut(_searched(files, SEPARATOR)))
        blocks = F.floor((F.col("start") + F.col("n_tokens")) / block) - F.floor(F.col("start") / block) + 1
        counted = _documents(placed, "docs").select(F.col("docs").alias("doc_id"), "file", "document", "start", "n_tokens", blocks.cast("long").alias("n_blocks"))
        return cut(counted)
