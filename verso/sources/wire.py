"""Page files: JSON pages with or without gzip, catalogue, search index, images, page lists."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import padded_path

BOX = "struct<x0:int,y0:int,x1:int,y1:int>"
WORD = "struct<id:bigint,text:string,x0:int,y0:int,x1:int,y1:int,lineIdx:int,conf:double,prefix:string,suffix:string,pos:string,lemma:string,freq:double,rarity:double,isContent:int,isConnective:int>"
GUTTER = "struct<id:int,kind:string,lineIdxA:int,lineIdxB:int,polyline:array<array<int>>,minWidth:double,riverScore:double>"
DOCK = "struct<wordId:bigint,dockAbove:int,dockBelow:int,dockLeft:int,dockRight:int,slackDirection:string,ports:array<struct<x:int,y:int,gutterId:int,compass:string,nodeId:int>>>"
NODE = "struct<id:int,x:int,y:int,edges:array<struct<dst:int,cost:double,gutter:int>>>"
PAGE = f"pageNum bigint, meta struct<width:int,height:int,body:{BOX},valid:{BOX}>, words array<{WORD}>, gutters array<{GUTTER}>, docks array<{DOCK}>, graph array<{NODE}>"
CATALOG = "pages array<bigint>, chapters array<struct<pageNum:bigint,label:string,roman:string>>"


def page_list(spec: str | None, total: int) -> list[int]:
    """'1,3,5-10' to its numbers in order, repeats kept, blank parts and falling ranges dropped; None is all."""
    if spec is None:
        return list(range(1, total + 1))
    out: list[int] = []
    for part in filter(None, map(str.strip, spec.split(","))):
        first, _, last = part.partition("-")
        out += range(int(first), int(last or first) + 1)
    return out


def page_numbers(spec: Column) -> Column:
    """page_list of a column, as an array."""
    parts = F.filter(F.transform(F.split(spec, ","), lambda p: F.trim(p)), lambda p: p != "")
    ends = F.transform(parts, lambda p: F.struct(F.split(p, "-")[0].cast("int").alias("a"), F.coalesce(F.get(F.split(p, "-"), 1), F.split(p, "-")[0]).cast("int").alias("b")))
    return F.flatten(F.transform(F.filter(ends, lambda e: e["a"] <= e["b"]), lambda e: F.sequence(e["a"], e["b"])))


def page_path(base: Column | str, n: Column, suffix: str) -> Column:
    """base without one trailing slash, and the page's file."""
    b = F.lit(base) if isinstance(base, str) else base
    return F.concat(F.regexp_replace(b, "/$", ""), F.lit("/"), padded_path("p", n, suffix))


def pages(spark: SparkSession, path: str) -> DataFrame:
    """One row a page from JSON lines, plain or gzip; of a page in both forms the gzip one counts."""
    read = spark.read.schema(PAGE).json(path).withColumn("__gz", F.input_file_name().endswith(".gz"))
    best = read.groupBy("pageNum").agg(F.max("__gz").alias("__best"))
    return read.join(best, "pageNum").where("__gz = __best").drop("__gz", "__best").dropDuplicates(["pageNum"])


def page(spark: SparkSession, path: str, n: int) -> DataFrame:
    return spark.read.schema(PAGE).json(path).where(F.col("pageNum") == n)


def catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CATALOG).json(path)


def search_index(spark: SparkSession, path: str) -> DataFrame:
    """(token, page_num, cnt) of index files of maps {token: [[page, count], ...]}, one a line."""
    entries = spark.read.text(path).select(F.explode(F.from_json("value", "map<string,array<array<bigint>>>")).alias("token", "postings"))
    return entries.select("token", F.explode("postings").alias("p")).select("token", F.col("p")[0].alias("page_num"), F.col("p")[1].alias("cnt"))


def images(spark: SparkSession, path: str, suffix: str = "jpg") -> DataFrame:
    """(page_num, path, length, content) of files pNNNN.suffix."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"p*.{suffix}").load(path)
    return files.select(F.regexp_extract("path", r"p(\d+)\.[^/]*$", 1).cast("long").alias("page_num"), "path", "length", "content")


def rendered(files: DataFrame, backend: Callable[[bytes, int], bytes], wanted: list[int], offset: int = 9) -> DataFrame:
    """Pages of bound files (path, content) as images (path, page_num, content), made by backend(file, raster page from 0).

    wanted are printed page numbers, without those that are there already (see pending); a printed
    page is offset raster pages further on. A file is opened once for all of them.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                for n in wanted:
                    yield pd.DataFrame({"path": [path], "page_num": [n], "content": [backend(content, n + offset - 1)]})

    return files.select("path", "content").mapInPandas(run, "path string, page_num long, content binary")


def pending(wanted: DataFrame, done: DataFrame) -> DataFrame:
    """Pages that have no output yet."""
    return wanted.join(done.select("page_num"), "page_num", "left_anti")


def words_of(pages_: DataFrame) -> DataFrame:
    """Wire words back as the words table."""
    return pages_.select(F.col("pageNum").alias("page_num"), F.inline("words")).select("id", "page_num", "text", *(F.col(a).alias(b) for a, b in (("x0", "bbox_x0"), ("y0", "bbox_y0"), ("x1", "bbox_x1"), ("y1", "bbox_y1"), ("lineIdx", "line_idx"))), "conf", "prefix", "suffix", "pos", "lemma", F.col("freq").alias("frequency"), "rarity", F.col("isContent").alias("is_content"), F.col("isConnective").alias("is_connective"))


def tables(spark: SparkSession, url: str, names: tuple[str, ...] = ("pages", "words", "page_corrections", "page_gutters", "word_docks", "page_graph"), driver: str = "org.sqlite.JDBC") -> dict[str, DataFrame]:
    """The tables of a database by JDBC; needs the driver's jar."""
    return {n: spark.read.format("jdbc").options(url=url, dbtable=n, driver=driver).load() for n in names}
